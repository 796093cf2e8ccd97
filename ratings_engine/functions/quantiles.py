"""Exact and approximate quantiles without pulling a column into one task.

``exact_quantiles`` is a selection in two passes over the input. The first
takes a mergeable sketch (KLL) of the column, in two levels, so no task merges
the sketches of all others. The sketch gives each needed rank a bracket, a
value range that holds it but for a small known probability. The second
pass counts the rows between the brackets and groups the few rows inside by value;
those counts are exact and show whether a rank did fall into its bracket.
Brackets with too many distinct values are narrowed by a sketch of their own
rows first; a bracket that missed its rank is widened and counted again. The
driver sees at most ``final_rows`` values, whatever the size and distribution of the
input. Interpolation is linear between the two closest ranks, as SQL
``percentile`` / ``quantile_cont``.

``approx_quantiles`` is the one-pass mergeable sketch (``percentile_approx``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch (about 200 KB) and the groups in which sketches are merged first.
SKETCH_K, FAN = 8192, 256
INF = float("inf")


@dataclass
class Counts:
    """Exact counts of a column, cut at disjoint brackets: one entry per gap and per value inside a bracket."""

    n: int                  # rows that are not NULL or NaN
    missing: int            # NULL rows
    nan: int
    parts: list             # (is a value, lowest, highest, rows), ascending

    def value_at(self, rank: int) -> float | None:
        """The value of 0-based ``rank``; None if the rank lies in a gap with several values."""
        at = 0
        for _, lo, hi, rows in self.parts:
            if rank < at + rows:
                return lo if lo == hi else None
            at += rows
        raise IndexError(rank)

    def split(self, x: float) -> tuple[int, float, float] | None:
        """(rows below ``x``, highest value below it, lowest value from it on); None where a gap hides them."""
        below, last = 0, None
        for _, lo, hi, rows in self.parts:
            if hi < x:
                below, last = below + rows, hi
            elif lo >= x:
                return below, last, lo
            else:
                return None
        return below, last, None


def _error(k: int) -> float:
    """Rank error of a sketch as a share of its rows, several times what it keeps to in 99 of 100 cases."""
    return 6 / k ** 0.9


def sketch(v: DataFrame, k: int, *more: Column):
    """(sketch of the finite values of ``v``, further sums) as one row; merged in two levels."""
    finite = F.when((F.col("v") > -INF) & (F.col("v") < INF), F.col("v"))
    sums = [c.alias(f"_s{i}") for i, c in enumerate(more)]
    some = v.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN)).alias("_g")).agg(F.kll_sketch_agg_double(finite, F.lit(k)).alias("_k"), *sums)
    return some.agg(F.kll_merge_agg_double("_k").alias("_k"), *(F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(more))))


def _quantiles_of(one: DataFrame, probs: list[float]):
    """The row of ``sketch`` with the values of its sketch at ``probs``."""
    known = F.kll_sketch_get_n_double("_k") > 0
    return one.select("*", F.when(known, F.kll_sketch_get_quantile_double("_k", F.lit([float(p) for p in probs]))).alias("_q")).drop("_k").first()


def _merged(ranges: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _segment(ranges: list[tuple[float, float]]) -> Column:
    """0, 2, 4, ... for the gaps around the brackets, 1, 3, ... for the brackets; -1 NULL, -2 NaN."""
    v = F.col("v")
    out = F.when(v.isNull(), -1).when(F.isnan(v), -2)
    for i, (a, b) in enumerate(ranges):
        out = out.when(v < a, 2 * i).when(v <= b, 2 * i + 1)
    return out.otherwise(2 * len(ranges))


def _count(v: DataFrame, ranges: list[tuple[float, float]]) -> Counts:
    """One pass: one hash aggregate by segment and, inside brackets, by value."""
    rows = (v.select("v", _segment(ranges).alias("seg")).select("v", "seg", F.when((F.col("seg") >= 0) & (F.col("seg") % 2 == 1), F.col("v")).alias("x"))
            .groupBy("seg", "x").agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
    parts = sorted((r["seg"], r["lo"], r["hi"], r["rows"]) for r in rows if r["seg"] >= 0)
    other = {r["seg"]: r["rows"] for r in rows if r["seg"] < 0}
    return Counts(sum(p[3] for p in parts), other.get(-1, 0), other.get(-2, 0), [(seg % 2 == 1, lo, hi, n) for seg, lo, hi, n in parts])


def _narrow(v: DataFrame, a: float, b: float, ranks: list[int], k: int, final_rows: int) -> list[tuple[float, float]]:
    """Brackets within [a, b] of the given ranks (of the whole column), which hold at most about ``final_rows`` distinct values in all."""
    x = F.col("v")
    inside = v.where((x >= a) & (x <= b))
    below = v.where(x < a).count()
    n = inside.count()
    wanted = [r - below for r in ranks if 0 <= r - below < n]
    if not wanted or a == b or inside.agg(F.approx_count_distinct("v")).first()[0] <= final_rows // 2:
        return [(a, b)]
    err = _error(k)
    probs = [min(1.0, max(0.0, (r + 0.5) / n + s * err)) for r in wanted for s in (-1, 1)]
    q = _quantiles_of(sketch(inside, k), probs)["_q"]
    new = _merged([(q[2 * i], q[2 * i + 1]) for i in range(len(wanted))])
    if err * 4 * n * len(new) <= final_rows or new == [(a, b)]:
        return new
    return [y for lo, hi in new for y in _narrow(v, lo, hi, ranks, k, final_rows)]


def counts_around(df: DataFrame, col: str, ranks, extra=None, k: int = SKETCH_K, final_rows: int = 200_000) -> tuple[Counts, list[int]]:
    """Exact counts with a value for each rank of ``ranks(n)``, and those ranks. ``extra`` turns the ranks'
    brackets into further value ranges to be counted by value."""
    v = df.select(F.col(col).cast("double").alias("v"))
    x, err, slack = F.col("v"), _error(k), 1
    real = x.isNotNull() & ~F.isnan(x)
    grid = 1024             # the sketch is read at equal steps: the number of rows is not known before the pass
    one = _quantiles_of(sketch(v, k, F.count_if(real), F.count_if(x == -INF), F.count_if(x == INF)), [i / grid for i in range(grid + 1)])
    n, low, high, q = one["_s0"] or 0, one["_s1"] or 0, one["_s2"] or 0, one["_q"]
    wanted, mid = (ranks(n) if n else []), n - low - high
    inner = [r for r in wanted if low <= r < n - high]
    ends = [(x, x) for x, any_ in ((-INF, wanted and wanted[0] < low), (INF, wanted and wanted[-1] >= n - high)) if any_]
    while True:
        def bracket(r):
            p = (r - low + 0.5) / mid
            return q[max(0, math.floor((p - slack * err) * grid))], q[min(grid, math.ceil((p + slack * err) * grid))]
        own = [bracket(r) for r in inner]
        ranges = _merged(ends + own + [(a, b) for a, b in (extra(dict(zip(inner, own))) if extra and own else []) if a <= b])
        if (2 * err * slack + 2 / grid) * mid * len(inner) > final_rows:
            ranges = _merged(ends + [y for a, b in _merged(own) for y in _narrow(v, a, b, inner, k, final_rows)])
        counted = _count(v, ranges)
        if all(counted.value_at(r) is not None for r in wanted):
            return counted, wanted
        slack *= 4          # a sketch out of its bound


def value_at_rank(df: DataFrame, col: str, rank: int, k: int = SKETCH_K, final_rows: int = 200_000) -> float:
    """The value of 0-based ``rank`` in the sorted column."""
    return counts_around(df, col, lambda n: [rank], None, k, final_rows)[0].value_at(rank)


def _closest(probs: dict[str, float]):
    return lambda n: sorted({f(float(p) * (n - 1)) for p in probs.values() for f in (math.floor, math.ceil)})


def _interpolated(counted: Counts, probs: dict[str, float]) -> dict[str, float]:
    out = {}
    for name, p in probs.items():
        at = float(p) * (counted.n - 1)
        a, b, part = counted.value_at(math.floor(at)), counted.value_at(math.ceil(at)), at - math.floor(at)
        out[name] = a if a == b or not part else a + (b - a) * part
    return out


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float], k: int = SKETCH_K, final_rows: int = 200_000) -> DataFrame:
    """One row: a column per name in ``probs`` plus ``n`` (NULL/NaN ignored)."""
    counted, _ = counts_around(df, col, _closest(probs), None, k, final_rows)
    values = _interpolated(counted, probs) if counted.n else dict.fromkeys(probs)
    return df.sparkSession.createDataFrame([(*(values[name] for name in probs), counted.n)], ", ".join(f"`{x}` double" for x in probs) + ", n long")


def box_plot(df: DataFrame, col: str, reach: float = 1.5, k: int = SKETCH_K, final_rows: int = 200_000) -> DataFrame:
    """q1, median, q3, iqr, the outermost values within ``reach`` IQRs of the box, the rows beyond and all rows, in one row.

    The brackets of q1 and q3 bracket the fences too, so the second pass counts both. Where a bracket of a
    fence is not fine enough (a gap hides its neighbours), one more aggregate reads them.
    """
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}

    def fences(own: dict) -> list[tuple[float, float]]:
        b = sorted(own.values())
        (l1, h1), (l3, h3) = b[0], b[-1]
        return [(l1 - reach * (h3 - l1), h1 - reach * (l3 - h1)), (l3 + reach * (l3 - h1), h3 + reach * (h3 - l1))]

    counted, _ = counts_around(df, col, _closest(probs), fences, k, final_rows)
    rows = counted.n + counted.nan + counted.missing
    if not counted.n:
        values, ends = dict.fromkeys((*probs, "iqr")), (None, None, 0)
    else:
        values = _interpolated(counted, probs)
        values["iqr"] = values["q3"] - values["q1"]
        lo, hi = values["q1"] - reach * values["iqr"], values["q3"] + reach * values["iqr"]
        left, right = counted.split(lo), counted.split(math.nextafter(hi, INF))
        if left and right:
            ends = left[2], right[1], left[0] + counted.n - right[0] + counted.nan
        else:
            x = F.col(col).cast("double")
            ends = tuple(df.agg(F.min(F.when((x >= lo) & ~F.isnan(x), x)), F.max(F.when(x <= hi, x)), F.count_if((x < lo) | (x > hi))).first())
    return df.sparkSession.createDataFrame([(*(values[c] for c in ("q1", "median", "q3", "iqr")), *ends, rows)],
                                           "q1 double, median double, q3 double, iqr double, whisker_low double, whisker_high double, n_outliers long, n long")


def approx_quantiles(df: DataFrame, col: str, probs: dict[str, float], rel_err: float = 0.01) -> DataFrame:
    acc = max(1, int(round(1.0 / rel_err)))
    names = list(probs)
    arr = F.percentile_approx(F.col(col).cast("double"), [float(probs[k]) for k in names], acc)
    return df.agg(arr.alias("_q"), F.count(F.col(col)).alias("n")).select(
        *[F.col("_q")[i].alias(n) for i, n in enumerate(names)], "n")


#: Added before rounding, so that exact halves round up whatever the merge order of the partial variances.
HALF_UP = 1e-9


def rounded_variance(x, digits: int) -> "F.Column":
    return F.round(F.var_samp(x) + F.lit(HALF_UP), digits)


def rounded_stddev(x, digits: int) -> "F.Column":
    return F.round(F.stddev_samp(x) + F.lit(HALF_UP), digits)
