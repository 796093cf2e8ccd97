"""Data-quality measurement and repair.

Every measure is one aggregate pass (``count_if`` per column, not one job per
column); user-level checks are ``groupBy`` aggregates with partial
aggregation, so a user or a duplicate group holding a third of the rows is
reduced map-side before any shuffle. Nothing is collected to the driver:
flagged users are removed with an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COLS, DEFAULTS, Cols, materialize
from ..functions.quantiles import approx_quantiles, exact_quantiles, rounded_stddev
from .windows import DEFAULT_HOT_ROWS, hot_keys, salted_join

CRITICAL = (COLS.user, COLS.item, COLS.rating, COLS.ts)


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return (c.isNull() | F.isnan(c)) if _is_float(df, name) else c.isNull()


def remove_out_of_range(df: DataFrame, lo: float = DEFAULTS.rating_min, hi: float = DEFAULTS.rating_max,
                        col: str = COLS.rating) -> DataFrame:
    """Keep lo <= value <= hi (pushed to the Parquet scan when adjacent)."""
    return df.where(F.col(col).between(lo, hi))


def drop_missing(df: DataFrame, cols=CRITICAL) -> DataFrame:
    """Drop rows with NULL (or NaN for float columns) in any listed column present."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    cond = None
    for name in present:
        m = _missing(df, name)
        cond = m if cond is None else (cond | m)
    return df.where(~cond)


def missing_report(df: DataFrame, digits: int = 4) -> DataFrame:
    """Per column null (or NaN) count and percentage, in one scan.

    Returns (column_name, null_count, null_pct, total_rows, total_cells); pct
    is 0 on an empty table.
    """
    names = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(_missing(df, n)).alias(f"_m{i}") for i, n in enumerate(names)])
    long = one.select("_total", F.inline(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"_m{i}").alias("null_count"))
        for i, n in enumerate(names)])))
    pct = F.when(F.col("_total") > 0,
                 F.round(F.col("null_count") / F.col("_total") * 100, digits)).otherwise(F.lit(0.0))
    return long.select("column_name", "null_count", pct.alias("null_pct"), F.col("_total").alias("total_rows"),
                       (F.col("_total") * len(names)).alias("total_cells"))


def duplicate_report(df: DataFrame, keys=(COLS.user, COLS.item, COLS.ts)) -> DataFrame:
    """Key groups occurring more than once, with their size."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).where(F.col("dup_count") > 1)


def duplicate_extra(df: DataFrame, keys=(COLS.user, COLS.item, COLS.ts)) -> DataFrame:
    """One row -- number of duplicate groups and sum(count - 1), 0 when none."""
    d = duplicate_report(df, keys)
    return d.agg(F.count(F.lit(1)).alias("dup_groups"),
                 F.coalesce(F.sum(F.col("dup_count") - 1), F.lit(0)).cast("bigint").alias("dup_extra"))


def _leading(df: DataFrame, name: str) -> Column:
    """A fixed-width value that orders as the column does, as far as it goes: the column itself, or the
    first eight bytes of a text as a number (an aggregate over it is hash-based; over a text it would sort)."""
    t = df.schema[name].dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        first = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 8)), 16, "0")
        return F.conv(first, 16, 10).cast("decimal(20,0)")
    if isinstance(t, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
        return F.col(name)
    return F.lit(0)


def remove_duplicates(df: DataFrame, keys=(COLS.user, COLS.item, COLS.ts),
                      order=(COLS.ts, COLS.key), hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """One row per key -- the first by ``order``, then by the remaining columns (deterministic
    "keep first"; NULLs come first).

    Two phases. A hash aggregate over fixed-width values counts each key and
    finds the least leading order value; keys that occur once need nothing more,
    which is the mass of the rows: they pass through a join that keeps what has
    no repeated key. Of a repeated key only the rows with the least leading
    value are ordered in full. Copies that are equal in all columns are merged
    before, and a key with more than ``hot_rows`` copies is salted, so no task holds
    a large copy group. The repeated keys are written once (an action); without any, ``df``
    itself is the result. Pass ``order=None`` for the reference's keep-any
    ``dropDuplicates``.
    """
    keys = list(keys)
    if order is None:
        return df.dropDuplicates(keys)
    ordered = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
    if not ordered:
        return df.dropDuplicates(keys)
    lead = _leading(df, ordered[0])
    none = F.col(ordered[0]).isNull()
    repeated = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), F.min(lead).alias("_least"), F.max(none).alias("_none"))
                           .where("_copies > 1"), "repeated")
    if repeated.isEmpty():
        return df
    x = salted_join(df, repeated, keys, "_copies", ordered, hot_rows=hot_rows, hot=hot_keys(repeated, keys, "_copies", hot_rows))
    once = x.where("_copies is null").select(*df.columns)
    first = F.when(F.col("_none"), none).otherwise(lead == F.col("_least"))
    copies = x.where(F.col("_copies").isNotNull() & first).select(*df.columns).distinct()
    w = Window.partitionBy(*keys).orderBy(*ordered)
    return once.unionByName(copies.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first"))


def iqr_bounds(df: DataFrame, col: str = COLS.rating, exact: bool = True,
               rel_err: float = DEFAULTS.quantile_rel_err, k: float = 1.5) -> DataFrame:
    """q1, median, q3, iqr and the k*IQR fences (one row).

    ``exact`` selects in two passes (``functions.quantiles``); otherwise
    ``percentile_approx`` with accuracy 1/rel_err, like ``approxQuantile``.
    """
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    q = exact_quantiles(df, col, probs) if exact else approx_quantiles(df, col, probs, rel_err)
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "median", "q3", iqr.alias("iqr"),
                    (F.col("q1") - k * iqr).alias("lower_bound"), (F.col("q3") + k * iqr).alias("upper_bound"))


def outlier_counts(df: DataFrame, bounds: DataFrame, col: str = COLS.rating,
                   valid_lo: float = DEFAULTS.rating_min, valid_hi: float = DEFAULTS.rating_max) -> DataFrame:
    """Rows strictly outside the IQR fences, and outside the valid range, in one pass."""
    v = F.col(col)
    j = df.select(v.alias("_v")).crossJoin(F.broadcast(bounds))  # one-row side
    counts = j.agg(
        F.count_if((F.col("_v") < F.col("lower_bound")) | (F.col("_v") > F.col("upper_bound")))
        .alias("outlier_count"),
        F.count_if((F.col("_v") < valid_lo) | (F.col("_v") > valid_hi)).alias("invalid_count"))
    return bounds.crossJoin(F.broadcast(counts))  # one row each, also for an empty input


def hyperactive_users(df: DataFrame, min_count: int = DEFAULTS.hyperactive_min, c: Cols = COLS) -> DataFrame:
    """Users with more than ``min_count`` ratings; round(avg,2), round(stddev,2)."""
    return (df.groupBy(c.user)
            .agg(F.count(F.lit(1)).alias("rating_count"),
                 F.round(F.avg(c.rating), 2).alias("avg_rating"),
                 rounded_stddev(F.col(c.rating), 2).alias("stddev_rating"))
            .where(F.col("rating_count") > min_count))


def suspicious_users(df: DataFrame, min_n: int = DEFAULTS.suspicious_min_n,
                     max_sd: float = DEFAULTS.suspicious_max_sd, c: Cols = COLS) -> DataFrame:
    """Count >= min_n and (round(stddev,4) < max_sd or stddev NULL)."""
    s = (df.groupBy(c.user)
         .agg(F.count(F.lit(1)).alias("rating_count"),
              F.round(F.avg(c.rating), 3).alias("avg_rating"),
              rounded_stddev(F.col(c.rating), 4).alias("stddev_rating"))
         .where(F.col("rating_count") >= min_n))
    return s.where((F.col("stddev_rating") < max_sd) | F.col("stddev_rating").isNull())


def exclude_users(df: DataFrame, flagged: DataFrame, c: Cols = COLS, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Remove the rows of flagged users (no driver-side id list).

    Flagged users are often the busiest ones: where ``flagged`` carries their
    ``rating_count``, the rows of those above ``hot_rows`` are salted over
    several join tasks. A NULL user is never removed.
    """
    if "rating_count" not in flagged.columns:
        return df.join(flagged.select(c.user), c.user, "left_anti")
    gone = flagged.where(F.col(c.user).isNotNull()).groupBy(c.user).agg(F.max("rating_count").alias("_flagged"))
    salt = [c.key] if c.key in df.columns else [x for x in (c.ts, c.item) if x in df.columns] or df.columns
    return salted_join(df, gone, c.user, "_flagged", salt, hot_rows=hot_rows).where("_flagged is null").drop("_flagged")


def clean(df: DataFrame, keys=(COLS.user, COLS.item, COLS.ts), order=(COLS.ts, COLS.key),
          lo: float = DEFAULTS.rating_min, hi: float = DEFAULTS.rating_max) -> DataFrame:
    """The reference's repair order: drop missing -> de-duplicate -> valid range."""
    return remove_out_of_range(remove_duplicates(drop_missing(df), keys, order), lo, hi)


def quality_report(df: DataFrame, keys=(COLS.user, COLS.item, COLS.ts), order=(COLS.ts, COLS.key),
                   lo: float = DEFAULTS.rating_min, hi: float = DEFAULTS.rating_max,
                   hyper_min: int = DEFAULTS.hyperactive_min, susp_min_n: int = DEFAULTS.suspicious_min_n,
                   susp_sd: float = DEFAULTS.suspicious_max_sd, exact: bool = True,
                   rel_err: float = DEFAULTS.quantile_rel_err, c: Cols = COLS,
                   materialize_dedup: bool = True) -> DataFrame:
    """The whole cleaning report as one row.

    Steps as in the reference: missing report on the input, drop missing,
    duplicates measured then removed, IQR on the de-duplicated rows, invalid
    range removed, then hyperactive / suspicious users on the valid rows
    (reported, not removed). Every part is a one-row aggregate; they are
    combined with one-row cross products.

    The de-duplicated rows feed three measures (IQR, outliers, user checks);
    with ``materialize_dedup`` they are written once under the shared
    checkpoint folder instead of re-running the de-duplication shuffle three times.
    """
    miss = missing_report(df)
    miss_one = miss.groupBy("total_rows").agg(
        F.sum("null_count").alias("missing_total"),
        *[F.sum(F.when(F.col("column_name") == n, F.col("null_count"))).alias(f"missing_{n}_count")
          for n in df.columns],
        *[F.max(F.when(F.col("column_name") == n, F.col("null_pct"))).alias(f"missing_{n}_pct")
          for n in df.columns]).withColumnRenamed("total_rows", "rows_before")
    nonmissing = drop_missing(df, list(CRITICAL))
    dups = duplicate_extra(nonmissing, keys).select(F.col("dup_extra").alias("duplicate_rows"))
    dedup = remove_duplicates(nonmissing, keys, order)
    if materialize_dedup:
        dedup = materialize(dedup, "dedup")
    b = iqr_bounds(dedup, c.rating, exact, rel_err)
    oc = outlier_counts(dedup, b, c.rating, lo, hi)
    valid = remove_out_of_range(dedup, lo, hi)
    users = (valid.groupBy(c.user).agg(F.count(F.lit(1)).alias("n"), rounded_stddev(F.col(c.rating), 4).alias("sd"))
             .agg(F.sum("n").alias("rows_after"),
                  F.count_if(F.col("n") > hyper_min).alias("hyperactive_users"),
                  F.count_if((F.col("n") >= susp_min_n) &
                             ((F.col("sd") < susp_sd) | F.col("sd").isNull())).alias("suspicious_users")))
    out = (miss_one.crossJoin(dups).crossJoin(oc).crossJoin(users)
           .withColumn("rows_after", F.coalesce("rows_after", F.lit(0)).cast("bigint")))
    removed = F.col("rows_before") - F.col("rows_after")
    return out.withColumns({
        "rows_removed": removed,
        "rows_removed_pct": F.when(F.col("rows_before") > 0,
                                   F.round(removed / F.col("rows_before") * 100, 4)).otherwise(F.lit(0.0)),
    })
