"""Skew-safe ordered numbering within a group (row_number and lag).

An ordered window partitioned by user puts every row of a user into one
task. If one user holds a third of the table, that task holds a third of the
table. ``ordered_sequence`` splits such hot groups:

1. A partial aggregate counts rows per key. Keys with more than ``hot_rows``
   rows are hot; there are at most total/hot_rows of them, so the hot-key
   table has a proven bound and is broadcast.
2. Cold keys use the plain window: each of their groups holds at most
   ``hot_rows`` rows.
3. Rows of hot keys are range-partitioned on (key, order...) into
   ``ceil(hot rows / rows_per_task)`` partitions -- balanced by row count
   whatever the time distribution, since the order ends in a unique column --
   and written once with their partition id under the shared checkpoint
   folder, so every later read agrees on the split (and a lost executor
   re-reads files rather than re-sampling the range bounds).
4. The window runs on (key, partition): row_number and lag are local.
5. Per (hot key, partition) counts and last values (bounded: hot keys x
   partitions rows) give each slice its offset and the value preceding it;
   a broadcast join adds them back.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_ROWS_PER_TASK = 2_000_000
#: From this many rows per hot key on, the hot-key table of a join (total/hot_rows rows at most) is broadcast.
BROADCAST_HOT_ROWS = 10


def hot_keys(counts: DataFrame, key: str | list[str], count_col: str, hot_rows: int = DEFAULT_HOT_ROWS):
    """(hot-key table with ``_n``, number of hot keys, their rows) from a
    per-key count table; one small action. The table has at most
    total/hot_rows rows."""
    keys = [key] if isinstance(key, str) else list(key)
    hot = counts.where(F.col(count_col) > hot_rows).select(*keys, F.col(count_col).alias("_n"))
    s = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows")).first()   # one row
    return hot, int(s["keys"]), int(s["rows"] or 0)


def ordered_sequence(df: DataFrame, key: str, order: list[str], lag_col: str, *,
                     rn_col: str = "rating_order", prev_col: str = "_prev",
                     hot_rows: int = DEFAULT_HOT_ROWS, rows_per_task: int | None = None,
                     hot: tuple | None = None) -> DataFrame:
    """Add ``rn_col`` = row_number() over (partition by key order by order) and
    ``prev_col`` = lag(lag_col) over the same window. ``order`` should end in
    a unique tie-break column so that the numbering is deterministic.
    ``hot`` may pass a precomputed ``hot_keys(...)`` result.
    """
    from ..config import materialize

    rows_per_task = rows_per_task or DEFAULT_ROWS_PER_TASK
    if hot is None:
        hot = hot_keys(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, "_n", hot_rows)
    hot, n_hot_keys, n_hot_rows = hot
    summary = {"keys": n_hot_keys, "rows": n_hot_rows}
    w = Window.partitionBy(key).orderBy(*order)
    plain = {rn_col: F.row_number().over(w), prev_col: F.lag(lag_col).over(w)}
    if not summary["keys"]:
        return df.withColumns(plain)

    # null-safe: a hot NULL key is split like any other key
    hk = hot.select(F.col(key).alias("_hk"), F.lit(True).alias("_hot"))
    flagged = df.join(F.broadcast(hk), F.col(key).eqNullSafe(F.col("_hk")), "left").drop("_hk")  # <= total/hot_rows
    cold = flagged.where(F.col("_hot").isNull()).drop("_hot").withColumns(plain)

    parts = max(1, math.ceil(summary["rows"] / rows_per_task))
    hot_rows_df = flagged.where(F.col("_hot")).drop("_hot")
    sliced = materialize(hot_rows_df.repartitionByRange(parts, key, *order)
                         .withColumn("_pid", F.spark_partition_id()), "hot_slices")
    wl = Window.partitionBy(key, "_pid").orderBy(*order)
    local = sliced.withColumns({"_lrn": F.row_number().over(wl), "_lprev": F.lag(lag_col).over(wl)})
    stats = sliced.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_c"),
                                             F.max_by(lag_col, F.struct(*order)).alias("_last"))
    ws = Window.partitionBy(key).orderBy("_pid")   # at most `parts` rows per hot key
    stats = stats.select(
        key, "_pid",
        F.coalesce(F.sum("_c").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lag("_last").over(ws).alias("_plast"))
    stats = stats.withColumnRenamed(key, "_sk").withColumnRenamed("_pid", "_spid")
    cond = F.col(key).eqNullSafe(F.col("_sk")) & (F.col("_pid") == F.col("_spid"))
    hot_out = local.join(F.broadcast(stats), cond, "left").drop("_sk", "_spid").withColumns({   # hot keys x parts
        rn_col: (F.col("_lrn") + F.col("_off")).cast("int"),
        prev_col: F.when(F.col("_lrn") == 1, F.col("_plast")).otherwise(F.col("_lprev")),
    }).drop("_pid", "_lrn", "_lprev", "_off", "_plast")
    return cold.unionByName(hot_out.select(*cold.columns))


def salted_join(df: DataFrame, stats: DataFrame, key: str | list[str], count_col: str, salt_cols: list[str], *,
                hot_rows: int = DEFAULT_HOT_ROWS, how: str = "left", hot: tuple | None = None) -> DataFrame:
    """Join per-key ``stats`` (one row per key, with its row count in
    ``count_col``) back to the rows ``df`` without a hot key landing in one task.
    ``key`` is one column or several.

    Keys with more than ``hot_rows`` rows get ``ceil(count / hot_rows)`` salts:
    their rows pick a salt from a hash of ``salt_cols`` (deterministic, so a
    re-run picks the same) and their single stats row is replicated once per
    salt. The hot-key table is bounded by total/hot_rows rows and the
    replicated stats by about total/hot_rows + hot keys rows. Cold keys keep
    salt 0, so the join is one shuffle on (key, salt) with no skewed partition.
    Without ``hot`` the salting is planned unconditionally (no action); with
    a ``hot_keys`` result showing no hot key it is the plain join.

    Below ``BROADCAST_HOT_ROWS`` nearly every key may be hot: the hot-key table then grows with the rows and is not
    broadcast. It meets the rows in a salted join of its own, at a threshold that bounds the table it broadcasts.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if hot is not None and not hot[1]:   # known: no hot key -> the plain join (AQE still guards at run time)
        return _null_safe(df, stats, keys, how)
    hot_table = hot[0] if hot is not None else stats.select(*keys, F.col(count_col).alias("_n")) \
        .where(F.col("_n") > hot_rows)
    if hot_rows < BROADCAST_HOT_ROWS:
        salts = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
        hot = hot_table.select(*keys, salts.alias("_ns"))
        x = salted_join(df, hot_table.select(*keys, "_n"), keys, "_n", salt_cols).withColumn("_ns", salts).drop("_n")
    else:
        hot = F.broadcast(hot_table.select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_ns")))
        x = _null_safe(df, hot, keys, "left")
    x = x.withColumn("_salt", F.when(F.col("_ns").isNull(), F.lit(0))
                     .otherwise(F.pmod(F.xxhash64(*salt_cols), F.col("_ns"))).cast("int")).drop("_ns")
    s = _null_safe(stats, hot, keys, "left")
    s = s.withColumn("_salt", F.explode(F.when(F.col("_ns").isNull(), F.array(F.lit(0)))
                                        .otherwise(F.sequence(F.lit(0), F.col("_ns") - 1)))).drop("_ns")
    return _null_safe(x, s, [*keys, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, order: list, out: str) -> DataFrame:
    """Number the rows from 0 in the total order of ``order`` (unique), without one task that holds them all:
    range-partitioned, written once with the partition id, numbered within each partition, and moved by
    the sizes of the partitions before (one row per partition)."""
    from ..config import materialize

    parts = materialize(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c")).select(
        "_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1
    return parts.withColumn(out, local).join(F.broadcast(offsets), "_pid").withColumn(out, F.col(out) + F.col("_off")).drop("_pid", "_off")


def _null_safe(x: DataFrame, s: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL meets NULL (a window groups NULL keys too)."""
    s = s.withColumnsRenamed({k: f"_s_{k}" for k in keys})
    on = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys))
    return x.join(s, on, how).drop(*(f"_s_{k}" for k in keys))
