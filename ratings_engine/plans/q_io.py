"""Registered source / sink / streaming queries.

Queries that write first (round trips, the streaming ingest) write under the
session's shared checkpoint folder (``spark.checkpoint.dir``), a fresh
sub-folder per call.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import scratch_path
from ..sources import tables as tb
from ..sources.views import events_view, items_view, ratings_view
from ..streaming import ingest as ig
from .registry import register

_RATE_SQL = """
w as (select cast(floor(epoch(ts) / 3) * 3 as bigint) as window_start, count(*) as rows_added
      from events group by 1),
lst as (select * from w order by window_start desc limit 60),
tot as (select count(*) as a from events),
rate as (select window_start, rows_added,
                cast(a - sum(rows_added) over () + sum(rows_added) over (order by window_start
                  rows between unbounded preceding and current row) as bigint) as total_rows,
                cast(floor(rows_added / 3) as bigint) as rows_per_sec from lst, tot)"""

TARGET = 25_000


def _parsed_fields(df):
    return df.select("user_id", "item_id", "rating", "ts")


@register("s10_publish_events", """
select cast(user_id as varchar) as key, user_id, item_id, cast(rating as float) as rating, ts from {R} r""")
def q_s10(spark, sf):
    r = ratings_view(spark, sf)
    text = r.select(*[F.col(c).cast("string").alias(w) for c, w in
                      (("user_id", "userId"), ("item_id", "movieId"), ("rating", "rating"), ("ts", "timestamp"))])
    msgs, _ = ig.publish_events(text)
    back = msgs.select("key", F.from_json("value", "userId int, movieId int, rating float, timestamp bigint")
                       .alias("d")).select("key", F.col("d.userId").alias("user_id"),
                                           F.col("d.movieId").alias("item_id"), F.col("d.rating").alias("rating"),
                                           F.col("d.timestamp").alias("ts"))
    return back


@register("s10_publish_counts", """
select count(*) as sent, cast(0 as bigint) as skipped from {R} r""")
def q_s10c(spark, sf):
    r = ratings_view(spark, sf)
    text = r.select(F.col("user_id").cast("string").alias("userId"), F.col("item_id").cast("string").alias("movieId"),
                    F.col("rating").cast("string").alias("rating"), F.col("ts").cast("string").alias("timestamp"))
    _, counts = ig.publish_events(text)
    return counts


@register("s10_publish_counts_bad_rows", """
select count(*) filter (where rating <> 0.5 and l.item_id % 7 <> 0) as sent,
       count(*) filter (where rating = 0.5 or l.item_id % 7 = 0) as skipped from {R} l""")
def q_s10_bad(spark, sf):
    """Texts that do not cast are skipped: half ratings are written as a word, some items with a letter."""
    r = ratings_view(spark, sf)
    text = r.select(F.col("user_id").cast("string").alias("userId"),
                    F.when(F.col("item_id") % 7 == 0, F.concat(F.lit("i"), "item_id")).otherwise(F.col("item_id").cast("string")).alias("movieId"),
                    F.when(F.col("rating") == 0.5, "half").otherwise(F.col("rating").cast("string")).alias("rating"),
                    F.col("ts").cast("string").alias("timestamp"))
    _, counts = ig.publish_events(text)
    return counts


@register("s13_commit_history", """
select o_orderstatus as table_name, count(*) as commits, min(cast(epoch(o_orderdate) as bigint)) * 1000 as first_commit_ms,
       max(cast(epoch(o_orderdate) as bigint)) * 1000 as last_commit_ms,
       array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') as operations
from orders where o_orderkey % 11 <> 0 group by o_orderstatus""")
def q_s13(spark, sf):
    """Orders written as commit logs, one table per status; each eleventh line is cut off and must be skipped."""
    base = scratch_path(spark, "commits")
    commit = F.struct((F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1000).alias("timestamp"),
                      F.col("o_orderpriority").alias("operation"))
    line = F.to_json(F.struct(commit.alias("commitInfo")))
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    for status, in o.select("o_orderstatus").distinct().collect():   # a handful of codes
        o.where(F.col("o_orderstatus") == status).select("value").write.text(f"{base}/{status}/_delta_log")
    h = tb.commit_history(spark, f"{base}/*/_delta_log/*.txt")
    return h.select(F.element_at(F.split("table_path", "/"), -1).alias("table_name"), "commits", "first_commit_ms",
                    "last_commit_ms", F.array_join("operations", ",").alias("operations"))


@register("p1_parse_ratings", """
select user_id, item_id, cast(rating as float) as rating, ts from {R} r""")
def q_p1(spark, sf):
    msgs = ig.wire_messages(ratings_view(spark, sf))
    raw = msgs.select("key", "value", F.lit(None).cast("timestamp").alias("kafka_timestamp"))
    return _parsed_fields(ig.parse_ratings(raw))


@register("p1_parse_props", """
select event_id, try_cast(json_extract(props, '$.k') as int) as k from events""")
def q_p1_props(spark, sf):
    e = events_view(spark, sf)
    return e.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@register("t1_ingest_stream", """
select user_id, item_id, cast(rating as float) as rating, ts from {R} r""")
def q_t1(spark, sf):
    """Wire messages are written as JSON-lines files (one per input partition),
    ingested by the streaming job (bounded files per micro-batch, availableNow),
    then the sink is read back."""
    base = scratch_path(spark, "ingest")
    src, sink, ckpt = f"{base}/source", f"{base}/sink", f"{base}/checkpoint"
    ig.wire_messages(ratings_view(spark, sf)).select("value").write.mode("overwrite").text(src)
    q = ig.ingest(spark, sink, ckpt, source="files", path=src, max_per_trigger=8, available_now=True)
    q.awaitTermination()
    return _parsed_fields(tb.read_table(spark, sink))


@register("t3_ingest_rate", "with " + _RATE_SQL + "\nselect * from rate")
def q_t3(spark, sf):
    return ig.ingest_rate(events_view(spark, sf), "ts", 3, 60)


@register("t4_ingest_progress", "with " + _RATE_SQL + f"""
, cur as (select (select a from tot) as count, (select rows_per_sec from rate order by window_start desc limit 1) as speed)
select count, {TARGET} as target, least(1.0 * count / {TARGET}, 1.0) as progress,
       greatest({TARGET} - count, 0) as remaining,
       case when speed > 0 then cast(floor(({TARGET} - count) / speed) as double) end as eta_seconds,
       case when speed > 0 then 'active' when count > 0 then 'idle' else 'empty' end as state
from cur""")
def q_t4(spark, sf):
    e = events_view(spark, sf)
    rate = ig.ingest_rate(e, "ts", 3, 60)
    cur = rate.orderBy(F.desc("window_start")).limit(1).select(F.col("rows_per_sec").alias("speed"))
    cnt = e.agg(F.count(F.lit(1)).alias("count"))
    x = cnt.crossJoin(cur)  # one row x one row
    p = ig.ingest_progress(F.col("count"), TARGET, F.col("speed"))
    return x.select("count", F.lit(TARGET).alias("target"), *[v.alias(k) for k, v in p.items()])


@register("s5_s8_write_read_table", """
select user_id, item_id, rating, ts, row_key from {R} r""")
def q_s5(spark, sf):
    path = scratch_path(spark, "table")
    tb.write_table(ratings_view(spark, sf), path, partition_cols=["rating"])
    return tb.read_table(spark, path).select("user_id", "item_id", "rating", "ts", "row_key")


@register("s6_read_first_available", """
select l_orderkey, l_linenumber from lineitem""")
def q_s6(spark, sf):
    df = tb.read_first_available(spark, [f"{sf}/no_such_table.parquet", f"{sf}/lineitem.parquet"])
    return df.select("l_orderkey", "l_linenumber")


@register("s7_read_items_csv", """
select item_id, title, genres from {I} i""")
def q_s7(spark, sf):
    path = scratch_path(spark, "items_csv")
    items_view(spark, sf).withColumnRenamed("item_id", "movieId").write.option("header", True) \
        .option("quote", '"').option("escape", '"').csv(path)
    return tb.read_items_csv(spark, path)


@register("s11_table_row_count", """
select 'lineitem' as table_name, count(*) as row_count from lineitem
union all select 'orders', count(*) from orders
union all select 'absent', cast(0 as bigint)""")
def q_s11(spark, sf):
    parts = [(n, tb.table_row_count(spark, f"{sf}/{n}.parquet")) for n in ("lineitem", "orders", "absent")]
    out = None
    for n, df in parts:
        x = df.select(F.lit(n).alias("table_name"), "row_count")
        out = x if out is None else out.unionByName(x)
    return out


@register("s12_sample_records", """
select user_id, item_id, rating, ts, strftime(epoch_ms(ts * 1000), '%Y-%m-%d %H:%M:%S') as datetime
from {R} r order by ts desc, row_key limit 8""")
def q_s12(spark, sf):
    r = ratings_view(spark, sf)
    s = tb.sample_records(r.select("user_id", "item_id", "rating", "ts", "row_key"), 8, ["ts", "row_key"], "ts",
                          wire=["user_id", "item_id", "rating", "ts", "row_key"])
    return s.select("user_id", "item_id", "rating", "ts",
                    F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"))
