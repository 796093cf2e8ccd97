"""Views over the driver tables that stand in for ratings, items and events.

R (ratings) = lineitem JOIN orders; I (items) = part; E (event ratings) = events.
Only the needed columns are selected next to each scan so that the Parquet
reader prunes columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: user_id, item_id, rating (0.5..5.0), ts (epoch s), row_key.

    lineitem x orders is a big-big equi-join on the order key: Spark plans a
    sort-merge join (or AQE turns it into a broadcast when orders turns out
    small at run time); no forced broadcast since orders grows with the data.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ts = F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("bigint")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        (F.ceil(F.col("l_quantity") / F.lit(5)).cast("double") / F.lit(2.0)).alias("rating"),
        ts.alias("ts"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), ts.cast("string")).alias("row_key"),
    )


def items_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I: item_id, title 'name (YYYY)', genres 'a|b'."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return p.select(
        F.col("p_partkey").cast("int").alias("item_id"),
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"),
                 F.lit(")")).alias("title"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("|")).alias("genres"),
    )


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: event_id, ts (timestamp), user_id, event_type, value, props."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                    "event_type", "value", "props")


# Oracle (DuckDB) forms of the same views, used by plans/registry.py.
R_SQL = """(select cast(o_custkey as int) as user_id, cast(l_partkey as int) as item_id,
       cast(ceil(l_quantity/5) as double)/cast(2 as double) as rating,
       cast(epoch(l_shipdate) as bigint) as ts,
       concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
                 cast(l_partkey as varchar), cast(cast(epoch(l_shipdate) as bigint) as varchar)) as row_key
from lineitem join orders on l_orderkey = o_orderkey)"""

I_SQL = """(select cast(p_partkey as int) as item_id,
       concat(p_name, ' (', cast(1950 + p_size as varchar), ')') as title,
       replace(p_name, ' ', '|') as genres from part)"""

E_SQL = """(select event_id, ts, user_id, event_type, value, props from events)"""
