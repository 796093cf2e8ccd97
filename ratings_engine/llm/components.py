"""Connected components of a link table, kept distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import discard, materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` -> one row ``(node, component)`` per linked node, where
    component is the smallest node reachable.

    Each round alternates two star contractions over an edge table that points
    from larger to smaller nodes: every neighbour of a node is tied to the
    smallest node around it. The table never holds more rows than it began with, a
    chain halves in each round, and each round is a written table, so a lost
    executor costs one round. Self links and repeated links do no harm.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        tied = both.join(low, "u")
        if large:
            out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def state(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    seen = state(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        mid = materialize(star(edges, True), "edges")
        new = materialize(star(mid, False), "edges")
        discard(edges, mid)
        edges, now = new, state(new)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    low = edges.groupBy("u").agg(F.min("v").alias("component"))
    return low.select(F.col("u").alias("node"), "component").unionByName(
        low.select(F.col("component").alias("node"), "component").distinct())
