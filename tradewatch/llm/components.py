"""Connected components of a link table, by alternating large and small stars.

Each round is two aggregations with map-side combine and two joins on the node. The
aggregates are stored first, so that the joins have two plain sides, which adaptive
execution splits where one node holds many links. Rounds are written to the shared folder; nothing but two counters reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import saved


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node onto the smallest one: the larger neighbours
    (large star), or the smaller ones and the node itself (small star)."""
    least = saved(links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least-neighbours")
    hung = links.join(least, "u")
    if large:
        hung = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = hung.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return hung.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has the columns u, v (long). Gives node, root for every node that has a
    link, where root is the smallest node reachable. Empty in, empty out."""
    cur = saved(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "links")
    before = None
    while True:
        row = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == before:
            break
        before = tuple(row)
        cur = saved(_star(_both_ways(cur), True), "links-large")
        cur = saved(_star(cur.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False), "links-small")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
