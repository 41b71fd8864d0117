"""Connected components of a link table by alternating star contractions.

Links are contracted towards the smallest id of a neighbourhood until every
node hangs on its component's smallest id. Each round is two aggregations
and joins over the links; the links are landed after each round. Only a
count and a checksum reach the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import landed


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links (u > v) hung on the smallest neighbour; `both_ways` moves larger
    neighbours to it, otherwise the smaller ones and the node itself."""
    if both_ways:
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in `links` (a, b) that isn't the smallest
    of its component; component is the smallest id reachable."""
    state = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    state, before = landed(state, "links"), None
    while True:
        mark = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(mark) == before:
            return state.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = tuple(mark)
        state = landed(_star(_star(state, True), False), "links")
