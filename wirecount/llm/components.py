"""Connected components of an edge table, by alternating star steps.

Every step replaces edges by edges to the smallest neighbour; minima come from aggregates with
a map-side step, so a hub's neighbours are never gathered. Each round is written to the shared
folder and read back, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wirecount.llm.common import stored


#: Partitions over which the edges of a hub are spread where they meet its minimum.
SALTS = 16


def _meet(edges: DataFrame, least: DataFrame, hub: str, other: str) -> DataFrame:
    """``edges`` with the minimum of their ``hub`` end, the hub's edges spread over salts."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)))
    each = least.withColumn("salt", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(each, [hub, "salt"]).drop("salt")


def _round(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)``, ``a < b``; one large-star and one small-star step."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (_meet(both.where("v > u"), least, "u", "v")
             .select(F.col("m").alias("a"), F.col("v").alias("b")).where("a != b").distinct())
    # Now every edge points from its larger end b to a.
    least = large.groupBy("b").agg(F.min("a").alias("m"))
    small = _meet(large, least, "b", "a")
    return (small.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a != b")
            .union(small.select(F.col("m").alias("a"), F.col("b"))).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                    .alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``edges (a, b)``; the smallest node names it."""
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .where("a != b").distinct())
    state = _state(now)
    while state[0]:
        now = stored(_round(now))
        new = _state(now)
        if new == state:
            break
        state = new
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a"), F.col("a")).distinct())
