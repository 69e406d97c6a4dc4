"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of ``edges``.

    Each round hangs the larger neighbours of every node on its smallest
    neighbour, then the smaller ones and the node itself; rounds go on until
    the edges stay the same, which takes about log(nodes) of them. Every round
    is written to the shared folder, and only two numbers come to the driver.
    Minima are combined before the shuffle; a node with very many neighbours is
    a skewed join, which adaptive execution splits. Null ends are no edges; an
    empty table gives an empty one.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    star = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(high.alias("u"), low.alias("v"))
    star = materialise(star.where("u <> v").distinct(), "edges")
    state = _state(star)
    while True:
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u").select("u", "v", "m")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state, before = _state(star), state
        if state == before:
            break
    centres = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)


def _state(star: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(star.agg(F.count("*"), total).first())
