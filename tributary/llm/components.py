"""Connected components of an edge table by alternating stars; nothing of the graph passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("least"))
    joined = large.join(least, "a")
    small = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return small.where("a > b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has an edge; a component is named by its smallest node.

    Each round is a few grouped minima and equi-joins whose result is written to the shared folder, so a lost
    executor costs one round at most. A node with very many edges is pre-aggregated and its join can be split by AQE.
    Edges with a null end and loops are ignored; repeated edges count once; no edges give an empty table.
    """
    now = materialize(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a > b").distinct(), "edges")
    mark = _mark(now)
    while True:
        then, now = mark, materialize(_stars(now), "edges")
        mark = _mark(now)
        if mark == then:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
