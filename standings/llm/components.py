"""Connected components of an edge table, as joins and aggregates of Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standings.llm.common import Stage


def connected_components(edges: DataFrame, stage: Stage, name: str = "component") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternating large-star and small-star steps: each links the neighbours of a node to the
    smallest one, until every component is a star about its smallest node. A step adds up minima
    map-side and joins them back; a hot node is the skewed side of a plain join, which Spark
    splits. Each round is written to the shared folder, so lineage stays short. The root itself
    has no row unless it is asked for as a node of the result, which this does.
    """
    stars = stage.keep(_oriented(edges), f"{name}-0")
    seen, rounds = _digest(stars), 0
    while True:
        rounds += 1
        stars = stage.keep(_small_star(_large_star(stars)), f"{name}-{rounds}")
        now = _digest(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.where("a is not null and b is not null and a <> b").distinct()


def _digest(stars: DataFrame) -> tuple:
    hashes = F.xxhash64("a", "b")
    return tuple(
        stars.agg(F.count(F.lit(1)), F.sum(hashes.cast("decimal(38,0)")), F.bit_xor(hashes)).first()
    )


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("a").agg(F.min("b").alias("m"))
    moved = stars.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
