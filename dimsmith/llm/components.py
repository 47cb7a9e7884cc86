"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import reliable

# A node with many neighbours is joined in this many parts.
SALTS = 8


def salted_join(many: DataFrame, one: DataFrame, key: str, spread: str) -> DataFrame:
    """``many`` joined with one row for each ``key``; rows of a hot key meet in ``SALTS`` tasks."""
    salted = many.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = one.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, [key, "__salt"]).drop("__salt")


def connected(edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = reliable) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b); root is the smallest node reached.

    Each round ends in ``cut`` (a checkpoint); the loop ends when a round leaves the edge
    set as it was. An empty edge table gives an empty result.
    """
    now = cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = salted_join(both, least, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, least, "u", "v").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
