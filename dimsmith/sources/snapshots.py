"""Snapshots compared by digests of key ranges.

A table's digest has one row a range of keys: the number of rows and two sums of
64-bit row hashes, under two seeds. Sums don't depend on order or partitioning
and add up, so a table is digested by one aggregate with map-side partial sums;
two tables of any size are compared by their digests, and only ranges that
differ are read again, row by row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ("rows", "sum_a", "sum_b")


def _row_hash(columns: list[str], seed: str) -> Column:
    # The column's number and whether it is NULL take part: xxhash64 passes over NULLs.
    parts = [F.lit(seed)]
    for c in columns:
        parts += [F.col(f"`{c}`"), F.col(f"`{c}`").isNull()]
    return F.xxhash64(*parts).cast("decimal(38,0)")


def range_of(key: str, width: int) -> Column:
    return F.floor(F.col(key) / width).cast("bigint")


def range_digest(df: DataFrame, key: str, width: int) -> DataFrame:
    """(range, rows, sum_a, sum_b) of each ``width`` keys that has rows; a null key is a range of its own."""
    columns = sorted(df.columns)
    return df.groupBy(range_of(key, width).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_row_hash(columns, "a")).alias("sum_a"), F.sum(_row_hash(columns, "b")).alias("sum_b"))


def changed_ranges(left: DataFrame, right: DataFrame, key: str, width: int) -> DataFrame:
    """(range, left_rows, right_rows) of the ranges whose digests differ."""
    a, b = (range_digest(d, key, width) for d in (left, right))
    a = a.select(F.col("range").alias("ra"), *[F.col(c).alias(f"a_{c}") for c in PARTS])
    b = b.select(F.col("range").alias("rb"), *[F.col(c).alias(f"b_{c}") for c in PARTS])
    same = reduce(lambda x, y: x & y, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in PARTS])
    zero = F.lit(0).cast("bigint")
    return a.join(b, F.col("ra").eqNullSafe(F.col("rb")), "full").where(~same).select(
        F.coalesce("ra", "rb").alias("range"), F.coalesce("a_rows", zero).alias("left_rows"),
        F.coalesce("b_rows", zero).alias("right_rows"))


def changed_rows(left: DataFrame, right: DataFrame, key: str, width: int) -> DataFrame:
    """Rows of one side without their like on the other (repeats counted), with ``side``; only changed ranges are read again."""
    ranges = changed_ranges(left, right, key, width).select(F.col("range").alias("__range")).checkpoint(eager=True)
    near = [d.join(ranges, range_of(key, width).eqNullSafe(F.col("__range")), "left_semi") for d in (left, right)]
    return near[0].exceptAll(near[1].select(*left.columns)).withColumn("side", F.lit("left")).unionByName(
        near[1].exceptAll(near[0].select(*right.columns)).withColumn("side", F.lit("right")))
