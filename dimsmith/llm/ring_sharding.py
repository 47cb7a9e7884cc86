"""Consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

The ring has ``SLOTS`` places. A document's key hashes to a place; a shard owns
``VNODES`` places. A document belongs to the first virtual node clockwise from
its place; where that shard is full, it goes on clockwise. With capacities that
add up to the number of documents (each floor or ceiling of the mean), every
shard ends exactly full: the law is ``rows`` (counts at most one apart).

A virtual node's place follows from its shard and number, so a further shard
brings nodes of its own and leaves the others where they are: it takes about
its share of the rows, and few rows move between old shards.

Only the number of documents per ring place is looked at to plan the overflow
(a table of at most ``SLOTS`` rows). Rows are then ranked inside (place, salt);
the salt is a hash of the row, so neither the order nor the partitions of the
input decide where a row goes, and a place that holds a third of all rows (say
a null ``doc_id``) is ranked in many tasks. Equal rows are ranked as one row
with a count for each input partition.

Null ids share one place; a null text has size 1 and crc32 0; repeated rows are
rows of their own, each with a slot of its own. Any number of documents works,
also fewer than shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import reliable

SLOTS = 4096
VNODES = 64
SALTS = 64


def ring(spark: SparkSession, shards: int, vnodes: int = VNODES, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes in clockwise order.

    A node's place follows from its shard and number; where that is taken by a
    node of a lower shard or number, it gets the next free one.
    """
    if shards * vnodes > slots:
        raise ValueError("more virtual nodes than ring places")
    node = F.col("id")
    placed = (spark.range(shards * vnodes, numPartitions=1)
              .select(F.pmod(F.xxhash64(F.lit("node"), node), F.lit(slots)).alias("place"),
                      F.floor(node / vnodes).cast("int").alias("shard"), node.alias("n"))
              .orderBy("n").collect())
    taken: dict[int, int] = {}
    for row in placed:
        place = row["place"]
        while place in taken:
            place = (place + 1) % slots
        taken[place] = row["shard"]
    return sorted(taken.items())


def fill(counts: dict[int, int], nodes: list[tuple[int, int]], shards: int,
         slots: int = SLOTS) -> list[tuple[int, int, int, int, int]]:
    """Bounded loads from the row count of each place.

    Returns pieces (place, first rank, end rank, shard, first slot). All places
    first fill their own node's shard, in ring order; what finds it full goes
    on to the next node, and so on.
    """
    total = sum(counts.values())
    room = [total // shards + (1 if s < total % shards else 0) for s in range(shards)]
    used = [0] * shards
    left = {p: n for p, n in sorted(counts.items()) if n}
    given = dict.fromkeys(left, 0)
    at, node = {}, 0
    for place in left:
        while node < len(nodes) and nodes[node][0] < place:
            node += 1
        at[place] = node % len(nodes)
    pieces = []
    while left:
        for place in list(left):
            shard = nodes[at[place]][1]
            take = min(left[place], room[shard] - used[shard])
            if take:
                pieces.append((place, given[place], given[place] + take, shard, used[shard]))
                given[place] += take
                used[shard] += take
                left[place] -= take
            if left[place]:
                at[place] = (at[place] + 1) % len(nodes)
            else:
                del left[place]
    return pieces


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
          vnodes: int = VNODES, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under ``rows``)."""
    spark = docs.sparkSession
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    row = ["place", "salt", "doc_id", "text_crc32", "size"]
    size = (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1).cast("long")
    # Equal rows of an input partition are one row with a count; nothing else tells them apart.
    alike = reliable(docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32")).select(
        F.pmod(F.xxhash64(F.lit("key"), "doc_id"), F.lit(slots)).alias("place"),
        F.pmod(F.xxhash64(F.lit("salt"), "doc_id", "text_crc32", "size"), F.lit(SALTS)).alias("salt"),
        "doc_id", "text_crc32", "size", F.spark_partition_id().alias("part")).groupBy(*row, "part").agg(F.count(F.lit(1)).alias("n")))
    # Ranks inside (place, salt), then the rows of lower salts at that place.
    groups = alike.groupBy("place", "salt").agg(F.sum("n").alias("n"))
    before = groups.select("place", "salt", (F.sum("n").over(
        Window.partitionBy("place").orderBy("salt")) - F.col("n")).alias("before"))
    counts = {r["place"]: r["n"] for r in groups.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    pieces = fill(counts, ring(spark, shards, vnodes, slots), shards, slots)
    plan = spark.createDataFrame(
        pieces, "p_place long, p_from long, p_to long, shard int, p_slot long")
    order = Window.partitionBy("place", "salt").orderBy(*row[2:], "part").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (alike.withColumn("upto", F.sum("n").over(order))
              .join(before, ["place", "salt"])
              .select(*row, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"),
                      (F.col("before") + F.col("upto") - F.col("n")).alias("from"))
              .withColumn("rank", F.col("from") + F.col("k")))
    # At most one piece for each place and shard: ``slots`` * shards rows.
    placed = ranked.join(F.broadcast(plan), (F.col("place") == F.col("p_place")) & (F.col("rank") >= F.col("p_from"))
                         & (F.col("rank") < F.col("p_to")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("p_slot") + F.col("rank") - F.col("p_from")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
