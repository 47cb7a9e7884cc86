"""Periodic change load (S7): append a perturbed sample every interval.

A ``rate`` source is the clock; each micro-batch appends one change batch,
numbered by the micro-batch id, to the feed path. Restarting from the same
checkpoint continues the numbering, and a retried micro-batch overwrites its
own batch partition, so every batch lands exactly once. Each batch samples the
source anew.

``run_intervals`` is the same load without a clock of its own: a
``rate-micro-batch`` source gives one tick an interval, stamped with its time,
and a run takes one tick (``availableNow``). A batch's number is the interval of
its tick's time, not the run's, so a run that is repeated or resumed after a
failure loads the batch that is due, in its own partition.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.functions.temporal import BATCH_MINUTES
from dimsmith.sources.feeds import periodic_batch

TICK_START_MS = 1_704_067_200_000  # 2024-01-01, the first tick


def start_change_task(source: DataFrame, feed_path: str, interval: str = "10 minutes",
                      n: int = 1000, seed: int = 0, key: str = "customer_id",
                      checkpoint_dir: str | None = None):
    spark = source.sparkSession
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def load(_: DataFrame, batch_id: int) -> None:
        batch = periodic_batch(source, batch_id + 1, n=n, seed=seed, key=key)
        (batch.withColumn("__batch", F.lit(batch_id + 1))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("__batch").parquet(feed_path))

    return (ticks.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint_dir or os.path.join(feed_path + "_checkpoint"))
            .trigger(processingTime=interval).start())


def load_interval(source: DataFrame, feed_path: str, number: int, n: int = 1000, seed: int = 0,
                  key: str = "customer_id") -> None:
    """Write change batch ``number`` into its own partition of the feed, whatever is there."""
    (periodic_batch(source, number, n=n, seed=seed, key=key).withColumn("__batch", F.lit(number))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__batch").parquet(feed_path))


def run_intervals(source: DataFrame, feed_path: str, checkpoint_dir: str, intervals: int, n: int = 1000, seed: int = 0,
                  key: str = "customer_id") -> None:
    """Load the next ``intervals`` change batches, by bounded runs of the stream.

    A run takes one tick; the first one after a failure also finishes the batch
    that was broken off, which counts."""
    spark = source.sparkSession
    step, loaded = BATCH_MINUTES * 60_000, 0

    def load(ticks: DataFrame, _: int) -> None:
        nonlocal loaded
        loaded += 1
        for row in ticks.select(F.unix_millis("timestamp").alias("ms")).collect():  # one tick a run
            load_interval(source, feed_path, 1 + (row.ms - TICK_START_MS) // step, n, seed, key)

    while loaded < intervals:
        ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1)
                 .option("startTimestamp", TICK_START_MS).option("advanceMillisPerBatch", step).load())
        query = (ticks.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))


def read_feed(spark: SparkSession, feed_path: str) -> DataFrame:
    """All loaded batches, without their numbers."""
    return spark.read.parquet(feed_path).drop("__batch")
