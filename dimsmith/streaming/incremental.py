"""Incremental maintenance of a history table from a file feed.

The maintained table must always equal the defining query over *all* feed
rows seen so far. A Type-1 change rewrites every version of its key, and a
late row can re-order a key's history, so the unit of work is the whole key.

A maintained table is a ``BucketedTable`` with two parts by key bucket: ``feed``
(every feed row seen) and ``table`` (the history). For each micro-batch
(``foreachBatch``):

1. its rows are written with the other feed rows of their buckets;
2. the affected keys are the batch's distinct keys; their whole history is
   recomputed from their feed rows and written with the history of the other
   keys of their buckets;
3. one pointer publishes both, with the stream's batch number.

So a batch reads and writes the buckets of its own keys, after any number of
batches. A writer that dies before the pointer leaves the table as it was, and
the retry starts afresh. Batches are numbered per stream: a new stream (another
name) on an existing table starts at its own number. Rows with a null key or
load time are kept, as in the full rebuild; ``not_null`` columns reject a batch
instead.
"""

from __future__ import annotations

import inspect
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.functions.joins import broadcast_if_small, same_keys
from dimsmith.operators.constraints import enforce_not_null
from dimsmith.session import scratch_path
from dimsmith.sources.bucketed import BucketedTable, buckets_for

FEED, TABLE = "feed", "table"


def read_table(spark: SparkSession, base: str, key: str | Sequence[str]) -> DataFrame:
    """The published state of the maintained table (a snapshot)."""
    return BucketedTable(spark, base, key).read(TABLE)


def committed_batch(spark: SparkSession, base: str, key: str | Sequence[str], stream: str = "default") -> int | None:
    return BucketedTable(spark, base, key).pointer.streams.get(stream)


def _history(history: Callable[..., DataFrame], feed: DataFrame, rows: int) -> DataFrame:
    """``history(feed)``, told the number of feed rows if it asks for it."""
    asks = "rows" in inspect.signature(history).parameters
    return history(feed, rows=rows) if asks else history(feed)


def refresh_batch(spark: SparkSession, base: str, batch: DataFrame, batch_id: int, key: str | Sequence[str],
                  history: Callable[..., DataFrame], buckets: int | None = None, stream: str = "default",
                  not_null: Sequence[str] = ()) -> None:
    """Apply one feed batch to the maintained table under ``base``.

    ``buckets`` is stored when the table is made; a later call with another
    count (or key) is refused. A batch at or below the stream's last published
    one has been applied already and is left out.
    """
    table = BucketedTable(spark, base, key, buckets)
    done = table.pointer.streams.get(stream)
    if done is not None and done >= batch_id:
        return
    enforce_not_null(batch, not_null)
    commit, keys = table.begin(), table.pointer.keys
    commit.check(FEED, batch)
    touched = table.buckets_of(batch)
    if touched:
        seen = table.read(FEED, touched)
        commit.rewrite(FEED, batch if seen is None else seen.select(*batch.columns).unionByName(batch), touched)
        affected = broadcast_if_small(batch.select(*keys).distinct())
        feed = commit.written(FEED)  # all rows of the touched buckets
        rows = same_keys(feed, affected, keys, "left_semi")
        renewed = _history(history, rows, feed.count())  # the count comes from the file footers
        before = table.read(TABLE, touched)
        if before is not None:
            renewed = same_keys(before, affected, keys, "left_anti").select(*renewed.columns).unionByName(renewed)
        commit.rewrite(TABLE, renewed, touched)
    commit.stream(stream, batch_id).publish()


def maintain(spark: SparkSession, feed_dir: str, base: str, key: str,
             history: Callable[..., DataFrame], *, schema=None, buckets: int | None = None,
             checkpoint_dir: str | None = None, max_files_per_trigger: int = 1,
             available_now: bool = True, processing_time: str | None = None, stream: str = "default",
             not_null: Sequence[str] = ()):
    """Start the maintenance stream over parquet files in ``feed_dir``.

    ``history`` maps feed rows (all rows of some keys) to table rows. ``stream``
    names the stream's checkpoint: batch numbers belong to it, so another
    checkpoint needs another name.
    Returns the ``StreamingQuery``; with ``available_now`` it stops once the
    files present at start are processed.
    """
    schema = schema or spark.read.parquet(feed_dir).schema
    checkpoint_dir = checkpoint_dir or os.path.join(base, f"stream_checkpoint_{stream}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(spark, base, batch, batch_id, key, history, buckets, stream, not_null)

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.parquet(feed_dir).writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def write_feed_files(feed: DataFrame, feed_dir: str, order: str = "__ldts", loads: int = 1) -> None:
    """Write the feed as files in load order, in one job.

    Rows are range-partitioned by load time into ``loads`` ranges or more; large
    loads are split further by the writer. A micro-batch may hold part of a load
    or several; maintenance does not depend on how the feed is split. Rows with
    a null load time come first."""
    (feed.repartitionByRange(max(1, loads), F.col(order).asc_nulls_first(), F.xxhash64(*feed.columns))
     .write.option("maxRecordsPerFile", 5_000_000).mode("append").parquet(feed_dir))


def incremental_history(feed: DataFrame, key: str, history: Callable[..., DataFrame],
                        order: str = "__ldts", work: str | None = None,
                        buckets: int | None = None, loads: int = 5, table_bytes: int | None = None) -> DataFrame:
    """Run the whole file-fed maintenance on ``feed`` and return the final table.

    The feed is delivered in ``loads`` files. The bucket count follows the
    bytes the table is expected to reach (by default the planner's estimate of
    the feed) and is stored with the table."""
    spark = feed.sparkSession
    work = work or scratch_path(spark, "incremental")
    feed_dir, base = os.path.join(work, "feed"), os.path.join(work, "maintained")
    write_feed_files(feed, feed_dir, order, loads)
    if table_bytes is None:
        table_bytes = int(str(spark.read.parquet(feed_dir)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    q = maintain(spark, feed_dir, base, key, history, schema=feed.schema, buckets=buckets or buckets_for(table_bytes))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_table(spark, base, key)
