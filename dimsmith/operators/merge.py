"""Type-2 MERGE of the newest feed batch into a dimension table.

``scd2_merge_changes`` classifies every row of a batch against the current
dimension with **one** join instead of three:

* the dimension is first reduced to the keys of the batch (semi-join; the
  batch keys are broadcast when their measured bytes are small, so the large
  dimension is streamed once and never shuffled; beyond the bound a Bloom filter
  of them is, and only the rows that pass it are shuffled to the exact join),
* each touched key is summarised to its latest row (``max`` of a struct whose
  first field is the version, deterministic even on a broken dimension),
* the batch is left-joined to that summary and each row emits zero, one or two
  change rows: ``new recs`` (key unknown), ``t2 insert`` (version + 1) and
  ``t2 expire`` (old latest row closed one microsecond before the new one).

``merge_upsert`` applies changes keyed on ``(key, __rec_version)``: matched
rows are replaced, the rest inserted (anti-join + union; the change keys are
broadcast under the same size check). ``scd2_merge`` materialises the change
set once (it is bounded by twice the batch) so it is not recomputed for the
anti-join and the union. It is idempotent:
merging the same batch twice changes nothing, because the hashes then match.
As in the source MERGE, only the newest batch is read; keys absent from the
batch are never closed, and a skipped batch is never merged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.functions.hashing import diff_hash, null_hash
from dimsmith.functions.joins import BROADCAST_MAX_BYTES, broadcast_if_small
from dimsmith.functions.keysets import semi_join
from dimsmith.functions.temporal import high_date, minus_tick
from dimsmith.operators.constraints import enforce_not_null, enforce_unique
from dimsmith.sources.bucketed import BucketedTable

UPDATE_TYPE = "__tmp_update_type"
# Fixed labels of the three change kinds.
NEW_RECS, T2_INSERT, T2_EXPIRE = "new recs", "t2 insert", "t2 expire"


def newest_batch(feed: DataFrame, order: str = "__ldts") -> DataFrame:
    """Rows of the newest load only (scalar subquery, evaluated once)."""
    return feed.where(F.col(order) == feed.select(F.max(order)).scalar())


def stage_batch(batch: DataFrame, key: str, payload: Sequence[str], order: str = "__ldts",
                hashed: Sequence[str] | None = None, batch_ts: Column | None = None) -> DataFrame:
    """Batch rows in dimension shape, as brand-new versions.

    ``batch_ts`` stamps ``__create_dts``/``__update_dts`` (the MERGE run time);
    by default the batch's own load time, so a replay is reproducible."""
    ts = F.col(order) if batch_ts is None else batch_ts
    hashed = list(hashed) if hashed else [key, *payload]
    return batch.select(
        F.col(key),
        F.col(order).alias("__from_dts"),
        high_date().alias("__to_dts"),
        *payload,
        F.col(order).alias("__load_dts"),
        F.lit(1).cast("bigint").alias("__rec_version"),
        F.lit(True).alias("__is_latest"),
        ts.alias("__create_dts"),
        ts.alias("__update_dts"),
        diff_hash(hashed).alias("__t2diff_hash"),
        null_hash().alias("__t1diff_hash"),
    )


def empty_dimension(feed: DataFrame, key: str, payload: Sequence[str], order: str = "__ldts") -> DataFrame:
    schema = stage_batch(feed, key, payload, order).schema
    return feed.sparkSession.createDataFrame([], schema)


def scd2_merge_changes(dim: DataFrame, batch: DataFrame, key: str, payload: Sequence[str],
                       order: str = "__ldts", hashed: Sequence[str] | None = None,
                       batch_ts: Column | None = None,
                       broadcast_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """Change rows (dimension columns + ``__tmp_update_type``) for one batch."""
    staged = stage_batch(batch, key, payload, order, hashed, batch_ts)
    cols = staged.columns
    rest = [c for c in cols if c != key]

    touched = semi_join(dim, staged, [key], broadcast_bytes)
    cur = F.max(F.when(F.col("__is_latest"),
                       F.struct(*[F.col(c) for c in ["__rec_version", *[c for c in rest if c != "__rec_version"]]])))
    state = touched.groupBy(key).agg(cur.alias("__cur")).withColumn("__known", F.lit(True))

    j = staged.join(state, key, "left")
    c = F.col("__cur")
    is_new = F.col("__known").isNull()
    changed = c.isNotNull() & (F.col("__t2diff_hash") != c["__t2diff_hash"])

    def row(values: dict[str, Column], label: str) -> Column:
        return F.struct(*[values.get(n, F.col(n)).alias(n) for n in cols], F.lit(label).alias(UPDATE_TYPE))

    new_row = row({}, NEW_RECS)
    insert_row = row({"__rec_version": c["__rec_version"] + 1,
                      "__create_dts": c["__create_dts"]}, T2_INSERT)
    expire_vals = {n: c[n] for n in rest}
    expire_vals.update({"__to_dts": minus_tick(F.col("__from_dts")),
                        "__is_latest": F.lit(False)})
    expire_row = row(expire_vals, T2_EXPIRE)

    rows = F.array(F.when(is_new, new_row), F.when(changed, insert_row), F.when(changed, expire_row))
    return j.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))


def merge_upsert(dim: DataFrame, changes: DataFrame, keys: Sequence[str],
                 broadcast_bytes: int | None = None) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE ALL WHEN NOT MATCHED INSERT ALL, on ``keys``.

    Pass ``broadcast_bytes`` only for a materialised (cheap to count) change set."""
    upd = changes.drop(UPDATE_TYPE) if UPDATE_TYPE in changes.columns else changes
    upd = upd.select(*dim.columns)
    change_keys = broadcast_if_small(upd.select(*keys), broadcast_bytes)
    return dim.join(change_keys, list(keys), "left_anti").unionByName(upd)


def scd2_merge(dim: DataFrame, feed: DataFrame, key: str, payload: Sequence[str],
               order: str = "__ldts", hashed: Sequence[str] | None = None,
               batch_ts: Column | None = None) -> DataFrame:
    """One MERGE run: the newest batch of ``feed`` applied to ``dim``.

    The change set is checkpointed (shared checkpoint folder) before it is
    applied: it is read twice and is at most twice the batch."""
    changes = scd2_merge_changes(dim, newest_batch(feed, order), key, payload, order, hashed, batch_ts)
    changes = changes.checkpoint(eager=True)
    return merge_upsert(dim, changes, [key, "__rec_version"], broadcast_bytes=BROADCAST_MAX_BYTES)


def _ts_literal(value) -> Column:
    if isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def scd2_merge_replay(feed: DataFrame, key: str, payload: Sequence[str], order: str = "__ldts",
                      hashed: Sequence[str] | None = None, dim: DataFrame | None = None,
                      checkpoint: bool = True) -> DataFrame:
    """Apply every load of ``feed`` in load order, one MERGE per load.

    Each step depends on the previous table state, so the loop is sequential
    by nature; the list of load timestamps is tiny. Lineage is cut after every
    step with a reliable checkpoint (shared checkpoint folder), so plans stay
    small and a lost executor recomputes one step, not the whole replay.
    """
    loads = [r[0] for r in feed.select(order).distinct().orderBy(order).collect()]
    state = dim if dim is not None else empty_dimension(feed, key, payload, order)
    for ts in loads:
        batch = feed.where(F.col(order) == _ts_literal(ts))
        changes = scd2_merge_changes(state, batch, key, payload, order, hashed).checkpoint(eager=True)
        state = merge_upsert(state, changes, [key, "__rec_version"], broadcast_bytes=BROADCAST_MAX_BYTES)
        if checkpoint:
            state = state.checkpoint(eager=True)
    return state


# -- stored dimension ------------------------------------------------------------

CURRENT, CLOSED = "current", "closed"


def merge_into_table(feed: DataFrame, table_path: str, key: str, payload: Sequence[str],
                     order: str = "__ldts", hashed: Sequence[str] | None = None,
                     buckets: int | None = None, batch: DataFrame | None = None) -> None:
    """MERGE the newest batch of ``feed`` (or ``batch``) into the dimension
    stored at ``table_path``.

    The table is a ``BucketedTable`` of two parts: ``current`` holds the latest
    row of each key, ``closed`` the expired ones. A MERGE reads the buckets of
    the batch's keys in ``current`` and writes them anew, and appends what it
    closed; closed rows are never read or written again. So its reads and writes
    follow the buckets that the batch touches, after any number of batches. One
    pointer publishes both; a writer that dies before that changes nothing, and
    a repeated batch finds no changes (hashes match). NULL keys or load times
    are refused with their counts, as the dimension declares them NOT NULL, and
    so are rows that repeat a key: their versions would not be told apart.
    """
    spark = feed.sparkSession
    batch = newest_batch(feed, order) if batch is None else batch
    enforce_not_null(batch, [key, order])
    enforce_unique(batch, [key])
    table = BucketedTable(spark, table_path, key, buckets)
    empty = empty_dimension(feed, key, payload, order)
    current = table.read(CURRENT, table.buckets_of(batch))
    changes = scd2_merge_changes(empty if current is None else current, batch, key, payload, order,
                                 hashed).checkpoint(eager=True)
    expired = F.col(UPDATE_TYPE) == T2_EXPIRE
    latest = changes.where(~expired).drop(UPDATE_TYPE)
    changed = table.buckets_of(latest)
    if not changed:
        return
    kept = table.read(CURRENT, changed)
    rows = latest if kept is None else kept.join(
        broadcast_if_small(latest.select(key)), key, "left_anti").select(*latest.columns).unionByName(latest)
    commit = table.begin().rewrite(CURRENT, rows, changed)
    commit.append(CLOSED, changes.where(expired).drop(UPDATE_TYPE)).publish()


def read_dimension(spark: SparkSession, table_path: str, key: str) -> DataFrame:
    """Latest and closed rows of the stored dimension (a snapshot)."""
    table = BucketedTable(spark, table_path, key)
    current, closed = table.read(CURRENT), table.read_appended(CLOSED)
    return current if closed is None else current.unionByName(closed)
