"""Type-2 and Type-2+1 histories built from a change feed.

A feed has a business key, an order column (the load timestamp) and payload
columns; ``(key, order)`` must be unique. Histories are computed with windows
partitioned by the key and ordered by the load timestamp: one hash exchange on
the key and one sort, shared by every window and by both window stages
(before and after the change filter), because they use the same partitioning
and ordering.

System columns:
``dim_skey`` (key '|' load ts), ``__from_dts``, ``__to_dts`` (next version's
start minus one microsecond, or the high date), ``__rec_version`` (1-based),
``__is_latest``, ``__create_dts`` / ``__last_update_dts`` (first / last load of
the key), ``__update_dts`` (this row's load), ``__t2diff_hash`` and
``__prev_t2diff_hash``.

``compact=False`` reproduces the plain single-select form exactly: its windows
see the unchanged rows that the change filter then drops, so versions have
gaps, validity has holes, and a key whose newest row is unchanged has no
latest row. ``compact=True`` drops unchanged rows first and computes the
system columns over the survivors (gap-free, one latest row per key).

Hot keys. A window group is one task, so a key holding a large share of the
feed would become one straggler. With ``max_key_rows`` set (the default), keys
with more rows than that are split off (a partially aggregated count per key
finds them; their number is at most rows / ``max_key_rows``) and processed in
*chunks*: the hot rows are range-partitioned on ``(key, order)`` into pieces of
about ``max_key_rows`` rows, pinned by a checkpoint, and every window runs per
``(key, chunk)``. What a chunk cannot see is carried over from small per-chunk
summaries (one row per key and chunk): the previous chunk's last hash (lag),
the next chunk's first timestamp (lead), row offsets (row_number) and the key's
first/last timestamps. Whole-key "last value" of Type-1 columns is an
aggregate (``max_by``), partially combined before its shuffle. Other keys take
the plain window plan above.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.functions.hashing import diff_hash, null_hash
from dimsmith.functions.joins import broadcast_if_small, same_keys
from dimsmith.functions.temporal import high_date, minus_tick, ts_text
from dimsmith.functions.windows import full_frame, key_window

T2_HASH = "__t2diff_hash"
PREV_HASH = "__prev_t2diff_hash"
T1_HASH = "__t1diff_hash"
CHUNK = "__chunk"

# Keys with more feed rows than this take the chunked path; also the target
# chunk size. A few million rows per task is comfortable for a window sort.
DEFAULT_MAX_KEY_ROWS = 2_000_000

_SYS = ("__nxt", "__rn", "__first", "__last")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def surrogate_key(keys: Sequence[str], order: str) -> Column:
    parts: list[Column] = []
    for k in keys:
        parts += [F.col(k).cast("string"), F.lit("|")]
    return F.concat(*parts, ts_text(order))


# -- plain window plan ---------------------------------------------------------

def _windowed_lag(df: DataFrame, keys, order) -> DataFrame:
    w = key_window(keys, [order])
    return df.withColumn(PREV_HASH, F.coalesce(F.lag(T2_HASH).over(w), null_hash()))


def _windowed_system(df: DataFrame, keys, order) -> DataFrame:
    w = key_window(keys, [order])
    return df.withColumns({
        "__nxt": F.lead(order).over(w),
        "__rn": F.row_number().over(w),
        "__first": F.first(order).over(full_frame(w)),
        "__last": F.last(order).over(full_frame(w)),
    })


def _windowed_type1(df: DataFrame, keys, order, type1) -> DataFrame:
    whole = full_frame(key_window(keys, [order]))
    return df.withColumns({c: F.last(c).over(whole) for c in type1})


# -- chunked plan for hot keys -------------------------------------------------

class _Hot:
    """Hot-key split of a feed: cold rows, chunked hot rows, and size bounds."""

    def __init__(self, feed: DataFrame, keys, order, max_key_rows: int):
        counts = feed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        over = counts.where(F.col("__n") > max_key_rows)
        # One small job in the common case (no hot key): two numbers come back.
        stats = over.agg(F.count(F.lit(1)).alias("k"), F.sum("__n").alias("rows")).first()
        self.keys, self.order = keys, order
        self.n_keys = stats["k"]
        if not self.n_keys:
            self.cold, self.hot = feed, None
            return
        hot = over.select(*keys).checkpoint(eager=True)  # <= rows / max_key_rows keys
        hot_keys = broadcast_if_small(hot)
        # Null keys are keys like any other: nulls meet nulls in these joins.
        self.cold = same_keys(feed, hot_keys, keys, "left_anti")
        self.n_chunks = max(2, math.ceil(stats["rows"] / max_key_rows) + 1)
        self.hot = (same_keys(feed, hot_keys, keys, "left_semi")
                    .repartitionByRange(self.n_chunks, *keys, order)
                    .withColumn(CHUNK, F.spark_partition_id())
                    .checkpoint(eager=True))        # pins chunk ids, cuts lineage

    def lag(self, df: DataFrame) -> DataFrame:
        keys, order = self.keys, self.order
        wc = Window.partitionBy(*keys, CHUNK).orderBy(order)
        loc = df.withColumns({"__lag_c": F.lag(T2_HASH).over(wc), "__rn_l": F.row_number().over(wc)})
        s = df.groupBy(*keys, CHUNK).agg(F.max_by(T2_HASH, order).alias("__last_h"))
        s = s.select(*keys, CHUNK, F.lag("__last_h").over(
            Window.partitionBy(*keys).orderBy(CHUNK)).alias("__carry_h"))
        j = same_keys(loc, s, [*keys, CHUNK], "left")
        prev = F.when(F.col("__rn_l") == 1, F.col("__carry_h")).otherwise(F.col("__lag_c"))
        return (j.withColumn(PREV_HASH, F.coalesce(prev, null_hash()))
                .drop("__lag_c", "__rn_l", "__carry_h"))

    def system(self, df: DataFrame) -> DataFrame:
        keys, order = self.keys, self.order
        wc = Window.partitionBy(*keys, CHUNK).orderBy(order)
        loc = df.withColumns({"__rn_c": F.row_number().over(wc), "__lead_c": F.lead(order).over(wc)})
        s = df.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("__min"),
                                         F.max(order).alias("__max"))
        wk = Window.partitionBy(*keys).orderBy(CHUNK)
        s = s.select(*keys, CHUNK,
                     F.coalesce(F.sum("__n").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("__off"),
                     F.lead("__min").over(wk).alias("__next_min"),
                     F.first("__min").over(full_frame(wk)).alias("__first"),
                     F.last("__max").over(full_frame(wk)).alias("__last"))
        j = same_keys(loc, s, [*keys, CHUNK], "left")
        return (j.withColumns({"__rn": F.col("__rn_c") + F.col("__off"),
                               "__nxt": F.coalesce(F.col("__lead_c"), F.col("__next_min"))})
                .drop("__rn_c", "__lead_c", "__off", "__next_min"))

    def type1(self, df: DataFrame, type1) -> DataFrame:
        keys, order = self.keys, self.order
        last = df.groupBy(*keys).agg(F.max_by(F.struct(*type1), order).alias("__t1"))
        j = same_keys(df, last, keys, "left")
        return j.withColumns({c: F.col("__t1")[c] for c in type1}).drop("__t1")


# -- public operators ----------------------------------------------------------

def _finish_t2(df: DataFrame, keys, order, payload) -> DataFrame:
    to = F.when(F.col("__nxt").isNull(), high_date()).otherwise(minus_tick(F.col("__nxt")))
    return df.select(
        surrogate_key(keys, order).alias("dim_skey"),
        *keys,
        F.col(order).alias("__from_dts"),
        to.alias("__to_dts"),
        *payload,
        order,
        F.col("__rn").cast("bigint").alias("__rec_version"),
        (to == high_date()).alias("__is_latest"),
        F.col("__first").alias("__create_dts"),
        F.col(order).alias("__update_dts"),
        F.col("__last").alias("__last_update_dts"),
        T2_HASH, PREV_HASH,
    )


def _t2(feed, keys, order, tracked, compact, payload, lag, system) -> DataFrame:
    staged = lag(feed.withColumn(T2_HASH, diff_hash(tracked)))
    changed = F.col(T2_HASH) != F.col(PREV_HASH)
    if compact:
        staged = staged.where(changed)
    out = _finish_t2(system(staged), keys, order, payload)
    return out if compact else out.where(changed)


def scd2_history(feed: DataFrame, key: str | Sequence[str], order: str,
                 tracked: Sequence[str], *, compact: bool = True,
                 max_key_rows: int | None = DEFAULT_MAX_KEY_ROWS, rows: int | None = None) -> DataFrame:
    """Type-2 history of ``feed``; a new version starts when the hash of
    ``tracked`` differs from the previous row's. ``rows``, if known, bounds the
    feed's rows: where no key can be hot, none is looked for."""
    keys = _keys(key)
    payload = [c for c in feed.columns if c not in keys and c != order]

    def plain(df):
        return _t2(df, keys, order, tracked, compact, payload,
                   lambda d: _windowed_lag(d, keys, order), lambda d: _windowed_system(d, keys, order))

    if max_key_rows is None or (rows is not None and rows <= max_key_rows):
        return plain(feed)
    split = _Hot(feed, keys, order, max_key_rows)
    out = plain(split.cold)
    if split.hot is None:
        return out
    hot = _t2(split.hot, keys, order, tracked, compact, payload, split.lag, split.system)
    return out.unionByName(hot)


def _finish_t2n1(df: DataFrame, keys, order, payload) -> DataFrame:
    to = F.when(F.col("__nxt").isNull(), high_date()).otherwise(minus_tick(F.col("__nxt")))
    return df.select(
        surrogate_key(keys, order).alias("dim_skey"),
        *keys, *payload, order,
        F.col(order).alias("__update_dts"),
        T2_HASH, PREV_HASH, T1_HASH,
        F.col(order).alias("__from_dts"),
        to.alias("__to_dts"),
        F.col("__rn").cast("bigint").alias("__rec_version"),
        F.col("__first").alias("__create_dts"),
        F.col("__last").alias("__last_update_dts"),
        (to == high_date()).alias("__is_latest"),
    )


def _t2n1(feed, keys, order, type2, type1, payload, lag, system, last1) -> DataFrame:
    staged = feed.withColumns({T2_HASH: diff_hash(type2), T1_HASH: diff_hash(type1)})
    staged = last1(lag(staged))          # Type-1 values overwritten after their hash
    staged = staged.where(F.col(T2_HASH) != F.col(PREV_HASH))
    return _finish_t2n1(system(staged), keys, order, payload)


def scd2n1_history(feed: DataFrame, key: str | Sequence[str], order: str,
                   type2: Sequence[str], type1: Sequence[str], *,
                   max_key_rows: int | None = DEFAULT_MAX_KEY_ROWS, rows: int | None = None) -> DataFrame:
    """Type-2 history on ``type2`` columns with ``type1`` columns overwritten.

    Type-1 columns take the key's last value over *all* feed rows (whole-key
    frame, computed before the change filter), so every version of a key shows
    the newest value. ``__t1diff_hash`` is over each row's own source values.
    Unchanged Type-2 rows are dropped, then the system columns are computed
    over the survivors.
    """
    keys = _keys(key)
    payload = [c for c in feed.columns if c not in keys and c != order]

    def plain(df):
        return _t2n1(df, keys, order, type2, type1, payload,
                     lambda d: _windowed_lag(d, keys, order), lambda d: _windowed_system(d, keys, order),
                     lambda d: _windowed_type1(d, keys, order, type1))

    if max_key_rows is None or (rows is not None and rows <= max_key_rows):
        return plain(feed)
    split = _Hot(feed, keys, order, max_key_rows)
    out = plain(split.cold)
    if split.hot is None:
        return out
    hot = _t2n1(split.hot, keys, order, type2, type1, payload, split.lag, split.system,
                lambda d: split.type1(d, type1))
    return out.unionByName(hot)


def as_of(history: DataFrame, at: Column | str, from_col: str = "__from_dts",
          to_col: str = "__to_dts") -> DataFrame:
    """The versions valid at ``at`` (closed interval ``[from, to]``): a
    point-in-time snapshot of the dimension; a pushed-down filter, no shuffle."""
    t = F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at
    return history.where((F.col(from_col) <= t) & (t <= F.col(to_col)))


def as_of_join(facts: DataFrame, history: DataFrame, key: str | Sequence[str], at: str,
               from_col: str = "__from_dts", to_col: str = "__to_dts",
               how: str = "left", span: str = "1 day") -> DataFrame:
    """Attach to each fact row the version valid at its time ``at``.

    No pairs are formed: versions and facts are put in one stream by key and
    time, and each fact takes the last version before it, if that is still
    valid. The stream is cut into spans of time, so that a key with any number
    of facts or versions is worked on span by span; a span starts with the
    version carried over from the spans before (one summary row a key and
    span). Facts with a null key or time match nothing. Intervals of one key
    must not overlap. ``how`` is left or inner.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    keys = _keys(key)
    held = [c for c in history.columns if c not in keys]
    width = F.expr(f"unix_micros(timestamp '1970-01-01 00:00:00' + interval {span}) - unix_micros(timestamp '1970-01-01 00:00:00')")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, at]])
    none = F.lit(None)
    fact_type = T.StructType(facts.schema.fields)
    version = F.struct(*[F.col(c) for c in held])
    v = (history.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, from_col]]))
         .select(*keys, micros(from_col).alias("__t"), F.lit(0).alias("__kind"), version.alias("__v"),
                 none.cast(fact_type).alias("__fact")))
    f = facts.where(usable).select(*keys, micros(at).alias("__t"), F.lit(1).alias("__kind"),
                                   none.cast(v.schema["__v"].dataType).alias("__v"),
                                   F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("__fact"))
    stream = v.unionByName(f).withColumn("__span", F.floor(F.col("__t") / width))
    summary = stream.groupBy(*keys, "__span").agg(
        F.max_by("__v", F.when(F.col("__kind") == 0, F.col("__t"))).alias("__last"))
    earlier = Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*keys, "__span", F.last("__last", ignorenulls=True).over(earlier).alias("__v"))
    opening = carried.where(F.col("__v").isNotNull()).select(
        *keys, (F.col("__span") * width).cast("long").alias("__t"), F.lit(-1).alias("__kind"), "__v",
        none.cast(fact_type).alias("__fact"), "__span")
    upto = Window.partitionBy(*keys, "__span").orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (stream.unionByName(opening).withColumn("__v", F.last("__v", ignorenulls=True).over(upto))
             .where(F.col("__kind") == 1))
    valid = F.col(f"__v.{to_col}") >= F.col(f"__fact.{at}")
    rows = found.select("__fact.*", *[F.when(valid, F.col(f"__v.{c}")).alias(c) for c in held])
    if how == "inner":
        return rows.where(F.col(from_col).isNotNull())
    types = dict(history.dtypes)
    return rows.unionByName(facts.where(F.coalesce(~usable, F.lit(True))).select(
        "*", *[none.cast(types[c]).alias(c) for c in held]))


def history_profile(feed: DataFrame, key: str | Sequence[str], top: int = 20) -> DataFrame:
    """Largest per-key histories (rows per key): a top-k report for skew audits."""
    keys = _keys(key)
    return (feed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), *keys).limit(top))
