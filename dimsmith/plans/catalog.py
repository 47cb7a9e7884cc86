"""The query catalogue: every implemented operator as a named query over the
test tables, with its DuckDB oracle SQL (``None`` = rows-only check).

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables; those that keep state (streams, MERGEs, stored feeds) run it while
they are built. Hash columns are returned as lowercase hex text so the two
engines can be compared value by value.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.functions.hashing import diff_hash, hash_hex, hashes_to_hex, null_hash
from dimsmith.functions.temporal import FEED_EPOCH
from dimsmith.operators import audit_ledger, constraints, loyalty, merge, scd, star
from dimsmith.operators import loyalty_maintained as maintained
from dimsmith.plans import oracle
from dimsmith.session import scratch_path
from dimsmith.sources import declared, feeds, sinks, snapshots, testdata
from dimsmith.sources.model import (CUSTOMER_MERGE_HASHED, CUSTOMER_PAYLOAD, CUSTOMER_T2_TRACKED,
                                    CUSTOMER_T2N1_TYPE1, CUSTOMER_T2N1_TYPE2, DIM_CUSTOMER,
                                    LOYALTY_CUSTOMER, SOURCE_SYSTEM_CUSTOMER, SRC_CUSTOMER, STAR_SPECS,
                                    empty_table, star_specs)
from dimsmith.streaming import change_task
from dimsmith.streaming.incremental import incremental_history

# Parameters of the catalogue queries (the source scripts' fixed ids do not
# exist in the test data; customer 1 also ranks, which exercises the
# duplicate-key case of the loyalty table).
EARLY_IDS = (1, 2, 3)
AS_OF = "2024-01-01 00:25:00"
REPORT_DATE = "2024-01-01"
SAMPLE_BATCH, SAMPLE_ROWS, SAMPLE_SEED = 1, 1000, 0
PERIODIC_BATCHES, PERIODIC_ROWS = 3, 1000
SHIP_FIRST, SHIP_LAST = "1995-01-01", "1996-12-31"
RANGE_WIDTH, ALTERED, DROPPED, REPEATED = 100, 236, 1004, 332
# SQL constants of the dimension's defaults: open, first version, no overwritten columns.
DIM_DEFAULTS = {"__to_dts": "TIMESTAMP_NTZ'9999-12-31 00:00:00'", "__rec_version": "1L", "__is_latest": "true",
                "__t1diff_hash": f"X'{hashlib.sha1(b'*null*').hexdigest()}'"}
AUDIT_BATCHES, AUDIT_BUCKETS, ORDER_BATCHES = 3, 8, 3
REPORT_YEAR, REPORT_TODAY = 2024, "2024-06-30"

Query = Callable[[SparkSession, str], DataFrame]

# The two declared models: with RELY on every key (rely) and without (norely).
RELY, NORELY = star_specs(trust=True), star_specs(trust=False)


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    ops: str


def _ssc(spark, sf):
    return testdata.source_system_customer(spark, sf)


def _feed(spark, sf):
    return feeds.change_feed(_ssc(spark, sf))


def _events(spark, sf):
    return testdata.events_feed(spark, sf)


def _star(spark, sf, early=EARLY_IDS):
    t = testdata.star_tables(spark, sf)
    t["loyalty_customer"] = loyalty.loyalty_customers(t["customer"], t["sales_order"], early)
    return t


# -- feeds -------------------------------------------------------------------

def src_customer_base(spark, sf):
    return feeds.base_load(_ssc(spark, sf))


def change_batch(spark, sf):
    return feeds.change_batch(_ssc(spark, sf), SAMPLE_BATCH, SAMPLE_ROWS, SAMPLE_SEED)


def change_feed(spark, sf):
    return _feed(spark, sf)


def diff_hash_customer(spark, sf):
    return _ssc(spark, sf).select(
        "customer_id",
        hash_hex(diff_hash(CUSTOMER_T2_TRACKED)).alias("t2_hash"),
        hash_hex(diff_hash(CUSTOMER_T2N1_TYPE2)).alias("t2n1_type2_hash"),
        hash_hex(diff_hash(CUSTOMER_T2N1_TYPE1)).alias("t2n1_type1_hash"),
        hash_hex(diff_hash(CUSTOMER_MERGE_HASHED)).alias("merge_hash"))


def snapshot_changed_ranges(spark, sf):
    """A copy in which rows were altered, dropped and repeated: the key ranges whose digests tell."""
    base = src_customer_base(spark, sf)
    copy = sinks.snapshot_copy(base, scratch_path(spark, "snapshot"))
    k = F.col("customer_id")
    altered = copy.withColumn("phone", F.when(k % ALTERED == 0, "altered").otherwise(F.col("phone"))).where(
        (k % DROPPED != 0) | (k % ALTERED == 0))
    return snapshots.changed_ranges(base, altered.unionByName(altered.where(k % REPEATED == 0)), "customer_id", RANGE_WIDTH)


def snapshot_copy(spark, sf):
    return sinks.snapshot_copy(src_customer_base(spark, sf), scratch_path(spark, "snapshot"))


# -- histories -----------------------------------------------------------------

def _customer_t2(spark, sf, compact):
    return scd.scd2_history(_feed(spark, sf), "customer_id", "__ldts", CUSTOMER_T2_TRACKED, compact=compact)


def _customer_t2n1(feed, rows=None):
    return scd.scd2n1_history(feed, "customer_id", "__ldts", CUSTOMER_T2N1_TYPE2, CUSTOMER_T2N1_TYPE1, rows=rows)


def _customer_t2_of(feed, rows=None):
    return scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_T2_TRACKED, rows=rows)


def scd2_customer_faithful(spark, sf):
    return hashes_to_hex(_customer_t2(spark, sf, False))


def scd2_customer(spark, sf):
    return hashes_to_hex(_customer_t2(spark, sf, True))


def scd2n1_customer(spark, sf):
    return hashes_to_hex(_customer_t2n1(_feed(spark, sf)))


def scd2_events(spark, sf):
    return hashes_to_hex(scd.scd2_history(_events(spark, sf), "user_id", "ts", ["event_type"]))


def scd2_events_faithful(spark, sf):
    return hashes_to_hex(scd.scd2_history(_events(spark, sf), "user_id", "ts", ["event_type"], compact=False))


def scd2n1_events(spark, sf):
    return hashes_to_hex(scd.scd2n1_history(_events(spark, sf), "user_id", "ts", ["event_type"], ["value"]))


def scd2_as_of(spark, sf):
    return hashes_to_hex(scd.as_of(_customer_t2(spark, sf, True), AS_OF))


def history_skew_profile(spark, sf):
    """Largest per-key histories of the change feed (top 20): the skew report."""
    return scd.history_profile(_feed(spark, sf), "customer_id", top=20)


def scd2_point_in_time_join(spark, sf):
    """Every event joined to the customer version valid at the event's time."""
    hist = _customer_t2(spark, sf, True).select("customer_id", "__from_dts", "__to_dts",
                                                "__rec_version", "account_balance_usd")
    events = testdata.raw(spark, sf, "events").select("event_id", F.col("user_id").alias("customer_id"),
                                                      F.col("ts").cast("timestamp_ntz").alias("ts"))
    return (scd.as_of_join(events, hist, "customer_id", "ts")
            .select("event_id", "customer_id", "ts", "__rec_version", "account_balance_usd"))


def scd2_incremental(spark, sf):
    return hashes_to_hex(incremental_history(_feed(spark, sf), "customer_id", _customer_t2n1))


def scd2_incremental_type2(spark, sf):
    """The plain Type-2 table, maintained batch by batch."""
    return hashes_to_hex(incremental_history(_feed(spark, sf), "customer_id", _customer_t2_of))


# -- MERGE -----------------------------------------------------------------------

def _dim_after_base(feed):
    # S3: the declared, empty Type-2 dimension (names, types, NOT NULLs, comments)
    empty = empty_table(feed.sparkSession, DIM_CUSTOMER)
    base = feed.where(F.col("__ldts") == F.lit(FEED_EPOCH).cast("timestamp_ntz"))
    changes = merge.scd2_merge_changes(empty, base, "customer_id", CUSTOMER_PAYLOAD)
    return merge.merge_upsert(empty, changes, ["customer_id", "__rec_version"])


def dim_customer_declared(spark, sf):
    """The base load inserted into a declared table without the columns that have defaults."""
    name = f"dim_customer_{uuid.uuid4().hex[:8]}"
    declared.create_table(spark, DIM_CUSTOMER, name, scratch_path(spark, name), DIM_DEFAULTS)
    feed = _feed(spark, sf)
    base = feed.where(F.col("__ldts") == F.lit(FEED_EPOCH).cast("timestamp_ntz"))
    staged = merge.stage_batch(base, "customer_id", CUSTOMER_PAYLOAD).drop(*DIM_DEFAULTS)
    declared.insert(staged, DIM_CUSTOMER, name)
    return hashes_to_hex(spark.table(name))


def _stored(df):
    """Stand-in for a table written to the shared folder: a reliable checkpoint
    (the feed and the dimension are tables in practice, not recomputed plans)."""
    return df.checkpoint(eager=True)


def _merge_inputs(spark, sf):
    feed = _stored(_feed(spark, sf))
    return feed, _stored(_dim_after_base(feed))


def scd2_merge_changes(spark, sf):
    feed, dim = _merge_inputs(spark, sf)
    return hashes_to_hex(merge.scd2_merge_changes(dim, merge.newest_batch(feed), "customer_id",
                                                  CUSTOMER_PAYLOAD))


def scd2_merge_upsert(spark, sf):
    feed, dim = _merge_inputs(spark, sf)
    return hashes_to_hex(merge.scd2_merge(dim, feed, "customer_id", CUSTOMER_PAYLOAD))


def scd2_merge_table(spark, sf):
    """Every load MERGEd in order into a stored, bucket-partitioned dimension."""
    feed = _stored(_feed(spark, sf))
    path = scratch_path(spark, "dim_customer")
    loads = [r[0] for r in feed.select("__ldts").distinct().orderBy("__ldts").collect()]
    for ts in loads:
        batch = feed.where(F.col("__ldts") == F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz"))
        merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=batch)
    return hashes_to_hex(merge.read_dimension(spark, path, "customer_id"))


def _appended_feed(spark, sf):
    """The stored feed: the base load and three periodic batches, each appended."""
    source, path = _ssc(spark, sf), scratch_path(spark, "src_customer")
    sinks.append(feeds.base_load(source), path)
    for b in range(1, PERIODIC_BATCHES + 1):
        sinks.append(feeds.periodic_batch(source, b, PERIODIC_ROWS), path)
    return spark.read.parquet(path)


def change_feed_appended(spark, sf):
    """The newest appended batch MERGEd into the dimension of the base load."""
    feed = _appended_feed(spark, sf)
    return hashes_to_hex(merge.scd2_merge(_stored(_dim_after_base(feed)), feed, "customer_id", CUSTOMER_PAYLOAD))


def change_feed_streamed(spark, sf):
    """The base load and three change batches, each loaded by a bounded run of the stream."""
    source, work = _ssc(spark, sf), scratch_path(spark, "change_stream")
    feed = f"{work}/feed"
    feeds.base_load(source).withColumn("__batch", F.lit(0)).write.partitionBy("__batch").parquet(feed)
    change_task.run_intervals(source, feed, f"{work}/checkpoint", PERIODIC_BATCHES, PERIODIC_ROWS)
    return change_task.read_feed(spark, feed)


def scd2_merge_replay(spark, sf):
    return hashes_to_hex(merge.scd2_merge_replay(_feed(spark, sf), "customer_id", CUSTOMER_PAYLOAD))


# -- star schema -------------------------------------------------------------------

def loyalty_customer(spark, sf):
    return _star(spark, sf)["loyalty_customer"]


def loyalty_maintained(spark, sf):
    """The loyalty table after three batches of orders, ranked from the kept candidates."""
    t, base = testdata.star_tables(spark, sf), scratch_path(spark, "loyalty")
    for b in range(ORDER_BATCHES):
        batch = t["sales_order"].where(F.pmod(F.xxhash64("sales_order_id"), F.lit(ORDER_BATCHES)) == b)
        maintained.apply_orders(spark, base, batch, t["customer"], b, buckets=8)
    return maintained.ranking(spark, base, EARLY_IDS)


def _lines(spark, sf):
    """The lines as stored, for views that read all columns."""
    spec = STAR_SPECS["lineitem"]
    return spec, testdata.raw(spark, sf, spec.source)


def main_reporting(spark, sf):
    return star.main_reporting(_star(spark, sf), trust=star.trust_of(NORELY["lineitem"]),
                               lines=_lines(spark, sf))


def main_reporting_trusted(spark, sf):
    return star.main_reporting(_star(spark, sf), trust=star.trust_of(RELY["lineitem"]),
                               lines=_lines(spark, sf))


def main_reporting_verified(spark, sf):
    return star.main_reporting(_star(spark, sf), trust=star.trust_of(RELY["lineitem"], verify=True),
                               lines=_lines(spark, sf))


def region_report_verified_columns(spark, sf):
    """Column-driven report on verified keys; the loyalty table's key is false."""
    view = star.main_reporting(_star(spark, sf), trust=star.trust_of(RELY["lineitem"], verify=True),
                               columns=["customer_region_id", "quantity", "extended_price_usd"])
    return star.report_by_customer_region(view)


def ship_mode_view_sql(spark, sf):
    """The reporting view under a name, queried by SQL text (declared keys)."""
    main_reporting_trusted(spark, sf).createOrReplaceTempView("main_reporting_v")
    return spark.sql(f"SELECT CAST('{REPORT_DATE}' AS DATE) AS as_of_date, ship_mode, "
                     "CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity FROM main_reporting_v GROUP BY 1, 2")


def _ship_mode_function(spark, sf, trusted):
    name = f"reporting_{uuid.uuid4().hex[:8]}"
    star.create_reporting_function(spark, _star(spark, sf), name)
    return spark.sql(f"SELECT ship_mode, CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity "
                     f"FROM {name}({trusted}, DATE'{SHIP_FIRST}', DATE'{SHIP_LAST}') GROUP BY ship_mode")


def ship_mode_function(spark, sf):
    """The view as a table function of trust and dates, trusted."""
    return _ship_mode_function(spark, sf, True)


def ship_mode_function_norely(spark, sf):
    return _ship_mode_function(spark, sf, False)


def ship_mode_report(spark, sf):
    return star.ship_mode_report(star.main_reporting(_star(spark, sf), trust=star.trust_of(RELY["lineitem"])),
                                 REPORT_DATE)


def ship_mode_report_norely(spark, sf):
    return star.ship_mode_report(star.main_reporting(_star(spark, sf), trust=star.trust_of(NORELY["lineitem"])),
                                 REPORT_DATE)


def reporting_by_customer_region(spark, sf):
    return star.report_by_customer_region(
        star.main_reporting(_star(spark, sf), trust=star.trust_of(RELY["lineitem"])))


def reporting_by_customer_region_columns(spark, sf):
    view = star.main_reporting(_star(spark, sf), trust=star.trust_of(RELY["lineitem"]),
                               columns=["customer_region_id", "quantity", "extended_price_usd"])
    return star.report_by_customer_region(view)


def reporting_by_customer_region_norely(spark, sf):
    return star.report_by_customer_region(
        star.main_reporting(_star(spark, sf), trust=star.trust_of(NORELY["lineitem"])))


def region_report_eager(spark, sf):
    """Customer-region report whose sums are taken before the joins (declared keys)."""
    return star.eager_region_report(_star(spark, sf), trust=star.trust_of(RELY["lineitem"]))


def region_report_eager_verified(spark, sf):
    """The same on verified keys; the loyalty table's false key repeats its customers' sums."""
    return star.eager_region_report(_star(spark, sf), trust=star.trust_of(RELY["lineitem"], verify=True))


def _location_4(k):
    return k.isNotNull() & k.cast("boolean").isNotNull() & (k == 4)


def fk_join_pruned(spark, sf):
    t = testdata.star_tables(spark, sf)
    spec = RELY["customer"]
    joined = star.fk_join(t["customer"], t["location"], "location_id", "location_id",
                          key_filter=_location_4, trust=star.trust_of(spec),
                          fk_declared=any(fk.parent == "location" for fk in spec.foreign_keys))
    return joined.select(F.col("name").alias("customer_name")).orderBy("customer_name").limit(100)


def join_methods(spark, sf):
    t = testdata.star_tables(spark, sf)
    spec = RELY["location"]
    return star.join_method_counts(t["location"], t["region_main"], "region_id", trust=star.trust_of(spec),
                                   fk_declared=any(fk.parent == "region_main" for fk in spec.foreign_keys))


def join_methods_bad_fk(spark, sf):
    t = testdata.star_tables(spark, sf)
    spec = RELY["location_bad_fk"]
    return star.join_method_counts(t["location_bad_fk"], t["region_main"], "region_id", trust=star.trust_of(spec),
                                   fk_declared=any(fk.parent == "region_main" for fk in spec.foreign_keys))


def join_methods_bad_fk_verified(spark, sf):
    t = testdata.star_tables(spark, sf)
    spec = RELY["location_bad_fk"]
    return star.join_method_counts(t["location_bad_fk"], t["region_main"], "region_id",
                                   trust=star.trust_of(spec, verify=True),
                                   fk_declared=any(fk.parent == "region_main" for fk in spec.foreign_keys))


def join_methods_year(spark, sf):
    """The join methods with the year guard, in its year and in another."""
    t = testdata.star_tables(spark, sf)
    out = None
    for year in (REPORT_YEAR, REPORT_YEAR + 1):
        one = star.join_method_counts(t["location"], t["region_main"], "region_id", as_of_year=year,
                                      today=REPORT_TODAY).withColumn("guard_year", F.lit(year).cast("bigint"))
        out = one if out is None else out.unionByName(one)
    return out


def typed_lineitem(spark, sf):
    return testdata.star_tables(spark, sf)["lineitem"]


def typed_inventory(spark, sf):
    return testdata.star_tables(spark, sf)["inventory"]


# -- audits ------------------------------------------------------------------------

AUDIT_SPECS = dict(STAR_SPECS, loyalty_customer=LOYALTY_CUSTOMER,
                   source_system_customer=SOURCE_SYSTEM_CUSTOMER, src_customer=SRC_CUSTOMER,
                   dim_customer=DIM_CUSTOMER)
TYPE_SPECS = dict(STAR_SPECS, source_system_customer=SOURCE_SYSTEM_CUSTOMER)
# Derived tables, whose declared lengths and scales are checked on the table itself.
DERIVED_SPECS = {s.name: s for s in (LOYALTY_CUSTOMER, SRC_CUSTOMER, DIM_CUSTOMER)}


def _inventory_source(spark, sf):
    """Source values of the inventory (distinct over the lines), stored once."""
    spec = STAR_SPECS["inventory"]
    return _stored(constraints.source_projection(spec, testdata.raw(spark, sf, spec.source)))


def _dimension_of(feed):
    """The dimension that merging every load in order leaves, by one pass of windows over the feed."""
    hist = scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_MERGE_HASHED)
    return hist.select("customer_id", "__from_dts", "__to_dts", *CUSTOMER_PAYLOAD, F.col("__ldts").alias("__load_dts"),
                       "__rec_version", "__is_latest", "__create_dts", "__update_dts", "__t2diff_hash",
                       null_hash().alias("__t1diff_hash"))


def audit_tables(spark, sf, inventory=None):
    t = _star(spark, sf)
    # Derived tables are stored tables in the model (CTAS / the appended feed):
    # audit them as written once, not as plans recomputed by every check.
    t["loyalty_customer"] = _stored(t["loyalty_customer"])
    t["source_system_customer"] = _ssc(spark, sf)
    t["src_customer"] = _stored(_feed(spark, sf))
    t["dim_customer"] = _stored(_dimension_of(t["src_customer"]))
    inventory = _inventory_source(spark, sf) if inventory is None else inventory
    t["inventory"] = inventory.select([F.col(c.name).cast(c.dtype).alias(c.name) for c in STAR_SPECS["inventory"].columns])
    return {n: (AUDIT_SPECS[n], t[n]) for n in AUDIT_SPECS}


def type_sources(spark, sf, tables=None, inventory=None):
    inventory = _inventory_source(spark, sf) if inventory is None else inventory
    found = {n: (s, inventory if n == "inventory" else constraints.source_projection(
        s, testdata.raw(spark, sf, s.source))) for n, s in TYPE_SPECS.items()}
    return found | {n: (tables or audit_tables(spark, sf))[n] for n in DERIVED_SPECS}


def audit_not_null(spark, sf):
    return constraints.audit_not_null(audit_tables(spark, sf))


def audit_primary_key(spark, sf):
    return constraints.audit_primary_key(audit_tables(spark, sf))


def audit_unique(spark, sf):
    return constraints.audit_unique(audit_tables(spark, sf))


def audit_foreign_key(spark, sf):
    return constraints.audit_foreign_key(audit_tables(spark, sf))


def audit_foreign_key_bitmaps(spark, sf):
    return constraints.audit_foreign_key_bitmaps(audit_tables(spark, sf))


def audit_types(spark, sf):
    return constraints.audit_types(type_sources(spark, sf))


def constraint_report(spark, sf):
    inventory = _inventory_source(spark, sf)
    tables = audit_tables(spark, sf, inventory)
    return constraints.constraint_report(tables, type_sources(spark, sf, tables, inventory))


def constraint_report_maintained(spark, sf):
    """The report kept batch by batch: every audited table arrives in three parts, by a hash of its rows."""
    inventory = _inventory_source(spark, sf)
    tables = audit_tables(spark, sf, inventory)
    sources = type_sources(spark, sf, tables, inventory)
    base = scratch_path(spark, "audit")
    for b in range(AUDIT_BATCHES):
        part = lambda t: {n: (s, df.where(F.pmod(F.xxhash64(*df.columns), F.lit(AUDIT_BATCHES)) == b))
                          for n, (s, df) in t.items()}
        audit_ledger.audit_batch(spark, base, part(tables), part(sources), b, buckets=AUDIT_BUCKETS)
    return audit_ledger.report(spark, base)


# -- registry ----------------------------------------------------------------------

def catalog() -> dict[str, Entry]:
    e = EARLY_IDS
    return {
        "src_customer_base": Entry(src_customer_base, oracle.base_load_sql(), "S2 P1 F2 K2"),
        "change_batch": Entry(change_batch, oracle.change_batch_sql(SAMPLE_BATCH, SAMPLE_ROWS, SAMPLE_SEED),
                              "O3 X2 X10-X12 K3"),
        "change_feed": Entry(change_feed, oracle.change_feed_sql(), "S6 U1 K2 K3"),
        "diff_hash_customer": Entry(diff_hash_customer, oracle.diff_hash_sql(), "K1 X1 X4-X7"),
        "snapshot_copy": Entry(snapshot_copy, oracle.base_load_sql(), "S5"),
        "scd2_customer_faithful": Entry(scd2_customer_faithful, oracle.customer_t2(False), "K4 W1-W5 F11 P6"),
        "scd2_customer": Entry(scd2_customer, oracle.customer_t2(True), "K4c"),
        "scd2n1_customer": Entry(scd2n1_customer, oracle.customer_t2n1(), "K5 P8"),
        "scd2_events": Entry(scd2_events, oracle.events_t2(True), "K4c"),
        "scd2_events_faithful": Entry(scd2_events_faithful, oracle.events_t2(False), "K4"),
        "scd2n1_events": Entry(scd2n1_events, oracle.events_t2n1(), "K5"),
        "scd2_as_of": Entry(scd2_as_of, oracle.as_of_sql(AS_OF), "interval lookup over K4c"),
        "scd2_incremental": Entry(scd2_incremental, oracle.customer_t2n1(), "S10 K8"),
        "scd2_incremental_type2": Entry(scd2_incremental_type2, oracle.customer_t2(True), "S10 K8 over K4c"),
        "scd2_point_in_time_join": Entry(scd2_point_in_time_join, oracle.point_in_time_sql(),
                                         "interval join over K4c"),
        "history_skew_profile": Entry(history_skew_profile, oracle.skew_profile_sql(20), "skew audit (top-k)"),
        "scd2_merge_changes": Entry(scd2_merge_changes, oracle.merge_changes_sql(), "F7 A4 J1 J4 J5 U1 K6"),
        "scd2_merge_upsert": Entry(scd2_merge_upsert, oracle.merge_upsert_sql(), "S3 S4 S11 K6"),
        "scd2_merge_replay": Entry(scd2_merge_replay, oracle.merge_replay_sql(), "K6 x5"),
        "scd2_merge_table": Entry(scd2_merge_table, oracle.merge_replay_sql(), "S11 stored, bucketed"),
        "change_feed_appended": Entry(change_feed_appended,
                                      oracle.appended_merge_sql(PERIODIC_BATCHES, PERIODIC_ROWS), "S6 S7 S11 F7"),
        "change_feed_streamed": Entry(change_feed_streamed, oracle.appended_feed_sql(PERIODIC_BATCHES, PERIODIC_ROWS),
                                      "S7 as a stream"),
        "loyalty_customer": Entry(loyalty_customer, oracle.loyalty_sql(e), "K7 A1 W6 X3 F3 F4 F6 S8 U1"),
        "loyalty_maintained": Entry(loyalty_maintained, oracle.loyalty_sql(e), "K7 W6 maintained by order batches"),
        "main_reporting": Entry(main_reporting, oracle.main_reporting_sql(e, False), "K9 J2 J6 P2-P5 X2 F5"),
        "main_reporting_trusted": Entry(main_reporting_trusted, oracle.main_reporting_sql(e, True), "K9 J7"),
        "main_reporting_verified": Entry(main_reporting_verified, oracle.main_reporting_sql(e, False),
                                         "K9 J7 verified"),
        "region_report_verified_columns": Entry(region_report_verified_columns, oracle.region_report_sql(e, False),
                                                "K9 J7 verified, column-driven"),
        "ship_mode_view_sql": Entry(ship_mode_view_sql, oracle.ship_mode_sql(e, True), "S9 K10"),
        "ship_mode_function": Entry(ship_mode_function, oracle.ship_mode_between_sql(e, True, SHIP_FIRST, SHIP_LAST),
                                    "S9 with arguments, J7"),
        "ship_mode_function_norely": Entry(ship_mode_function_norely,
                                           oracle.ship_mode_between_sql(e, False, SHIP_FIRST, SHIP_LAST), "S9 control"),
        "dim_customer_declared": Entry(dim_customer_declared, oracle.dim_base_sql(), "S4 C1 C7 in the catalogue"),
        "snapshot_changed_ranges": Entry(
            snapshot_changed_ranges, oracle.changed_ranges_sql(RANGE_WIDTH, ALTERED, DROPPED, REPEATED), "S5 K1 digests"),
        "join_methods_year": Entry(join_methods_year, oracle.join_methods_year_sql(REPORT_YEAR, REPORT_TODAY),
                                   "F10 X14 J10"),
        "ship_mode_report": Entry(ship_mode_report, oracle.ship_mode_sql(e, True), "K10 J7 A2"),
        "ship_mode_report_norely": Entry(ship_mode_report_norely, oracle.ship_mode_sql(e, False), "K10 control"),
        "reporting_by_customer_region": Entry(reporting_by_customer_region, oracle.region_report_sql(e, True),
                                              "K9 partial use"),
        "reporting_by_customer_region_columns": Entry(reporting_by_customer_region_columns,
                                                      oracle.region_report_sql(e, True), "K9 column-driven"),
        "reporting_by_customer_region_norely": Entry(reporting_by_customer_region_norely,
                                                     oracle.region_report_sql(e, False), "K9 control"),
        "region_report_eager": Entry(region_report_eager, oracle.region_report_sql(e, True), "K9 A2 sums below the joins"),
        "region_report_eager_verified": Entry(region_report_eager_verified, oracle.region_report_sql(e, False),
                                              "K9 J7 verified, sums below the joins"),
        "fk_join_pruned": Entry(fk_join_pruned, oracle.fk_join_sql(), "J8 F5 F9 O2"),
        "join_methods": Entry(join_methods, oracle.join_methods_sql("location", False), "J3 J10 A3 U1"),
        "join_methods_bad_fk": Entry(join_methods_bad_fk, oracle.join_methods_sql("location_bad_fk", True), "J9"),
        "join_methods_bad_fk_verified": Entry(join_methods_bad_fk_verified,
                                              oracle.join_methods_sql("location_bad_fk", False), "J9 verified"),
        "typed_lineitem": Entry(typed_lineitem, oracle.conformed_sql("lineitem"), "S1 S2 P1 T8"),
        "typed_inventory": Entry(typed_inventory, oracle.conformed_sql("inventory"), "S2 distinct"),
        "audit_not_null": Entry(audit_not_null, oracle.not_null_sql(AUDIT_SPECS, e), "C1"),
        "audit_primary_key": Entry(audit_primary_key, oracle.primary_key_sql(AUDIT_SPECS, e), "C2 C3"),
        "audit_unique": Entry(audit_unique, oracle.unique_sql(AUDIT_SPECS, e), "C4"),
        "audit_foreign_key": Entry(audit_foreign_key, oracle.foreign_key_sql(AUDIT_SPECS, e), "C5"),
        "audit_foreign_key_bitmaps": Entry(audit_foreign_key_bitmaps, oracle.foreign_key_sql(AUDIT_SPECS, e),
                                           "C5 by bitmaps of keys"),
        "audit_types": Entry(audit_types, oracle.types_sql(TYPE_SPECS, DERIVED_SPECS, e), "C7 C8"),
        "constraint_report": Entry(constraint_report,
                                   oracle.constraint_report_sql(AUDIT_SPECS, TYPE_SPECS, e, DERIVED_SPECS), "K12"),
        "constraint_report_maintained": Entry(
            constraint_report_maintained, oracle.constraint_report_sql(AUDIT_SPECS, TYPE_SPECS, e, DERIVED_SPECS),
            "K12 C1-C8 batch by batch"),
    }
