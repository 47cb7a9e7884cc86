import pytest
from pyspark.sql import functions as F

from dimsmith.operators import merge, scd
from dimsmith.plans import catalog
from dimsmith.sources.model import CUSTOMER_MERGE_HASHED, CUSTOMER_PAYLOAD

from conftest import SF01

KEY = ["customer_id", "__rec_version"]
CMP = ["customer_id", "__from_dts", "__to_dts", "__rec_version", "__is_latest", "__t2diff_hash"]


@pytest.fixture(scope="module")
def feed(spark):
    return catalog._feed(spark, SF01).checkpoint(eager=True)


def _rows(df, cols=CMP):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_replay_equals_compact_history(spark, feed):
    replay = merge.scd2_merge_replay(feed, "customer_id", CUSTOMER_PAYLOAD)
    hist = scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_MERGE_HASHED)
    assert replay.count() == 2075
    assert _rows(replay) == _rows(hist)


def test_same_batch_twice_changes_nothing(spark, feed):
    dim = merge.scd2_merge(merge.empty_dimension(feed, "customer_id", CUSTOMER_PAYLOAD), feed,
                           "customer_id", CUSTOMER_PAYLOAD).checkpoint(eager=True)
    again = merge.scd2_merge(dim, feed, "customer_id", CUSTOMER_PAYLOAD)
    assert _rows(again) == _rows(dim)
    changes = merge.scd2_merge_changes(dim, merge.newest_batch(feed), "customer_id", CUSTOMER_PAYLOAD)
    assert changes.count() == 0


def test_change_kinds(spark):
    schema = "customer_id long, name string, __ldts timestamp_ntz"
    t = "2024-01-01 00:00:00"
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id long, name string").withColumn(
        "__ldts", F.lit(t).cast("timestamp_ntz"))
    dim = merge.scd2_merge(merge.empty_dimension(b0, "customer_id", ["name"]), b0, "customer_id", ["name"])
    b1 = spark.createDataFrame([(1, "a"), (2, "B2"), (3, "c")], "customer_id long, name string").withColumn(
        "__ldts", F.lit("2024-01-01 00:10:00").cast("timestamp_ntz"))
    ch = merge.scd2_merge_changes(dim, b1, "customer_id", ["name"])
    kinds = sorted((r.customer_id, r["__tmp_update_type"], r["__rec_version"], r["__is_latest"]) for r in ch.collect())
    assert kinds == [(2, "t2 expire", 1, False), (2, "t2 insert", 2, True), (3, "new recs", 1, True)]
    out = merge.merge_upsert(dim, ch, KEY)
    assert out.count() == 4
    assert out.where("__is_latest").count() == 3
    expired = out.where("customer_id = 2 AND NOT __is_latest").first()
    assert str(expired["__to_dts"]) == "2024-01-01 00:09:59.999999"


def test_merge_reads_only_newest_batch(spark, feed):
    dim0 = catalog._dim_after_base(feed)
    changes = merge.scd2_merge_changes(dim0, merge.newest_batch(feed), "customer_id", CUSTOMER_PAYLOAD)
    newest = feed.agg(F.max("__ldts")).first()[0]
    loads = {r[0] for r in changes.where("__tmp_update_type <> 't2 expire'").select("__load_dts").distinct().collect()}
    assert loads == {newest}


def _load_batches(feed):
    loads = [r[0] for r in feed.select("__ldts").distinct().orderBy("__ldts").collect()]
    return [feed.where(F.col("__ldts") == F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")) for t in loads]


def test_stored_merge_writes_only_the_buckets_of_its_keys(spark, feed):
    from dimsmith.session import scratch_path
    from dimsmith.sources.bucketed import BucketedTable
    path = scratch_path(spark, "test-dim")
    loads = _load_batches(feed)
    merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=loads[0], buckets=8)
    before = BucketedTable(spark, path, "customer_id").pointer
    some = loads[1].where("customer_id % 4 = 0").limit(3).checkpoint()
    merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=some)
    table = BucketedTable(spark, path, "customer_id")
    after = table.pointer
    new = {b for b, c in after.written["current"].items() if c != before.written["current"][b]}
    assert new and new <= {str(b) for b in table.buckets_of(some)}
    assert table.read_appended("closed").count() <= some.count()
    for batch in loads[1:]:
        merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=batch)
    replay = merge.scd2_merge_replay(feed, "customer_id", CUSTOMER_PAYLOAD)
    assert _rows(merge.read_dimension(spark, path, "customer_id")) == _rows(replay)


def test_stored_merge_survives_a_writer_that_dies(spark, feed, monkeypatch):
    from dimsmith.session import scratch_path
    from dimsmith.sources.bucketed import Commit
    path = scratch_path(spark, "test-dim-crash")
    loads = _load_batches(feed)
    merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=loads[0], buckets=4)
    done = _rows(merge.read_dimension(spark, path, "customer_id"))
    for step in ("append", "publish"):
        with monkeypatch.context() as m:
            m.setattr(Commit, step, lambda *_, **__: (_ for _ in ()).throw(RuntimeError("died")))
            with pytest.raises(RuntimeError):
                merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=loads[1])
        assert _rows(merge.read_dimension(spark, path, "customer_id")) == done
    for batch in loads[1:]:
        merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=batch)
    replay = merge.scd2_merge_replay(feed, "customer_id", CUSTOMER_PAYLOAD)
    assert _rows(merge.read_dimension(spark, path, "customer_id")) == _rows(replay)


def test_stored_merge_refuses_other_buckets_and_null_keys(spark, feed):
    from dimsmith.operators.constraints import NotNullViolation, UniqueViolation
    from dimsmith.session import scratch_path
    from dimsmith.sources.bucketed import Mismatch
    path = scratch_path(spark, "test-dim-refuse")
    batch = _load_batches(feed)[0]
    merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=batch, buckets=4)
    with pytest.raises(Mismatch):
        merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=batch, buckets=8)
    bad = batch.withColumn("customer_id", F.when(F.col("customer_id") > 8, F.col("customer_id")))
    with pytest.raises(NotNullViolation) as e:
        merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=bad)
    assert e.value.counts == {"customer_id": 3}
    with pytest.raises(UniqueViolation) as u:
        merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=batch.unionByName(batch.limit(5)))
    assert u.value.surplus == 5


def test_upsert_streams_the_dimension(spark, feed):
    from dimsmith.plans.inspect import exchanges, physical_plan
    dim = catalog._dim_after_base(feed).checkpoint(eager=True)
    out = merge.scd2_merge(dim, feed, "customer_id", CUSTOMER_PAYLOAD)
    plan = physical_plan(out)
    assert exchanges(out) == 0
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_broadcast_only_under_the_bound(spark):
    from dimsmith.functions.joins import broadcast_if_small
    from dimsmith.plans.inspect import physical_plan
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yes = big.join(broadcast_if_small(small, max_bytes=100 * 32), "k")
        no = big.join(broadcast_if_small(small, max_bytes=5 * 32), "k")
        assert "BroadcastHashJoin" in physical_plan(yes)
        assert "BroadcastHashJoin" not in physical_plan(no)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_declared_empty_dimension_matches_staged_shape(spark, feed):
    from dimsmith.sources.model import DIM_CUSTOMER, empty_table
    empty = empty_table(spark, DIM_CUSTOMER)
    staged = merge.stage_batch(feed, "customer_id", CUSTOMER_PAYLOAD)
    assert empty.count() == 0
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in staged.schema]
    assert empty.schema["__is_latest"].metadata["comment"] == "whether this version is open"


def test_stored_merge_retry_is_a_no_op(spark, feed):
    from dimsmith.session import scratch_path
    path = scratch_path(spark, "test-dim-retry")
    merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, buckets=4)
    once = _rows(merge.read_dimension(spark, path, "customer_id"))
    merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, buckets=4)   # same newest batch
    assert _rows(merge.read_dimension(spark, path, "customer_id")) == once
