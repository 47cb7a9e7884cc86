import os

import pytest
from pyspark.sql import functions as F

from dimsmith.operators.constraints import NotNullViolation
from dimsmith.plans import catalog
from dimsmith.session import scratch_path
from dimsmith.sources import feeds, sinks
from dimsmith.sources.bucketed import BucketedTable, Commit, Mismatch
from dimsmith.streaming.incremental import committed_batch, maintain, read_table, refresh_batch

from conftest import SF01

CMP = ["customer_id", "__from_dts", "__to_dts", "__rec_version", "__is_latest", "phone", "__t2diff_hash"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*CMP).collect())


def test_incremental_equals_batch_in_any_arrival_order(spark):
    feed = catalog._feed(spark, SF01)
    work = scratch_path(spark, "test-incremental")
    feed_dir = os.path.join(work, "feed")
    # arrival order: newest load first, then the rest split in two files
    loads = [r[0] for r in feed.select("__ldts").distinct().orderBy(F.desc("__ldts")).collect()]
    first = F.lit(loads[0].isoformat(sep=" ")).cast("timestamp_ntz")
    feed.where(F.col("__ldts") == first).coalesce(1).write.mode("append").parquet(feed_dir)
    rest = feed.where(F.col("__ldts") != first)
    rest.where("customer_id % 2 = 0").coalesce(1).write.mode("append").parquet(feed_dir)
    rest.where("customer_id % 2 = 1").coalesce(1).write.mode("append").parquet(feed_dir)
    table = os.path.join(work, "table")
    q = maintain(spark, feed_dir, table, "customer_id", catalog._customer_t2n1, schema=feed.schema)
    q.awaitTermination()
    got = read_table(spark, table, "customer_id")
    assert _rows(got) == _rows(catalog._customer_t2n1(feed))
    # a restart from the same checkpoint finds nothing new and keeps the table
    q2 = maintain(spark, feed_dir, table, "customer_id", catalog._customer_t2n1, schema=feed.schema)
    q2.awaitTermination()
    assert _rows(read_table(spark, table, "customer_id")) == _rows(got)


def _loads(feed):
    times = [r[0] for r in feed.select("__ldts").distinct().orderBy("__ldts").collect()]
    return [feed.where(F.col("__ldts") == F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")) for t in times]


def _refresh(spark, base, batch, number, **options):
    refresh_batch(spark, base, batch, number, "customer_id", catalog._customer_t2n1, **options)


@pytest.fixture(scope="module")
def feed(spark):
    return catalog._feed(spark, SF01).checkpoint(eager=True)


def _folders(base):
    local = base.replace("file:", "")
    return {os.path.relpath(d, local) for d, _, _ in os.walk(local) if os.path.basename(d).startswith("bucket=")}


def test_refresh_writes_only_the_buckets_of_its_keys(spark, feed):
    base = scratch_path(spark, "test-small-batch")
    loads = _loads(feed)
    _refresh(spark, base, loads[0], 0, buckets=8)
    before, files = BucketedTable(spark, base, "customer_id").pointer, _folders(base)
    one = feed.where((F.col("__ldts") != F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")) & (F.col("customer_id") == 4))
    _refresh(spark, base, one, 1)
    after = BucketedTable(spark, base, "customer_id").pointer
    for part in ("feed", "table"):
        assert sum(after.written[part][b] != before.written[part][b] for b in before.written[part]) == 1
    assert len(_folders(base) - files) == 2
    assert _rows(read_table(spark, base, "customer_id")) == _rows(catalog._customer_t2n1(loads[0].unionByName(one)))


def test_no_full_rewrite_after_many_batches(spark, feed):
    """Thirty small batches: each writes its own bucket only, and replaced folders go away."""
    base = scratch_path(spark, "test-many")
    some = feed.where("customer_id < 200").checkpoint(eager=True)
    first = some.where(F.col("__ldts") == F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    plain = lambda feed: feed
    refresh_batch(spark, base, first, 0, "customer_id", plain, buckets=6)
    for k in range(1, 31):
        refresh_batch(spark, base, some.where(f"customer_id = {4 + k % 2}").limit(1), k, "customer_id", plain)
        written = BucketedTable(spark, base, "customer_id").pointer.written["table"]
        assert sum(c == k + 1 for c in written.values()) == 1
    held = BucketedTable(spark, base, "customer_id").pointer.written
    assert len(_folders(base)) <= sum(map(len, held.values())) + 4  # the last commit's are still there
    assert read_table(spark, base, "customer_id").count() == first.count() + 30


@pytest.mark.parametrize("died_after", ["nothing", "feed", "table", "pointer under another name"])
def test_writer_that_dies_before_the_pointer_changes_nothing(spark, feed, died_after, monkeypatch):
    base = scratch_path(spark, "test-crash")
    loads = _loads(feed)
    _refresh(spark, base, loads[0], 0, buckets=4)
    done = _rows(read_table(spark, base, "customer_id"))
    write = Commit.rewrite

    def die(*_, **__):
        raise RuntimeError("writer died")

    with monkeypatch.context() as m:
        if died_after == "nothing":
            m.setattr(Commit, "rewrite", die)
        elif died_after == "feed":
            m.setattr(Commit, "rewrite", lambda c, part, *a: die() if part == "table" else write(c, part, *a))
        elif died_after == "table":
            m.setattr(Commit, "publish", die)
        else:
            m.setattr(sinks, "replace_text", lambda s, path, text: (sinks.write_text(s, path + ".tmp", text), die()))
        with pytest.raises(RuntimeError):
            _refresh(spark, base, loads[1], 1)
    assert _rows(read_table(spark, base, "customer_id")) == done
    for k, load in enumerate(loads[1:], 1):
        _refresh(spark, base, load, k)
    assert _rows(read_table(spark, base, "customer_id")) == _rows(catalog._customer_t2n1(feed))


def test_folders_of_a_dead_writer_are_never_read(spark, feed):
    base = scratch_path(spark, "test-half")
    loads = _loads(feed)
    _refresh(spark, base, loads[0], 0, buckets=4)
    table = BucketedTable(spark, base, "customer_id")
    commit = table.begin()
    commit.rewrite("feed", loads[1], table.buckets_of(loads[1]))                # written, never published
    commit.rewrite("table", catalog._customer_t2n1(loads[1]).limit(3), [0, 1, 2, 3])
    one = loads[1].where("customer_id = 4")
    _refresh(spark, base, one, 1)                                               # same commit number, other buckets
    _refresh(spark, base, loads[1].where("customer_id <> 4"), 2)
    for k, load in enumerate(loads[2:], 3):
        _refresh(spark, base, load, k)
    assert _rows(read_table(spark, base, "customer_id")) == _rows(catalog._customer_t2n1(feed))


def test_second_stream_continues_the_table(spark, feed):
    """Batch numbers belong to a stream: another one starts at 0 and nothing is left out."""
    base = scratch_path(spark, "test-two-streams")
    loads = _loads(feed)
    for k, load in enumerate(loads[:3]):
        _refresh(spark, base, load, k, stream="one")
    for k, load in enumerate(loads[3:]):
        _refresh(spark, base, load, k, stream="two")
    assert _rows(read_table(spark, base, "customer_id")) == _rows(catalog._customer_t2n1(feed))
    version = BucketedTable(spark, base, "customer_id").pointer.commit
    _refresh(spark, base, loads[0], 0, stream="two")     # a repeated batch of a stream
    assert BucketedTable(spark, base, "customer_id").pointer.commit == version
    assert committed_batch(spark, base, "customer_id", "two") == len(loads) - 4


def test_other_bucket_count_or_key_is_refused(spark, feed):
    base = scratch_path(spark, "test-mismatch")
    load = _loads(feed)[0]
    _refresh(spark, base, load, 0, buckets=4)
    with pytest.raises(Mismatch):
        _refresh(spark, base, load, 1, buckets=8)
    with pytest.raises(Mismatch):
        refresh_batch(spark, base, load, 1, "name", catalog._customer_t2n1)
    with pytest.raises(Mismatch):
        _refresh(spark, base, load.withColumn("extra", F.lit(1)), 1)


def test_null_keys_and_load_times_as_in_the_full_rebuild(spark, feed):
    some = feed.where("customer_id < 40")
    odd = some.limit(3).withColumn("customer_id", F.lit(None).cast("bigint")).unionByName(
        some.where("customer_id = 8").limit(1).withColumn("__ldts", F.lit(None).cast("timestamp_ntz")))
    whole = some.unionByName(odd).checkpoint(eager=True)
    base = scratch_path(spark, "test-nulls")
    _refresh(spark, base, some, 0, buckets=4)
    _refresh(spark, base, odd, 1)
    got, want = read_table(spark, base, "customer_id"), catalog._customer_t2n1(whole)
    assert got.count() == want.count()
    assert got.where("customer_id IS NULL").count() == want.where("customer_id IS NULL").count() > 0
    with pytest.raises(NotNullViolation) as e:
        _refresh(spark, base, odd, 2, not_null=["customer_id", "__ldts"])
    assert e.value.counts == {"customer_id": 3, "__ldts": 1}


def test_empty_batches(spark, feed):
    base = scratch_path(spark, "test-empty")
    _refresh(spark, base, feed.limit(0), 0, buckets=4)
    for k, load in enumerate(_loads(feed), 1):
        _refresh(spark, base, load, k)
    _refresh(spark, base, feed.limit(0), 10)
    assert _rows(read_table(spark, base, "customer_id")) == _rows(catalog._customer_t2n1(feed))
    assert committed_batch(spark, base, "customer_id") == 10


def test_change_task_appends_numbered_batches(spark):
    import time
    from dimsmith.streaming.change_task import start_change_task
    src = catalog._ssc(spark, SF01)
    path = scratch_path(spark, "test-change-task")
    q = start_change_task(src, path, interval="1 second", n=50)
    try:
        deadline = time.time() + 120
        local = path.replace("file:", "")
        while time.time() < deadline and not os.path.exists(os.path.join(local, "__batch=1")):
            time.sleep(1)
    finally:
        q.stop()
    got = spark.read.parquet(path).where("__batch = 1").drop("__batch")
    want = feeds.periodic_batch(src, 1, n=50)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_streamed_intervals_resume_and_repeat(spark, monkeypatch):
    """A run that dies half-way loads its own batch when it is resumed, once."""
    from dimsmith.streaming import change_task
    src, work = catalog._ssc(spark, SF01), scratch_path(spark, "test-intervals")
    path, state = f"{work}/feed", f"{work}/checkpoint"
    change_task.run_intervals(src, path, state, 1, n=40)
    with monkeypatch.context() as m:
        write = change_task.load_interval

        def half(*args, **options):
            write(*args, **options)                      # written, but the run doesn't get to its end
            raise RuntimeError("died")
        m.setattr(change_task, "load_interval", half)
        with pytest.raises(Exception, match="died"):
            change_task.run_intervals(src, path, state, 1, n=40)
    change_task.run_intervals(src, path, state, 2, n=40)
    want = [tuple(r) for b in (1, 2, 3) for r in feeds.periodic_batch(src, b, n=40).collect()]
    got = change_task.read_feed(spark, path).select(*feeds.periodic_batch(src, 1, n=1).columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sorted(r[0] for r in spark.read.parquet(path).select("__batch").distinct().collect()) == [1, 2, 3]


def test_periodic_batches_sample_anew(spark):
    """Two runs share about n * n / N keys; a repeated run shares all."""
    src = catalog._ssc(spark, SF01)
    total, n = src.count(), 400
    one, two, again = ({r[0] for r in feeds.periodic_batch(src, b, n).select("customer_id").collect()} for b in (1, 2, 1))
    assert len(one) == n and one == again
    assert 0.6 * n * n / total < len(one & two) < 1.5 * n * n / total
