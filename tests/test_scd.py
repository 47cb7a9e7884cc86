import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import scd
from dimsmith.plans import catalog
from dimsmith.sources.model import CUSTOMER_T2N1_TYPE1, CUSTOMER_T2N1_TYPE2, CUSTOMER_T2_TRACKED

from conftest import SF01

T0 = dt.datetime(2024, 1, 1)


def _golden(spark):
    rows = [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (2, 1, "x"), (2, 2, "x")]
    df = spark.createDataFrame(rows, "k long, t long, v string")
    return df.select("k", (F.lit(T0.isoformat(sep=" ")).cast("timestamp_ntz")
                           + F.make_dt_interval(mins=F.col("t"))).alias("ts"), "v", "t")


def _shape(df):
    return sorted((r.k, r.t, r["__rec_version"], r["__is_latest"])
                  for r in df.select("k", "t", "__rec_version", "__is_latest").collect())


def test_golden_faithful(spark):
    out = scd.scd2_history(_golden(spark), "k", "ts", ["v"], compact=False)
    assert _shape(out) == [(1, 1, 1, False), (1, 3, 3, True), (2, 1, 1, False)]


def test_golden_compact(spark):
    feed = _golden(spark)
    out = scd.scd2_history(feed, "k", "ts", ["v"], compact=True)
    assert _shape(out) == [(1, 1, 1, False), (1, 3, 2, True), (2, 1, 1, True)]


def test_golden_intervals_close_one_microsecond_early(spark):
    out = scd.scd2_history(_golden(spark), "k", "ts", ["v"]).where("k = 1").orderBy("__from_dts").collect()
    assert out[0]["__to_dts"] == out[1]["__from_dts"] - dt.timedelta(microseconds=1)
    assert out[1]["__to_dts"] == dt.datetime(9999, 12, 31)
    assert out[0]["__create_dts"] == out[1]["__create_dts"] == T0 + dt.timedelta(minutes=1)


def test_type1_takes_last_value_over_all_rows(spark):
    rows = [(1, 1, "a", "p1"), (1, 2, "b", "p2"), (1, 3, "b", "p3")]
    df = spark.createDataFrame(rows, "k long, t long, v string, w string").select(
        "k", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("t"))).alias("ts"),
        "v", "w")
    out = scd.scd2n1_history(df, "k", "ts", ["v"], ["w"]).orderBy("__from_dts").collect()
    assert [r.w for r in out] == ["p3", "p3"]          # newest Type-1 value on every version
    assert [r["__rec_version"] for r in out] == [1, 2]
    import hashlib
    # T1 hash is over each row's own source value, not the propagated one
    assert out[0]["__t1diff_hash"] == bytearray(hashlib.sha1(b"P1").digest())


@pytest.fixture(scope="module")
def feed(spark):
    return catalog._feed(spark, SF01)


def _props(df, key="customer_id"):
    rows = df.select(key, "__from_dts", "__to_dts", "__rec_version", "__is_latest",
                     "__t2diff_hash").collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for k, vs in by.items():
        vs.sort(key=lambda r: r["__from_dts"])
        assert [v["__rec_version"] for v in vs] == list(range(1, len(vs) + 1))
        assert sum(v["__is_latest"] for v in vs) == 1 and vs[-1]["__is_latest"]
        for a, b in zip(vs, vs[1:]):
            assert a["__to_dts"] == b["__from_dts"] - dt.timedelta(microseconds=1)
            assert a["__t2diff_hash"] != b["__t2diff_hash"]
    return by


def test_compact_history_properties(spark, feed):
    by = _props(scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_T2_TRACKED))
    assert len(by) == 1050


def test_t2n1_properties_and_type1_constant(spark, feed):
    out = scd.scd2n1_history(feed, "customer_id", "__ldts", CUSTOMER_T2N1_TYPE2, CUSTOMER_T2N1_TYPE1)
    _props(out)
    varying = (out.groupBy("customer_id")
               .agg(*[F.countDistinct(c).alias(c) for c in CUSTOMER_T2N1_TYPE1])
               .where(" OR ".join(f"{c} > 1" for c in CUSTOMER_T2N1_TYPE1)).count())
    assert varying == 0


def test_faithful_counts_match_fixture(spark, feed):
    out = scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_T2_TRACKED, compact=False)
    assert out.count() == 2075
    assert out.where("__is_latest").count() == 1000


def test_history_is_one_shuffle(spark, feed):
    from dimsmith.plans.inspect import exchanges
    out = scd.scd2n1_history(feed, "customer_id", "__ldts", CUSTOMER_T2N1_TYPE2, CUSTOMER_T2N1_TYPE1)
    assert exchanges(out) == 1


def test_as_of_snapshot_has_one_row_per_loaded_key(spark, feed):
    hist = scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_T2_TRACKED)
    snap = scd.as_of(hist, "2024-01-01 00:25:00")
    loaded = feed.where("__ldts <= timestamp_ntz'2024-01-01 00:25:00'").select("customer_id").distinct().count()
    assert snap.count() == loaded == snap.select("customer_id").distinct().count()


def test_as_of_join_matches_snapshot(spark, feed):
    hist = scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_T2_TRACKED)
    facts = feed.select("customer_id").distinct().withColumn(
        "at", F.lit("2024-01-01 00:25:00").cast("timestamp_ntz"))
    joined = scd.as_of_join(facts, hist.select("customer_id", "__from_dts", "__to_dts", "__rec_version"),
                            "customer_id", "at", how="inner")
    snap = scd.as_of(hist, "2024-01-01 00:25:00")
    assert sorted(tuple(r) for r in joined.select("customer_id", "__rec_version").collect()) == \
        sorted(tuple(r) for r in snap.select("customer_id", "__rec_version").collect())


def test_events_counts(spark):
    ev = catalog._events(spark, SF01)
    faithful = scd.scd2_history(ev, "user_id", "ts", ["event_type"], compact=False)
    assert (faithful.count(), faithful.where("__is_latest").count()) == (8016, 126)


def test_hot_key_chunked_path_equals_plain_windows(spark, feed):
    """Keys above the bound are range-split into chunks with carried state;
    the result must not depend on it."""
    def rows(df):
        return sorted(tuple(r) for r in df.collect())
    ev = catalog._events(spark, SF01)
    cases = [
        (3, lambda m: scd.scd2_history(feed, "customer_id", "__ldts", CUSTOMER_T2_TRACKED, compact=False,
                                       max_key_rows=m)),
        (3, lambda m: scd.scd2n1_history(feed, "customer_id", "__ldts", CUSTOMER_T2N1_TYPE2,
                                         CUSTOMER_T2N1_TYPE1, max_key_rows=m)),
        (40, lambda m: scd.scd2_history(ev, "user_id", "ts", ["event_type"], max_key_rows=m)),
    ]
    for bound, make in cases:
        assert rows(make(bound)) == rows(make(None))


def test_hot_keys_are_found_and_chunked(spark):
    ev = catalog._events(spark, SF01)
    split = scd._Hot(ev, ["user_id"], "ts", 40)
    assert split.n_keys == 150 and split.hot is not None
    # every chunk holds a bounded, contiguous slice of (key, ts)
    sizes = [r[1] for r in split.hot.groupBy(scd.CHUNK).count().collect()]
    assert max(sizes) <= 2 * 40 * 1.5 + 40 and len(sizes) > 100


def test_composite_key_hot_path_equals_plain(spark):
    ev = catalog._events(spark, SF01)
    keys = ["user_id", "event_type"]
    plain = scd.scd2_history(ev, keys, "ts", ["value"], max_key_rows=None)
    hot = scd.scd2_history(ev, keys, "ts", ["value"], max_key_rows=10)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(hot) == rows(plain)
    r = plain.select("dim_skey", "user_id", "event_type").first()
    assert r.dim_skey.startswith(f"{r.user_id}|{r.event_type}|")


def _versions(spark, n=40, keys=(1, 2, None)):
    rows = [(k, i * 50_000, f"v{k}-{i}") for k in keys for i in range(1, n)]
    df = spark.createDataFrame(rows, "k long, sec long, v string")
    feed = df.select("k", F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("t0"), "sec", "v").select(
        "k", (F.col("t0") + F.make_dt_interval(secs=F.col("sec").cast("decimal(18,6)"))).alias("ts"), "v")
    return scd.scd2_history(feed, "k", "ts", ["v"]).select("k", "__from_dts", "__to_dts", "__rec_version")


def _facts(spark, n=500):
    df = spark.range(n).selectExpr("id", "case when id % 7 = 6 then null else id % 4 end as k", "id * 4973 as sec")
    stamp = F.expr("timestamp_ntz '2024-01-01 00:00:00'") + F.make_dt_interval(secs=F.col("sec").cast("decimal(18,6)"))
    return df.select("id", "k", F.when(F.col("id") % 11 != 3, stamp).alias("at"))


@pytest.mark.parametrize("span", ["1 hour", "1 day", "365 days"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_as_of_join_equals_the_interval_join(spark, span, how):
    hist, facts = _versions(spark), _facts(spark)
    gaps = hist.where("__rec_version % 5 <> 0")          # holes: nothing is valid there
    for h in (hist, gaps, hist.limit(0)):
        got = scd.as_of_join(facts, h, "k", "at", how=how, span=span)
        other = h.withColumnRenamed("k", "hk")
        want = facts.join(other, (facts.k == other.hk) & facts["at"].between(
            other["__from_dts"], other["__to_dts"]), how).drop("hk")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_as_of_join_forms_no_pairs(spark):
    """One key with 3000 versions and 3000 facts: no join, no task over a span's rows."""
    from dimsmith.plans.inspect import physical_plan
    rows = spark.range(3000)
    hist = rows.selectExpr("1L as k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, id) as __from_dts",
                           "timestamp_ntz '2024-01-01' + make_dt_interval(0, id, 59, 59) as __to_dts", "id as v")
    facts = rows.selectExpr("1L as k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, id, 30) as at", "id")
    out = scd.as_of_join(facts, hist, "k", "at")
    plan = physical_plan(out)
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert out.where("v = id").count() == 3000


def test_null_key_takes_the_hot_path(spark):
    """A null key with most rows is chunked like any other and loses nothing."""
    rows = [(None if i % 4 else i, i, f"x{i // 3}") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, n long, v string").select(
        "k", (F.expr("timestamp_ntz '2024-01-01'") + F.make_dt_interval(mins=F.col("n"))).alias("ts"), "v")
    plain = scd.scd2_history(df, "k", "ts", ["v"], max_key_rows=None)
    hot = scd.scd2_history(df, "k", "ts", ["v"], max_key_rows=50)
    assert sorted(map(str, hot.collect())) == sorted(map(str, plain.collect()))
    assert plain.where("k IS NULL").count() > 50


def test_known_rows_skip_the_search_for_hot_keys(spark, monkeypatch):
    df = _golden(spark)
    monkeypatch.setattr(scd, "_Hot", lambda *_: pytest.fail("searched"))
    assert scd.scd2_history(df, "k", "ts", ["v"], rows=5).count() == 3
