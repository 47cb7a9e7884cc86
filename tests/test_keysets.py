"""Key sets as bitmaps: Bloom-filtered semi-joins and exact reference audits."""

import pytest
from pyspark.sql import functions as F

from dimsmith.functions.keysets import bloom_filter, may_hold, semi_join
from dimsmith.operators import constraints
from dimsmith.plans.inspect import physical_plan
from dimsmith.sources.model import ForeignKey, TableSpec, col


def test_bloom_filter_misses_no_key_and_passes_few_others(spark):
    keys = spark.range(0, 40_000, 2).selectExpr("id k", "'x' || id s")
    every = spark.range(80_000).selectExpr("id k", "'x' || id s")
    passed = may_hold(every, ["k", "s"], *bloom_filter(keys, ["k", "s"], 20_000)).select("k")
    inside = passed.where("k < 40000 and k % 2 = 0").count()
    outside = passed.count() - inside
    assert inside == 20_000
    assert 0 < outside < 0.02 * 60_000


@pytest.mark.parametrize("n_keys", [1, 50, 5000])
def test_semi_join_is_exact_whatever_the_filter_passes(spark, n_keys):
    """A filter sized for too few keys passes nearly everything; the exact join drops it."""
    from dimsmith.functions import keysets
    big = spark.range(20_000).selectExpr("id k", "id % 7 v")
    some = spark.range(0, 20_000, 3).selectExpr("id k")
    bloom, blocks = bloom_filter(some, ["k"], n_keys)
    passed = may_hold(big, ["k"], bloom, blocks)
    assert passed.select("k").count() >= some.count()
    want = sorted(r.k for r in some.collect())
    for bound in (None, 1 << 30, keysets.BITMAP_BYTES * 4, 10):
        got = semi_join(big, some, ["k"], bound)
        assert got.columns == big.columns
        assert sorted(r.k for r in got.collect()) == want


def test_large_key_sets_filter_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100_000).selectExpr("id k")
        some = spark.range(0, 100_000, 50).selectExpr("id k")
        plan = physical_plan(semi_join(big, some, ["k"], 30_000))   # 32 bytes a key are too many, 12 bits are not
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "bitmap_construct_agg" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _tables(spark, child, parent, kind="bigint"):
    c = spark.createDataFrame([(k,) for k in child], f"fk {kind}")
    p = spark.createDataFrame([(k,) for k in parent], f"pk {kind}")
    spec = TableSpec("child", (col("fk", "bigint", "fk"),), foreign_keys=(ForeignKey(("fk",), "parent", ("pk",)),))
    return {"child": (spec, c), "parent": (TableSpec("parent", (col("pk", "bigint", "pk"),)), p)}


@pytest.mark.parametrize("kind", ["bigint", "int"])
@pytest.mark.parametrize("dense", [1, 10 ** 6])
def test_bitmap_audit_equals_the_audit_by_keys(spark, monkeypatch, kind, dense):
    monkeypatch.setattr(constraints, "DENSE_KEYS", 0 if dense == 1 else constraints.DENSE_KEYS)
    parent = [*range(-500, 40_000), 65_536]
    child = [*parent, *parent[:100], None, None, 40_000, 40_000, -501, 65_535, 100_000, 32_768, 0, 1]
    if kind == "bigint":
        child += [2 ** 62, -2 ** 62]
    tables = _tables(spark, child, parent, kind)
    got, want = (sorted(map(tuple, f(tables).collect())) for f in (constraints.audit_foreign_key_bitmaps,
                                                                   constraints.audit_foreign_key))
    assert got == want and got[0][3] >= 4


def test_bitmap_audit_of_clean_empty_and_unknown_parents(spark):
    for child, parent in (([], []), ([1, 2], [1, 2, 3]), ([None], [])):
        tables = _tables(spark, child, parent)
        assert [tuple(r)[3:] for r in constraints.audit_foreign_key_bitmaps(tables).collect()] == [(0, 0)]
    tables = _tables(spark, [1], [1])
    del tables["parent"]
    assert [tuple(r)[3:] for r in constraints.audit_foreign_key_bitmaps(tables).collect()] == [(None, None)]


def test_bitmap_audit_shuffles_bitmaps_not_keys(spark):
    tables = _tables(spark, range(0), range(0))
    tables = {n: (s, spark.range(200_000).selectExpr(f"id {'fk' if n == 'child' else 'pk'}")) for n, (s, _) in tables.items()}
    bits = constraints.bitmaps(tables["child"][1], "fk")
    assert bits.count() == 8 and bits.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 200_000
    assert [tuple(r)[3:] for r in constraints.audit_foreign_key_bitmaps(tables).collect()] == [(0, 0)]
