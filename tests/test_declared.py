"""Declared tables, snapshots compared by digests, the reporting function."""

import uuid

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import loyalty, star
from dimsmith.operators.constraints import NotNullViolation
from dimsmith.plans.inspect import explain_text, logical_joins
from dimsmith.session import scratch_path
from dimsmith.sources import declared, snapshots, testdata
from dimsmith.sources.model import TableSpec, col

from conftest import SF001

SPEC = TableSpec("t", (col("id", "bigint", "id", False), col("code", "string", "code", True, 3, "the code's text"),
                       col("version", "bigint", "version", False), col("open", "boolean", "open", False)))
DEFAULTS = {"version": "1L", "open": "true"}


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    declared.create_table(spark, SPEC, name, scratch_path(spark, name), DEFAULTS)
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_inserts_take_defaults_by_name(spark, table):
    declared.insert(spark.createDataFrame([("ab", 1)], "code string, id bigint"), SPEC, table)
    declared.insert(spark.createDataFrame([(False, 2, 7)], "open boolean, id bigint, version bigint"), SPEC, table)
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "ab", 1, True), (2, None, 7, False)]


def test_bad_rows_are_refused_whole(spark, table):
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        declared.insert(spark.createDataFrame([(1, "ok"), (2, "long")], "id bigint, code string"), SPEC, table)
    with pytest.raises(NotNullViolation) as e:
        declared.insert(spark.createDataFrame([(1, 5), (None, None), (3, None)], "id bigint, version bigint"), SPEC, table)
    assert e.value.counts == {"id": 1, "version": 2}
    with pytest.raises(ValueError, match="id"):
        declared.insert(spark.createDataFrame([("x",)], "code string"), SPEC, table)
    with pytest.raises(ValueError, match="nowhere"):
        declared.create_table(spark, SPEC, "never", scratch_path(spark, "never"), {"nowhere": "1"})
    assert spark.table(table).count() == 0


def test_digests_find_what_changed(spark):
    left = spark.range(1000).selectExpr("id k", "nullif(id % 7, 3) v", "'x' || id s").unionByName(
        spark.sql("SELECT CAST(NULL AS BIGINT) k, 1L v, 'n' s"))
    same = left.repartition(5, F.rand(3)).select("s", "k", "v")
    assert snapshots.changed_ranges(left, same, "k", 10).collect() == []
    swapped = left.withColumn("v", F.when(F.col("k") == 55, None).when(F.col("k") == 56, F.lit(None)).otherwise(F.col("v")))
    right = swapped.where("k IS NULL OR k NOT BETWEEN 120 AND 139").unionByName(left.where("k = 700")).unionByName(
        left.where("k IS NULL"))
    got = {r.range: (r.left_rows, r.right_rows) for r in snapshots.changed_ranges(left, right, "k", 10).collect()}
    assert got == {5: (10, 10), 12: (10, 0), 13: (10, 0), 70: (10, 11), None: (1, 2)}
    rows = snapshots.changed_rows(left, right, "k", 10)
    assert sorted((r.side, -1 if r.k is None else r.k) for r in rows.collect()) == sorted(
        [("left", 55), ("left", 56), ("right", 55), ("right", 56), ("right", 700), ("right", -1)]
        + [("left", k) for k in range(120, 140)])


def test_values_that_trade_places_are_seen(spark):
    a = spark.createDataFrame([(1, None, 2), (2, 5, 5)], "k long, x long, y long")
    b = spark.createDataFrame([(1, 2, None), (2, 5, 5)], "k long, x long, y long")
    assert [r.range for r in snapshots.changed_ranges(a, b, "k", 1).collect()] == [1]


def test_reporting_function_prunes_by_its_arguments(spark):
    t = testdata.star_tables(spark, SF001)
    t["loyalty_customer"] = loyalty.loyalty_customers(t["customer"], t["sales_order"], (1,)).checkpoint()
    star.create_reporting_function(spark, t, "reporting_t")
    ask = lambda trusted: spark.sql("SELECT ship_mode, sum(quantity) q FROM "  # noqa: E731
                                    f"reporting_t({trusted}, DATE'1995-01-01', DATE'1995-12-31') GROUP BY 1")
    assert logical_joins(ask(True)) == 0 and logical_joins(ask(False)) == 7
    scan = explain_text(ask(True), "formatted")
    assert scan.count("ReadSchema") == 1 and "GreaterThanOrEqual(l_shipdate,1995-01-01" in scan
    want = t["lineitem"].where("year(ship_date) = 1995").groupBy("ship_mode").agg(F.sum("quantity").alias("q"))
    assert sorted(map(str, ask(True).collect())) == sorted(map(str, want.collect()))
