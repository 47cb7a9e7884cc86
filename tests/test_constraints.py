from dimsmith.operators import constraints
from dimsmith.plans import catalog

from conftest import SF01


def test_lineitem_key_really_repeats(spark):
    pk = {r.table_name: r for r in catalog.audit_primary_key(spark, SF01).collect()}
    assert (pk["lineitem"].duplicate_keys, pk["lineitem"].duplicate_rows) == (11785, 25953)
    assert pk["customer"].duplicate_keys == 0 and pk["customer"].null_keys == 0
    assert pk["loyalty_customer"].duplicate_keys >= 1      # early supporter who also ranks


def test_bad_fk_orphans(spark):
    fk = {(r.table_name, r.parent_table): r for r in catalog.audit_foreign_key(spark, SF01).collect()}
    assert fk[("location_bad_fk", "region_main")].orphan_rows == 5
    assert fk[("lineitem", "sales_order")].orphan_rows == 0
    assert fk[("sales_order", "customer")].orphan_rows == 0


def test_not_null_and_types_clean(spark):
    assert catalog.audit_not_null(spark, SF01).where("violations > 0").count() == 0
    assert catalog.audit_types(spark, SF01).where("violations > 0").count() == 0


def test_type_checks_catch_overflow_length_scale(spark):
    from dimsmith.sources.model import TableSpec, col
    spec = TableSpec("t", (col("a", "decimal(4,2)", "a"), col("s", "string", "s", max_length=3)))
    df = spark.createDataFrame([(123.456, "abcd"), (1.5, "ab"), (12.34, None)], "a double, s string")
    out = {(r.column_name, r.rule): r.violations for r in constraints.audit_types({"t": (spec, df)}).collect()}
    assert out == {("a", "precision"): 1, ("a", "scale"): 1, ("s", "length"): 1}


def test_type_checks_survive_what_no_decimal_holds(spark):
    from dimsmith.sources.model import TableSpec, col
    spec = TableSpec("t", (col("a", "decimal(12,2)", "a"),))
    df = spark.createDataFrame([(1e300,), (float("nan"),), (float("inf"),), (1.25,), (None,)], "a double")
    out = {(r.column_name, r.rule): r.violations for r in constraints.audit_types({"t": (spec, df)}).collect()}
    assert out == {("a", "precision"): 3, ("a", "scale"): 3}


def test_reference_without_a_parent_is_reported(spark):
    from dimsmith.sources.model import ForeignKey, TableSpec, col
    spec = TableSpec("t", (col("a", "bigint", "a"),), foreign_keys=(ForeignKey(("a",), "nowhere", ("b",)),))
    rows = constraints.audit_foreign_key({"t": (spec, spark.range(5).toDF("a"))}).collect()
    assert [(r.table_name, r.parent_table, r.orphan_keys, r.orphan_rows) for r in rows] == [("t", "nowhere", None, None)]


def test_dim_customer_is_audited(spark):
    pk = {r.table_name: r for r in catalog.audit_primary_key(spark, SF01).collect()}["dim_customer"]
    assert (pk.key_columns, pk.duplicate_keys, pk.null_keys) == ("customer_id,__from_dts", 0, 0)
    checked = {(r.table_name, r.column_name) for r in catalog.audit_types(spark, SF01).collect()}
    assert ("dim_customer", "phone") in checked and ("src_customer", "market_segment") in checked


def test_report_scans_lineitem_at_most_four_times(spark):
    """Three passes over the lines in the report's plan, one when the inventory is stored."""
    report = catalog.constraint_report(spark, SF01)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("FileScan parquet") if "lineitem.parquet" in x[:4000].split("\n")[0]]
    assert len(scans) <= 3
    assert report.count() == len({(r.table_name, r.rule, r["columns"]) for r in report.collect()})
