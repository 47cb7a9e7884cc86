import pytest
from pyspark.sql import functions as F

from dimsmith.operators import loyalty, star
from dimsmith.plans import catalog
from dimsmith.plans.inspect import logical_joins, optimized_plan
from dimsmith.sources import testdata
from dimsmith.sources.model import conform

from conftest import SF01


@pytest.fixture(scope="module")
def tables(spark):
    t = testdata.star_tables(spark, SF01)
    t["loyalty_customer"] = loyalty.loyalty_customers(t["customer"], t["sales_order"], (1, 2, 3))
    return t


@pytest.fixture(scope="module")
def plain_tables(spark, tables):
    # loyalty as a stored table (no joins of its own), for exact join counts
    t = dict(tables)
    t["loyalty_customer"] = tables["loyalty_customer"].checkpoint(eager=True)
    return t


def test_trusted_ship_mode_report_has_no_joins(plain_tables):
    trusted = star.ship_mode_report(star.main_reporting(plain_tables, "declared"))
    control = star.ship_mode_report(star.main_reporting(plain_tables, "none"))
    assert logical_joins(trusted) == 0
    assert logical_joins(control) == 7


def test_partial_use_keeps_three_joins(plain_tables):
    view = star.main_reporting(plain_tables, "declared")
    assert logical_joins(view.select("customer_location_name")) == 3
    assert logical_joins(view.select("is_loyalty_customer")) == 3
    cols = star.main_reporting(plain_tables, "declared", columns=["customer_location_name"])
    assert logical_joins(cols) == 3


def test_column_pruning_reaches_scan(plain_tables):
    view = star.main_reporting(plain_tables, "declared")
    from dimsmith.plans.inspect import read_schemas
    schemas = read_schemas(star.ship_mode_report(view))
    assert schemas == ["struct<l_orderkey:bigint,l_quantity:double>"]


def test_view_has_fifty_columns(tables):
    assert len(star.main_reporting(tables, "none").columns) == 50


def test_duplicate_loyalty_key_fans_out_only_without_trust(tables):
    loy = tables["loyalty_customer"]
    dups = loy.groupBy("customer_id").count().where("count > 1").select("customer_id")
    dup_ids = [r[0] for r in dups.collect()]
    assert dup_ids                       # an early supporter who also ranks
    lines = (tables["lineitem"].join(tables["sales_order"], "sales_order_id")
             .where(F.col("customer_id").isin(dup_ids)).count())
    assert star.main_reporting(tables, "none").count() == 60000 + lines
    assert star.main_reporting(tables, "declared").count() == 60000
    # verified: loyalty fails the key check, so it joins for real (truth)
    assert star.main_reporting(tables, "verified").count() == 60000 + lines


def test_trust_modes_agree_on_valid_keys(spark):
    t = testdata.star_tables(spark, SF01)
    t["loyalty_customer"] = loyalty.loyalty_customers(t["customer"], t["sales_order"], ())
    answers = [sorted(tuple(r) for r in star.ship_mode_report(star.main_reporting(t, m)).collect())
               for m in ("none", "declared", "verified")]
    assert answers[0] == answers[1] == answers[2]


def test_lineitem_is_mapped_by_name(spark):
    raw = testdata.raw(spark, SF01, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    li = testdata.star_tables(spark, SF01)["lineitem"]
    r = raw.orderBy("l_orderkey", "l_linenumber", "l_partkey").first()
    m = li.where((F.col("sales_order_id") == r.l_orderkey) & (F.col("line_number") == r.l_linenumber)
                 & (F.col("part_id") == r.l_partkey)).first()
    assert m is not None and m.supplier_id == r.l_suppkey


def test_false_fk_gives_wrong_answer_only_when_trusted(spark):
    t = testdata.star_tables(spark, SF01)
    def counts(trust):
        df = star.join_method_counts(t["location_bad_fk"], t["region_main"], "region_id", trust=trust,
                                     fk_declared=True)
        return {r.method: r.cnt for r in df.collect()}
    assert counts("declared") == {"inner join": 25, "left join no filter": 25, "left join filter": 25}
    assert counts("verified") == {"inner join": 20, "left join no filter": 25, "left join filter": 20}
    assert counts("none") == counts("verified")


def test_fk_join_pruned_moves_predicates_to_child(spark):
    t = testdata.star_tables(spark, SF01)
    f = lambda k: k.isNotNull() & k.cast("boolean").isNotNull() & (k == 4)
    pruned = star.fk_join(t["customer"], t["location"], "location_id", "location_id", key_filter=f)
    real = star.fk_join(t["customer"], t["location"], "location_id", "location_id", key_filter=f, trust="none")
    assert logical_joins(pruned) == 0 and logical_joins(real) == 1
    assert pruned.count() == real.count() == 55


def test_join_methods_counts(spark):
    df = catalog.join_methods(spark, SF01)
    assert {r.method: r.cnt for r in df.collect()} == {
        "inner join": 20, "left join no filter": 25, "left join filter": 20}


def test_loyalty_tiers_and_early_cut(spark, tables):
    totals = loyalty.customer_order_totals(tables["customer"], tables["sales_order"])
    from pyspark.sql import Window
    ranked = totals.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc_nulls_first("total_price_usd"))))
    got = {}
    for lo, hi, name in loyalty.TIERS:
        sel = ranked.where(F.col("r").between(lo, hi))
        got[name] = (sel.count(), str(sel.agg(F.sum("total_price_usd")).first()[0]))
    assert got == {"Gold": (20, "101732459.87"), "Silver": (80, "336341337.16"),
                   "Bronze": (300, "995454152.79")}
    assert "WindowGroupLimit" in optimized_plan(tables["loyalty_customer"])


def test_moved_predicate_reaches_the_scan(spark):
    from dimsmith.plans.inspect import explain_text
    text = explain_text(catalog.fk_join_pruned(spark, SF01), "formatted")
    assert "EqualTo(c_nationkey,4)" in text
    assert "ReadSchema: struct<c_name:string,c_nationkey:int>" in text


def test_left_join_to_trusted_key_vanishes_without_fk(spark):
    t = testdata.star_tables(spark, SF01)
    loc, rm = t["location"].select("region_id"), t["region_main"]
    assert logical_joins(star.left_join_keep(loc, rm, "region_id", "declared")) == 0
    assert logical_joins(star.left_join_keep(loc, rm, "region_id", "none")) == 1
    # an inner join cannot go without a declared foreign key
    assert logical_joins(star.fk_join(loc, rm, "region_id", "region_id", fk_declared=False)) == 1


def test_quantity_by_return_flag_matches_fixture(spark):
    li = testdata.star_tables(spark, SF01)["lineitem"]
    got = {r.return_flag: int(r.q) for r in li.groupBy("return_flag").agg(F.sum("quantity").alias("q")).collect()}
    assert got == {"A": 506627, "N": 508966, "R": 508542}


@pytest.mark.parametrize("trust", ["declared", "verified"])
def test_one_answer_with_and_without_columns(tables, trust):
    """On the loyalty table whose key repeats: any columns, the same rows."""
    for columns in (["quantity", "ship_mode"], ["quantity", "loyalty_level"]):
        whole = star.main_reporting(tables, trust=trust).select(*columns)
        part = star.main_reporting(tables, trust=trust, columns=columns)
        assert whole.count() == part.count()
        total = lambda df: df.agg({"quantity": "sum"}).first()[0]
        assert total(whole) == total(part)


def test_verified_columns_join_what_fails_its_check(tables):
    columns = ["quantity", "ship_mode"]
    truth = star.main_reporting(tables, trust="none").count()
    assert star.main_reporting(tables, trust="verified", columns=columns).count() == truth
    assert truth > star.main_reporting(tables, trust="declared", columns=columns).count()


def test_loyalty_ranks_one_total_shared_by_all(spark):
    """Thousands of customers without a total share rank 1, then the others follow."""
    customers = spark.range(3000).selectExpr("id as customer_id", "cast(1 as decimal(12,2)) as account_balance_usd",
                                             "1L as location_id")
    orders = spark.range(3000).selectExpr(
        "id as customer_id", "cast(if(id < 2000, null, id) as decimal(12,2)) as total_price_usd")
    got = loyalty.loyalty_customers(customers, orders).groupBy("level").count().collect()
    assert {r.level: r["count"] for r in got} == {"Gold": 2000 + 19, "Silver": 80, "Bronze": 300}


def test_eager_report_sums_before_the_joins(tables):
    from dimsmith.plans.inspect import exchanges, physical_plan
    eager = star.eager_region_report(tables)
    want = star.report_by_customer_region(star.main_reporting(tables, trust="declared", columns=[
        "customer_region_id", "quantity", "extended_price_usd"]))
    assert sorted(map(str, eager.collect())) == sorted(map(str, want.select(*eager.columns).collect()))
    plan = optimized_plan(eager)
    assert logical_joins(eager) == 3
    below = plan[plan.rindex("Join LeftOuter"):]                     # the innermost join and what it reads
    assert "Aggregate [sales_order_id" in below
    lines = [x for x in physical_plan(eager).splitlines() if "Exchange hashpartitioning" in x]
    assert len(lines) == exchanges(eager) and all("sales_order_id" in x or "customer_id" in x or "region" in x or "key" in x for x in lines)


def test_eager_report_repeats_what_false_keys_repeat(spark, tables):
    """Repeated part, customer and loyalty keys count as in the view."""
    some = dict(tables)
    for name in ("part", "customer"):
        some[name] = tables[name].unionByName(tables[name].limit(20))
    view = star.main_reporting(some, trust="verified")
    got = star.eager_region_report(some, trust="verified")
    want = star.report_by_customer_region(view).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        star.eager_region_report(tables, trust="none")


def test_whole_view_conforms_its_lines_after_the_joins(spark):
    """Below the joins lines have raw columns only, and part is met before the orders."""
    for query in (catalog.main_reporting, catalog.main_reporting_trusted, catalog.main_reporting_verified):
        plan = optimized_plan(query(spark, SF01))
        below = plan[plan.index("Join LeftOuter"):]
        assert "l_orderkey" in below and "l_shipdate" in below
        assert not any(c in below for c in ("ship_instructions", "ship_mode", "receipt_date", "lineitem_comment"))
        joins = [x for x in plan.splitlines() if "Join LeftOuter" in x and "l_" in x]
        assert [k for x in joins for k in ("l_suppkey", "l_orderkey", "l_partkey") if k in x] == ["l_suppkey", "l_orderkey", "l_partkey"]


@pytest.mark.parametrize("trust", star.TRUST_MODES)
@pytest.mark.parametrize("small", [True, False])
def test_lines_as_stored_give_the_rows_of_the_view(spark, tables, monkeypatch, trust, small):
    """Missing and unknown keys, repeated dimension keys; supplier broadcast or not."""
    if not small:
        monkeypatch.setattr(star, "broadcast_if_small", lambda df: df)
    spec, raw = catalog._lines(spark, SF01)
    raw = raw.limit(300)
    odd = raw.limit(6).selectExpr("if(l_linenumber % 2 = 0, null, -1L) as l_orderkey", "if(l_linenumber % 2 = 0, -1L, null) as l_partkey",
                                  "cast(null as bigint) as l_suppkey", *raw.columns[3:])
    raw = raw.unionByName(odd).unionByName(raw.limit(5)).localCheckpoint()
    some = dict(tables, lineitem=conform(raw, spec))
    for name in ("part", "customer", "supplier", "location"):
        some[name] = tables[name].unionByName(tables[name].limit(20))
    want = star.main_reporting(some, trust=trust)
    got = star.main_reporting(some, trust=trust, lines=(spec, raw))
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
