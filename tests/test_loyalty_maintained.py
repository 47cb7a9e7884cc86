import decimal
import random

import pytest

from dimsmith.operators import loyalty, loyalty_maintained as op
from dimsmith.session import scratch_path
from dimsmith.sources.bucketed import BucketedTable

TIERS = ((1, 2, "Gold"), (3, 5, "Silver"))
ORDERS = "customer_id bigint, total_price_usd decimal(12,2)"


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(k, decimal.Decimal(k % 7 - 1), 22 if k % 11 == 0 else k % 5) for k in range(120)] + [(5, decimal.Decimal(3), 1)]
    return spark.createDataFrame(rows, "customer_id bigint, account_balance_usd decimal(12,2), location_id bigint").checkpoint()


def _orders(spark, rows):
    return spark.createDataFrame([(k, None if v is None else decimal.Decimal(v)) for k, v in rows], ORDERS)


def _rows(df):
    return sorted(map(tuple, df.select("customer_id", "level", "type").collect()), key=str)


def _same(spark, base, seen, customers):
    want = loyalty.loyalty_customers(customers, _orders(spark, seen), (1,), TIERS)
    assert _rows(op.ranking(spark, base, (1,), TIERS)) == _rows(want)


def test_equals_the_rebuild_after_every_batch(spark, customers):
    """Growing, falling and missing totals: candidates run dry, are taken anew and are thinned out."""
    base, rnd, seen = scratch_path(spark, "test-loyal"), random.Random(4), []
    batches = [
        [(rnd.randrange(120), rnd.randrange(1, 400)) for _ in range(300)],
        [(3, None), (4, 5), (999, 50)],
        [(rnd.randrange(120), rnd.randrange(1, 50)) for _ in range(40)],
    ]
    floors = []
    for b in range(6):
        if b >= len(batches):  # take back the orders of those that rank highest
            top = {}
            for k, v in seen:
                top[k] = top.get(k, 0) + (v or 0)
            batches.append([(k, -v + b) for k, v in sorted(top.items(), key=lambda x: -x[1])[:25]])
        seen += batches[b]
        op.apply_orders(spark, base, _orders(spark, batches[b]), customers, b, buckets=3, tiers=TIERS)
        floors.append(BucketedTable(spark, base, "customer_id").pointer.notes.get(op.FLOOR))
        _same(spark, base, seen, customers)
    assert len({f for f in floors if f}) >= 2  # raised at first, lowered when it ran dry
    op.apply_orders(spark, base, _orders(spark, batches[0]), customers, 3, tiers=TIERS)  # repeated
    op.apply_orders(spark, base, _orders(spark, []), customers, 9, tiers=TIERS)
    _same(spark, base, seen, customers)


def test_ranking_reads_candidates_only(spark, customers):
    base = scratch_path(spark, "test-loyal-few")
    op.apply_orders(spark, base, _orders(spark, [(k, 10 * k + 1) for k in range(120)]), customers, 0, buckets=2, tiers=TIERS)
    op.apply_orders(spark, base, _orders(spark, [(2, 1)]), customers, 1, tiers=TIERS)
    table = BucketedTable(spark, base, "customer_id")
    assert table.read("candidates").count() <= 2 * op.SLACK * 5
    assert table.read("totals").count() == 120
    assert sum(c == 2 for c in table.pointer.written["totals"].values()) == 1


def test_writer_that_dies(spark, customers, monkeypatch):
    from dimsmith.sources.bucketed import Commit
    base, one, two = scratch_path(spark, "test-loyal-crash"), [(k, k + 1) for k in range(50)], [(1, 500), (2, 100)]
    op.apply_orders(spark, base, _orders(spark, one), customers, 0, buckets=2, tiers=TIERS)
    with monkeypatch.context() as m:
        m.setattr(Commit, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            op.apply_orders(spark, base, _orders(spark, two), customers, 1, tiers=TIERS)
    _same(spark, base, one, customers)
    op.apply_orders(spark, base, _orders(spark, two), customers, 1, tiers=TIERS)
    _same(spark, base, one + two, customers)
