import pytest
from pyspark.sql import functions as F

from dimsmith.llm import quality_cascade as op

from . import brute
from .helpers import bag


@pytest.mark.parametrize("table", ["hard", "small"])
def test_measures_equal_brute_force(request, table):
    want = []
    for d, t in request.getfixturevalue(f"{table}_rows"):
        q = brute.quality(t)
        want.append((d, *q, q[0] < 10 or 100 * q[4] > 20 * q[0]))
    got = op.quality(request.getfixturevalue(table)).collect()
    assert bag(tuple(r)[:7] for r in got) == bag(want)
    assert not any(r.kept and r.base_failed for r in got)


def test_empty_table(none):
    assert op.quality(none).collect() == []
    assert op.keep(none).collect() == []


def test_keep_is_the_verdict_and_leaves_rows_alone(hard):
    kept = op.keep(hard)
    assert kept.columns == hard.columns
    want = op.quality(hard).where("kept").collect()
    assert bag(r.doc_id for r in kept.collect()) == bag(r.doc_id for r in want)


def test_order_never_changes_the_verdict(hard):
    words = F.col("w")
    rows = hard.select("doc_id", "text").withColumn("w", op.words_of(F.col("text")))
    rules = op._rules(F.col("text"), words)
    names = [r.name for r in rules]
    a, b = op.cascade(rules, names).isNull(), op.cascade(rules, names[::-1]).isNull()
    assert rows.where(a != b).count() == 0


def test_cascade_order_is_by_rejections_per_cost(small):
    found = op.measure(small, sample_rows=100)
    rate = [x["rejects"] / x["cost"] for x in found]
    assert rate == sorted(rate, reverse=True) and len(found) == 6


def test_no_python_in_the_plan(hard):
    plan = op.quality(hard)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_random_repeats(session):
    """Few distinct words, so that windows repeat, overlap and touch in every way."""
    import random
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 40))) for _ in range(150)]
    df = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n for r in df.select(
        "doc_id", op.n_repeat_words(op.words_of(F.col("text"))).alias("n")).collect()}
    assert got == {i: brute.quality(t)[4] for i, t in enumerate(texts)}
