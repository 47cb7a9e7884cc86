import hashlib
import random
from collections import Counter

import pytest

from dimsmith.llm import pii_disclosure as op

from . import brute
from .helpers import bag


def expected(d, t):
    spans = brute.private(t)
    n = Counter(k for k, _, _ in spans)
    return (d, *(n[k] for k in op.KINDS), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())


@pytest.mark.parametrize("table", ["hard", "small"])
def test_base_columns_equal_brute_force(request, table):
    got = op.report(request.getfixturevalue(table)).collect()
    rows = request.getfixturevalue(f"{table}_rows")
    assert bag(tuple(r)[:6] for r in got) == bag(expected(d, t) for d, t in rows)
    by = {t: ",".join(f"{k}:{a}:{b}" for k, a, b in brute.private(t)) for _, t in rows}
    assert all(any(r.spans.startswith(s) for s in by.values()) for r in got)


def test_random_strings_equal_plain_patterns():
    rnd = random.Random(8)
    parts = ["a", "b.c", "@", "@@", "x@y.z", ".", "-", " ", "+", "1", "25", "255", "256", "4111111111111111", "(", ")", "%",
             "10.1.2.3", "0", "é", "\n", "+49 ", "007"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 18)))
        assert op.base_spans(text) == brute.private(text), repr(text)


def test_long_runs_stay_linear():
    import time
    began = time.time()
    for run in ("1" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "+1" + " " * 300_000, "@" * 200_000, "1 " * 200_000):
        op.base_spans(run)
    assert time.time() - began < 20


def _corpus():
    """A nickname used next to one address in many wordings, and hardly elsewhere."""
    rnd = random.Random(3)
    words = [f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(200)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = []
    for k in range(12):
        rows.append(f"{some(9)} zorbo {some(2)} zed.orbo@mail.example.org {some(9)}")
    rows += [f"{some(9)} person{k}@mail.example.org {some(9)}" for k in range(200)]
    copied = f"{some(4)} unique copied passage near 10.1.1.1 {some(4)}"
    rows += [copied] * 30
    rows += [f"{some(30)}" for _ in range(60)] + ["in passing, Zorbo is named here"]
    return rows


def test_disclosing_terms(session):
    rows = _corpus()
    df = session.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    terms = {r.term: r for r in op.disclosing_terms(df).collect()}
    assert set(terms) == {"zorbo"}  # the passage that is only copied reveals nothing
    assert terms["zorbo"].share == pytest.approx(12 / 13) and terms["zorbo"].bits > op.MIN_BITS
    got = {r.doc_id: r for r in op.report(df).collect()}
    last = rows[-1]
    assert got[len(rows) - 1].spans == f"term:{last.index('Zorbo')}:{last.index('Zorbo') + 5}"
    assert got[0].spans.startswith("email:") and ",term:" in got[0].spans
    clean = {r.doc_id: r.text for r in op.sanitise(df).collect()}
    assert clean[len(rows) - 1] == "in passing, <TERM> is named here"
    assert "<EMAIL>" in clean[0] and "zorbo" not in clean[0] and clean[len(rows) - 2] == rows[-2]


def test_fixed_line_in_many_documents(session):
    """The words beside the name are always the same; the documents differ."""
    rnd = random.Random(5)
    words = [f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(200)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [f"{some(20)}\nJane Doe <jane.doe@x.org>" for _ in range(30)] + [some(30) for _ in range(300)]
    rows += [f"{some(5)} Max Muster <max.muster@x.org>"] * 30
    near = some(400)
    rows += [f"{near} closing {end} Eva Beispiel <eva.b@x.org>" for end in ("one", "two", "three")]
    rows += ["a note about Doe"]
    df = session.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    terms = {r.term: r.share for r in op.disclosing_terms(df).collect()}
    assert terms == {"jane": 1.0, "doe": pytest.approx(30 / 31)}  # copies and near copies prove nothing
    clean = {r.doc_id: r.text for r in op.sanitise(df).collect()}
    assert clean[len(rows) - 1] == "a note about " and clean[0].endswith("  <<EMAIL>>")


def test_short_and_alphanumeric_terms_at_any_distance(session):
    """A letter's head has a two-letter name and an account number, its end the address."""
    rnd = random.Random(6)
    words = [f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(200)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [f"To Li, account 77x15 7, {some(60)} li@x.org" for _ in range(12)]
    rows += [f"To whom it concerns, 7, {some(60)}" for _ in range(200)] + ["Li owes 77x15 a visit"]
    df = session.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.term for r in op.disclosing_terms(df).collect()} == {"li", "77x15", "account"}
    assert {r.doc_id: r.text for r in op.sanitise(df).collect()}[len(rows) - 1] == "<TERM> owes <TERM> a visit"


def test_term_blocks_give_the_same(session, monkeypatch):
    df = session.createDataFrame(list(enumerate(_corpus())), "doc_id long, text string")
    want = bag(map(tuple, op.report(df).collect()))
    monkeypatch.setattr(op, "BLOCK_TERMS", 1)
    assert bag(map(tuple, op.report(df).collect())) == want
    monkeypatch.setattr(op, "BLOCK_TERMS", 50_000)
    clean = bag(map(tuple, op.sanitise(df).collect()))
    monkeypatch.setattr(op, "BLOCK_TERMS", 1)
    assert bag(map(tuple, op.sanitise(df).collect())) == clean


def test_replacing_overlaps():
    spans = [{"kind": "ip", "start": 2, "end": 9}, {"kind": "card", "start": 5, "end": 12},
             {"kind": "term-removed", "start": 14, "end": 16}]
    assert op.replaced("ab3456789012cdEFgh", spans) == "ab<IP>cdgh"


def test_sanitise_keeps_rows_and_columns(hard, none):
    got = op.sanitise(hard)
    assert got.columns == hard.columns and got.count() == hard.count()
    assert op.report(none).collect() == [] and op.sanitise(none).collect() == []
