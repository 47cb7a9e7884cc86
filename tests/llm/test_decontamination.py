import random

import numpy as np
import pytest

from dimsmith.llm import suffix_decontamination as op

from . import brute
from .conftest import ENGLISH
from .helpers import bag

ITEMS = [(1, ENGLISH), (2, "lazy dog"), (2, "over the lazy"), (3, None), (None, "two words"), (4, ""), (5, ENGLISH + " more"),
         (6, "café naïve")]


@pytest.fixture(scope="module")
def items(session):
    return session.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, found int")


@pytest.mark.parametrize("block_words", [1, 30, op.BLOCK_WORDS])
def test_hard_rows_equal_brute_force(hard, hard_rows, items, block_words):
    got = op.report(hard, items, block_words=block_words).collect()
    named = [("" if i is None else i, t) for i, t in ITEMS]
    assert bag(map(tuple, got)) == bag((d, *brute.contamination(t, named)) for d, t in hard_rows)


def test_small_table_equals_brute_force(session, small, small_rows):
    bench = session.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    named = [(r.item_id, r.text) for r in bench.collect()]
    got = op.report(small, bench).collect()
    assert any(r.contaminated for r in got)
    assert bag(map(tuple, got)) == bag((d, *brute.contamination(t, named)) for d, t in small_rows)


def test_random_words_equal_brute_force():
    """A tiny alphabet: windows overlap, share states and repeat."""
    rnd = random.Random(5)
    draw = lambda n: " ".join(rnd.choice("abc") for _ in range(n))
    for _ in range(40):
        items = [(k, draw(rnd.randint(0, 9))) for k in range(6)]
        automaton = op.ItemAutomaton([(str(k), [w.encode() for w in t.split()]) for k, t in items], window=4)
        for _ in range(10):
            text = draw(rnd.randint(0, 30)) + (" z " + draw(8) if rnd.random() < 0.5 else "")
            hit, names = automaton.search([w.encode() for w in text.split()])
            want = brute.contamination(text, items, window=4)
            assert (len(hit), int(hit.sum()), len(names)) == want[:3]


def test_empty_tables(hard, none, items):
    assert op.report(none, items).collect() == []
    got = op.report(hard, items.where("false"))
    assert got.count() == hard.count() and got.where("contaminated").count() == 0


def test_spans_are_cut_and_covered_documents_go(session, items):
    other = " ".join(f"word{i}" for i in range(60))
    rows = [(1, ENGLISH.upper() + "!"), (2, f"{other}. {ENGLISH.title()}; {other}"), (3, other), (4, None)]
    got = {r.doc_id: r.text for r in op.decontaminate(
        session.createDataFrame(rows, "doc_id long, text string"), items.where("item_id = 1")).collect()}
    assert got == {2: f"{other}. ; {other}", 3: other, 4: None}


def test_cut():
    flags = np.array([0, 1, 1, 0, 1], bool)
    assert op.cut("One, TWO-three Four  fiVe!", flags) == "One,  Four  !"


def test_decontaminate_leaves_other_columns(hard, items):
    got = op.decontaminate(hard, items)
    assert got.columns == hard.columns


@pytest.mark.parametrize("block_words", [1, 30])
def test_blocks_cut_the_same(hard, items, block_words):
    one = op.decontaminate(hard, items).select("doc_id", "text").collect()
    many = op.decontaminate(hard, items, block_words=block_words).select("doc_id", "text").collect()
    assert bag(one) == bag(many)
