import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimsmith.llm import odd_sketch_neardup as op

from . import brute
from .helpers import bag


def shingle_set(text, size=4):
    words = brute.space_words(text)
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)] if words else [])


def expected(rows):
    sets = [shingle_set(t) for _, t in rows]
    near = lambda i, j: bool(sets[i] and sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    comp = brute.components([d for d, _ in rows], near)
    return [(d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, comp)]


@pytest.mark.parametrize("table", ["hard", "small"])
def test_equals_brute_force(request, table):
    got = op.neardups(request.getfixturevalue(table))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert bag(map(tuple, got.collect())) == bag(expected(request.getfixturevalue(f"{table}_rows")))


def test_empty_table(none):
    assert op.neardups(none).collect() == []


def _families(seed, families=3, size=60, words=60, most=4):
    """Families of distinct near copies, some of whose members are linked through others only."""
    rnd, rows = random.Random(seed), []
    for f in range(families):
        base = [f"f{f}w{rnd.randrange(500)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rnd.randint(0, most)):
                copy[rnd.randrange(words)] = f"new{rnd.randrange(10 ** 6)}"
            if rnd.random() < 0.2:
                base = copy
            rows.append(" ".join(copy))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, forest, chunk, rest", [(1, 10, 8192, 2048), (2, 0, 8192, 2048), (3, 10, 9, 7), (4, 1, 9, 16)])
def test_families_near_the_limit(session, monkeypatch, seed, forest, chunk, rest):
    """Forest, chunks and the rest give the components of all links, whatever each of them finds."""
    for name, value in (("FOREST_BANDS", forest), ("CHUNK", chunk), ("REST_CHUNK", rest)):
        monkeypatch.setattr(op, name, value)
    rows = _families(seed)
    got = op.neardups(session.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert bag(map(tuple, got.collect())) == bag(expected(rows))


def test_walk_and_rest_give_few_edges(session):
    """Members linked through one text only: edges grow with the members, not with their pairs."""
    base = [f"w{k}" for k in range(100)]
    rnd = random.Random(3)
    rows = [" ".join(base)]
    for k in range(300):
        copy = list(base)
        for at in rnd.sample(range(100), 2):
            copy[at] = f"x{k}y{at}"
        rows.append(" ".join(copy))
    docs = session.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = op.neardups(docs).collect()
    assert bag(map(tuple, got)) == bag(expected(list(enumerate(rows))))
    nodes = op.signatures(docs, "doc_id", "text", 4).withColumnRenamed("n_shingles", "n").checkpoint()
    cells = nodes.select("node", F.explode("bands").alias("cell")).join(
        nodes.select(F.explode("bands").alias("cell")).groupBy("cell").agg(F.count("*").alias("members")), "cell")
    assert op._forest(cells, nodes, 80).count() <= 5 * 300


def test_sketch_estimates_high_similarities():
    rng = np.random.default_rng(7)
    for common, own in ((400, 50), (200, 25), (900, 20), (45, 5)):
        true, found, bits, shared = common / (common + 2 * own), [], [], 0
        for _ in range(200):
            x = rng.integers(0, 2 ** 64, common + 2 * own, np.uint64)
            a, b = op.samples(np.sort(x[:common + own])), op.samples(np.sort(np.concatenate([x[:common], x[common + own:]])))
            bits.append(int(np.bitwise_count((op.odd_sketch(a) ^ op.odd_sketch(b)).view(np.uint64)).sum()))
            found.append(op.estimate(bits[-1]))
            shared += bool((op.bands(a) == op.bands(b)).any())
        assert abs(np.mean(found) - true) < 0.01
        assert np.std(found) < 0.035
        assert max(bits) < op.MOST_DIFFERENT and shared == 200


def test_one_word_apart_at_the_exact_limit():
    a = np.arange(9, dtype=np.uint64)
    assert op.alike(a, np.arange(1, 10, dtype=np.uint64)) and 8 * 100 == 80 * 10
    assert not op.alike(np.arange(8, dtype=np.uint64), np.arange(1, 9, dtype=np.uint64))


def test_result_does_not_depend_on_partitions(hard):
    one, many = (Counter(map(tuple, op.neardups(d).collect())) for d in (hard.coalesce(1), hard.repartition(7, F.rand(1))))
    assert one == many


@pytest.mark.parametrize("confirmed", [True, False])
def test_few_rows_are_stored_in_few_files(session, monkeypatch, confirmed):
    """The passes over full sets run in many tasks; their few rows are not stored in a file a task."""
    monkeypatch.setattr(op, "FOREST_BANDS", op.FOREST_BANDS if confirmed else 0)
    kept = []
    name = "confirmed" if confirmed else "_rest"
    made = getattr(op, name)
    monkeypatch.setattr(op, name, lambda *args: kept.append(made(*args)) or kept[-1])
    rows = _families(5)
    before = session.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = op.neardups(session.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        session.conf.set("spark.sql.shuffle.partitions", before)
    assert bag(map(tuple, got)) == bag(expected(rows))
    assert kept[0].count() and len(kept[0].inputFiles()) <= 2
