import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimsmith.llm import simhash_neardup as op
from dimsmith.llm.components import connected

from . import brute
from .helpers import bag


def expected(rows):
    fps = [brute.simhash(t) for _, t in rows]
    comp = brute.components([d for d, _ in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    return [(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, comp)]


@pytest.mark.parametrize("table", ["hard", "small"])
def test_equals_brute_force(request, table):
    got = op.neardups(request.getfixturevalue(table))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert bag(map(tuple, got.collect())) == bag(expected(request.getfixturevalue(f"{table}_rows")))


def test_empty_table(none):
    assert op.neardups(none).collect() == []
    assert op.deduplicate(none).collect() == []


def test_manhattan_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 2 ** 64, (2, 5000), np.uint64)
    u, v = op.unary(x), op.unary(y)
    counts = lambda z: np.array([[(int(a) >> 2 * s & 3).bit_count() for s in range(32)] for a in z])
    assert (np.bitwise_count(u ^ v) <= np.bitwise_count(x ^ y)).all()
    assert (np.bitwise_count(u ^ v) == np.abs(counts(x) - counts(y)).sum(axis=1)).all()


@pytest.mark.parametrize("n", [10, 10 ** 5, 10 ** 7, 10 ** 10])
def test_every_grid_choice_finds_every_pair(n):
    masks = [m & (1 << 64) - 1 for m in op.grids(n)]
    rnd = random.Random(n)
    for _ in range(300):
        x = rnd.getrandbits(64)
        y = x
        for b in rnd.sample(range(64), rnd.randint(0, 3)):
            y ^= 1 << b
        u, v = (int(op.unary(np.array([z], np.uint64))[0]) for z in (x, y))
        assert any(u & m == v & m for m in masks)


def test_links_of_clusters_and_chunked_cells(session, monkeypatch):
    """Dense clusters, dealt as pairs of small chunks: same components, few edges."""
    monkeypatch.setattr(op, "CHUNK", 16)
    rnd = random.Random(3)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(4):
        centre = rnd.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rnd.sample(range(10), rnd.randint(0, 4))) for _ in range(150)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = op.links(session.createDataFrame([(s,) for s in signed], "fp long"), len(fps))
    root = {r.node: r.root for r in connected(edges).collect()}
    want = brute.components(signed, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    assert [root.get(s, s) for s in signed] == want


def test_components_of_a_long_path_and_a_star(session):
    n = 300
    path = [(i, i + 1) for i in range(n)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    loops = [(5, 5), (9999, 9999)]
    got = {r.node: r.root for r in connected(session.createDataFrame(path + star + loops, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(200)}}
    assert connected(session.createDataFrame([], "a long, b long")).collect() == []


def test_deduplicate_keeps_one_of_each_group(hard, hard_rows):
    got = op.deduplicate(hard)
    assert got.columns == hard.columns
    groups = {}
    fps = [brute.simhash(t) for _, t in hard_rows]
    comp = brute.components(list(range(len(fps))), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    for c, (d, t) in zip(comp, hard_rows):
        groups.setdefault(c, []).append((d, t))
    best = [min((d for d, _ in g if d is not None), default=None) for g in groups.values()]
    assert bag(r.doc_id for r in got.collect()) == bag(best)
    assert {(r.doc_id, r.text) for r in got.collect()} <= set(hard_rows)


def test_result_does_not_depend_on_partitions(hard):
    one = op.neardups(hard.coalesce(1)).orderBy("doc_id", "fingerprint").collect()
    many = op.neardups(hard.repartition(7, F.rand(1))).orderBy("doc_id", "fingerprint").collect()
    assert one == many
