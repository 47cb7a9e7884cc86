import numpy as np
import pytest

from dimsmith.llm import elias_fano_lm as op

from . import brute


def _check(df, rows, **options):
    number = lambda x: float(op.restored(op.quantise(np.array([x])))[0])
    want = {}
    for (d, _), v in zip(rows, brute.language_model(rows, op.MU, number)):
        want.setdefault(d, []).append(v)
    got = op.score(df, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (brute.fold(r.doc_id, 5) == 1)
        fits = [v for v in want[r.doc_id] if (r.n_tokens, r.n_known, r.train_tokens) == v[:3]
                and r.base_score == pytest.approx(v[3]) and r.score == pytest.approx(v[4], abs=2e-3 * r.n_tokens)]
        assert fits, r


@pytest.mark.parametrize("hot", [op.HOT, 20, 1])
def test_hard_rows_equal_brute_force(hard, hard_rows, monkeypatch, hot):
    monkeypatch.setattr(op, "HOT", hot)
    _check(hard, hard_rows)


def test_small_table_equals_brute_force(small, small_rows):
    _check(small, small_rows)


def test_levels_in_files_are_memory_mapped(session, small, small_rows):
    from dimsmith.llm.common import open_fs, shared_folder
    folder = shared_folder(session, "trie")
    _check(small, small_rows, folder=folder)
    fs, path = open_fs(folder)
    import pyarrow.fs as pafs
    assert any(f.path.endswith(".trie") for f in fs.get_file_info(pafs.FileSelector(path)))


def test_model_beats_unigrams_on_held_out_rows(small):
    r = op.score(small).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


def test_no_training_rows_and_empty_table(session, none):
    assert op.score(none).collect() == []
    held = next(i for i in range(100) if brute.fold(i, 5) == 1)
    got = op.score(session.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (got.n_tokens, got.n_known, got.train_tokens) == (3, 0, 0) and got.held_out


def test_smoothed_probabilities_sum_to_one(small_rows):
    """Over the known words and one unknown word, for some contexts."""
    texts = [brute.space_words(t) + [None] for d, t in small_rows[:60]]
    from collections import Counter
    c, pairs, after = Counter(w for t in texts for w in t), Counter(), Counter()
    for t in texts:
        pairs.update(zip(t, t[1:]))
        after.update(t[:-1])
    z = sum(c.values()) + 0.5 * (len(c) + 1)
    for u in list(after)[:20]:
        mass = sum(pairs[u, w] + op.MU * (c[w] + 0.5) / z for w in [*c, "never seen"]) / (after[u] + op.MU)
        assert mass == pytest.approx(1)


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 2 ** 64), (500, 600), (3000, 2 ** 64), (4000, 2 ** 50), (1000, 2 ** 20)])
def test_elias_fano_finds_and_selects(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe - 1, n, np.uint64, endpoint=True))
    ef = op.EliasFano(op.EliasFano.build(values, universe))
    i = np.arange(len(values))
    assert (ef.at(i) == values).all()
    others = rng.integers(0, universe - 1, 500, np.uint64, endpoint=True)
    asked = np.concatenate((values, others))
    got = ef.find(asked, 0, len(values))
    spot = np.minimum(np.searchsorted(values, asked), max(len(values) - 1, 0))
    want = np.where(values[spot] == asked, spot, -1) if len(values) else np.full(len(asked), -1)
    assert (got == want).all()
    if len(values) > 4:  # only inside the range
        lo, hi = len(values) // 4, len(values) // 2
        assert (ef.find(values, lo, hi) == np.where((i >= lo) & (i < hi), i, -1)).all()


def test_repeated_values_select():
    values = np.sort(np.random.default_rng(0).integers(0, 50, 1000)).astype(np.uint64)
    ef = op.EliasFano(op.EliasFano.build(values, 51))
    assert (ef.at(np.arange(1000)) == values).all()


def test_trie_segments(monkeypatch):
    """Words beyond one segment's key space."""
    monkeypatch.setattr(op.Trie, "SEGMENT", 16)
    rng = np.random.default_rng(7)
    words = np.unique(rng.integers(0, 2 ** 64, 100, np.uint64))
    sizes = rng.integers(0, 20, len(words))
    ranges = np.concatenate(([0], np.cumsum(sizes)))
    contexts = np.concatenate([np.sort(rng.choice(1000, s, replace=False)) for s in sizes]).astype(np.uint64)
    trie = op.Trie(op.Trie.build(words, sizes.astype(np.int64), ranges, contexts, np.arange(ranges[-1]).astype(np.uint16)))
    of = np.repeat(np.arange(len(words)), sizes)
    assert (trie.word(words) == np.arange(len(words))).all()
    assert (trie.context(of, contexts) == np.arange(ranges[-1])).all()
    assert (trie.context(of, contexts + np.uint64(5000)) == -1).all()
    assert (trie.word(words + np.uint64(1)) == -1).all()
