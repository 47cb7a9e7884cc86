import corpus_pipeline as cp
import pytest

import __spark_entry__ as ent
from dimsmith.llm import aho_viterbi, pii_disclosure, quality_cascade

from . import brute
from .conftest import SF


@pytest.fixture(scope="module")
def brute_run(session, small_rows):
    """The stages in plain Python over the whole small table."""
    kept_ids = {r.doc_id for r in quality_cascade.quality(session.read.parquet(f"{SF}/documents.parquet")).where("kept").collect()}
    rows = [(d, t) for d, t in small_rows if d in kept_ids]
    assert not any(q[0] < 10 or 100 * q[4] > 20 * q[0] for q in (brute.quality(t) for _, t in rows))
    fps = [brute.simhash(t) for _, t in rows]
    comp = brute.components([d for d, _ in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    rows = [(d, t) for (d, t), c in zip(rows, comp) if d == c]
    items = [(r.item_id, r.text) for r in session.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = {}
    for d, t in rows:
        n, hit, *_ = brute.contamination(t, items)
        out[d] = None if hit > 0.5 * n else (t, hit)
    return out


def test_run_equals_brute_force(session, brute_run):
    got = {r.doc_id: r for r in cp.run(session, SF).collect()}
    assert set(got) == {d for d, v in brute_run.items() if v is not None}
    with open(aho_viterbi.model_path(), "rb") as f:
        model = aho_viterbi.PieceModel(f.read())
    for d, v in brute_run.items():
        if v is None:
            continue
        text, hit = v
        back = model.decode([int(k) for k in got[d].ids])
        assert not any(k in back for _, a, b in brute.private(text) for k in [text[a:b]])
        if not hit and not brute.private(text):
            assert back == text
        elif not hit:
            spans = [{"kind": k, "start": a, "end": b} for k, a, b in brute.private(text)]
            assert back == pii_disclosure.replaced(text, spans)


def test_stages(session, small):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "sentencepiece"]
    docs = small
    for name, stage in cp.STAGES[:-1]:
        after = stage(session, docs, SF)
        assert after.columns == small.columns and after.dtypes == small.dtypes, name
        docs = after


def test_stages_on_hard_rows(session, hard, none):
    for table in (hard, none):
        docs = table
        for _, stage in cp.STAGES:
            docs = stage(session, docs, SF).checkpoint()
        assert docs.columns == ["doc_id", "source", "ids", "n_pieces"]
    assert docs.count() == 0


def test_every_operator_is_registered():
    names = set(ent.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert cp.ORACLE_SQL is None
