import random
import zlib

import numpy as np
import pytest

from dimsmith.llm import aho_viterbi as op

from .helpers import bag


@pytest.fixture(scope="module")
def model():
    with open(op.model_path(), "rb") as f:
        return op.PieceModel(f.read())


@pytest.fixture(scope="module")
def scores(model):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=op.model_path())
    return {model.pieces[k]: sp.get_score(k) for k in range(len(model.pieces)) if model.kinds[k] in (op.NORMAL, op.USER)}


def best_score(text, scores, unknown):
    """Best sum of scores over all segmentations, trying every substring."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            piece = text[start:end]
            if piece in scores:
                best[end] = max(best[end], best[start] + scores[piece])
        if text[end - 1] not in scores:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


def path_score(ids, model, scores):
    total, held = 0.0, b""
    for k in ids:
        if k in model.byte_of:
            held += model.byte_of[k]
            try:
                held.decode()
            except UnicodeDecodeError:
                continue
            total, held = total + model.unk_score, b""
        else:
            total += scores[model.pieces[k]]
    return total


def test_viterbi_is_optimal_and_decodes(model, scores, small_rows):
    rnd = random.Random(1)
    texts = [t[:400] for _, t in rnd.sample(small_rows, 25)]
    texts += ["", " ", "  two  spaces ", "日本語 naïve ☃☃ x\ty\nz", "▁already", "a", "émentoi " * 3]
    for text in texts:
        ids = model.encode(text)
        plain = model.normalise(text)
        assert model.decode_normalised(ids) == plain
        assert path_score(ids, model, scores) == pytest.approx(best_score(plain, scores, model.unk_score))


def test_decode_gives_the_text(session, hard, hard_rows):
    got = op.decode(op.encode(hard.select("doc_id", "text"), "pieces").drop("text"), "back", "pieces").collect()
    assert bag((r.doc_id, r.back) for r in got) == bag((d, t or "") for d, t in hard_rows)


def test_library_decodes_the_ids(model, small_rows):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=op.model_path())
    for _, t in small_rows[:50]:
        assert sp.decode(model.encode(t)) == t


@pytest.mark.parametrize("table", ["hard", "small"])
def test_report(request, model, table):
    got = op.report(request.getfixturevalue(table)).collect()
    want = []
    for d, t in request.getfixturevalue(f"{table}_rows"):
        ids = np.array(model.encode(t), "<u4")
        want.append((d, len(ids), sum(int(k) in model.byte_of for k in ids), zlib.crc32(ids.tobytes()), True))
    assert bag(map(tuple, got)) == bag(want)


def test_words_kept_are_bounded(model):
    with open(op.model_path(), "rb") as f:
        tiny = op.PieceModel(f.read(), words_kept=5)
    text = " ".join(f"word{i}" for i in range(100))
    assert tiny.encode(text) == model.encode(text) and len(tiny.kept) <= 5


def test_empty_table(none):
    assert op.report(none).collect() == []
    assert "ids" in op.encode(none.drop("ids")).columns
