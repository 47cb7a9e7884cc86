import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from dimsmith.llm import token_store as op

from .helpers import bag


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(op.tokenizer_path())


def expected(rows, tokenizer):
    """(doc_id, n_tokens, crc) in id order, nulls first."""
    out = []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, op.END_ID], "<u4")
        out.append((d, len(ids), zlib.crc32(ids.tobytes())))
    return out


@pytest.mark.parametrize("table", ["hard", "small"])
def test_files_hold_the_library_ids_in_order(request, tokenizer, table):
    rows = request.getfixturevalue(f"{table}_rows")
    got = op.report(request.getfixturevalue(table)).orderBy("start").collect()
    want = expected(rows, tokenizer)
    assert bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == bag(want)
    assert [r.doc_id for r in got] == [d for d, _, _ in want]
    ends = np.cumsum([r.n_tokens for r in got])
    assert [r.start for r in got] == [0, *ends[:-1].tolist()]


def test_keyed_access(hard, hard_rows, tokenizer):
    manifest = op.write(hard, shards=4)
    for key in {d for d, _ in hard_rows}:
        want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, op.END_ID] for d, t in hard_rows if d == key]
        assert bag(x.tolist() for x in op.lookup(manifest, key)) == bag(want)
    for key in (99, -99, 2 ** 50):
        assert op.lookup(manifest, key) == []


def test_empty_table(none):
    assert op.write(none) == []
    assert op.report(none).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_index_is_minimal_and_perfect(n):
    keys = random.Random(n).sample(range(-10 ** 12, 10 ** 12), n)
    seeds, slots = op.build_index(keys)
    assert sorted(slots.tolist()) == list(range(n)) and len(seeds) == max(1, n // 3)


def test_fingerprints_turn_away_other_keys(tmp_path):
    keys = list(range(0, 3000, 3))
    chunks, _ = op.shard_bytes(keys, [b"\x07\x00"] * len(keys), 2)
    (tmp_path / "s").write_bytes(b"".join(chunks))
    shard = op.Shard(f"file://{tmp_path}/s")
    assert all(len(shard.get(k)) == 1 for k in keys)
    strangers = [k for k in range(3000) if k % 3]
    assert all(shard.get(k) == [] for k in strangers)
    assert sum(shard.find(k) is not None for k in strangers) <= 1


def test_word_by_word_is_exact(tokenizer):
    encoder = op.WordEncoder(op.tokenizer_path(), kept=50)
    rnd = random.Random(4)
    parts = ["a", "B", "é", "é", "́", " ", "\n", "\t", " ", " ", "\x1c", "\x85", "'s", "12", "<|endoftext|>",
             "Σ", "ẞ", "日", "😀", "-", "_", "\x00", "don't", "word,", "Word.***", "!?", "0", "<|", "|>", "\u0338", "<|ENDOFTEXT|>", "%%%", "'"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        got = np.frombuffer(encoder.encode(text), "<u2").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
