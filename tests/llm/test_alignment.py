import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimsmith.llm import cross_alignment as op

from .helpers import bag


class Brute:
    """Whole texts through both libraries, and every link spelled out."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        first, second, _ = op.tokenizer_paths()
        self.a, self.b = Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
        self.a.encode_special_tokens = True
        self.letters = op.byte_letters()

    def tokens(self, text):
        if not text:
            return None
        got = self.a.encode(" " + text, add_special_tokens=False)
        a = [(k, bytes(self.letters[c] for c in t)) for k, t in zip(got.ids, got.tokens)]
        b = []
        for k in self.b.encode(text):
            p = self.b.id_to_piece(k)
            b.append((k, bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()))
        data = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == data == b"".join(x for _, x in b) else None

    def groups(self, text):
        found = self.tokens(text)
        if found is None:
            return []
        ends = []
        for side in found:
            at, where = 0, []
            for _, x in side:
                at += len(x)
                where.append(at)
            ends.append(where)
        out, p, q = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0].index(cut, p) + 1, ends[1].index(cut, q) + 1
            out.append(([k for k, _ in found[0][p:i]], [k for k, _ in found[1][q:j]]))
            p, q = i, j
        return out

    def report(self, rows):
        grouped = [self.groups(t) for _, t in rows]
        counts, best = Counter(), defaultdict(int)
        for groups in grouped:
            counts.update({(x, y) for a, b in groups for x in a for y in b})
        for (x, _), n in counts.items():
            best[x] = max(best[x], n)
        out = []
        for (doc, _), groups in zip(rows, grouped):
            links = [counts[x, y] == best[x] for a, b in groups for x in a for y in b]
            total = sum(counts[x, y] for a, b in groups for x in a for y in b)
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            out.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                        sum(links), total, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
        return out


@pytest.fixture(scope="module")
def plain():
    return Brute()


ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "  two  spaces  ", "\t tab\n\nlines \r\n end \n", "mark ▁ in it", "x", " ", "\n",
       "it's we'll 'tis ' s", "a b", "日本語のテキスト と 空白", "😀😀 é́ ​ z w  em", "aaaa" * 500, " " * 700 + "x",
       "ab" * 400 + " " + "=" * 333, "\x1c sep \x85 next\x0bv\x0cf", "1234567890 12 3.14e10", "\x00 nul", "end. stop!! why?! a.b c,d x'. Été, straße; \0, q\0. one. one, One. 5. ²., x"]


@pytest.mark.parametrize("table", ["hard", "small"])
def test_equals_brute_force(request, plain, table):
    got = op.report(request.getfixturevalue(table))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert bag(map(tuple, got.collect())) == bag(plain.report(request.getfixturevalue(f"{table}_rows")))


def test_odd_texts_and_many_shards(session, plain):
    rows = [(k, t) for k, t in enumerate(ODD * 2)]
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    files = op.build_index(docs, shard_pairs=20)
    assert len(files) > 3
    assert bag(map(tuple, op.align(docs, files).collect())) == bag(plain.report(rows))
    found = op.pair_counts(session, files).collect()
    want = Counter()
    for _, t in rows:
        want.update({(x, y) for a, b in plain.groups(t) for x in a for y in b})
    assert {(r["first"], r["second"]): r.n_docs for r in found} == dict(want)


@pytest.mark.parametrize("limit, big", [(1, 16), (3000, 0), (1 << 20, 1 << 16)])
def test_units_are_those_of_the_whole_text(plain, monkeypatch, limit, big):
    monkeypatch.setattr(op, "BIG_GROUP", big)

    def work(fresh):
        for chunk in op.aligner(op.tokenizer_paths()).chunks(fresh):
            for n, k in enumerate(chunk.members):
                yield k, (chunk.groups[n], int(chunk.times[chunk.cut[n]:chunk.cut[n + 1]].sum())), 10

    known = op.Remembered(work, lambda a, b: (f"{a[0]};{b[0]}", a[1] + b[1]), limit)
    for text in [*ODD, " ".join(ODD[:3] + ODD[4:]), " ".join(ODD[:1] * 40)]:
        found = known.hold(set(op.units(text)))
        of = [found[u] for u in op.units(text)]
        want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain.groups(text))
        assert (None in of) == (not want)
        if want:
            assert ";".join(g for g, _ in of) == want
            assert sum(n for _, n in of) == sum(len(a) * len(b) for a, b in plain.groups(text))


def test_line_breaks_go_through_the_rank_file(plain):
    """Units with line breaks and tabs take the fast first tokenizer, and are cut as by the plain one."""
    known = op.aligner(op.tokenizer_paths())
    texts = ["end.\nNext", "a\n\nb", "x\n\n\n1 y", "été,\r\nÜber", "tab\tbed", "a\t\n b", "1\n2", "it's\n'tis", "a \n b\n", "\n\n c"]
    for u in {u for t in texts for u in op.units(t)}:
        assert op._PLAIN.fullmatch(u)
        assert known.plain.encode_ordinary(" " + u) == plain.a.encode(" " + u, add_special_tokens=False).ids
    for t in texts:
        got = [g for u in op.units(t) for c in known.chunks([u]) for g in c.groups]
        assert ";".join(got) == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain.groups(t))


@pytest.mark.parametrize("together", [1, 40, 1 << 22])
def test_units_of_several_texts_are_looked_up_once(monkeypatch, together):
    """A unit that many texts have is looked up once for all of them; each text keeps its units in order."""
    monkeypatch.setattr(op, "TOGETHER_CHARS", together)
    texts = ["to be or not to be", None, "to be, to be", "", "a  b\n c", "not to be,"]
    known = op.Remembered(lambda fresh: ((k, str(u), 1) for k, u in enumerate(fresh)), lambda a, b: f"{a}/{b}")
    seen = []
    for found, places in op._held(known, texts):
        assert len(set(found)) == len(found)
        seen += [[found[k] for k in wanted] for wanted in places]
    assert [[x.split("/")[0] for x in units] for units in seen] == [
        ["to", "be", "or", "not", "to", "be"], [], ["to", "be", "to", "be"], [], ["a  b\n c"], ["not", "to", "be"]]


def test_pairs_count_once_a_text():
    """A pair of several units, or of a unit met twice, counts once; a text with a unit without alignment has none."""
    found = [np.array(x, np.int64).tobytes() if x else None for x in ([5, 7], [7, 9, 7], None, [11])]
    texts = [np.array(x, np.int64) for x in ([0, 1, 0], [1, 1], [3, 2], [], [0])]
    pairs, counts = op._documents_of(found, texts)
    assert dict(zip(pairs.tolist(), counts.tolist())) == {5: 2, 7: 3, 9: 2}
    assert [len(x) for x in op._documents_of([], [np.zeros(0, np.int64)])] == [0, 0]


def test_units_with_inner_and_outer_space_in_one_run(plain):
    """Units of all kinds in one call: those with white space at an end are encoded apart, the others together."""
    known = op.aligner(op.tokenizer_paths())
    held = ["one", "a  b", " lead", "trail\t", "x \n y", "été", "日本", "mark ▁", "\n", "two,,", "=" * 90]
    got = {k: g for c in known.chunks(held) for k, g in zip(c.members, c.groups)}
    want = {k: ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain.groups(u)) for k, u in enumerate(held)}
    assert got == {k: x for k, x in want.items() if x}
    assert 7 not in got


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    pairs = np.unique(rng.integers(0, 1 << 48, n + 10))[:n]
    found = op.PairHash.build(pairs)
    assert sorted(found.slots(pairs).tolist()) == list(range(n))
    assert (found.slots(pairs + (1 << 50)) < n).all()


def test_unknown_pairs_are_refused(session):
    docs = session.createDataFrame([(1, "one text")], "doc_id long, text string")
    files = op.build_index(docs)
    with pytest.raises(Exception, match="not in the index"):
        op.align(session.createDataFrame([(2, "quite another")], docs.schema), files).collect()


def test_shards_as_spark_has_them(session):
    ids = np.arange(0, 60_000, 997)
    df = session.createDataFrame([(int(k) << 32,) for k in ids], "pair long").select("pair", op._shard(F.col("pair"), 7).alias("s"))
    assert {r.pair >> 32: r.s for r in df.collect()} == dict(zip(ids.tolist(), op.shard_numbers(7)(ids).tolist()))


def test_empty_table_and_texts_without_tokens(session, none):
    assert op.report(none).collect() == []
    docs = session.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert bag(map(tuple, op.report(docs).collect())) == bag([(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)])
