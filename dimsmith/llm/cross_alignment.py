"""Cross-tokenizer alignment, with counts held in dense vectors under a minimal perfect hash.

Both tokenizers cut a text's bytes; offsets where both have a token's end cut
the tokens into groups, and a token pair is linked where it shares a group. How
many documents hold a pair linked is counted over the corpus:

1. The first pass aligns documents and gives, a task at a time, the distinct
   pairs of each document with their number of documents.
2. Distinct pairs, in shards of their first id, get a minimal perfect hash each:
   a pair takes the slot of a bit that it alone hits at some level, numbered by
   the set bits before it. The shard file holds the pairs by slot.
3. Counts become dense vectors indexed by the hash: one vector for each shard
   and group of tasks, then the sum of the groups' vectors, written beside the
   pairs together with the highest count of each first id.
4. The second pass aligns the documents again and looks every pair up: one
   slot, whose stored pair is compared. A document with a pair that isn't there
   is an error.

A text is cut before each space between two characters that are no white space.
Neither tokenizer has tokens across such a place, so a text's alignment is that
of its units one after the other, and a worker remembers those met last.

Texts that are null, empty, or not given back byte by byte by either tokenizer
(one with the second tokenizer's space mark in it) have no tokens: zeros and an
empty digest. Null and repeated ids are kept, a row each; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import posixpath
import re
import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass
from itertools import count, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .aho_viterbi import MARK
from .common import byte_letters, partitions, read_input, shared_folder, stored, write_bytes

# File names of the contract.
FIRST_FILE, SECOND_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
RANKS_FILE = "byte_bpe_50k.tiktoken"  # the first vocabulary as ranks
KEPT_BYTES = 192 << 20   # of the units a worker remembers, twice
TOGETHER_CHARS = 1 << 22  # of texts whose units are looked up, and the new ones encoded, together
JOINED_CHARS = 1 << 14   # units encoded in one call
BIG_GROUP = 1 << 16      # pair occurrences of a group that are counted, not spelled out
SHARD_PAIRS = 1 << 19
SHARDS_OPEN = 32
FAN_IN = 8
BLOCK = 1 << 15
PARTIAL_PAIRS = 1 << 20
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r" (?:\s|(?<=\s ))")  # beginning with its space, so that the search goes from space to space


Paths = tuple[str, str, str | None]
# The pattern before the merges of the rank file; a fixed value of byte-level vocabularies.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters whose classes are the same in every edition of Unicode.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
# Marks after a letter: both tokenizers cut between them.
_MARKS = ".,;:!?"
_LETTER = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]")
_CROSSING = re.compile(f"{_LETTER.pattern}[{_MARKS}]")


def tokenizer_paths() -> Paths:
    """Files of both tokenizers, and of the first one's ranks (or None)."""
    import public_tokenizers
    return tuple(public_tokenizers.path(f) for f in (FIRST_FILE, SECOND_FILE, RANKS_FILE))


def units(text: str) -> list[str]:
    """Stretches of space+text, each without the space that opens it."""
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or _WIDE.search(text):
        return _CUT.split(text)
    return text.split(" ")  # no space is next to white space, so every one is a cut


def _clean(unit: str) -> bool:
    """Whether a unit neither begins nor ends with white space, nor has the second tokenizer's space mark."""
    return unit != "" and unit.strip() == unit and MARK not in unit


@dataclass
class Chunk:
    """The alignment of units that were encoded together.

    ``members`` are their numbers; ``tokens`` has a row of first tokens, second
    tokens and groups each; pairs (distinct in a unit) and how often they occur
    lie unit by unit, from ``cut[k]`` to ``cut[k + 1]``; ``groups`` are the texts.
    """

    members: list[int]
    tokens: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    cut: np.ndarray
    groups: list[str]


class Aligner:
    """Two tokenizer files side by side; a pair is ``first id << 32 | second id``."""

    def __init__(self, first: str, second: str, ranks: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task a core
        import sentencepiece
        from tokenizers import Tokenizer
        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        self.plain = None  # the first tokenizer from its ranks: the same ids in less time
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.plain = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=merges, special_tokens={})
        letters = byte_letters()
        vocab = self.first.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.a_bytes[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = []
        for k in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(k)
            if MARK in piece.lstrip(MARK):
                raise ValueError("a piece crosses into the next word")
            if self.second.is_byte(k) + self.second.is_control(k) + self.second.is_unknown(k) == 0 and _CROSSING.search(piece):
                raise ValueError("a piece crosses from a letter to a mark")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.second.is_byte(k) else
                                b"" if self.second.is_control(k) else piece.replace(MARK, " ").encode())
        self.a_len, self.b_len = (np.array([*map(len, x)], np.int64) for x in (self.a_bytes, self.b_bytes))
        # Each id as text before "," and "|" (first ids), "," and ";" (second ids).
        self.names = [f"{k}{end}" for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
                      for end in ends for k in range(n)]
        self.name_len = np.array([*map(len, self.names)], np.int64)

    def chunks(self, held: list[str | bytes], texts: bool = True) -> Iterator[Chunk]:
        """The units' alignments; units whose bytes a tokenizer doesn't give back are left out.

        Bytes among them are marks that follow a letter."""
        plain, other = [], []
        for k, u in enumerate(held):
            if isinstance(u, bytes):
                yield self._marks(k, u.decode())
            else:
                (plain if u.isascii() or _PLAIN.fullmatch(u) else other).append(k)
        for which in (plain, other):  # units of plain characters are encoded together
            run, size = [], 0
            for k in which:
                run.append(k)
                size += len(held[k])
                if size > JOINED_CHARS:
                    yield from self._run(held, run, texts)
                    run, size = [], 0
            yield from self._run(held, run, texts)

    def _run(self, held: list[str], run: list[int], texts: bool) -> Iterator[Chunk]:
        text = " ".join([held[k] for k in run])
        if not text[:1].isspace() and not text[-1:].isspace() and MARK not in text and not _WIDE.search(text):
            yield from self._encoded(held, run, texts)  # no unit begins or ends with white space
            return
        yield from self._encoded(held, [k for k in run if _clean(held[k])], texts)
        for k in run:
            if not _clean(held[k]):  # next to another unit its ends might be cut in another way
                yield from self._encoded(held, [k], texts)

    def _marks(self, k: int, marks: str) -> Chunk:
        """Marks after a letter: what is left of a word without its only letter."""
        (whole,) = self._encoded(["x" + marks], [0], True)
        (letter,) = self._encoded(["x"], [0], True)
        times = whole.times - np.isin(whole.pairs, letter.pairs)
        keep = times > 0
        groups = whole.groups[0].partition(";")[2]
        return Chunk([k], whole.tokens - letter.tokens, whole.pairs[keep], times[keep], np.array([0, keep.sum()]), [groups])

    def _encoded(self, held: list[str], run: list[int], texts: bool) -> Iterator[Chunk]:
        if not run:
            return
        units_ = [held[k] for k in run]
        text = " ".join(units_)
        if self.plain and _PLAIN.fullmatch(text):
            a = self.plain.encode_ordinary(" " + text)
        else:
            a = self.first.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.second.encode(text, num_threads=1)  # it puts the first space itself
        data = (" " + text).encode("utf-8", "surrogatepass")
        if b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b)):
            ends = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32)[1:], len(data))
            if len(ends) != len(run):  # spaces within units
                ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) + 1 for u in units_])
            yield self._grouped(run, a, b, ends, texts)
        elif len(run) > 1:
            for k in run:
                yield from self._encoded(held, [k], texts)

    def _grouped(self, run: list[int], a: list[int], b: list[int], unit_ends: np.ndarray, texts: bool) -> Chunk:
        a_ids, b_ids = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_len[a_ids]), np.cumsum(self.b_len[b_ids])
        both = np.zeros(a_ends[-1] + 1, np.int8)
        both[a_ends] = 1
        both[b_ends] += 1
        common = np.flatnonzero(both == 2)
        before = np.cumsum(both == 2)
        before[common] -= 1
        a_group, b_group, unit = before[a_ends], before[b_ends], np.searchsorted(unit_ends, common)
        n_a, n_b = (np.bincount(g, minlength=len(common)) for g in (a_group, b_group))
        a_from, b_from = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        big = n_a * n_b > BIG_GROUP
        spread = np.where(big, 0, n_b)[a_group]
        place = np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread)
        # A pair and its unit as one number: the vocabularies' sizes multiplied are below 2 ** 32.
        key = np.repeat((unit[a_group] * len(self.a_len) + a_ids) * len(self.b_len), spread) + b_ids[
            np.repeat(b_from[a_group], spread) + place]
        key, time = _counted(key)
        if big.any():
            keys, times = [key], [time]
            for g in np.flatnonzero(big):
                x, xn = np.unique(a_ids[a_from[g]:a_from[g] + n_a[g]], return_counts=True)
                y, yn = np.unique(b_ids[b_from[g]:b_from[g] + n_b[g]], return_counts=True)
                keys.append((((unit[g] * len(self.a_len) + x) * len(self.b_len))[:, None] + y).ravel())
                times.append((xn[:, None] * yn).ravel())
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            time = np.zeros(len(key), np.int64)
            np.add.at(time, at, np.concatenate(times))
        first, second = np.divmod(key, len(self.b_len))
        owner, first = np.divmod(first, len(self.a_len))
        cut = np.searchsorted(owner, np.arange(len(unit_ends) + 1))
        tokens = np.stack([np.bincount(unit, n, len(run)).astype(np.int64) for n in (n_a, n_b, np.ones(len(unit)))], axis=1)
        groups = self._texts(a_ids, b_ids, a_group, b_group, n_a, a_from, b_from, unit, len(run)) if texts else []
        return Chunk(run, tokens, first << 32 | second, time, cut, groups)

    def _texts(self, a_ids, b_ids, a_group, b_group, n_a, a_from, b_from, unit, n: int) -> list[str]:
        """The groups of each unit, ``a1,a2|b1;a3|b2,b3``: first ids before second ids, group by group."""
        a_last, b_last = (np.append(g[1:] != g[:-1], True) for g in (a_group, b_group))
        a_at = np.arange(len(a_ids)) + b_from[a_group]
        b_at = np.arange(len(b_ids)) + (a_from + n_a)[b_group]
        names = np.empty(len(a_ids) + len(b_ids), np.int64)
        names[a_at] = a_ids + len(self.a_len) * a_last
        names[b_at] = b_ids + 2 * len(self.a_len) + len(self.b_len) * b_last
        whole = "".join(map(self.names.__getitem__, names.tolist()))
        ends = np.cumsum(self.name_len[names])[b_at[b_last]]  # of the groups
        ends = ends[np.searchsorted(unit, np.arange(n), side="right") - 1].tolist()
        return [whole[start:end - 1] for start, end in zip([0, *ends], ends)]


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each occurs."""
    x = np.sort(x)
    at = np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])
    return x[at], np.diff(at, append=len(x))


class Remembered:
    """What was worked out of the units met last; about twice ``limit`` bytes at most, and a text's own.

    Results of a unit that ends in marks are put together by ``add`` from those
    of the word and of the marks."""

    def __init__(self, work, add, limit: int = KEPT_BYTES):
        self.work, self.add, self.limit, self.size = work, add, limit, 0
        self.kept: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def hold(self, wanted: Collection[str]) -> dict[str, object]:
        """Results that have all ``wanted`` units; None of a unit without alignment. Valid until the next call."""
        new = set(filterfalse(self.kept.__contains__, wanted))
        if new and self.size > self.limit:
            self.older, self.kept, self.size = self.kept, {}, 0
            new = set(wanted)
        if new:
            kept, older = self.kept, self.older
            if older:
                kept.update({u: older[u] for u in new if u in older})
            marked = [u for u in new if u[-1:] in _MARKS and u not in kept]
            parts = []
            for u in marked:
                word = u.rstrip(_MARKS)
                if _LETTER.fullmatch(word[-1:]) and _clean(u):
                    parts.append((u, word, u[len(word):].encode()))
            fresh = new.difference([u for u, _, _ in parts]).union(*[x[1:] for x in parts])
            todo = []
            for u in filterfalse(kept.__contains__, fresh):
                if u in older:
                    kept[u] = older[u]
                else:
                    todo.append(u)
            found = [None] * len(todo)
            for k, value, size in self.work(todo):
                found[k] = value
                self.size += size
            kept.update(zip(todo, found))
            for u, word, marks in parts:
                kept[u] = None if kept[word] is None else self.add(kept[word], kept[marks])
            self.size += sum(map(len, new)) + 250 * len(new)
        return self.kept


def _held(known: Remembered, texts: Iterable[str | None]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(results of the distinct units of several texts, the units of each text as places in that list)."""
    number, held, size = defaultdict(count().__next__), [], 0
    for text in texts:
        found = units(text)
        held.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
        size += len(text or "")
        if size > TOGETHER_CHARS:
            yield _results(known, number), held
            number, held, size = defaultdict(count().__next__), [], 0
    if held:
        yield _results(known, number), held


def _results(known: Remembered, wanted: dict[str, int]) -> list:
    return [*map(known.hold(wanted).__getitem__, wanted)]


_ALIGNERS: dict[Paths, Aligner] = {}


def aligner(paths: Paths) -> Aligner:
    """One a worker process."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


# -- the index ------------------------------------------------------------------

def _mix(x: np.ndarray, level: int) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shard(pair: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.shiftright(pair, 32)), F.lit(shards)).cast("int")


class PairHash:
    """Minimal perfect hash: levels of bits, each set where exactly one pair left over falls."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.cumsum(sizes) - sizes
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @classmethod
    def build(cls, pairs: np.ndarray) -> "PairHash":
        sizes, bits = [], []
        while len(pairs):
            size = -(-2 * len(pairs) // 64) * 64
            at = (_mix(pairs, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little"))
            pairs = pairs[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(bits or [np.zeros(0, np.uint8)]).view(np.uint64))

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        """Slot of each pair; -1 where no level has its bit."""
        out = np.full(len(pairs), -1, np.int64)
        left = np.arange(len(pairs))
        for level, (size, start) in enumerate(zip(self.sizes.tolist(), self.starts.tolist())):
            if not len(left):
                break
            at = start + (_mix(pairs[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return out


class Shard:
    """File of a shard: levels, words and pairs; after the sum also counts and which are highest.

    Little-endian int64 throughout: number of levels, of words, of pairs; level
    sizes; words; pairs by slot; then counts, negative where a pair's count is
    its first id's highest.
    """

    def __init__(self, uri: str):
        file = read_input(uri)
        data = np.frombuffer(file.read_buffer(file.size()), "<i8")
        levels, words, n = data[:3].tolist()
        at = 3 + levels
        self.hash = PairHash(data[3:at], data[at:at + words].view(np.uint64))
        self.pairs = data[at + words:at + words + n]
        self.counts = data[at + words + n:]

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        """Slot of each pair; -1 where the stored pair is another or none."""
        slots = self.hash.slots(pairs)
        there = slots >= 0
        there[there] = self.pairs[slots[there]] == pairs[there]
        return np.where(there, slots, -1)


def _chunks(found: PairHash, by_slot: np.ndarray) -> list[bytes]:
    head = np.array([len(found.sizes), len(found.words), len(by_slot)], "<i8")
    return [head.tobytes(), found.sizes.tobytes(), found.words.tobytes(), by_slot.tobytes()]


def _by_shard(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list[np.ndarray]]]]:
    """(first column's value, the other columns' arrays batch by batch) of each run of rows."""
    now, held = None, []
    for batch in it:
        keys = batch.column(0).to_numpy()
        ends = [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        start = 0
        for end in ends:
            if end == start:
                continue
            if keys[start] != now and now is not None:
                yield now, held
                held = []
            now = int(keys[start])
            held.append([batch.column(c).slice(start, end - start) for c in range(1, batch.num_columns)])
            start = end
    if now is not None:
        yield now, held


def _documents_of(found: list[bytes | None], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of several texts, and how many of the texts have each."""
    there = np.array([x is not None for x in found], bool)
    pairs, pair = np.unique(np.frombuffer(b"".join(filter(None, found)), np.int64), return_inverse=True)
    n = np.array([len(x or b"") >> 3 for x in found], np.int64)
    start = np.cumsum(n) - n
    counts = np.zeros(len(pairs), np.int64)
    for wanted in texts:
        if not there[wanted].all():
            continue
        of = np.unique(wanted)
        many = n[of]
        counts[pair[np.repeat(start[of] - np.cumsum(many) + many, many) + np.arange(many.sum())]] += 1  # once a pair
    had = counts > 0
    return pairs[had], counts[had]


def _first_pass(it: Iterator[pa.RecordBatch], paths: Paths) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of each document, added up as long as they fit."""
    def work(fresh: list[str]) -> Iterator[tuple[int, bytes, int]]:
        for chunk in aligner(paths).chunks(fresh, texts=False):
            data, cut = chunk.pairs.tobytes(), (8 * chunk.cut).tolist()
            for k, start, end in zip(chunk.members, cut, cut[1:]):
                yield k, data[start:end], end - start

    known = Remembered(work, bytes.__add__)
    part = TaskContext.get().partitionId()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add_up() -> None:
        nonlocal held, size, pairs, counts
        every, weights = (np.concatenate(x) for x in zip((pairs, counts), *held))
        pairs, at = np.unique(every, return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, at, weights)
        held, size = [], 0

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts), pa.array(np.full(len(pairs), part, np.int32))],
                                          names=["pair", "n", "part"])
    for found, texts in _held(known, (t.as_py() for batch in it for t in batch.column(0))):
        held.append(_documents_of(found, texts))
        size += len(held[-1][0])
        if size > PARTIAL_PAIRS:
            add_up()
            if len(pairs) > PARTIAL_PAIRS:
                yield give()
                pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if held or len(pairs):
        add_up()
        yield give()


def build_index(docs: DataFrame, text_col: str = "text", paths: Paths | None = None,
                shard_pairs: int = SHARD_PAIRS) -> list[str]:
    """Files of the shards, in order: every linked pair of the corpus with its number of documents.

    Only one row a shard reaches the driver; there are at most as many pairs as
    the vocabularies' sizes multiplied.
    """
    spark, paths = docs.sparkSession, paths or tokenizer_paths()
    folder, n = shared_folder(spark, "alignment"), partitions(spark)
    partial = stored(docs.select(F.col(text_col).alias("text")).mapInArrow(
        lambda it: _first_pass(it, paths), "pair long, n long, part int"))
    distinct = partial.select("pair").distinct()
    shards = max(1, -(-distinct.count() // shard_pairs))

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, held in _by_shard(it):
            pairs = np.concatenate([h[0].to_numpy() for h in held])
            found = PairHash.build(pairs)
            by_slot = np.zeros(len(pairs), "<i8")
            by_slot[found.slots(pairs)] = pairs
            uri = posixpath.join(folder, f"pairs-{shard:06d}-{uuid.uuid4().hex[:12]}")
            write_bytes(uri, _chunks(found, by_slot))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([uri])], names=["shard", "uri"])

    spread = distinct.select(_shard(F.col("pair"), shards).alias("shard"), "pair")
    made = spread.repartition(min(n, shards), "shard").sortWithinPartitions("shard").mapInArrow(build, "shard int, uri string")
    index = {r.shard: r.uri for r in made.collect()}

    def vectors(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held in _by_shard(it):
            shard, group = divmod(key, FAN_IN)
            there = Shard(index[shard])
            total = np.zeros(len(there.pairs), np.int64)
            for pairs, counts in held:
                slots = there.slots(pairs.to_numpy())
                if (slots < 0).any():
                    raise ValueError("a pair is not in the index")
                np.add.at(total, slots, counts.to_numpy())
            blocks = [total[k:k + BLOCK].tobytes() for k in range(0, len(total), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(blocks), shard, np.int32)), pa.array(np.arange(len(blocks), dtype=np.int32)),
                 pa.array(np.full(len(blocks), group, np.int32)), pa.array(blocks, pa.binary())],
                names=["shard", "block", "member", "counts"])

    def summed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, held in _by_shard(it):
            there = Shard(index[shard])
            total = np.zeros(len(there.pairs), np.int64)
            for block, _, counts in held:
                for k, data in zip(block.to_pylist(), counts):
                    part = np.frombuffer(data.as_buffer(), np.int64)
                    total[k * BLOCK:k * BLOCK + len(part)] += part
            first = there.pairs >> 32
            best = np.zeros(int(first.max(initial=0)) + 1, np.int64)
            np.maximum.at(best, first, total)
            total[total == best[first]] *= -1
            uri = posixpath.join(folder, f"counts-{shard:06d}-{uuid.uuid4().hex[:12]}")
            write_bytes(uri, [*_chunks(there.hash, there.pairs), total.astype("<i8").tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([uri])], names=["shard", "uri"])

    grouped = partial.select((_shard(F.col("pair"), shards) * FAN_IN + F.pmod("part", F.lit(FAN_IN))).alias("member"),
                             "pair", "n")
    tree = grouped.repartition(min(n, shards * FAN_IN), "member").sortWithinPartitions("member").mapInArrow(
        vectors, "shard int, block int, member int, counts binary")
    sums = tree.repartition(min(n, shards), "shard").sortWithinPartitions("shard", "block", "member").mapInArrow(
        summed, "shard int, uri string")
    files = {r.shard: r.uri for r in sums.collect()}
    return [files.get(k, "") for k in range(shards)]


class Counts:
    """Looks pairs up in the shard files; the shards used last stay open."""

    def __init__(self, files: list[str], shard_of):
        self.files, self.shard_of = files, shard_of
        self.open: OrderedDict[int, Shard] = OrderedDict()

    def shard(self, k: int) -> Shard:
        if k not in self.open:
            self.open[k] = Shard(self.files[k])
            if len(self.open) > SHARDS_OPEN:
                self.open.popitem(last=False)
        self.open.move_to_end(k)
        return self.open[k]

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of documents, whether it is the first id's highest) of each pair; 0 of one that isn't there."""
        shards = self.shard_of(pairs >> 32)
        out = np.zeros(len(pairs), np.int64)
        for k in np.unique(shards).tolist():
            if not self.files[k]:
                continue
            at = np.flatnonzero(shards == k)
            there = self.shard(k)
            slots = there.slots(pairs[at])
            out[at] = np.where(slots < 0, 0, there.counts[slots])
        return np.abs(out), out < 0


def shard_numbers(shards: int):
    """The shard of first ids, as Spark's hash of them has it."""
    import xxhash

    def of(first: np.ndarray) -> np.ndarray:
        if shards == 1:
            return np.zeros(len(first), np.int64)
        ids, at = np.unique(first, return_inverse=True)
        hashes = np.array([xxhash.xxh64_intdigest(int(k).to_bytes(8, "little"), 42) for k in ids], np.uint64).view(np.int64)
        return np.mod(hashes, shards)[at]
    return of


_OUT = ("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _second_pass(it: Iterator[pa.RecordBatch], paths: Paths, files: list[str]) -> Iterator[pa.RecordBatch]:
    counts = Counts(files, shard_numbers(len(files)))

    def work(fresh: list[str]) -> Iterator[tuple[int, tuple[bytes, str], int]]:
        for chunk in aligner(paths).chunks(fresh):
            n, best = counts.of(chunk.pairs)
            at = chunk.cut[:-1]
            # Links, links of highest count, counts added up, pairs that aren't in the index.
            sums = [np.add.reduceat(x, at) for x in (chunk.times, chunk.times * best, chunk.times * n, (n == 0).astype(np.int64))]
            data = np.column_stack([chunk.tokens, *sums]).tobytes()
            for place, (k, groups) in enumerate(zip(chunk.members, chunk.groups)):
                yield k, (data[place * 56:place * 56 + 56], groups), 56 + len(groups)

    known = Remembered(work, lambda a, b: (a[0] + b[0], f"{a[1]};{b[1]}"))
    for batch in it:
        rows = []
        for found, texts in _held(known, (t.as_py() for t in batch.column(1))):
            there = np.array([x is not None for x in found], bool)
            data, groups = zip(*[x or (bytes(56), "") for x in found]) if found else ((), ())
            sums = np.frombuffer(b"".join(data), np.int64).reshape(-1, 7)  # a unit that was put together has two rows
            if len(sums) > len(data):
                sums = np.add.reduceat(sums, np.cumsum([0, *map(len, data[:-1])]) // 56)
            for wanted in texts:
                if not len(wanted) or not there[wanted].all():
                    rows.append((0, 0, 0, 0, 0, 0, ""))
                    continue
                *totals, unknown = sums[wanted].sum(axis=0).tolist()
                if unknown:
                    raise ValueError("a pair is not in the index")
                text = ";".join(map(groups.__getitem__, wanted.tolist()))
                rows.append((*totals, hashlib.sha256(text.encode()).hexdigest()))
        columns = [batch.column(0), *(pa.array(c) for c in zip(*rows))] if rows else [batch.column(0)] + [
            pa.array([], pa.int64())] * 6 + [pa.array([], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(c.split()[0] for c in _OUT.split(", "))])


def align(docs: DataFrame, files: list[str], id_col: str = "doc_id", text_col: str = "text",
          paths: Paths | None = None) -> DataFrame:
    """One row a document: tokens, groups, links, links of highest count, counts added up, digest of the groups."""
    paths = paths or tokenizer_paths()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _second_pass(it, paths, files), f"doc_id {kind}, {_OUT}")


def pair_counts(spark: SparkSession, files: list[str]) -> DataFrame:
    """first, second, n_docs and highest of every pair in the index."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for uri in batch.column(0).to_pylist():
                there = Shard(uri)
                for k in range(0, len(there.pairs), BLOCK):
                    pairs, n = there.pairs[k:k + BLOCK], there.counts[k:k + BLOCK]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pairs >> 32), pa.array(pairs & 0xFFFFFFFF), pa.array(np.abs(n)), pa.array(n < 0)],
                        names=["first", "second", "n_docs", "highest"])
    there = [(f,) for f in files if f]
    listed = spark.createDataFrame(there, "uri string").repartition(max(1, len(there)))
    return listed.mapInArrow(run, "first long, second long, n_docs long, highest boolean")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Build the index of ``docs`` and align them by it."""
    return align(docs, build_index(docs, text_col), id_col, text_col)
