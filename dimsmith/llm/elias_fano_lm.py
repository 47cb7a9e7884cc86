"""Language-model scoring with Elias-Fano n-gram tries, one trie a shard.

Model: bigrams with Dirichlet-smoothed maximum likelihood,
p(w | u) = (c(u, w) + MU * p0(w)) / (c(u) + MU) with p0(w) = (c(w) + 0.5) / Z and
Z = N + 0.5 * (V + 1). Its logarithm is log(c(u, w) + MU * p0(w)) less
log(c(u) + MU). The first part needs what is known of w, the second what is
known of u, and u is itself a word to predict one place earlier. So all n-grams
are dealt by the predicted word, each shard holds the whole counts of its words
and their contexts, and one pass over the shards scores every document.

A shard's trie has two levels, the words and, below each, its contexts. The
level keys and the pointers between them are monotone sequences in Elias-Fano
form; the leaves hold quantised logarithms of the smoothed probabilities. A
lookup finds the word, then the context by successor search inside the word's
own range. A shard's levels are one file in the shared folder, queried through a
memory map (through ranged reads where the store is not a local one); it is
removed once the shard's documents are scored, unless ``folder`` asks to keep it.

Passes over the documents: (1) word counts, which give N, V and the words with
at least 1 / ``HOT`` of all tokens (so at most ``HOT``); (2) counts of pairs of
hot words, of which at most ``HOT`` are hot themselves; (3) n-grams by batch of
documents, pre-aggregated, to the shards. Hot words are dealt by word and
context, their counts broadcast; hot pairs are scored where they are read. So
no word and no pair, however frequent, gathers in one task.

Words are keyed by 64-bit hashes and contexts by 48 bits of them. A null or
empty text has the end token alone. Null ids count as the empty text for the
fold. With no training rows all counts are zero.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (batches, fold, open_fs, partitions, read_input, reliable, shared_folder, space_words,
                     write_bytes)

MU = 200.0
HOT = 2000
SHARDS_PER_TASK = 4
CONTEXT_BITS = 48
# Quantiser of log10 values: fixed grid, 16 bits.
STEP, LOWEST = 1 / 1024, -24.0
SEED = 11
END = np.uint64(xxhash.xxh64_intdigest(b"", SEED))
BEGIN = np.uint64(xxhash.xxh64_intdigest(b"", SEED + 1))
_CONTEXT = np.uint64((1 << CONTEXT_BITS) - 1)


def quantise(values: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((values - LOWEST) / STEP), 0, 65535).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return codes * STEP + LOWEST


class EliasFano:
    """Monotone sequence: low bytes as they are, high parts in unary in a bit vector.

    ``data`` is one flat buffer: header (n, low bytes an entry, high bit count),
    low parts, high bits. The number of low bits is a multiple of eight.
    """

    _HEAD = struct.Struct("<3q")

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> bytes:
        n = len(values)
        low = max(0, -(-((universe // max(n, 1)).bit_length() - 1) // 8)) if n else 0
        bits = np.uint64(8 * low)
        high = (values >> bits if low < 8 else np.zeros(n, np.uint64)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 2
        size += -size % 64
        ones = np.zeros(size, np.uint8)
        ones[high + np.arange(n)] = 1
        parts = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low]
        return cls._HEAD.pack(n, low, size) + parts.tobytes() + np.packbits(ones, bitorder="little").tobytes()

    def __init__(self, data):
        self.n, self.low, size = self._HEAD.unpack_from(data)
        at = self._HEAD.size
        self.lows = np.frombuffer(data, np.uint8, self.n * self.low, at).reshape(self.n, self.low)
        self.high = np.frombuffer(data, np.uint8, size // 8, at + self.n * self.low).reshape(-1, 8)
        # Zeros before each 64-bit word; a zero ends each high value's bucket.
        zeros = 64 - np.bitwise_count(self.high).sum(axis=1, dtype=np.int64)
        self.zeros = np.concatenate(([0], np.cumsum(zeros)))

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero (from 0)."""
        word = np.minimum(np.searchsorted(self.zeros, k, "right") - 1, len(self.high) - 1)
        out = np.empty(len(k), np.int64)
        for at in range(0, len(k), 1 << 15):
            part = slice(at, at + (1 << 15))
            seen = np.cumsum(np.unpackbits(self.high[word[part]], axis=1, bitorder="little") ^ 1, axis=1, dtype=np.uint8)
            want = (k[part] - self.zeros[word[part]] + 1).astype(np.uint8)
            out[part] = word[part] * 64 + (seen < want[:, None]).sum(axis=1)
        return out

    def _start(self, high: np.ndarray) -> np.ndarray:
        """Index of the first entry whose high part is at least this."""
        last = self.zeros[-1]
        out = np.zeros(len(high), np.int64)
        some = high > 0
        k = np.minimum(high[some], last) - 1
        out[some] = self._select0(k) - k
        return np.minimum(out, self.n)

    def lows_at(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros((len(i), 8), np.uint8)
        out[:, :self.low] = self.lows[i]
        return out.view("<u8").reshape(-1)

    def find(self, x: np.ndarray, lo: np.ndarray | int, hi: np.ndarray | int) -> np.ndarray:
        """Index of each x inside [lo, hi), or -1: successor search among the entries that share its high part."""
        if not self.n or not len(x):
            return np.full(len(x), -1)
        bits = np.uint64(8 * self.low)
        h = (x >> bits if self.low < 8 else np.zeros(len(x), np.uint64)).astype(np.int64)
        want = x & np.uint64((1 << (8 * self.low)) - 1) if self.low < 8 else x
        a, b = np.maximum(self._start(h), lo), np.minimum(self._start(h + 1), hi)
        end = b.copy()
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                break
            mid = (a[open_] + b[open_]) >> 1
            less = self.lows_at(mid) < want[open_]
            a[open_[less]] = mid[less] + 1
            b[open_[~less]] = mid[~less]
        out = np.full(len(x), -1)
        inside = np.flatnonzero(a < end)
        hit = inside[self.lows_at(a[inside]) == want[inside]]
        out[hit] = a[hit]
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at indices (select of the i-th one, by bisection over word counts)."""
        ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(ones, i, "right") - 1
        out = np.empty(len(i), np.int64)
        for k in range(0, len(i), 1 << 15):
            part = slice(k, k + (1 << 15))
            seen = np.cumsum(np.unpackbits(self.high[word[part]], axis=1, bitorder="little"), axis=1, dtype=np.uint8)
            want = (i[part] - ones[word[part]] + 1).astype(np.uint8)
            out[part] = word[part] * 64 + (seen < want[:, None]).sum(axis=1)
        return ((out - i).astype(np.uint64) << np.uint64(8 * self.low) if self.low < 8 else np.uint64(0)) | self.lows_at(i)


class Trie:
    """Two levels: words, and the contexts of each. Segments of at most 2**16 words share a key space."""

    SEGMENT = 1 << (64 - CONTEXT_BITS)

    @classmethod
    def build(cls, words: np.ndarray, word_counts: np.ndarray, ranges: np.ndarray, contexts: np.ndarray,
              codes: np.ndarray) -> list[bytes]:
        """Levels of sorted ``words``; word k has the sorted contexts ``ranges[k]`` to ``ranges[k + 1]``."""
        of = np.repeat(np.arange(len(words)), np.diff(ranges))
        keys = ((of % cls.SEGMENT).astype(np.uint64) << np.uint64(CONTEXT_BITS)) | contexts
        cuts = ranges[np.append(np.arange(0, len(words), cls.SEGMENT), len(words))]
        second = [EliasFano.build(keys[a:b], (min(cls.SEGMENT, len(words)) << CONTEXT_BITS)) for a, b in zip(cuts, cuts[1:])]
        return [EliasFano.build(words, 1 << 64), EliasFano.build(ranges.astype(np.uint64), int(ranges[-1]) + 1),
                word_counts.astype("<i8").tobytes(), codes.astype("<u2").tobytes(), *second]

    def __init__(self, levels: list):
        self.words, self.ranges = EliasFano(levels[0]), EliasFano(levels[1])
        self.counts, self.codes = np.frombuffer(levels[2], "<i8"), np.frombuffer(levels[3], "<u2")
        self.second = [EliasFano(x) for x in levels[4:]]
        self.offsets = np.concatenate(([0], np.cumsum([x.n for x in self.second]))).astype(np.int64)

    def word(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word, or -1."""
        return self.words.find(hashes, 0, self.words.n)

    def context(self, ranks: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Leaf of each (word rank, context), or -1: a search inside the word's own range."""
        out = np.full(len(ranks), -1)
        for k, level in enumerate(self.second):
            own = np.flatnonzero(ranks // self.SEGMENT == k) if len(self.second) > 1 else np.flatnonzero(ranks >= 0)
            if len(own):
                lo = self.ranges.at(ranks[own]).astype(np.int64) - self.offsets[k]
                hi = self.ranges.at(ranks[own] + 1).astype(np.int64) - self.offsets[k]
                key = ((ranks[own] % self.SEGMENT).astype(np.uint64) << np.uint64(CONTEXT_BITS)) | contexts[own]
                found = level.find(key, lo, hi)
                out[own] = np.where(found >= 0, found + self.offsets[k], -1)
        return out


@contextmanager
def mapped(levels: list[bytes], folder: str, name: str, keep: bool) -> Iterator[list]:
    """The levels in a file below ``folder``, memory-mapped; the file goes in the end unless kept."""
    uri = posixpath.join(folder, f"{name}-{uuid.uuid4().hex[:8]}.trie")
    write_bytes(uri, levels)
    sizes = [len(x) for x in levels]
    levels.clear()
    with read_input(uri) as file:
        yield [file.read_at(n, end - n) for n, end in zip(sizes, np.cumsum(sizes).tolist())]
    if not keep:
        fs, path = open_fs(uri)
        fs.delete_file(path)


def word_hashes(words) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, SEED) for w in words], np.uint64)


# Pass 1 and 2: word counts; counts of pairs of hot words.

_COUNT = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _count_words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        counts: Counter = Counter()
        for text in batch.column(0):
            counts.update(space_words(text.as_py()))
        keys = np.append(word_hashes(counts), END)
        n = np.append(np.fromiter(counts.values(), np.int64, len(counts)), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(_signed(keys)), pa.array(n)], schema=_COUNT)


def _count_pairs(hot: dict[int, int]):
    """Counts of (context, word) pairs whose words are both hot; key: context number * size + word number."""
    size = len(hot) + 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        begin, end = len(hot), hot.get(int(END), -1)
        for batch in it:
            total: Counter = Counter()
            for text in batch.column(0):
                words = space_words(text.as_py())
                for w in {w for w in words if w not in number}:
                    if len(number) > 1_000_000:
                        break
                    number[w] = hot.get(xxhash.xxh64_intdigest(w, SEED), -1)
                ids = [begin, *(number[w] if w in number else hot.get(xxhash.xxh64_intdigest(w, SEED), -1) for w in words), end]
                x = np.array(ids, np.int64)
                both = (x[:-1] >= 0) & (x[1:] >= 0)
                total.update((x[:-1] * size + x[1:])[both].tolist())
            yield from batches(total.items(), _COUNT)
    return run


class Totals:
    """Corpus totals and the hot words and pairs (each at most ``HOT``)."""

    def __init__(self, train: DataFrame, mu: float):
        words = reliable(train.mapInArrow(_count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
                         .where("n > 0"))
        row = words.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).first()
        self.v, self.n, self.mu = row["v"], row["n"] or 0, mu
        self.z = self.n + 0.5 * (self.v + 1)
        self.rows = train.count()
        least = max(1.0, self.n / HOT)
        found = words.where(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(HOT).collect()
        self.hot = {r["key"] & ((1 << 64) - 1): r["n"] for r in found}
        self.hot_pairs: dict[tuple[int, int], int] = {}
        if self.hot:
            number = {h: k for k, h in enumerate(sorted(self.hot))}
            listed = [*sorted(self.hot), int(BEGIN)]
            pairs = (train.mapInArrow(_count_pairs(number), "key long, n long").groupBy("key")
                     .agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(HOT))
            size = len(listed)
            self.hot_pairs = {(listed[r["key"] // size], listed[r["key"] % size]): r["n"] for r in pairs.collect()}

    def values(self, word_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """MU * p0 of words, and log10(c + MU) as contexts (quantised)."""
        return self.mu * (word_counts + 0.5) / self.z, restored(quantise(np.log10(word_counts + self.mu)))


# Pass 3: n-grams of a batch of documents to the shards.
# Message: counts of words, pairs and entries; per word hash and pairs; per pair
# context and entries; per entry document and count; training flags of documents.

_MSG_SQL = "shard int, batch long, kind int, payload binary"
_MSG = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_HEAD = struct.Struct("<4q")


def _pack(w: np.ndarray, u: np.ndarray, doc: np.ndarray, n: np.ndarray, train: np.ndarray) -> bytes:
    """Entries in (word, context, document) order."""
    new_pair = np.ones(len(w), bool)
    new_pair[1:] = (w[1:] != w[:-1]) | (u[1:] != u[:-1])
    pair_at = np.flatnonzero(new_pair)
    pw, pu = w[pair_at], u[pair_at]
    word_at = np.flatnonzero(np.append(True, pw[1:] != pw[:-1]))
    contexts = pu.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CONTEXT_BITS // 8]
    return b"".join((
        _HEAD.pack(len(word_at), len(pair_at), len(w), len(train)), pw[word_at].astype("<u8").tobytes(),
        np.diff(np.append(word_at, len(pair_at))).astype("<u4").tobytes(), contexts.tobytes(),
        np.diff(np.append(pair_at, len(w))).astype("<u4").tobytes(), doc.astype("<u2").tobytes(),
        n.astype("<u4").tobytes(), np.packbits(train).tobytes()))


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    words, pairs, entries, docs = _HEAD.unpack_from(data)
    at = _HEAD.size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out
    w, per_word = take("<u8", words), take("<u4", words)
    raw = take("u1", pairs * (CONTEXT_BITS // 8)).reshape(pairs, -1)
    u = np.zeros((pairs, 8), np.uint8)
    u[:, :raw.shape[1]] = raw
    per_pair, doc, n = take("<u4", pairs), take("<u2", entries), take("<u4", entries)
    train = np.unpackbits(take("u1", -(-docs // 8)), count=docs).astype(bool)
    return np.repeat(w, per_word), u.view("<u8").reshape(-1), per_pair, doc, n, train


class _Sums:
    """Per-document sums of a batch: base logarithms, known tokens, model logarithms."""

    def __init__(self, docs: int):
        self.base, self.known, self.score = np.zeros(docs), np.zeros(docs, np.int64), np.zeros(docs)

    def add(self, doc: np.ndarray, n: np.ndarray, c: np.ndarray, gain: np.ndarray, cost: np.ndarray) -> None:
        """Entries: document, times, word count, log10 numerator, log10 cost as a context."""
        size = len(self.base)
        self.base += np.bincount(doc, n * np.log10(c + 0.5), size)
        self.known += np.bincount(doc, n * (c > 0), size).astype(np.int64)
        self.score += np.bincount(doc, n * (gain - cost), size)

    def pack(self) -> bytes:
        return b"".join((struct.pack("<q", len(self.base)), self.base.tobytes(), self.known.tobytes(), self.score.tobytes()))

    def merge(self, data: bytes) -> None:
        n = struct.unpack_from("<q", data)[0]
        parts = [np.frombuffer(data, kind, n, 8 + 8 * n * k) for k, kind in enumerate(("<f8", "<i8", "<f8"))]
        self.base += parts[0]
        self.known += parts[1]
        self.score += parts[2]


def _messages(totals, shards: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = totals.value
        hot = np.array(sorted(t.hot), np.uint64)
        hot_counts = np.array([t.hot[h] for h in sorted(t.hot)], np.int64)
        pairs = sorted(t.hot_pairs)
        batch_key = TaskContext.get().partitionId() << 33
        for batch in it:
            for at in range(0, batch.num_rows, 60_000):  # document numbers have 16 bits
                part = batch.slice(at, 60_000)
                for shard, kind, payload in _batch_messages(part, t, hot, hot_counts, pairs, shards):
                    number = batch_key % shards if shard < 0 else shard
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                        (number, batch_key, kind, payload), _MSG)], schema=_MSG)
                batch_key += 1
    return run


def _batch_messages(batch: pa.RecordBatch, t: Totals, hot: np.ndarray, hot_counts: np.ndarray,
                    pairs: list[tuple[int, int]], shards: int) -> Iterator[tuple[int, int, bytes]]:
    train = np.array(batch.column(2).to_pylist(), bool)
    vocab: dict[bytes, int] = {}
    number, ids, sizes = vocab.setdefault, [], []
    for text in batch.column(1):
        words = space_words(text.as_py())
        ids.extend([number(w, len(vocab)) for w in words])
        sizes.append(len(words))
    sizes = np.array(sizes, np.int64)
    hashes = np.concatenate((word_hashes(vocab), [END, BEGIN]))
    n_words, docs = len(vocab), len(sizes)
    ends = np.cumsum(sizes + 1) - 1
    w = np.full(len(ids) + docs, n_words, np.int64)
    inner = np.ones(len(w), bool)
    inner[ends] = False
    w[inner] = np.array(ids, np.int64) if ids else np.zeros(0, np.int64)
    del ids
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[np.append(0, ends[:-1] + 1)] = n_words + 1
    doc = np.repeat(np.arange(docs), sizes + 1)
    # Local numbers in hash order, so that sorting by number sorts by hash.
    order = np.argsort(hashes, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    hashes, w, u = hashes[order], rank[w], rank[u]
    size = len(hashes)
    key, n = np.unique((w * size + u) * docs + doc, return_counts=True)
    w, rest = key // (size * docs), key % (size * docs)
    u, doc = rest // docs, rest % docs
    sums = _Sums(docs)
    hot_at = np.searchsorted(hot, hashes) if len(hot) else np.zeros(size, np.int64)
    is_hot = (hot[np.minimum(hot_at, len(hot) - 1)] == hashes) if len(hot) else np.zeros(size, bool)
    counts = np.where(is_hot, hot_counts[np.minimum(hot_at, len(hot) - 1)], 0) if len(hot) else np.zeros(size, np.int64)
    # Hot pairs are scored here.
    here = np.zeros(len(key), bool)
    if pairs:
        local = {int(h): k for k, h in enumerate(hashes)}
        known = {local[b] * size + local[a]: t.hot_pairs[a, b] for a, b in pairs if a in local and b in local}
        if known:
            listed = np.array(sorted(known), np.int64)
            pair_counts = np.array([known[k] for k in listed.tolist()], np.int64)
            pair = w * size + u
            spot = np.minimum(np.searchsorted(listed, pair), len(listed) - 1)
            here = listed[spot] == pair
            c = counts[w[here]]
            prior, cost = t.values(c)
            gain = restored(quantise(np.log10(pair_counts[spot[here]] + prior)))
            sums.add(doc[here], n[here], c, gain, np.where(hashes[w[here]] == END, 0.0, cost))
    header = struct.pack("<q", docs) + train.tobytes() + sizes.astype("<i8").tobytes()
    ids_column = pa.RecordBatch.from_arrays([batch.column(0)], names=["doc_id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ids_column.schema) as out:
        out.write_batch(ids_column)
    yield -1, 0, header + sink.getvalue().to_pybytes()
    yield -1, 1, sums.pack()
    w, u, doc, n = w[~here], u[~here], doc[~here], n[~here]
    wh, uh = hashes[w], hashes[u]
    mix = (wh ^ (uh * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    shard = (np.where(is_hot[w], mix >> np.uint64(20), wh >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
    uh = uh & _CONTEXT
    by = np.lexsort((uh, wh, shard)) if len(shard) else np.zeros(0, np.int64)
    cut = np.searchsorted(shard[by], np.arange(shards + 1))
    for s in range(shards):
        rows = by[cut[s]:cut[s + 1]]
        if len(rows):
            yield s, 2, _pack(wh[rows], uh[rows], doc[rows], n[rows], train)


def _score_shard(messages: list[tuple[int, bytes]], t: Totals, hot: np.ndarray, hot_counts: np.ndarray,
                 sums: dict[int, _Sums], folder: str, name: str, keep: bool) -> None:
    parts = [_unpack(m) for _, m in messages]
    w, u = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    c = np.concatenate([np.add.reduceat(np.where(p[5][p[3]], p[4], 0).astype(np.int64), np.cumsum(p[2], dtype=np.int64) - p[2])
                        for p in parts])
    order = np.lexsort((u, w))
    w, u, c = w[order], u[order], c[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (u[1:] != u[:-1])
    pair_of = np.empty(len(w), np.int64)
    pair_of[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    w, u, c = w[at], u[at], np.add.reduceat(c, at)
    # The trie holds what training rows have.
    kw, ku, kc = w[c > 0], u[c > 0], c[c > 0]
    word_at = np.flatnonzero(np.append(True, kw[1:] != kw[:-1])) if len(kw) else np.zeros(0, np.int64)
    words = kw[word_at]
    word_counts = np.add.reduceat(kc, word_at) if len(kw) else np.zeros(0, np.int64)
    if len(hot) and len(words):
        spot = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        word_counts = np.where(hot[spot] == words, hot_counts[spot], word_counts)
    ranges = np.append(word_at, len(kw))
    prior, _ = t.values(np.repeat(word_counts, np.diff(ranges)))
    levels = Trie.build(words, word_counts, ranges, ku, quantise(np.log10(kc + prior)))
    with mapped(levels, folder, name, keep) as views:
        wc, gain, cost = _lookup(Trie(views), t, hot, hot_counts, w, u)
    first = 0
    for (batch, _), (_, _, per_pair, doc, n, train) in zip(messages, parts):
        pair = np.repeat(pair_of[first:first + len(per_pair)], per_pair)
        first += len(per_pair)
        if batch not in sums:
            sums[batch] = _Sums(len(train))
        sums[batch].add(doc, n, wc[pair], gain[pair], cost[pair])


def _lookup(trie: Trie, t: Totals, hot: np.ndarray, hot_counts: np.ndarray, w: np.ndarray,
            u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word count, log10 numerator and log10 cost as a context of each distinct (word, context), sorted."""
    distinct = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
    of = np.repeat(np.arange(len(distinct)), np.diff(np.append(distinct, len(w))))
    ranks = trie.word(w[distinct])
    wc = np.where(ranks >= 0, trie.counts[np.maximum(ranks, 0)] if len(trie.counts) else 0, 0)
    if len(hot):  # a hot word's training pairs may all be in other shards
        spot = np.minimum(np.searchsorted(hot, w[distinct]), len(hot) - 1)
        wc = np.where(hot[spot] == w[distinct], hot_counts[spot], wc)
    prior, cost = t.values(wc)
    cost = np.where(w[distinct] == END, 0.0, cost)
    leaf = trie.context(ranks[of], u)
    unseen = restored(quantise(np.log10(prior)))[of]
    gain = np.where(leaf >= 0, restored(trie.codes[np.maximum(leaf, 0)]) if len(trie.codes) else 0.0, unseen)
    return wc[of], gain, cost[of]


_PART_SQL = "batch long, kind int, payload binary"
_PART = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
HELD_DOCS = 2_000_000


def _scores(totals, folder: str, keep: bool):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = totals.value
        hot = np.array(sorted(t.hot), np.uint64)
        hot_counts = np.array([t.hot[h] for h in sorted(t.hot)], np.int64)
        sums: dict[int, _Sums] = {}
        shard, held = None, []

        def rows(parts) -> Iterator[pa.RecordBatch]:
            for batch, kind, payload in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip((batch, kind, payload), _PART)], schema=_PART)

        for batch in it:
            for number, key, kind, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if kind < 2:
                    yield from rows([(key, kind, payload)])
                    continue
                if number != shard and held:
                    _score_shard(held, t, hot, hot_counts, sums, folder, f"shard-{shard}", keep)
                    held = []
                    if sum(len(x.base) for x in sums.values()) > HELD_DOCS:
                        yield from rows((k, 1, x.pack()) for k, x in sums.items())
                        sums.clear()
                shard = number
                held.append((key, payload))
        if held:
            _score_shard(held, t, hot, hot_counts, sums, folder, f"shard-{shard}", keep)
        yield from rows((k, 1, x.pack()) for k, x in sums.items())
    return run


def _results(totals):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = totals.value
        first_cost = float(restored(quantise(np.log10([t.rows + t.mu])))[0])  # the begin mark as a context
        key, header, sums = None, None, None

        def finished() -> pa.RecordBatch:
            docs = len(sums.base)
            train = np.frombuffer(header, bool, docs, 8)
            n = np.frombuffer(header, "<i8", docs, 8 + docs) + 1
            with pa.ipc.open_stream(pa.py_buffer(header[8 + 9 * docs:])) as stream:
                ids = stream.read_all().column(0).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(~train), pa.array(n), pa.array(sums.known),
                 pa.array(np.full(docs, t.n, np.int64)), pa.array(sums.base - n * np.log10(t.z)),
                 pa.array(sums.score - first_cost)], names=names)

        for batch in it:
            for number, kind, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if number != key:
                    if key is not None:
                        yield finished()
                    key, header = number, payload  # the header is the first row of its batch
                    sums = _Sums(struct.unpack_from("<q", payload)[0])
                else:
                    sums.merge(payload)
        if key is not None:
            yield finished()
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5, held: int = 1,
          mu: float = MU, folder: str | None = None) -> DataFrame:
    """Train on the rows outside the held-out fold and score every row.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (log10 probability of the text under the model). With ``folder`` the shards'
    tries stay there.
    """
    spark = docs.sparkSession
    keep, folder = folder is not None, folder or shared_folder(spark, "trie")
    doc_id = F.col(id_col)
    rows = docs.select(doc_id.cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       (fold(doc_id, modulus) != held).alias("train"))
    totals = Totals(rows.where("train").select("text"), mu)
    shared, tasks = spark.sparkContext.broadcast(totals), partitions(spark)
    shards = SHARDS_PER_TASK * tasks
    dealt = rows.mapInArrow(_messages(shared, shards), _MSG_SQL)
    parts = (dealt.repartition(tasks, "shard").sortWithinPartitions("shard", "batch")
             .mapInArrow(_scores(shared, folder, keep), _PART_SQL))
    return (parts.repartition(tasks, "batch").sortWithinPartitions("batch", "kind")
            .mapInArrow(_results(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                          "train_tokens long, base_score double, score double"))
