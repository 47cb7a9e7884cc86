"""Benchmark decontamination with a suffix automaton over test items.

Items are normalised to words and joined, each followed by a separator of its
own, into one suffix automaton. A document streams through it word by word; the
automaton state tells the longest suffix of the words read that occurs in some
item. Where it reaches the window length (or all of a shorter item), the words
of that window are hit.

The items are a stated query set. They are taken in blocks of ``BLOCK_WORDS``
words; each block's automaton, bounded by that, is broadcast and run over all
documents. A null or empty item has no words and never occurs; a null text has
no words and is never hit; items that repeat an id count as one item.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, fresh, reliable

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 200_000
# Words of a text as it is, before A-Z are lower-cased.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class ItemAutomaton:
    """Suffix automaton over the words of a block of items."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        listed = [(name, [self.vocab.setdefault(w, len(self.vocab)) for w in words]) for name, words in items if words]
        last = 0
        for k, (_, ids) in enumerate(listed):
            for token in ids:
                last = self._extend(last, token)
            last = self._extend(last, -1 - k)
        # Ancestor (or self) whose strings include the last ``window`` words.
        self.window_state = [-1] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            if self.len[s] >= window:
                parent = self.link[s]
                self.window_state[s] = s if self.len[parent] < window else self.window_state[parent]
        self.items_at: dict[int, set[str]] = {}
        self.short_at: dict[int, list[tuple[int, str]]] = {}
        for name, ids in listed:
            for _, state, length in self._stream(ids, 0):
                if length >= window:
                    self.items_at.setdefault(self.window_state[state], set()).add(name)
            if len(ids) < window:
                state = 0
                for token in ids:
                    state = self.next[state][token]
                self.short_at.setdefault(state, []).append((len(ids), name))
        # Nearest ancestor (or self) at which a short item ends.
        self.short_up = [-1] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.short_up[s] = s if s in self.short_at else self.short_up[self.link[s]]
        self.least = min([window, *(n for short in self.short_at.values() for n, _ in short)])

    def _extend(self, last: int, token: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        cur = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        p = last
        while p != -1 and token not in nxt[p]:
            nxt[p][token] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][token]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                while p != -1 and nxt[p].get(token) == q:
                    nxt[p][token] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        return cur

    def _stream(self, ids: list[int], at: int) -> Iterator[tuple[int, int, int]]:
        """(place, state, longest match) after each of the known words ``ids``."""
        nxt, link, length = self.next, self.link, self.len
        state = matched = 0
        for place, token in enumerate(ids, at):
            step = nxt[state].get(token)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = nxt[state].get(token)
            if step is None:
                matched = 0
            else:
                state, matched = step, matched + 1
            yield place, state, matched

    def search(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Hit words (one flag a word) and the items with an occurring window."""
        hit, items = np.zeros(len(words), bool), set()
        ids = list(map(self.vocab.get, words, repeat(-1)))
        known = np.zeros(len(words) + 2, np.int8)
        known[1:-1] = np.array(ids, np.int64) >= 0
        turn = np.flatnonzero(np.diff(known))
        for a, b in zip(turn[::2].tolist(), turn[1::2].tolist()):
            if b - a < self.least:  # no window fits between two unknown words
                continue
            for place, state, matched in self._stream(ids[a:b], a):
                if matched >= self.window:
                    hit[place + 1 - self.window:place + 1] = True
                    items |= self.items_at[self.window_state[state]]
                short = self.short_up[state]
                while short != -1:
                    for n, name in self.short_at.get(short, ()):
                        if n <= matched:
                            hit[place + 1 - n:place + 1] = True
                            items.add(name)
                    short = self.short_up[self.link[short]]
        return hit, items


def blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in id order, in lists of about ``block_words`` words; one partition at a time reaches the driver."""
    held, size = [], 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("k"), F.col(text_col).alias("t"))
    for row in rows.orderBy("k", "t").toLocalIterator():
        words = alnum_words(row["t"])
        held.append((row["k"], words))
        size += len(words)
        if size >= block_words:
            yield held
            held, size = [], 0
    if held:
        yield held


_FOUND = "n_words long, n_hit long, hits binary, items array<string>"


def _search_udf(automaton: Broadcast):
    @F.pandas_udf(_FOUND)
    def found(texts: pd.Series, before: pd.Series, items: pd.Series) -> pd.DataFrame:
        out = []
        for text, packed, names in zip(texts, before, items):
            words = alnum_words(text)
            hit, new = automaton.value.search(words)
            if packed is not None:
                hit |= unpack(packed, len(words))
            some = bool(hit.any())
            out.append((len(words), int(hit.sum()), pack(hit) if some else None,
                        sorted(new.union(() if names is None else names))))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "hits", "items"])
    return found.asNondeterministic()  # else Catalyst may run it once for a filter and once more for the column


def pack(hit: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(hit).tobytes(), 1)


def unpack(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n).astype(bool)


def scan(docs: DataFrame, items: DataFrame, column: str, text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a struct ``column``: n_words, n_hit, hits (packed flags, null if none) and items.

    Blocks after the first read the rows of the block before from a checkpoint,
    so one automaton at a time is in a worker's memory.
    """
    return _scan(docs, [*blocks(items, item_id, item_text, block_words)] or [[]], column, text_col, window)


def _scan(docs: DataFrame, listed: list, column: str, text_col: str, window: int = WINDOW) -> DataFrame:
    none = F.lit(None)
    out = None
    for block in listed:
        found = _search_udf(docs.sparkSession.sparkContext.broadcast(ItemAutomaton(block, window)))
        if out is None:
            out = docs.withColumn(column, found(F.col(text_col), none.cast("binary"), none.cast("array<string>")))
        else:
            out = reliable(out).withColumn(
                column, found(F.col(text_col), F.col(f"{column}.hits"), F.col(f"{column}.items")))
    return out


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = scan(rows, items, "found", **options).select("doc_id", "found.*")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def cut(text: str, hit: np.ndarray) -> str:
    """The text without its runs of hit words (from a run's first character to its last)."""
    spans = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    out, at = [], 0
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        out.append(text[at:spans[a][0]])
        at = spans[b - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", max_coverage: float = MAX_COVERAGE,
                  **options) -> DataFrame:
    """Documents without their hit spans; those covered over ``max_coverage`` go.

    All columns stay; only the text changes, and only where words are hit.
    """
    found = [*blocks(items, options.pop("item_id", "item_id"), options.pop("item_text", "text"),
                     options.pop("block_words", BLOCK_WORDS))] or [[]]
    column = fresh(docs, "found")
    if len(found) == 1:  # one pass of one function
        shared = docs.sparkSession.sparkContext.broadcast(ItemAutomaton(found[0], options.pop("window", WINDOW)))

        @F.pandas_udf("n_words long, n_hit long, text string")
        def cleaned(texts: pd.Series) -> pd.DataFrame:
            out = []
            for text in texts:
                hit, _ = shared.value.search(alnum_words(text))
                n = int(hit.sum())
                out.append((len(hit), n, cut(text, hit) if n else text))
            return pd.DataFrame(out, columns=["n_words", "n_hit", "text"])

        marked = docs.withColumn(column, cleaned.asNondeterministic()(F.col(text_col)))
        left = marked.where(F.col(f"{column}.n_hit") <= max_coverage * F.col(f"{column}.n_words"))
        return left.withColumn(text_col, F.col(f"{column}.text")).select(*[F.col(f"`{c}`") for c in docs.columns])

    @F.pandas_udf("string")
    def without(texts: pd.Series, packed: pd.Series) -> pd.Series:
        return pd.Series([t if p is None else cut(t, unpack(p, len(alnum_words(t)))) for t, p in zip(texts, packed)],
                         dtype=object)

    marked = _scan(docs, found, column, text_col, **options)
    left = marked.where(F.col(f"{column}.n_hit") <= max_coverage * F.col(f"{column}.n_words"))
    return left.withColumn(text_col, without(F.col(text_col), F.col(f"{column}.hits"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
