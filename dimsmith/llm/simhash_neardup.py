"""SimHash near-duplicates by a segment-popcount embedding and a grid range join.

A 64-bit fingerprint is cut into 32 segments of two bits; a segment's bit count
(0 to 2), written in unary, gives an embedding in which the Manhattan distance
of two fingerprints is the number of differing unary bits. It never exceeds
their bit distance, so Manhattan distance above the limit rules a pair out.

Grid: the segments form B blocks. Two fingerprints within distance d agree on
the counts of at least B - d blocks, so one grid for each choice of B - d
blocks, keyed by their counts, brings every pair within reach into one cell.
B is the number with the least expected work for the number of distinct
fingerprints; every B finds the same links. Cells with one fingerprint are
dropped; a large cell is dealt out as pairs of chunks, each compared in a task
of its own. Candidates pass the Manhattan bound and then the exact bit
distance. A cell gives a spanning forest of its links, never all its pairs.

Equal fingerprints are one node, whatever the number of copies. Texts without
words have fingerprint zero and link like any other. A null ``doc_id`` is kept;
a component of null ids alone has a null id. Repeated rows are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, partitions, reliable, space_words
from .components import connected, salted_join

SEED = 42
SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 32
# Two random bits give the counts 0, 1, 2 with 1/4, 1/2, 1/4: 1.5 bits.
SEGMENT_ENTROPY = 1.5
CHUNK = 2048
_EVEN = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the ``shingle``-word shingles, repeats included."""
    words = space_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounds the bit matrix of very long texts
        part = words[at:at + (1 << 16) + shingle - 1]
        h = np.array([digest(s, SEED) for s in map(b" ".join, zip(*(part[k:] for k in range(shingle))))], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        values = np.array([fingerprint(x, shingle) for x in text], np.uint64)
        return pd.Series(values.view(np.int64))
    return fp


def unary(x: np.ndarray) -> np.ndarray:
    """Per-segment bit counts of fingerprints, in unary."""
    y = x >> np.uint64(1)
    return (((x & y) & _EVEN) << np.uint64(1)) | ((x | y) & _EVEN)


def _unary_column(x: Column) -> Column:
    even, y = F.lit(0x5555555555555555), F.shiftrightunsigned(x, 1)
    return F.shiftleft(x.bitwiseAND(y).bitwiseAND(even), 1).bitwiseOR(x.bitwiseOR(y).bitwiseAND(even))


def grids(n: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks (as signed longs) of the grids' blocks for ``n`` distinct fingerprints."""
    def work(blocks: int) -> float:
        bits = SEGMENT_ENTROPY * SEGMENTS * (blocks - max_bits) / blocks
        return comb(blocks, max_bits) * (1 + n / 2 ** bits)

    blocks = min(range(max_bits + 1, max_bits + 8), key=work)
    ends = [SEGMENTS * k // blocks for k in range(blocks + 1)]
    of = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(ends, ends[1:])]
    masks = [sum(of[k] for k in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that span all links.

    The graph of these edges has the components of the graph of all links.
    """
    u = _unary_column(F.col("fp"))
    tables = F.array(*[F.struct(F.lit(t).cast("short").alias("t"), u.bitwiseAND(F.lit(m)).alias("cell"))
                       for t, m in enumerate(grids(n, max_bits))])
    cells = fps.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.cell")
    sizes = cells.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK)
    slot = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("k"))
    dealt = (cells.join(sizes, ["t", "cell"]).withColumn("k", chunks).withColumn("slot", slot)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
             .select("t", "cell", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "fp"))
    keys = ["t", "cell", "i", "j"]
    grouped = dealt.repartition(partitions(fps.sparkSession), *keys).sortWithinPartitions(*keys, "fp")
    return grouped.mapInArrow(lambda it: _forests(it, max_bits), "a long, b long")


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forests(it: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Spanning edges of each group of rows; groups follow one another in the partition."""
    held = None
    for batch in it:
        rows = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
        starts = _starts(held)
        if len(starts) > 1:
            yield from _edges([c[:starts[-1]] for c in held], starts[:-1], max_bits)
            held = [c[starts[-1]:] for c in held]
    if held is not None and len(held[0]):
        yield from _edges(held, _starts(held), max_bits)


def _starts(rows: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(rows[0]), bool)
    new[:1] = True
    for c in rows[:-1]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _edges(rows: list[np.ndarray], starts: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    x = rows[-1].view(np.uint64)
    u = unary(x)
    sizes = np.diff(np.append(starts, len(x)))
    found = []
    small = sizes <= 32
    at, size = starts[small], sizes[small]
    first = np.repeat(at, size)
    place = np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
    last = np.repeat(size, size)
    for step in range(1, int(size.max(initial=1))):
        p = (first + place)[place + step < last]
        p = p[np.bitwise_count(u[p] ^ u[p + step]) <= max_bits]
        p = p[np.bitwise_count(x[p] ^ x[p + step]) <= max_bits]
        found.append((x[p], x[p + step]))
    for a, n in zip(starts[~small], sizes[~small]):
        found += _search(x[a:a + n], u[a:a + n], max_bits)
    a, b = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.uint64)]).view(np.int64) for k in (0, 1))
    differ = a != b
    if differ.any():
        yield pa.RecordBatch.from_arrays([pa.array(a[differ]), pa.array(b[differ])], schema=_EDGES)


def _search(x: np.ndarray, u: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Breadth-first search in one group: an edge for each node when it is reached."""
    left, found = np.arange(len(x)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(u[left] ^ u[node]) <= max_bits
            near[near] = np.bitwise_count(x[left[near]] ^ x[node]) <= max_bits
            if near.any():
                reached = left[near]
                found.append((np.full(len(reached), x[node]), x[reached]))
                queue.extend(reached.tolist())
                left = left[~near]
    return found


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
           max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, component_id) of every distinct fingerprint."""
    rows = reliable(docs.select(F.col(id_col).alias("doc_id"), fingerprint_udf(shingle)(F.col(text_col)).alias("fp")))
    fps = reliable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected(links(fps.select("fp"), fps.count(), max_bits))
    roots = reliable(roots.withColumnsRenamed({"node": "fp"}))
    rooted = fps.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, reliable(salted_join(rooted, ids, "root", "fp").select("fp", "root", "component_id"))


def neardups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows, of = groups(docs, id_col, text_col, shingle, max_bits)
    return rows.join(of, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, all columns as they were.

    The row with the smallest id stays; among rows that repeat this id, the one
    whose text hash is smallest. Null ids come last.
    """
    rows, of = groups(docs, id_col, text_col, shingle, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("fp").alias("fp"))
    best = reliable(rows.distinct().join(of.select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("o"))
                    .select("root", F.col("o.id").alias("best_id"), F.col("o.fp").alias("best_fp")))
    fp, root, row = fresh(docs, "fp_of_row"), fresh(docs, "root_of_row"), fresh(docs, "row_itself")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                         fingerprint_udf(shingle)(F.col(text_col)).alias(fp))
    kept = marked.join(best.withColumnRenamed("root", root), (F.col(fp) == F.col("best_fp")) & F.col(
        f"{row}.{id_col}").eqNullSafe(F.col("best_id")))
    one = kept.groupBy(root).agg(F.min_by(row, F.xxhash64(F.col(f"{row}.{text_col}"))).alias(row))
    return one.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])
