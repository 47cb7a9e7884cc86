"""MinHash near-duplicates verified through odd sketches.

Each text is its set of distinct word shingles. ``SAMPLES`` MinHash samples of a
set serve twice. The first ``BANDS * BAND_ROWS`` form bands; sets that agree on
a whole band share a cell (two sets of similarity 0.8 share none with a chance
of 1.4e-7). All samples are folded into an odd sketch: each flips one of
``BITS`` bits, so the bits in which two sketches differ count the samples that
differ, most precisely where few do.

1. Forest. In the cells of the first ``FOREST_BANDS`` bands, members are walked
   through by their sketches: a pair that differs in at most ``LIKELY`` bits
   (0.81 estimated) is probably a link. A cell gives the edges of that walk,
   one a member at most, and full sets confirm them. Components are formed of
   the confirmed links.
2. Rest. In the cells of all bands that still hold more than one component, the
   members outside the cell's largest component meet all its members. Pairs of
   different components whose sketches differ in at most ``MOST_DIFFERENT`` bits
   (0.65 estimated, more than five deviations below 0.8) are compared on their
   full sets where they meet; a cell gives the links that join components.

Only full sets make a link. Cells give no pairs of their members outright; a
large cell is dealt out in chunks. Links of the forest are confirmed in blocks
of one text and a share of its partners, so that a text with any number of
partners is worked on in many tasks.

Equal sets are one node, whatever the number of copies.

Texts without words have the empty set and are linked with nothing; their
component is their own id. Null ids are kept; a component of null ids alone has
the id null. Repeated rows are rows of their own, other columns are not looked
at, and an empty table gives an empty result. Shingles are compared by 64-bit
hashes of their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.joins import broadcast_if_small

from .common import partitions, space_words, stored
from .components import connected, salted_join

SHINGLE = 4
SIMILARITY_PERCENT = 80
SAMPLES = 512
BANDS, BAND_ROWS = 30, 4
BITS = 1024
LIKELY, MOST_DIFFERENT = 160, BITS // 4
FOREST_BANDS = 10
SLOTS = 256
CHUNK = 8192                   # members of a cell that meet in one task
REST_CHUNK, REST_SHINGLES = 2048, 1 << 20
_STEP = 128

_rng = np.random.default_rng(42)
_SAMPLE_MULT = _rng.integers(0, 1 << 31, SAMPLES, np.uint32) * np.uint32(2) + np.uint32(1)
_SAMPLE_ADD = _rng.integers(0, 1 << 32, SAMPLES, np.uint32)
_FOLD_MULT = _rng.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_MULT = _rng.integers(0, 1 << 63, (BANDS, BAND_ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_MULT = _rng.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = space_words(text)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += h[k:k + n] * _WORD_MULT[k]
    return np.unique(_mixed(total))


def samples(members: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that isn't empty."""
    x = (members >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    work = np.empty((min(_STEP, len(x)), SAMPLES), np.uint32)
    for at in range(0, len(x), _STEP):
        part = x[at:at + _STEP, None]
        out = work[:len(part)]
        np.bitwise_xor(part, _SAMPLE_ADD, out=out)
        np.multiply(out, _SAMPLE_MULT, out=out)
        np.minimum(least, out.min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One cell number a band."""
    parts = least[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64) + np.uint64(1)
    return _mixed((_mixed(parts) * _BAND_MULT).sum(axis=1)).view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parities of the samples that fall on each of the bits, as 64-bit words."""
    at = _mixed((least.astype(np.uint64) + np.uint64(1)) * _FOLD_MULT) >> np.uint64(64 - int(math.log2(BITS)))
    odd = np.bincount(at.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def estimate(different: int) -> float:
    """Similarity estimated from the number of bits in which two odd sketches differ."""
    return 1 + BITS / (4 * SAMPLES) * math.log(1 - 2 * different / BITS) if 2 * different < BITS else 0.0


def alike(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY_PERCENT) -> bool:
    """Whether two sets (sorted, distinct) reach the similarity, in whole numbers."""
    few, many = sorted((len(a), len(b)))
    if 100 * few < percent * many:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (few + many - common)


_SIGNED = "doc_id {id}, text_hash long, n_shingles long, node binary, bands array<long>, sketch array<long>"


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def _signed(it: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    nothing = np.zeros(0, np.int64)
    for batch in it:
        counts, nodes, cells, sketches = [], [], [], []
        for text in batch.column(2):
            members = shingles(text.as_py(), size)
            counts.append(len(members))
            if not len(members):
                nodes.append(None)
                cells.append(nothing)
                sketches.append(nothing)
                continue
            least = samples(members)
            nodes.append(xxhash.xxh3_128_digest(members.tobytes()))
            cells.append(bands(least))
            sketches.append(odd_sketch(least))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
             _lists(cells), _lists(sketches)],
            names=["doc_id", "text_hash", "n_shingles", "node", "bands", "sketch"])


def _gathered(df: DataFrame) -> DataFrame:
    """``df`` stored in as few files as its size asks for, not in one of each task that made it.

    Without Hadoop's native library each file on a local path starts child processes
    (chmod), which share the executor's whole memory until they run.
    """
    return stored(df.hint("rebalance"))


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _signed(it, size), _SIGNED.format(id=kind))


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node and text of the nodes in ``wanted``; each node has one row that stands for it."""
    rep = nodes.join(wanted, "node", "left_semi").select("node", F.col("rep.doc_id").alias("rep_id"),
                                                         F.col("rep.text_hash").alias("rep_hash"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    found = rows.join(broadcast_if_small(rep), F.col("doc_id").eqNullSafe(F.col("rep_id")) & (
        F.col("text_hash") == F.col("rep_hash")))
    return found.groupBy("node").agg(F.min("text").alias("text"))


def _confirm(it: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a block's first text with each of the others that reach the similarity."""
    block, one, mine = None, None, None
    for batch in it:
        a, b = [], []
        for first, slot, lead, node, text in zip(*(c.to_pylist() for c in batch.columns)):
            members = shingles(text, size)
            if lead:
                block, one, mine = (first, slot), node, members
            elif (first, slot) == block and alike(mine, members, percent):
                a.append(one)
                b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int,
              percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets reach the similarity."""
    near = stored(pairs.withColumn("slot", F.pmod(F.xxhash64("b"), F.lit(SLOTS))))
    members = near.select("a", "slot", F.lit(False).alias("lead"), F.col("b").alias("node")).unionByName(
        near.select("a", "slot").distinct().select("a", "slot", F.lit(True).alias("lead"), F.col("a").alias("node")))
    texts = _texts(docs, nodes, members.select("node").distinct(), id_col, text_col)
    blocks = members.join(texts, "node").select("a", "slot", "lead", "node", "text")
    dealt = blocks.repartition(partitions(docs.sparkSession), "a", "slot").sortWithinPartitions("a", "slot", F.desc("lead"))
    return _gathered(dealt.mapInArrow(lambda it: _confirm(it, size, percent), "a binary, b binary"))


def _runs(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """(rows, where groups start and end) of whole groups: rows that are equal in the first three columns."""
    held = None
    for batch in it:
        held = batch if held is None else pa.concat_batches([held, batch])
        if not held.num_rows:
            continue
        new = np.zeros(held.num_rows, bool)
        for c in held.columns[:3]:
            x = c.to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        if len(starts) > 1:
            yield held.slice(0, starts[-1]), starts  # the last group may go on in the next batch
            held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held, [0, held.num_rows]


def _sketches(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64)


def _pairs_of(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*((min(p), max(p)) for p in found))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _fit(sizes: np.ndarray, n: int, percent: int) -> np.ndarray:
    return 100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)


def _walk(it: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Edges of a walk through each group along sketches that differ little."""
    for rows, cuts in _runs(it):
        nodes = rows.column(3).to_pylist()
        sizes, sketches = rows.column(4).to_numpy(), _sketches(rows.column(5))
        found = []
        for start, end in zip(cuts, cuts[1:]):
            left = np.arange(start, end)
            while len(left):
                queue, left = [left[0]], left[1:]
                while queue and len(left):
                    at = queue.pop()
                    near = np.bitwise_count(sketches[left] ^ sketches[at]).sum(axis=1, dtype=np.int32) <= LIKELY
                    near &= _fit(sizes[left], sizes[at], percent)
                    if near.any():
                        reached = left[near].tolist()
                        found += [(nodes[at], nodes[k]) for k in reached if nodes[k] != nodes[at]]
                        queue += reached
                        left = left[~near]
        if found:
            yield _pairs_of(found)


def _forest(cells: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Likely links of the members of each cell (cell, node, n members), as a forest."""
    slot = F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.col("k"))
    dealt = (cells.withColumn("k", F.ceil(F.col("members") / CHUNK)).withColumn("slot", slot)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
             .select("cell", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "node"))
    keys = ["cell", "i", "j"]
    rows = dealt.join(nodes.select("node", "n", "sketch"), "node").select(*keys, "node", "n", "sketch")
    spread = rows.repartition(partitions(cells.sparkSession), *keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(lambda it: _walk(it, percent), "a binary, b binary").distinct()


def _split(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, node, root) of the cells that lie in more than one component."""
    known = cells.join(roots, "node", "left").select("cell", "node", F.coalesce("root", "node").alias("root"))
    many = known.groupBy("cell").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("cell")
    return stored(salted_join(known, many, "cell", "node"))


def _touching(it: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows of each group that may have a link: outsiders and members of other components, by their sketches."""
    for rows, cuts in _runs(it):
        outside = rows.column(3).to_numpy(zero_copy_only=False)
        roots = np.unique(rows.column(5).to_numpy(zero_copy_only=False), return_inverse=True)[1]
        sizes, sketches = rows.column(6).to_numpy(), _sketches(rows.column(7))
        keep = np.zeros(rows.num_rows, bool)
        for start, end in zip(cuts, cuts[1:]):
            side = outside[start:end]
            rest = start + np.flatnonzero(~side)
            for at in (start + np.flatnonzero(side)).tolist():
                other = rest[(roots[rest] != roots[at]) & _fit(sizes[rest], sizes[at], percent)]
                near = np.bitwise_count(sketches[other] ^ sketches[at]).sum(axis=1, dtype=np.int32) <= MOST_DIFFERENT
                keep[at] = near.any()
                keep[other[near]] = True
        if keep.any():
            yield rows.filter(pa.array(keep))


def _joining(it: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links by full sets that join components, of each group's outsiders with its other members."""
    for rows, cuts in _runs(it):
        outside = rows.column(3).to_numpy(zero_copy_only=False)
        nodes, texts = rows.column(4).to_pylist(), rows.column(8)
        label = np.unique(rows.column(5).to_numpy(zero_copy_only=False), return_inverse=True)[1]
        sketches, found = _sketches(rows.column(7)), []
        for start, end in zip(cuts, cuts[1:]):
            rest = start + np.flatnonzero(~outside[start:end])
            mine = (start + np.flatnonzero(outside[start:end])).tolist()
            if not len(rest) or not mine:
                continue
            sets = [shingles(texts[k].as_py(), size) for k in rest.tolist()]
            sizes = np.array([*map(len, sets)])
            every, ids = np.unique(np.concatenate(sets), return_inverse=True)
            begin = np.cumsum(sizes) - sizes
            for at in mine:
                open_to = label[rest] != label[at]
                open_to &= np.bitwise_count(sketches[rest] ^ sketches[at]).sum(axis=1, dtype=np.int32) <= MOST_DIFFERENT
                if not open_to.any():
                    continue
                own = shingles(texts[at].as_py(), size)
                place = np.minimum(np.searchsorted(every, own), len(every) - 1)
                marked = np.zeros(len(every), np.int32)
                marked[place[every[place] == own]] = 1
                common = np.add.reduceat(marked[ids], begin)
                linked = rest[open_to & (100 * common >= percent * (sizes + len(own) - common))]
                for k in linked.tolist():
                    if label[k] != label[at]:
                        found.append((nodes[at], nodes[k]))
                        label[label == label[k]] = label[at]
        if found:
            yield _pairs_of(found)


def _rest(cells: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int,
          percent: int) -> DataFrame:
    """Links across components of the cells (cell, node, root)."""
    spark = cells.sparkSession
    rows = cells.join(nodes.select("node", "n", "sketch"), "node")
    sizes = rows.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    whole = sizes.groupBy("cell").agg(F.max(F.struct("c", "s", "root")).alias("big"), F.sum("c").alias("c"), F.sum("s").alias("s"))
    chunks = lambda c, s: F.greatest(F.ceil(c / REST_CHUNK), F.ceil(s / REST_SHINGLES))
    about = whole.select("cell", F.col("big.root").alias("big"), chunks(F.col("c"), F.col("s")).alias("nj"),
                         chunks(F.col("c") - F.col("big.c"), F.col("s") - F.col("big.s")).alias("ni"))
    rows = salted_join(rows, about, "cell", "node")
    slots = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    mine = lambda n: F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.col(n))
    tail = ["node", "root", "n", "sketch"]
    first = rows.where("root <> big").withColumn("j", F.explode(slots("nj"))).select(
        "cell", mine("ni").alias("i"), "j", F.lit(True).alias("outside"), *tail)
    second = rows.withColumn("i", F.explode(slots("ni"))).select(
        "cell", "i", mine("nj").alias("j"), F.lit(False).alias("outside"), *tail)
    keys, n = ["cell", "i", "j"], partitions(spark)
    meet = first.unionByName(second).select(*keys, "outside", *tail)
    dealt = meet.repartition(n, *keys).sortWithinPartitions(*keys)
    left = _gathered(dealt.mapInArrow(lambda it: _touching(it, percent), meet.schema))
    texts = _texts(docs, nodes, left.select("node").distinct(), id_col, text_col)
    full = left.join(texts, "node").select(*keys, "outside", *tail, "text")
    dealt = full.repartition(n, *keys).sortWithinPartitions(*keys, "node")
    return _gathered(dealt.mapInArrow(lambda it: _joining(it, size, percent), "a binary, b binary"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
           percent: int = SIMILARITY_PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node) of every row, and (node, component_id) of every node.

    A node is a distinct set; a row without words has none.
    """
    rows = stored(signatures(docs, id_col, text_col, size))
    nodes = stored(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("rep"),
        F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    spread = nodes.select("node", F.posexplode("bands").alias("band", "cell"))
    shared = spread.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    cells = _gathered(salted_join(spread, shared, "cell", "node"))
    args = (nodes, docs, id_col, text_col, size, percent)
    links = confirmed(_forest(cells.where(F.col("band") < FOREST_BANDS), nodes, percent), *args)
    roots = stored(connected(links, stored))
    left = _split(cells, roots)
    if not left.isEmpty():
        more = _rest(left, *args)
        if not more.isEmpty():
            # Joining a component's root to another's is joining the components.
            across = more.join(roots.withColumnsRenamed({"node": "a", "root": "ra"}), "a", "left").join(
                roots.withColumnsRenamed({"node": "b", "root": "rb"}), "b", "left").select(
                F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct()
            tops = connected(across, stored).select(F.col("node").alias("root"), F.col("root").alias("top"))
            known = nodes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
            roots = stored(known.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
    rooted = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stored(salted_join(rooted, ids, "root", "node").select("node", "component_id"))
    return rows.select("doc_id", "n_shingles", "node"), of


def neardups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id, nulls alike) of every row."""
    rows, of = groups(docs, id_col, text_col, size, percent)
    linked = salted_join(rows.where("node IS NOT NULL"), of, "node", "doc_id").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
