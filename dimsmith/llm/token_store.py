"""Token-id shards with a minimal perfect hash index over document keys.

Documents are range-partitioned in ascending ``doc_id`` order; each partition
encodes its texts and writes one shard file: raw ids back to back, then the
records of its documents and a minimal perfect hash over its distinct keys. The
hash maps a key to its slot with one displacement lookup; the slot holds the
record number and a 32-bit fingerprint of the key that turns away other keys.
So a keyed read touches one bucket, one slot, one record and its ids.

Shard file, little-endian: ids (unsigned 16-bit where the vocabulary allows,
else 32-bit); records in document order (key int64, has-key uint8, first id
int64, id count int64); index (displacement int64 per bucket; per slot:
fingerprint uint32, first record int64, record count int64); footer (six int64:
id bytes, ids, records, buckets, slots, magic).

Files carry the task attempt's own name and are renamed when complete; the
manifest lists the files of the attempts that counted, so a repeated task
leaves at most an unlisted file.

A null text is an empty text: the end id alone. Null ids come first and share
one key of their own; rows that repeat an id are consecutive records under one
slot (their texts in hash order). An empty table writes no file.
"""

from __future__ import annotations

import os
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_letters, partitions, read_input, shared_folder, write_bytes

MAGIC = 0x444D534944583031
END_ID = 1
WORDS_KEPT = 400_000
_RECORD = np.dtype([("key", "<i8"), ("has", "u1"), ("first", "<i8"), ("count", "<i8")])
_SLOT = np.dtype([("print", "<u4"), ("record", "<i8"), ("count", "<i8")])
_FOOTER = struct.Struct("<6q")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Marks that end a word after an ASCII or a Latin-1 letter; they are pre-tokens of their own.
_MARKS = rb"[.,;:!?*$%&#|]"
_TAIL = re.compile(rb"%b(?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))%b*+(?=\s|\Z)" % (_MARKS, _MARKS))
# Put between words that are encoded together. A digit is a pre-token of its
# own, so no word without it gives its id.
_CUT = b"0"
# Words that the file's normaliser leaves as they are and that are one pre-token each.
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")


class WordEncoder:
    """The lower-casing tokenizers file with word ends, applied word by word.

    ASCII white space never becomes part of a token and bounds its words, so the
    ids of a text are those of the words between, one after the other. A text is
    brought to lower case (ASCII) and the marks that end its words are set apart
    before it is cut, so only distinct cores are looked up; the library encodes
    those not met before, a text's worth in one call. Words of lower-case ASCII
    and Latin-1 letters go to the same model without the file's normaliser and
    pre-tokenizer, which would leave them as they are. At most twice ``kept``
    distinct words are remembered, those met last.
    """

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task a core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer, self.bare.pre_tokenizer = None, WhitespaceSplit()
        self.letters = str.maketrans({chr(b): c for c, b in byte_letters().items() if b != 32})
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.limit = kept
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        (self.cut,) = self._ids(_CUT)

    def _ids(self, text: bytes) -> list[int]:
        return self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids

    def _bare_ids(self, text: bytes) -> list[int]:
        shown = text.decode("latin-1").translate(self.letters)
        return self.bare.encode_batch_fast([shown], add_special_tokens=False)[0].ids

    def _learn(self, words: Iterable[bytes]) -> None:
        kept, older = self.kept, self.older
        plain, other = [], []
        for w in words:
            if w in older:
                kept[w] = older[w]
            elif _PLAIN.fullmatch(w.decode("utf-8", "replace")):
                plain.append(w)
            elif _CUT in w or b"<|" in w:
                kept[w] = np.array(self._ids(w), f"<u{self.width}").tobytes()
            else:
                other.append(w)
        for held, encoded in ((plain, self._bare_ids), (other, self._ids)):
            if held:
                ids = np.array(encoded((b" " + _CUT + b" ").join(held)), f"<u{self.width}")
                cuts = np.flatnonzero(ids == self.cut) * self.width
                data, at = ids.tobytes(), 0
                for w, end in zip(held, [*cuts.tolist(), len(data)]):
                    kept[w] = data[at:end]
                    at = end + self.width

    def encode(self, text: str | None) -> bytes:
        """Ids of the text, packed."""
        if not text:
            return b""
        data = text.encode("utf-8", "surrogatepass")
        if b"<|" not in data:  # special tokens are matched before lower-casing
            data = _TAIL.sub(rb" \g<0>", data.lower())
        kept, words = self.kept, data.split()
        new = set(words).difference(kept)
        if new:
            if len(kept) + len(new) > self.limit:  # words not met since the last time are forgotten
                self.older, self.kept = kept, {}
                kept, new = self.kept, set(words)
            self._learn(new)
        return b"".join(map(kept.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def key_hash(key: int | None) -> tuple[int, int]:
    """(64-bit hash, 32-bit fingerprint) of a key; a null key has a hash of its own."""
    data = b"" if key is None else struct.pack("<q", key)
    return xxhash.xxh64_intdigest(data, 1), xxhash.xxh32_intdigest(data, 2)


def _displaced(h: int, seed: int, slots: int) -> int:
    x = (h ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 29)) % slots


def build_index(keys: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
    """(displacement per bucket, slot of each distinct key) without empty slots.

    Buckets are placed from the largest on, each with the first displacement
    that sends all its keys to free slots; a bucket of one key takes a free slot
    directly, stored as a negative number.
    """
    n = len(keys)
    hashes = [key_hash(k)[0] for k in keys]
    buckets: list[list[int]] = [[] for _ in range(max(1, n // 3))]
    for at, h in enumerate(hashes):
        buckets[(h >> 32) % len(buckets)].append(at)
    seeds, slot_of = np.zeros(len(buckets), np.int64), np.zeros(n, np.int64)
    taken = bytearray(n)
    free = 0
    for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
        members = buckets[b]
        if not members:
            break
        if len(members) == 1:
            while taken[free]:
                free += 1
            taken[free], seeds[b], slot_of[members[0]] = 1, -1 - free, free
            continue
        seed = 0
        while True:
            slots = [_displaced(hashes[m], seed, n) for m in members]
            if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                break
            seed += 1
        seeds[b] = seed
        for m, s in zip(members, slots):
            taken[s], slot_of[m] = 1, s
    return seeds, slot_of


def shard_bytes(keys: list[int | None], packed: list[bytes], width: int) -> tuple[Iterator[bytes], int]:
    """The chunks of a shard file and its number of ids."""
    counts = np.array([len(p) // width for p in packed], np.int64)
    records = np.zeros(len(keys), _RECORD)
    records["has"] = [k is not None for k in keys]
    records["key"] = [k or 0 for k in keys]
    records["count"], records["first"] = counts, np.cumsum(counts) - counts
    distinct, first, size = [], [], []
    for at, k in enumerate(keys):
        if at and keys[at - 1] == k and (keys[at - 1] is None) == (k is None):
            size[-1] += 1
        else:
            distinct.append(k)
            first.append(at)
            size.append(1)
    seeds, slot_of = build_index(distinct)
    slots = np.zeros(len(distinct), _SLOT)
    slots["print"][slot_of] = [key_hash(k)[1] for k in distinct]
    slots["record"][slot_of], slots["count"][slot_of] = first, size
    total = int(counts.sum())
    footer = _FOOTER.pack(total * width, total, len(keys), len(seeds), len(slots), MAGIC)
    tail = [records.tobytes(), seeds.astype("<i8").tobytes(), slots.tobytes(), footer]
    return iter([*packed, *tail]), total


class Shard:
    """A shard file, read by key in constant time; only the parts asked for are read."""

    def __init__(self, uri: str):
        self.file = read_input(uri)
        size = self.file.size()
        id_bytes, self.n_ids, self.n_records, self.n_buckets, self.n_slots, magic = _FOOTER.unpack(
            self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a token shard: {uri}")
        self.width = id_bytes // self.n_ids if self.n_ids else 2
        self.at_records = id_bytes
        self.at_seeds = self.at_records + self.n_records * _RECORD.itemsize
        self.at_slots = self.at_seeds + 8 * self.n_buckets

    def _rows(self, at: int, kind: np.dtype, first: int, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(n * kind.itemsize, at + first * kind.itemsize), kind)

    def records(self, first: int, n: int) -> np.ndarray:
        return self._rows(self.at_records, _RECORD, first, n)

    def ids(self, first: int, n: int) -> np.ndarray:
        return self._rows(0, np.dtype(f"<u{self.width}"), first, n).astype("<u4")

    def find(self, key: int | None) -> tuple[int, int] | None:
        """(first record, record count) of a key; None if its fingerprint doesn't match."""
        if not self.n_slots:
            return None
        h, mark = key_hash(key)
        seed = int(self._rows(self.at_seeds, np.dtype("<i8"), (h >> 32) % self.n_buckets, 1)[0])
        slot = self._rows(self.at_slots, _SLOT, -1 - seed if seed < 0 else _displaced(h, seed, self.n_slots), 1)[0]
        return (int(slot["record"]), int(slot["count"])) if slot["print"] == mark else None

    def get(self, key: int | None) -> list[np.ndarray]:
        """Ids of every document with this key, end id included; none if it isn't there."""
        found = self.find(key)
        if found is None:
            return []
        rows = self.records(*found)
        if (rows["key"][0] if rows["has"][0] else None) != key:
            return []
        return [self.ids(int(r["first"]), int(r["count"])) for r in rows]

    def close(self) -> None:
        self.file.close()


_MANIFEST_SQL = "shard int, uri string, n_docs long, n_ids long, least long, most long"


def write(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
          end_id: int = END_ID, folder: str | None = None, shards: int | None = None) -> list[dict]:
    """Write the shard files; the manifest, one entry a shard in order, with ``start`` ids before it.

    Only the manifest's one row a shard reaches the driver.
    """
    spark = docs.sparkSession
    path, folder = path or tokenizer_path(), folder or shared_folder(spark, "tokens")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = end_id.to_bytes(encoder.width, "little")
        keys, packed = [], []
        for batch in it:
            keys += batch.column(0).to_pylist()
            packed += [encoder.encode(t.as_py()) + end for t in batch.column(1)]
        if keys:
            number = TaskContext.get().partitionId()
            uri = posixpath.join(folder, f"shard-{number:06d}-{uuid.uuid4().hex[:12]}.ids")
            chunks, total = shard_bytes(keys, packed, encoder.width)
            write_bytes(uri, chunks)
            known = [k for k in keys if k is not None]
            row = [number, uri, len(keys), total, min(known, default=None), max(known, default=None)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.string()] + [pa.int64()] * 4)],
                names=["shard", "uri", "n_docs", "n_ids", "least", "most"])

    order = ["doc_id", "h", "salt"]  # the salt lets rows that repeat id and text fall into several shards
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("salt"))
    spread = rows.repartitionByRange(shards or partitions(spark), *order).sortWithinPartitions(*order)
    manifest = [r.asDict() for r in spread.select("doc_id", "text").mapInArrow(run, _MANIFEST_SQL).collect()]
    start = 0
    for entry in sorted(manifest, key=lambda r: r["shard"]):
        entry["start"] = start
        start += entry["n_ids"]
    return sorted(manifest, key=lambda r: r["shard"])


def lookup(manifest: list[dict], key: int | None) -> list[np.ndarray]:
    """Ids of every document with ``key``: the manifest's key ranges name the shards to ask."""
    out = []
    for entry in manifest:
        if key is None or entry["least"] is not None and entry["least"] <= key <= entry["most"]:
            shard = Shard(entry["uri"])
            out += shard.get(key)
            shard.close()
    return out


def read_back(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    Each distinct key of a shard is looked up through the index; its records
    and ids are read from there.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for entry in batch.to_pylist():
                shard, seen = Shard(entry["uri"]), 0
                while seen < shard.n_records:
                    part = shard.records(seen, min(4096, shard.n_records - seen))
                    new = np.ones(len(part), bool)
                    new[1:] = (part["key"][1:] != part["key"][:-1]) | (part["has"][1:] != part["has"][:-1])
                    rows, at = [], 0
                    for k in np.flatnonzero(new).tolist():
                        key = int(part["key"][k]) if part["has"][k] else None
                        found = shard.find(key)
                        if found is None or found[0] > seen + k:
                            raise ValueError(f"the index of {entry['uri']} misses key {key}")
                        at = found[0] + found[1] - seen
                        for r in shard.records(seen + k, at - k):
                            first, n = int(r["first"]), int(r["count"])
                            rows.append((key, entry["start"] + first, n, zlib.crc32(shard.ids(first, n).tobytes())))
                    seen += at
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                shard.close()

    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest:
        return spark.createDataFrame([], out)
    listed = spark.createDataFrame([(m["uri"], m["start"]) for m in manifest], "uri string, start long")
    return listed.repartition(len(manifest)).mapInArrow(run, out)


def report(docs: DataFrame, **options) -> DataFrame:
    """Write the shards of ``docs`` and give back what they hold of every document."""
    return read_back(docs.sparkSession, write(docs, **options))
