"""Stored tables in key buckets: a batch writes the buckets of its keys anew, and nothing else.

A table folder has one folder for each part, and in it one folder a commit,
partitioned by key bucket: ``<part>/commit=7/bucket=3``. A rewritten part has
each bucket in one folder; an appended part is the union of its commits. One
small pointer file says which commit last wrote each bucket. A commit writes
its folders and then replaces the pointer, so readers see the table before or
after. A writer that dies before that has changed nothing; its folders are
written over by the next commit, which has the same number.

Reading is a plain Parquet read of the folders that the pointer names; there is
nothing to merge. Folders that a commit replaced are deleted by the next one,
so a reader that began before a commit can still finish.

A table has one writer at a time (a stream or a job); a batch is numbered in
its stream, and a repeated batch is left out by the caller.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.sources import sinks

BUCKET, COMMIT = "bucket", "commit"
_BUCKET_COL = "__bucket"
# Bytes of stored rows a bucket should hold; the pointer has one entry a bucket, so their number is bounded.
BUCKET_BYTES, MAX_BUCKETS = 256 << 20, 65_536


class Mismatch(ValueError):
    """A table is used with another key, bucket count or schema than it was made with."""


def buckets_for(table_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Key buckets for a table expected to reach ``table_bytes`` (stored with the table)."""
    return min(MAX_BUCKETS, max(1, -(-table_bytes // bucket_bytes)))


@dataclass
class Pointer:
    """What a table is now. ``written``: commit that last wrote a bucket, by part and bucket;
    ``replaced``: folders that the last commit replaced; ``notes``: a writer's own few values."""

    commit: int
    keys: list[str]
    buckets: int
    schemas: dict[str, str] = field(default_factory=dict)
    written: dict[str, dict[str, int]] = field(default_factory=dict)
    appended: dict[str, int] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)
    replaced: list[str] = field(default_factory=list)
    notes: dict[str, str | None] = field(default_factory=dict)


class BucketedTable:
    """One table folder; ``pointer`` is the state that reads and the next commit start from."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str] | str, buckets: int | None = None):
        self.spark, self.base = spark, base
        keys = [keys] if isinstance(keys, str) else list(keys)
        held = sinks.read_text(spark, self._pointer_path())
        self.pointer = Pointer(**json.loads(held)) if held else Pointer(0, keys, buckets or 1)
        if self.pointer.keys != keys:
            raise Mismatch(f"{base} is keyed by {self.pointer.keys}, not {keys}")
        if buckets is not None and buckets != self.pointer.buckets:
            raise Mismatch(f"{base} was made with {self.pointer.buckets} buckets, not {buckets}")

    def _pointer_path(self) -> str:
        return os.path.join(self.base, "_pointer.json")

    def _folder(self, part: str, commit: int, bucket: str | int | None = None) -> str:
        path = os.path.join(self.base, part, f"{COMMIT}={commit}")
        return path if bucket is None else os.path.join(path, f"{BUCKET}={bucket}")

    def _schema(self, part: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.pointer.schemas[part]))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.pointer.keys), F.lit(self.pointer.buckets))

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows' keys (at most the bucket count)."""
        if self.pointer.buckets == 1:
            return [] if rows.isEmpty() else [0]
        return [r.b for r in rows.select(self.bucket().alias("b")).distinct().collect()]

    def read(self, part: str, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """Rows of a rewritten part, of some buckets or all; None if there are none."""
        held = self.pointer.written.get(part, {})
        wanted = held if buckets is None else [str(b) for b in buckets if str(b) in held]
        paths = [self._folder(part, held[b], b) for b in wanted]
        return self.spark.read.schema(self._schema(part)).parquet(*paths) if paths else None

    def read_appended(self, part: str) -> DataFrame | None:
        """Rows of an appended part, of the commits that count."""
        if part not in self.pointer.appended:
            return None
        schema = self._schema(part)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(COMMIT, T.LongType())]))
        return (rows.parquet(os.path.join(self.base, part))
                .where(F.col(COMMIT) <= self.pointer.appended[part]).select(*schema.names))

    def begin(self) -> Commit:
        return Commit(self)


class Commit:
    """Folders written for the next state; nothing of it is visible before ``publish``."""

    def __init__(self, table: BucketedTable):
        self.table = table
        self.new = Pointer(**json.loads(json.dumps(table.pointer.__dict__)))
        self.new.commit += 1
        self.new.replaced = []

    def check(self, part: str, df: DataFrame) -> None:
        """Refuse rows with other columns than the part has; the first rows say which it has."""
        schema = T.StructType.fromJson(json.loads(df.schema.json().replace('"nullable":false', '"nullable":true')))
        if part in self.new.schemas:
            held = T.StructType.fromJson(json.loads(self.new.schemas[part]))
            if [(f.name, f.dataType) for f in held] != [(f.name, f.dataType) for f in schema]:
                raise Mismatch(f"rows of {part} have columns {schema.simpleString()}, the table {held.simpleString()}")
        else:
            self.new.schemas[part] = schema.json()

    def rewrite(self, part: str, rows: DataFrame, buckets: Sequence[int]) -> Commit:
        """``rows`` are from now on all rows of ``buckets``; other buckets stay as they are."""
        self.check(part, rows)
        folder = self.table._folder(part, self.new.commit)
        # REBALANCE gathers a bucket's rows in few files and lets AQE split a skewed one.
        (rows.withColumn(_BUCKET_COL, self.table.bucket()).withColumnRenamed(_BUCKET_COL, BUCKET).hint("rebalance", BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(folder))
        held = self.new.written.setdefault(part, {})
        there = {n.partition("=")[2] for n in sinks.list_names(self.table.spark, folder) if n.startswith(f"{BUCKET}=")}
        for b in map(str, buckets):
            before = held.pop(b, self.new.commit)
            if before != self.new.commit:
                self.new.replaced.append(self.table._folder(part, before, b))
            if b in there:
                held[b] = self.new.commit
        return self

    def append(self, part: str, rows: DataFrame) -> Commit:
        """Add rows to an appended part."""
        self.check(part, rows)
        rows.write.mode("overwrite").parquet(self.table._folder(part, self.new.commit))
        self.new.appended[part] = self.new.commit
        return self

    def written(self, part: str) -> DataFrame | None:
        """Rows of the buckets that this commit wrote, before it is published."""
        held = [b for b, c in self.new.written.get(part, {}).items() if c == self.new.commit]
        schema = T.StructType.fromJson(json.loads(self.new.schemas[part]))
        paths = [self.table._folder(part, self.new.commit, b) for b in held]
        return self.table.spark.read.schema(schema).parquet(*paths) if paths else None

    def all(self, part: str) -> DataFrame | None:
        """All rows of a rewritten part as this commit leaves them, before it is published."""
        held = self.new.written.get(part, {})
        paths = [self.table._folder(part, c, b) for b, c in held.items()]
        if not paths:
            return None
        schema = T.StructType.fromJson(json.loads(self.new.schemas[part]))
        return self.table.spark.read.schema(schema).parquet(*paths)

    def stream(self, name: str, batch: int) -> Commit:
        self.new.streams[name] = batch
        return self

    def note(self, name: str, value: str | None) -> Commit:
        self.new.notes[name] = value
        return self

    def publish(self) -> None:
        table, spark = self.table, self.table.spark
        for part, last in self.new.appended.items():
            if last != self.new.commit:  # what a dead writer may have left under this number
                sinks.delete(spark, table._folder(part, self.new.commit))
        sinks.replace_text(spark, table._pointer_path(), json.dumps(self.new.__dict__, indent=1))
        for folder in table.pointer.replaced:
            sinks.delete(spark, folder)
        table.pointer = self.new
