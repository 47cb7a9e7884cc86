"""Helpers shared by the training-data operators.

Edge cases, the same for every operator unless its docstring says otherwise:
a null text is an empty text; a null ``doc_id`` is kept as null; repeated rows
are rows of their own; an empty table gives an empty result with the same
schema; columns other than the id and the text are never looked at, so their
names cannot clash.
"""

from __future__ import annotations

import os
import posixpath
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.session import ensure_checkpoint_dir

# Fixed value: the white space that separates words of most contracts.
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
# Arrow batches to Python workers hold at most this many bytes of rows.
ARROW_BATCH_BYTES = 8 << 20
ARROW_BATCH_ROWS = 4000

_ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))
_LOWER_TABLE = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8.

    Bytes from 0x80 up belong to words, so working on the encoded text finds
    the same words as working on code points.
    """
    return text.encode("utf-8", "surrogatepass").translate(_ALNUM_TABLE).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER_TABLE).split() if text else []


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, unless their PYTHONPATH has it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_dimsmith_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="dimsmith-py-"), "dimsmith_py.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "dimsmith")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    sc.addPyFile(archive)
    sc._dimsmith_shipped = True


def tune(spark: SparkSession, batch_bytes: int = ARROW_BATCH_BYTES, batch_rows: int = ARROW_BATCH_ROWS) -> None:
    """Prepare the session: ship the package, bound the Arrow batches by bytes and rows."""
    ship(spark)
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes),
                      ("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)):
        have = spark.conf.get(key, None)
        value = int(re.sub(r"\D", "", have) or 0) if have else 0
        if not 0 < value <= most:
            spark.conf.set(key, str(most))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (Spark compares without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus)).cast("int")


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table written in the shared folder.

    Unlike a checkpoint, the table read back has the size of its files, so the
    size estimates of a loop's joins don't multiply from round to round.
    """
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``most`` rows from tuples in schema order."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema)], schema=schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder below the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark)
    if "://" not in root and not root.startswith("file:"):
        root = "file://" + os.path.abspath(root)
    return posixpath.join(root, "dimsmith-llm", f"{name}-{uuid.uuid4().hex[:12]}")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI of a store that pyarrow knows."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def write_bytes(uri: str, chunks: Iterable[bytes]) -> None:
    """Write under a name of its own, then rename: readers see whole files only."""
    fs, path = open_fs(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    with fs.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(part, path)


def read_input(uri: str):
    """A random-access file; memory-mapped where the store is a local one."""
    fs, path = open_fs(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(path, "r")
    return fs.open_input_file(path)
