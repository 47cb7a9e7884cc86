"""Sinks: snapshot copies (S5), appends (S6) and small marker files.

Stored tables that change (the MERGE-maintained dimension, the incrementally
maintained histories) are folders of key buckets that one small pointer file
names; see ``sources.bucketed``. Small files are written through the Hadoop file
system of the target path, so they live in the same shared storage as the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it doesn't exist."""
    fs, p, _ = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole under another name and rename it over ``path``."""
    _, p, jvm = _fs(spark, path)
    part = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    write_text(spark, part, text)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(part), p, how)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it isn't there."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def snapshot_copy(df: DataFrame, path: str) -> DataFrame:
    """Materialise ``df`` at ``path`` and return the copy (a clone by value)."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
