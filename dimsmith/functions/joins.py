"""Join helpers: broadcast only behind a checked size in bytes; keys with nulls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bound for broadcast sides: comfortable for every executor.
BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame):
    """Bytes of a row as a column: fixed-size values as they are, strings and binaries by length.

    None if a column's size can't be told (nested types)."""
    parts = []
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return None
        else:
            parts.append(F.lit(16))
    return reduce(lambda a, b: a + b, parts, F.lit(16))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if its rows take at most ``max_bytes``, else ``df`` unchanged
    (the planner then shuffles both sides). Measuring costs one partially
    aggregated pass over ``df``, so use it on small or materialised inputs.
    ``max_bytes=None`` skips the check and leaves the choice to the planner/AQE."""
    size = None if max_bytes is None else row_bytes(df)
    if size is None:
        return df
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= max_bytes else df


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on the keys, nulls equal to nulls; the right side keeps its other columns."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    joined = left.join(other, on, how)
    return joined.drop(*[f"__r_{k}" for k in keys])
