"""Change-detection hash over a column list (K1).

The compare text of each column is ``coalesce(upper(trim(cast(c as string))), '^^')``
and the pieces are joined with ``'|'`` before SHA-1. This is deliberately the
same loose comparison as the source scripts: case and outer blanks do not count
as a change, NULL equals the literal ``'^^'``, and the delimiter is not escaped.
The digest is kept as 20 raw bytes (``BINARY(20)``); ``hash_hex`` gives the
lowercase hex text used when results are compared across engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values shared with the source scripts: NULL stand-in, delimiter, and
# the text whose digest is the "no previous row" default.
NULL_TOKEN = "^^"
DELIMITER = "|"
NULL_HASH_TEXT = "*null*"


def null_hash() -> Column:
    """Digest used as the previous hash of a key's first row."""
    return F.unhex(F.sha1(F.lit(NULL_HASH_TEXT)))


def compare_text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.upper(F.trim(col.cast("string"))), F.lit(NULL_TOKEN))


def diff_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-1 (20 bytes) over the compare text of ``columns`` in order."""
    if not columns:
        raise ValueError("diff_hash needs at least one column")
    parts: list[Column] = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(DELIMITER))
        parts.append(compare_text(c))
    return F.unhex(F.sha1(F.concat(*parts)))


def hash_hex(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.hex(col))


def hashes_to_hex(df: DataFrame) -> DataFrame:
    """Turn every binary ``__*hash`` column into lowercase hex text."""
    out = {name: hash_hex(name) for name, dtype in df.dtypes
           if dtype == "binary" and name.endswith("hash")}
    return df.withColumns(out) if out else df
