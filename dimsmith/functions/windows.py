"""Window specs for per-key histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Window, WindowSpec


def key_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def full_frame(w: WindowSpec) -> WindowSpec:
    """Whole-partition frame: FIRST_VALUE / LAST_VALUE over all rows of a key.

    Spark's default frame with an ORDER BY ends at the current row, which
    would turn a Type-1 "last value" into the current row's own value.
    """
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
