"""Timestamp helpers for validity intervals.

Intervals are closed ``[from, to]``; a closed interval ends one tick before
the next version starts. Spark timestamps are microsecond, so one tick is
one microsecond. Open intervals end at the surrogate high date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The surrogate high date of open intervals (as in the source
# scripts), and the fixture feed's first load time and load interval.
HIGH_DATE = "9999-12-31 00:00:00"
FEED_EPOCH = "2024-01-01 00:00:00"
BATCH_MINUTES = 10


def high_date() -> Column:
    return F.lit(HIGH_DATE).cast("timestamp_ntz")


def minus_tick(c: Column) -> Column:
    return c - F.expr("INTERVAL 1 MICROSECOND")


def load_ts(batch: int, epoch: str = FEED_EPOCH, minutes: int = BATCH_MINUTES) -> Column:
    """Load timestamp of change batch ``batch``: epoch + batch x 10 minutes."""
    return F.lit(epoch).cast("timestamp_ntz") + F.make_dt_interval(
        mins=F.lit(int(batch) * minutes))


def ts_text(c: str | Column) -> Column:
    """Fixed-width text of a timestamp (microseconds always printed)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
