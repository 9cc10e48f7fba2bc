"""Time as epoch milliseconds: integer arithmetic only, so no session time zone can move a bucket."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE, HOUR, DAY, WEEK = 60_000, 3_600_000, 86_400_000, 604_800_000
#: 1970-01-01 was a Thursday; weeks begin on Monday, three days before.
TO_MONDAY = 3 * DAY


def div(a: Column, b: int) -> Column:
    """Integer quotient of a non-negative long."""
    return (a - F.pmod(a, F.lit(b))) / b


def bucket(ts: str | Column, width: int, shift: int = 0) -> Column:
    """Start of the bucket of `width` milliseconds that holds ts; shift moves all borders back."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (ts + shift - F.pmod(ts + shift, F.lit(width)) - shift).cast("long")


def day(ts: str | Column) -> Column:
    return bucket(ts, DAY)


def week(ts: str | Column) -> Column:
    return bucket(ts, WEEK, TO_MONDAY)


def month_key(ts: str | Column) -> Column:
    """yyyy-MM of epoch milliseconds in UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.floor(ts / DAY).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyy-MM")


def window_index(block: str | Column, start: int, interval: int) -> Column:
    """Number of the window of `interval` blocks that holds a block, from 0 at `start` (rounded down)."""
    block = F.col(block) if isinstance(block, str) else block
    return F.floor((block - start) / interval).cast("long")


def millis(ts: str | Column) -> Column:
    """Epoch milliseconds of a timestamp, with or without zone; the session runs in UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts.cast("timestamp"))
