"""Tolerant date parsing (Column -> Column).

Spark 4 runs with ANSI semantics, where ``to_date`` and ``cast`` raise on
malformed text. Raw feeds are dirty, so every parser here returns null for
text it cannot read instead of failing the job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.functions.util import as_col

ISO_DATE = "yyyy-MM-dd"
COMPACT_DATE = "yyyyMMdd"


def as_of_date(as_of: str | _dt.date | Column | None) -> Column:
    """Reference date for "today": a fixed value for reproducible runs,
    ``current_date()`` when None."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def parse_date(c: Column | str, fmt: str = ISO_DATE) -> Column:
    """Text in ``fmt`` -> date; unreadable text -> null."""
    return F.try_to_date(as_col(c), fmt)


def cast_date(c: Column | str) -> Column:
    """Spark's lenient date cast (``yyyy``, ``yyyy-M-d``, ...), null on failure."""
    return as_col(c).try_cast("date")


def guarded_compact_date(c: Column | str) -> Column:
    """``yyyyMMdd`` codes -> date, only when the text has exactly eight
    characters and reads as a positive number; anything else -> null."""
    c = as_col(c)
    ok = (F.length(c) == 8) & (c.try_cast("bigint") > 0)
    return F.when(ok, F.try_to_date(c, COMPACT_DATE)).otherwise(F.lit(None).cast("date"))


def cap_future_date(c: Column | str, as_of=None) -> Column:
    """Parse with the lenient cast and drop dates later than ``as_of``."""
    d = cast_date(c)
    return F.when(d <= as_of_date(as_of), d).otherwise(F.lit(None).cast("date"))
