"""Column-building helpers (all built-in expressions, so they stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"


def surrogate_key(*parts: Column) -> Column:
    """Upper-case hex MD5 of the parts joined by ``|``.

    ``concat`` propagates NULL (like ``||``), so a NULL part gives a NULL key and the not-null test
    fires, instead of silently hashing a shorter text as ``concat_ws`` would.
    """
    sep = F.lit("|")
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(sep)
        pieces.append(p.cast("string"))
    return F.upper(F.md5(F.concat(*pieces)))


def ts_text(c: Column) -> Column:
    """Timestamp as text with fixed milliseconds (``2024-01-01 10:00:00.000``)."""
    return F.date_format(c, TS_TEXT)


def date_key(d: Column) -> Column:
    """Integer day key ``yyyymmdd``."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def weekday_sun0(d: Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(d) - 1).cast("int")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)
