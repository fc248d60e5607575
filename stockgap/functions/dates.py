"""Calendar expressions: integer date keys, month ends, day numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """Integer key ``YYYYMMDD`` (sorts like the date)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(k: Column) -> Column:
    """Inverse of :func:`date_key`."""
    return F.to_date(k.cast("string"), "yyyyMMdd")


def is_month_end(d: Column) -> Column:
    return d == F.last_day(d)


def day_number(d: Column) -> Column:
    """Days since 1970-01-01: a numeric order key usable in RANGE frames."""
    return F.unix_date(d)


def day_span(lo: Column, hi: Column) -> Column:
    """Number of days in the closed range ``[lo, hi]``; 0 when empty."""
    return F.greatest(F.datediff(hi, lo) + 1, F.lit(0))
