"""The date dimension, one row per day with key, parts and month end."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, is_month_end


def with_date_parts(df: DataFrame, col: str = "full_date") -> DataFrame:
    d = F.col(col)
    return df.select(
        date_key(d).alias("date_id"), d.alias("full_date"),
        F.year(d).cast("smallint").alias("year"),
        F.month(d).cast("smallint").alias("month"),
        F.dayofmonth(d).cast("smallint").alias("day"),
        is_month_end(d).alias("is_month_end"))


def calendar_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Days from ``lo`` to ``hi`` of a one-row frame (e.g. min/max of a fact).

    The row count is the number of days in the span, so the result is small
    whatever the size of the fact it was derived from.
    """
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("full_date"))
    return with_date_parts(days)


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar for fixed bounds (tests and ad-hoc runs)."""
    bounds = spark.range(1).select(F.lit(start).alias("lo"), F.lit(end).alias("hi"))
    return calendar_between(bounds)


def calendar_row(wh, daily: DataFrame | None = None) -> DataFrame:
    """One row, ``_cal``: the calendar's first and last day, a struct (lo, hi);
    part of the plan that uses it, so new days show up without a new binding.

    ``daily`` is the roll-up the caller reads anyway.  Where the calendar
    spans the facts by construction, the bounds are those of the roll-up; they
    name all its columns, so it is the same aggregate and Spark reuses its
    exchange instead of scanning the facts again.
    """
    if daily is None or not wh.calendar_spans_facts:
        return wh.span().select(F.struct("lo", "hi").alias("_cal"))
    row = F.struct("full_date", *[c for c in daily.columns if c != "full_date"])
    # the count keeps Spark from dropping a roll-up without sums below min and max
    return daily.agg(F.min(row).alias("lo"), F.max(row).alias("hi"), F.count(F.lit(1)).alias("n")).select(
        F.struct(F.col("lo.full_date").alias("lo"), F.col("hi.full_date").alias("hi"), "n").alias("_cal"))


def with_calendar(df: DataFrame, row: DataFrame) -> DataFrame:
    """``df`` with the column ``_cal`` of :func:`calendar_row`: a broadcast of
    one row, which enters the plan once however often its fields are used."""
    return df.crossJoin(F.broadcast(row))


def calendar_bounds(wh, daily: DataFrame | None = None) -> tuple[Column, Column]:
    """First and last day as columns (scalar subqueries).  Every use, also by
    the optimizer, puts the subquery into the plan anew; where there are
    several, use :func:`with_calendar`."""
    pick = calendar_row(wh, daily).scalar()
    return pick["lo"], pick["hi"]


def in_calendar(df: DataFrame, wh, daily: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` whose ``full_date`` is a calendar day."""
    if wh.calendar_spans_facts:
        return df
    lo, hi = calendar_bounds(wh, daily)
    return df.filter((F.col("full_date") >= lo) & (F.col("full_date") <= hi))
