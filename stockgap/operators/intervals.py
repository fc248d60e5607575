"""Joins of days and day ranges by bins, exact, in proportion to matches.

An equi-join on the SKU alone pairs every row of a SKU with every promotion of
it and filters afterwards.  Here ranges are exploded to the bins of days they
touch, and rows meet them in their bin, so a row is only paired with ranges
near it.  The condition itself is still tested; bins only propose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 16
#: bins of 16 days to 44 years; longer ranges fall into several of the widest
LEVELS = tuple(range(4, 15))


def _bin(day: str | Column, days: int | Column) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def _bins(lo: str | Column, hi: str | Column, days: int | Column) -> Column:
    return F.explode(F.sequence(_bin(lo, days), _bin(hi, days)))


def days_in_ranges(rows: DataFrame, ranges: DataFrame, on: Sequence[str], day: str, lo: str, hi: str, bin_days: int = BIN_DAYS) -> DataFrame:
    """Rows with every range of their ``on`` columns that holds their ``day``
    (``lo`` and ``hi`` included).

    A row is in one bin, a range in those it touches, so a pair meets once.
    Pairs made and dropped again are those of a range's two outer bins.  Ranges
    that end before they begin, and nulls, match nothing.
    """
    wide = ranges.where(F.col(lo) <= F.col(hi)).withColumn("_bin", _bins(lo, hi, bin_days))
    return (rows.withColumn("_bin", _bin(day, bin_days)).join(wide, [*on, "_bin"]).drop("_bin")
            .where((F.col(day) >= F.col(lo)) & (F.col(day) <= F.col(hi))))


def overlapping(runs: DataFrame, ranges: DataFrame, on: Sequence[str], run: tuple[str, str], span: tuple[str, str],
                levels: Sequence[int] = LEVELS) -> DataFrame:
    """Runs with every range of their ``on`` columns that shares a day with them.

    Runs may be very long (quiet years) or a day.  Each goes to bins of its own
    width, the level whose bins are as long as the run: two bins a run.  Ranges
    go to the bins they touch on every level.  A pair that meets in several bins
    is kept in the one where the later of the two begins.
    """
    (a, b), (lo, hi) = run, span
    length = F.datediff(F.col(b), F.col(a)) + 1
    level = F.lit(levels[-1])
    for k in reversed(levels[:-1]):
        level = F.when(length <= 1 << k, F.lit(k)).otherwise(level)
    width = F.pow(F.lit(2), F.col("_level")).cast("int")
    left = runs.where(F.col(a) <= F.col(b)).withColumn("_level", level).withColumn("_bin", _bins(a, b, width))
    right = ranges.where(F.col(lo) <= F.col(hi)).withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn("_bin", _bins(lo, hi, width))
    met = left.join(right, [*on, "_level", "_bin"]).where((F.col(b) >= F.col(lo)) & (F.col(a) <= F.col(hi)))
    return met.where(F.col("_bin") == _bin(F.greatest(a, lo), width)).drop("_bin", "_level")
