"""Month-end channel stuffing, and the distributor-day grain it uses.

A month-end day is flagged when the distributor's primary purchases are at
least ``ratio`` times its own mean over the previous ``trail_days`` days and
that mean is at least ``min_trail``.

Two plans give the same flags:

* dense (the reference's): every distributor-day, ``ROWS`` frame of 28 rows;
* spine-free (default when ``min_trail > 0``): a flagged day has
  ``primary >= ratio * min_trail > 0`` so it is a day with movement; the
  trailing sum is a ``RANGE`` frame over movement days only and the number
  of days in the frame is ``min(trail_days, days since calendar start)``.
  Nothing dense is generated or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_key, day_number, is_month_end
from ..functions.exact import mean_ge, round_ratio, value_ge_k_mean
from ..params import StuffingParams
from ..sources.warehouse import Warehouse
from .calendar import calendar_bounds, calendar_row, in_calendar, with_calendar
from .densify import densify

VALUES = ["primary_units", "secondary_units"]


def dist_day_sparse(wh: Warehouse) -> DataFrame:
    """A3 on movement days only: (distributor, day) totals over all SKUs."""
    return (in_calendar(wh.movements, wh).groupBy("distributor_id", "full_date")
            .agg(F.coalesce(F.sum("primary_units"), F.lit(0)).cast("bigint").alias("primary_units"),
                 F.coalesce(F.sum("secondary_units"), F.lit(0)).cast("bigint")
                 .alias("secondary_units")))


def dist_day_dense(wh: Warehouse) -> DataFrame:
    """A3: one row per distributor per calendar day (zeros on quiet days)."""
    daily = dist_day_sparse(wh)
    lo, hi = calendar_bounds(wh, daily)
    return densify(daily, ["distributor_id"], VALUES, lo, hi, anchors=wh.dist_keys(),
                   in_range=wh.calendar_spans_facts)


def dist_day(wh: Warehouse) -> DataFrame:
    return dist_day_dense(wh).select(date_key(F.col("full_date")).alias("date_id"),
                                     "distributor_id", *VALUES)


def dist_day_named(wh: Warehouse) -> DataFrame:
    """The distributor-day rows with calendar and distributor attributes."""
    d = F.col("full_date")
    return (dist_day_dense(wh).join(wh.dist_names(), "distributor_id")
            .select(date_key(d).alias("date_id"), "full_date",
                    is_month_end(d).alias("is_month_end"), "distributor_id",
                    "distributor_name", *VALUES))


def trailing_dense(wh: Warehouse, p: StuffingParams = StuffingParams()) -> DataFrame:
    """W2+W3: dense distributor-days with the trailing frame's count and sums.

    One window spec is shared by all three aggregates (a single Window node);
    the densified input is already partitioned by distributor, so the frame
    adds a sort but no exchange.
    """
    w = (Window.partitionBy("distributor_id").orderBy("full_date")
         .rowsBetween(-p.trail_days, -1))
    dd = dist_day_dense(wh)
    return dd.select(
        "distributor_id", "full_date", *VALUES,
        F.count(F.lit(1)).over(w).alias("trail_days"),
        F.coalesce(F.sum("primary_units").over(w), F.lit(0)).cast("bigint").alias("trail_primary_sum"),
        F.coalesce(F.sum("secondary_units").over(w), F.lit(0)).cast("bigint").alias("trail_secondary_sum"))


def trailing_28d(wh: Warehouse, p: StuffingParams = StuffingParams()) -> DataFrame:
    t = trailing_dense(wh, p)
    return t.select(
        "distributor_id", date_key(F.col("full_date")).alias("date_id"), *VALUES,
        "trail_days", "trail_primary_sum", "trail_secondary_sum",
        round_ratio(F.col("trail_primary_sum"), F.col("trail_days")).alias("trail_28d_avg"),
        round_ratio(F.col("trail_secondary_sum"), F.col("trail_days")).alias("trail_sec_avg"))


def trailing_sparse(wh: Warehouse, p: StuffingParams = StuffingParams(),
                    values: Sequence[str] = VALUES) -> DataFrame:
    """The same frame over movement days only (RANGE on the day number), with
    the trailing sums of ``values``."""
    dd = dist_day_sparse(wh).select("distributor_id", "full_date", *values)
    w = (Window.partitionBy("distributor_id").orderBy(day_number(F.col("full_date")))
         .rangeBetween(-p.trail_days, -1))
    return with_calendar(dd, calendar_row(wh, dd)).select(
        "distributor_id", "full_date", *values,
        F.least(F.lit(p.trail_days), F.datediff(F.col("full_date"), F.col("_cal.lo"))).cast("bigint")
        .alias("trail_days"),
        *[F.coalesce(F.sum(v).over(w), F.lit(0)).cast("bigint").alias(f"trail_{v.removesuffix('_units')}_sum")
          for v in values])


def is_flagged(p: StuffingParams) -> Column:
    """The detector's test on a day's ``primary_units``, ``trail_days`` and
    ``trail_primary_sum`` (NULL when the frame has no days)."""
    n, tp = F.col("trail_days"), F.col("trail_primary_sum")
    return (is_month_end(F.col("full_date")) & mean_ge(tp, n, p.min_trail)
            & value_ge_k_mean(F.col("primary_units"), tp, n, p.ratio))


def stuffing_flags(wh: Warehouse, p: StuffingParams = StuffingParams(),
                   method: str = "auto", known_only: bool = True,
                   values: Sequence[str] = VALUES) -> DataFrame:
    """Flagged (distributor, month-end day) rows with trailing count and sums.

    ``known_only=False`` skips the restriction to the distributor dimension,
    for callers that join from the dimension anyway."""
    if method == "auto":
        method = "sparse" if p.min_trail > 0 else "dense"
    t = trailing_sparse(wh, p, values) if method == "sparse" else trailing_dense(wh, p)
    hits = t.filter(is_flagged(p))
    if not known_only:
        return hits
    # keep distributors of the dimension only, as the dense spine does
    return hits.join(wh.dist_keys(), "distributor_id", "left_semi")


def channel_stuffing(wh: Warehouse, p: StuffingParams = StuffingParams(),
                     method: str = "auto") -> DataFrame:
    """The detector's report, strongest spike first."""
    f = stuffing_flags(wh, p, method)
    names = wh.dist_names()
    n, tp, ts = F.col("trail_days"), F.col("trail_primary_sum"), F.col("trail_secondary_sum")
    out = f.join(names, "distributor_id").select(
        "distributor_id", "distributor_name", F.col("full_date").alias("spike_date"),
        "primary_units",
        round_ratio(tp, n).alias("trail_28d_avg"),
        round_ratio(F.col("primary_units") * n, tp, 1).alias("spike_ratio"),
        "secondary_units",
        round_ratio(ts, n).alias("trail_sec_avg"))
    return out.orderBy(F.desc("spike_ratio"), "distributor_id", "spike_date")


def stuffing_counts(wh: Warehouse, p: StuffingParams = StuffingParams(),
                    method: str = "auto", known_only: bool = True) -> DataFrame:
    """Flagged month-ends per distributor (only distributors with flags)."""
    return (stuffing_flags(wh, p, method, known_only, ["primary_units"]).groupBy("distributor_id")
            .agg(F.count(F.lit(1)).alias("spike_days")))
