"""The fused risk score, the ranked list and its KPIs.

Points: ``points_per_spike`` per stuffing flag capped at ``stuffing_cap``;
``promo_points`` if any SKU leaked; ``route_share_points`` if the bulk share
reaches ``route_share_pct`` percent, else ``route_repeat_points`` for
repeated bulk drops.  Every distributor is kept (left joins from the
dimension); all three inputs are already one row per distributor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_number
from ..functions.exact import round_ratio
from ..params import (TIER_CLEAN, TIER_CRITICAL, TIER_HIGH, TIER_MEDIUM, Params)
from ..sources.warehouse import Warehouse
from .calendar import calendar_row, with_calendar
from .leakage import leak_counts
from .route import drop_moments
from .stuffing import is_flagged, stuffing_counts


def stuffing_and_route(wh: Warehouse, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(distributor_id, spike_days, bulk_dumps, total_units, bulk_units) from
    one roll-up of the facts, and the calendar's bounds (:func:`calendar_row`).

    Both detectors start from the same lines: a distributor-day row carries
    the purchases for the one and the drop sums for the other."""
    q = F.col("secondary_units")
    bulk = q >= p.route.bulk_units
    dd = wh.movements.groupBy("distributor_id", "full_date").agg(
        F.coalesce(F.sum("primary_units"), F.lit(0)).cast("bigint").alias("primary_units"),
        F.coalesce(F.sum(q), F.lit(0)).cast("bigint").alias("total_units"),
        F.count_if(bulk).alias("bulk_dumps"),
        F.coalesce(F.sum(F.when(bulk, q)), F.lit(0)).cast("bigint").alias("bulk_units"))
    calendar = calendar_row(wh, dd)
    lo, hi = F.col("_cal.lo"), F.col("_cal.hi")
    d = F.col("full_date")
    dd = with_calendar(dd, calendar)
    if not wh.calendar_spans_facts:  # purchases outside the calendar are no stuffing; drops count
        inside = (d >= lo) & (d <= hi)
        dd = dd.withColumn("primary_units", F.when(inside, F.col("primary_units")).otherwise(0))
    else:
        inside = F.lit(True)
    n = p.stuffing.trail_days
    w = Window.partitionBy("distributor_id").orderBy(day_number(d)).rangeBetween(-n, -1)
    t = dd.select("*", F.least(F.lit(n), F.datediff(d, lo)).cast("bigint").alias("trail_days"),
                  F.coalesce(F.sum("primary_units").over(w), F.lit(0)).cast("bigint").alias("trail_primary_sum"))
    spike = F.coalesce(inside & is_flagged(p.stuffing), F.lit(False))
    out = t.groupBy("distributor_id").agg(
        F.count_if(spike).alias("spike_days"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("bulk_dumps", "total_units", "bulk_units")])
    return out, calendar


def risk_score(wh: Warehouse, p: Params = Params()) -> DataFrame:
    """The fused score, one row per distributor of the dimension.

    Two scans of the facts: one for stuffing, route and the calendar's bounds,
    one (of the promoted SKUs) for leakage."""
    d = wh.distributors.select("distributor_id", "distributor_name", "region")
    if p.stuffing.min_trail > 0 and wh.movements_are_lines:
        both, calendar = stuffing_and_route(wh, p)
        j = d.join(both, "distributor_id", "left").join(
            leak_counts(wh, p.leakage, calendar), "distributor_id", "left")
        return scored(j, p)
    # without a floor quiet month ends count too: they need the dense days;
    # a stored ledger's movements are daily sums: drops come from deliveries
    rt = drop_moments(wh, p.route).select("distributor_id", "bulk_dumps",
                                          F.col("_s1").alias("total_units"),
                                          F.col("_bulk_s").alias("bulk_units"))
    return score(d, stuffing_counts(wh, p.stuffing, known_only=False), leak_counts(wh, p.leakage), rt, p)


def score(distributors: DataFrame, stuffing: DataFrame, leaks: DataFrame,
          route: DataFrame, p: Params = Params()) -> DataFrame:
    """Points and tier from per-distributor counts.

    distributors  distributor_id, distributor_name, region
    stuffing      distributor_id, spike_days
    leaks         distributor_id, leaked_skus
    route         distributor_id, bulk_dumps, total_units, bulk_units
    """
    return scored(distributors.join(stuffing, "distributor_id", "left")
                  .join(leaks, "distributor_id", "left").join(route, "distributor_id", "left"), p)


def scored(j: DataFrame, p: Params = Params()) -> DataFrame:
    """Points and tier of rows that hold the counts of :func:`score`."""
    r = p.risk
    flags = F.coalesce(F.col("spike_days"), F.lit(0))
    leaked = F.coalesce(F.col("leaked_skus"), F.lit(0))
    dumps = F.coalesce(F.col("bulk_dumps"), F.lit(0))
    s1, bulk_s = F.col("total_units"), F.col("bulk_units")
    # share >= threshold, with a missing or undefined share read as 0
    share_ok = F.when(s1 > 0, bulk_s * 100 * r.route_share_pct.denominator
                      >= s1 * r.route_share_pct.numerator
                      ).otherwise(F.lit(0 >= r.route_share_pct))
    pts = j.select(
        "distributor_id", "distributor_name", "region",
        flags.alias("stuffing_flags"), leaked.alias("promo_leak_flags"),
        dumps.alias("route_dump_events"),
        F.coalesce(round_ratio(bulk_s * 100, s1, 1), F.lit(0.0)).alias("bulk_volume_pct"),
        F.least(F.lit(r.stuffing_cap), flags * r.points_per_spike).alias("stuffing_pts"),
        F.when(leaked > 0, F.lit(r.promo_points)).otherwise(F.lit(0)).alias("promo_pts"),
        F.when(share_ok, F.lit(r.route_share_points))
         .when(dumps >= p.route.repeat_dumps, F.lit(r.route_repeat_points))
         .otherwise(F.lit(0)).alias("route_pts"))
    total = F.col("stuffing_pts") + F.col("promo_pts") + F.col("route_pts")
    tier = (F.when(total >= r.critical_at, F.lit(TIER_CRITICAL))
            .when(total >= r.high_at, F.lit(TIER_HIGH))
            .when(total > 0, F.lit(TIER_MEDIUM)).otherwise(F.lit(TIER_CLEAN)))
    return pts.select("*", total.alias("risk_score"), tier.alias("risk_tier"))


def risk_top(risk: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` of the ranked list (score desc, then id).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n`` and only those reach the final merge.
    """
    return (risk.orderBy(F.desc("risk_score"), "distributor_id").limit(n)
            .select("distributor_id", "distributor_name", "region", "stuffing_flags",
                    "promo_leak_flags", "route_dump_events", "stuffing_pts", "promo_pts",
                    "route_pts", "risk_score", "risk_tier"))


def risk_kpis(risk: DataFrame) -> DataFrame:
    """Dashboard KPIs; "high_risk" counts tier HIGH only (quirk K9)."""
    return risk.agg(
        F.count(F.lit(1)).alias("distributors"),
        F.count_if(F.col("risk_tier") == TIER_HIGH).alias("high_risk"),
        F.coalesce(F.sum("stuffing_flags"), F.lit(0)).cast("bigint").alias("stuffing"),
        F.coalesce(F.sum("route_dump_events"), F.lit(0)).cast("bigint").alias("dumps"))
