"""Thresholds and labels of the detectors, as frozen dataclasses.

Thresholds are ``Fraction`` so that every comparison against a mean can be
done exactly by cross-multiplying integers (no floating point, no decimal
scale loss).  The defaults are the reference's own values; ``DRIVER_*``
instances hold the values tuned for the TPC-H-shaped driver tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from fractions import Fraction

# ---------------------------------------------------------------------------
# These must equal the reference's so that results match.
# ---------------------------------------------------------------------------
# Channel stuffing: spike ratio 4, trailing mean floor 500, 28 trailing days.
# Promotion leakage: 14 days before, 15 days after, promo mean <= 0.1 x
#   baseline, baseline >= 50, post-promo mean >= 1.5 x baseline.
# Route falsification: bulk drop >= 100 units, 5 dumps = falsified.
# Risk score: 10 points per spike capped at 40; 30 for any leaked SKU;
#   30 when bulk share >= 0.20 (percent), else 12 when dumps >= 5;
#   tiers >= 60 CRITICAL, >= 25 HIGH, > 0 MEDIUM, else CLEAN.
LEAK_VERDICT = "LEAKAGE - HOARD & DUMP"
OK_VERDICT = "OK"
ROUTE_FALSIFIED = "FALSIFIED - BULK DUMPING"
ROUTE_SUSPECT = "SUSPECT - INVESTIGATE"
TIER_CRITICAL = "CRITICAL"
TIER_HIGH = "HIGH"
TIER_MEDIUM = "MEDIUM"
TIER_CLEAN = "CLEAN"
# Drop-size bucket upper edges of the dashboard extract; the last bucket is
# "<last edge>+", and its cohort labels.
REFERENCE_BUCKET_EDGES = (20, 60, 100, 150, 200, 250, 300)
COHORT_SUFFIX = " (falsifier)"
COHORT_OTHERS = "All other distributors"
# The one promotion the reference seeds: 20 % off, 16 days in April.
REFERENCE_PROMO = ("PROMO001", "CleanMax Spring Clean Sale", "SKU001",
                   dt.date(2023, 4, 10), dt.date(2023, 4, 25), 20)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class StuffingParams:
    ratio: Fraction = Fraction(4)
    min_trail: Fraction = Fraction(500)
    trail_days: int = 28


@dataclass(frozen=True)
class LeakageParams:
    pre_days: int = 14
    post_days: int = 15
    max_promo_share: Fraction = Fraction(1, 10)
    min_baseline: Fraction = Fraction(50)
    min_post_lift: Fraction = Fraction(3, 2)


@dataclass(frozen=True)
class RouteParams:
    bulk_units: int = 100
    repeat_dumps: int = 5


@dataclass(frozen=True)
class RiskParams:
    points_per_spike: int = 10
    stuffing_cap: int = 40
    promo_points: int = 30
    route_share_points: int = 30
    route_repeat_points: int = 12
    # The reference compares a percentage with 0.20 (quirk K1): keep it.
    route_share_pct: Fraction = Fraction(1, 5)
    critical_at: int = 60
    high_at: int = 25


@dataclass(frozen=True)
class ReportParams:
    bucket_edges: tuple[int, ...] = REFERENCE_BUCKET_EDGES
    # pair series range around the promotion (reference: 21 days before the
    # start, 36 days after the end)
    series_days_before: int = 21
    series_days_after: int = 36


@dataclass(frozen=True)
class Params:
    stuffing: StuffingParams = field(default_factory=StuffingParams)
    leakage: LeakageParams = field(default_factory=LeakageParams)
    route: RouteParams = field(default_factory=RouteParams)
    risk: RiskParams = field(default_factory=RiskParams)
    report: ReportParams = field(default_factory=ReportParams)


REFERENCE = Params()

# Values for the TPC-H-shaped driver tables: quantities run 1..50 and a
# supplier ships about one line every four days, so the floors shrink.
DRIVER = Params(
    stuffing=StuffingParams(min_trail=Fraction(50)),
    leakage=LeakageParams(min_baseline=Fraction(1, 2)),
    route=RouteParams(bulk_units=45),
    risk=RiskParams(route_share_pct=Fraction(20)),
    report=ReportParams(bucket_edges=(5, 10, 15, 20, 25, 30, 40)),
)
