"""Promotion leakage (hoard during the promotion, dump after it).

For every distributor and promoted SKU the reference averages daily
secondary sales over three dense windows around each promotion (baseline
before, the promotion, post after), reads the stock at the promotion's last
day, and calls it leakage when promotion sales collapse while the baseline
was active and post-promotion sales jump.

Spine-free plan: the promoted SKUs' movements are rolled up per day first.
The cumulative sums that the windows need are those at a few cut days per
promotion (:func:`balances_at`): the cut days join the daily rows of their
(distributor, SKU) as probe rows of one running window, whatever the number
of promotions.  Window sums are differences of cumulative sums, day counts
are calendar arithmetic, and the stock at the promotion's end is the net
balance there.  Rows entering the window are daily rows plus four probes per
distributor and promotion; no fact line is ever multiplied by promotions.

Promotions sharing a SKU are kept apart (``promotion_id`` is a column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_key, day_span
from ..functions.exact import mean_ge, mean_ge_k_mean, mean_le_k_mean, round_ratio
from ..params import LEAK_VERDICT, OK_VERDICT, LeakageParams
from ..sources.warehouse import Warehouse
from .calendar import calendar_bounds, calendar_row, in_calendar, with_calendar
from .densify import densify
from .intervals import days_in_ranges
from .keys import attach_all
from .ledger import daily_movements

PROMO_COLS = ["promotion_id", "sku_id", "promo_start", "promo_end"]
PAIR = ["distributor_id", "sku_id"]
KEYS = ["promotion_id", "distributor_id", "sku_id"]


def valid_promotions(wh: Warehouse) -> DataFrame:
    """Promotions whose SKU exists in the product dimension (the FK)."""
    return wh.promotions.join(wh.products.select("sku_id").distinct(), "sku_id", "left_semi")


def promo_calendar(wh: Warehouse, p: LeakageParams = LeakageParams()) -> DataFrame:
    """The seeded promotions with the calendar days of each window."""
    lo, hi = F.col("_cal.lo"), F.col("_cal.hi")
    a, b = F.col("promo_start"), F.col("promo_end")
    return with_calendar(valid_promotions(wh), calendar_row(wh)).select(
        "promotion_id", "promo_name", "sku_id", "promo_start", "promo_end", "discount_pct",
        day_span(F.greatest(F.date_sub(a, p.pre_days), lo), F.least(F.date_sub(a, 1), hi))
        .cast("bigint").alias("baseline_days"),
        day_span(F.greatest(a, lo), F.least(b, hi)).cast("bigint").alias("promo_days"),
        day_span(F.greatest(F.date_add(b, 1), lo), F.least(F.date_add(b, p.post_days), hi))
        .cast("bigint").alias("post_days"))


def promoted_daily(wh: Warehouse) -> DataFrame:
    """Daily roll-up of the SKUs that have a promotion: the semi join filters
    the lines before they are rolled up; Spark broadcasts the promotions'
    SKUs where it measures them small."""
    skus = valid_promotions(wh).select("sku_id").distinct()
    return in_calendar(daily_movements(wh).join(skus, "sku_id", "left_semi"), wh)


def promo_pairs(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """Every distributor with every valid promotion; with ``daily``
    (:func:`promoted_daily`) only the pairs that moved."""
    if daily is None:
        return attach_all(wh.dist_keys(), valid_promotions(wh), PROMO_COLS)
    moved = daily.select(*PAIR).distinct().join(wh.dist_keys(), "distributor_id", "left_semi")
    return moved.join(valid_promotions(wh).select(*PROMO_COLS), "sku_id")


def balances_at(daily: DataFrame, probes: DataFrame) -> DataFrame:
    """``probes`` (distributor_id, sku_id, full_date, more) with
    ``cum_secondary`` and ``cum_net``: the pair's secondary sales and net
    movement up to and including that day.

    One running window over the daily rows and the probes of a pair; a
    partition holds a row per movement day and its probes.
    """
    more = [c for c in probes.columns if c not in (*PAIR, "full_date")]
    empty = [F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in more]
    rows = daily.select(*PAIR, "full_date", *empty, "primary_units", "secondary_units",
                        F.lit(0).alias("_probe")).unionByName(
        probes.select(*PAIR, "full_date", *more, F.lit(0).cast("bigint").alias("primary_units"),
                      F.lit(0).cast("bigint").alias("secondary_units"), F.lit(1).alias("_probe")))
    w = (Window.partitionBy(*PAIR).orderBy("full_date", "_probe")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    net = F.col("primary_units") - F.col("secondary_units")
    return (rows.select("*", F.sum("secondary_units").over(w).cast("bigint").alias("cum_secondary"),
                        F.sum(net).over(w).cast("bigint").alias("cum_net"))
            .filter(F.col("_probe") == 1).select(*PAIR, "full_date", *more, "cum_secondary", "cum_net"))


def promo_stats(wh: Warehouse, p: LeakageParams = LeakageParams(),
                calendar: DataFrame | None = None, moved_only: bool = False) -> DataFrame:
    """Sums and day counts of every window, per (promotion, distributor, sku).

    ``calendar``: :func:`calendar_row`, where the caller has it.
    ``moved_only``: leave out pairs without any movement, for tests that they
    cannot pass (a baseline above 0)."""
    own = promoted_daily(wh)
    lo, hi = F.col("_cal.lo"), F.col("_cal.hi")
    a, b = F.col("promo_start"), F.col("promo_end")
    base_lo, post_hi = F.date_sub(a, p.pre_days), F.date_add(b, p.post_days)
    cuts = F.array(F.date_sub(base_lo, 1), F.date_sub(a, 1), b, post_hi)
    pairs = promo_pairs(wh, own if moved_only else None)
    at = balances_at(own, pairs.select("*", F.posexplode(cuts).alias("_cut", "full_date")))

    def upto(i: int, c: str) -> Column:
        return F.max(F.when(F.col("_cut") == i, F.col(c)))

    s = at.groupBy(*KEYS, "promo_start", "promo_end").agg(
        (upto(1, "cum_secondary") - upto(0, "cum_secondary")).alias("baseline_units"),
        (upto(2, "cum_secondary") - upto(1, "cum_secondary")).alias("promo_units"),
        (upto(3, "cum_secondary") - upto(2, "cum_secondary")).alias("post_units"),
        upto(1, "cum_secondary").alias("before_units"),
        upto(2, "cum_net").alias("_net_to_end"))
    s = with_calendar(s, calendar_row(wh) if calendar is None else calendar)
    return s.select(
        *KEYS, "promo_start", "promo_end", lo.alias("_first_day"),
        day_span(F.greatest(base_lo, lo), F.least(F.date_sub(a, 1), hi)).cast("bigint")
        .alias("baseline_days"), "baseline_units",
        day_span(F.greatest(a, lo), F.least(b, hi)).cast("bigint").alias("promo_days"),
        "promo_units",
        day_span(F.greatest(F.date_add(b, 1), lo), F.least(post_hi, hi)).cast("bigint")
        .alias("post_days"), "post_units",
        day_span(lo, F.least(F.date_sub(a, 1), hi)).cast("bigint").alias("before_days"),
        "before_units",
        F.when((b >= lo) & (b <= hi), F.col("_net_to_end")).alias("stock_at_promo_end"),
        day_span(F.greatest(base_lo, lo), F.least(post_hi, hi)).alias("_window_days"))


def is_leak(p: LeakageParams) -> Column:
    """The detector's test on :func:`promo_stats` columns: promotion mean at
    most ``max_promo_share`` x baseline, baseline at least ``min_baseline``,
    post mean at least ``min_post_lift`` x baseline (NULL when a window has
    no days)."""
    bs, bn = F.col("baseline_units"), F.col("baseline_days")
    return (mean_le_k_mean(F.col("promo_units"), F.col("promo_days"), bs, bn, p.max_promo_share)
            & mean_ge(bs, bn, p.min_baseline)
            & mean_ge_k_mean(F.col("post_units"), F.col("post_days"), bs, bn, p.min_post_lift))


def promo_windows(wh: Warehouse, p: LeakageParams = LeakageParams()) -> DataFrame:
    """The three windows' day counts, unit sums and rounded daily means."""
    st = promo_stats(wh, p).filter(F.col("_window_days") > 0)
    return st.select(
        *KEYS,
        "baseline_days", "baseline_units",
        round_ratio(F.col("baseline_units"), F.col("baseline_days"), 1).alias("baseline_daily_units"),
        "promo_days", "promo_units",
        round_ratio(F.col("promo_units"), F.col("promo_days"), 1).alias("promo_daily_units"),
        "post_days", "post_units",
        round_ratio(F.col("post_units"), F.col("post_days"), 1).alias("post_promo_units"))


def stock_at_promo_end(wh: Warehouse, p: LeakageParams = LeakageParams()) -> DataFrame:
    """Closing stock on the promotion's last day (NULL outside the calendar)."""
    st = promo_stats(wh, p).filter(F.col("_window_days") > 0)
    return st.select(*KEYS, "stock_at_promo_end")


def promotion_leakage(wh: Warehouse, p: LeakageParams = LeakageParams(),
                      stats: DataFrame | None = None) -> DataFrame:
    """C4: the detector's report, per promotion, distributor and SKU (from
    ``stats`` if given, e.g. of a stored ledger)."""
    st = (promo_stats(wh, p) if stats is None else stats).filter(F.col("_window_days") > 0)
    verdict = F.when(is_leak(p), F.lit(LEAK_VERDICT)).otherwise(F.lit(OK_VERDICT))
    return st.select(
        *KEYS,
        round_ratio(F.col("baseline_units"), F.col("baseline_days"), 1).alias("baseline_daily_units"),
        round_ratio(F.col("promo_units"), F.col("promo_days"), 1).alias("promo_daily_units"),
        round_ratio(F.col("post_units"), F.col("post_days"), 1).alias("post_promo_units"),
        "stock_at_promo_end", verdict.alias("verdict"),
    ).orderBy("verdict", "distributor_id", "sku_id", "promotion_id")


def leak_counts(wh: Warehouse, p: LeakageParams = LeakageParams(),
                calendar: DataFrame | None = None) -> DataFrame:
    """Distinct leaked SKUs per distributor (only distributors with one)."""
    st = promo_stats(wh, p, calendar).filter((F.col("_window_days") > 0) & is_leak(p))
    return st.groupBy("distributor_id").agg(F.count_distinct("sku_id").alias("leaked_skus"))


def leaked_pairs(wh: Warehouse, p: LeakageParams = LeakageParams()) -> DataFrame:
    """P9 (quirk K3): the dump-day query's own test, with an unbounded
    baseline (every calendar day before the promotion) and no post test."""
    return _leaked(wh, p).select("promotion_id", "distributor_id", "sku_id", "promo_end")


def _leaked(wh: Warehouse, p: LeakageParams) -> DataFrame:
    st = promo_stats(wh, p)
    cond = (mean_le_k_mean(F.col("promo_units"), F.col("promo_days"),
                           F.col("before_units"), F.col("before_days"), p.max_promo_share)
            & mean_ge(F.col("before_units"), F.col("before_days"), p.min_baseline))
    return st.filter(cond)


def prev_day_units(wh: Warehouse, p: LeakageParams = LeakageParams()) -> DataFrame:
    """Leaked pairs' daily secondary sales with the previous day's value.

    The series of a pair is made dense once; its leaked promotions join the
    finished rows."""
    leaked = leaked_pairs(wh, p)
    lo, hi = calendar_bounds(wh)
    dense = densify(promoted_daily(wh), PAIR, ["secondary_units"], lo, hi,
                    anchors=leaked.select(*PAIR).distinct(), in_range=True)
    w = Window.partitionBy(*PAIR).orderBy("full_date")
    series = dense.select(*PAIR, "full_date", "secondary_units",
                          F.lag("secondary_units").over(w).alias("prev_day_units"))
    return series.join(leaked, PAIR).select("promotion_id", *PAIR, "promo_end", "full_date",
                                            "secondary_units", "prev_day_units")


def dump_day(wh: Warehouse, p: LeakageParams = LeakageParams()) -> DataFrame:
    """First day after the promotion when a hoarder sells again
    (yesterday 0 units, today > 0), per distributor and SKU.

    Spine-free: on the dense ledger "yesterday = 0" means "no non-zero
    movement row yesterday", so a LAG over the non-zero rows decides it.  Over
    several leaked promotions of a pair the first such day after any of them
    is the first one after the earliest end.
    """
    after = _leaked(wh, p).groupBy(*PAIR).agg(F.min("promo_end").alias("_after"), F.first("_first_day").alias("_lo"))
    mv = promoted_daily(wh).filter(F.col("secondary_units") != 0).join(after, PAIR)
    w = Window.partitionBy(*PAIR).orderBy("full_date")
    prev = F.lag("full_date").over(w)
    cand = mv.select(*PAIR, "_after", "_lo", "full_date", "secondary_units", prev.alias("_prev"))
    d = F.col("full_date")
    hit = ((F.col("secondary_units") > 0) & (d > F.col("_after")) & (d > F.col("_lo"))
           & (F.col("_prev").isNull() | (F.col("_prev") < F.date_sub(d, 1))))
    first = (cand.filter(hit).groupBy(*PAIR)
             .agg(F.min(F.struct("full_date", "secondary_units")).alias("_f")))
    return first.select(*PAIR, F.col("_f.full_date").alias("resumed_selling_on"),
                        F.col("_f.secondary_units").alias("units_sold_that_day")
                        ).orderBy(*PAIR)


def promo_window_rows(wh: Warehouse, p: LeakageParams = LeakageParams()) -> DataFrame:
    """Dense ledger rows of promoted SKUs inside each promotion's range
    ``[start - pre_days, end + post_days]``, labelled by window.

    Only movements near a range meet its promotion (a join by bins of days);
    the balance before the range comes from :func:`balances_at`.
    """
    daily = promoted_daily(wh)
    a, b, lo, hi = F.col("promo_start"), F.col("promo_end"), F.col("_cal.lo"), F.col("_cal.hi")
    calendar = calendar_row(wh)
    carry = ["promo_start", "promo_end", "_lo", "_hi"]
    spans = [F.greatest(F.date_sub(a, p.pre_days), lo).alias("_lo"),
             F.least(F.date_add(b, p.post_days), hi).alias("_hi")]
    ranges = with_calendar(valid_promotions(wh), calendar).select(*PROMO_COLS, *spans)
    mv = days_in_ranges(daily, ranges, ["sku_id"], "full_date", "_lo", "_hi")
    pairs = with_calendar(promo_pairs(wh), calendar).select("*", *spans).drop("_cal")
    before = balances_at(daily, pairs.withColumn("full_date", F.date_sub("_lo", 1)))
    anchors = before.select(*KEYS, *carry, F.col("cum_net").alias("primary_units"))
    dense = densify(mv, KEYS, ["primary_units", "secondary_units"], F.col("_lo"), F.col("_hi"),
                    anchors=anchors, carry=carry, in_range=True,
                    opening=("opening_units",
                             F.col("primary_units") - F.col("secondary_units")))
    d = F.col("full_date")
    label = (F.when(d < a, F.lit("baseline")).when(d <= b, F.lit("promo"))
             .otherwise(F.lit("post")))
    return dense.select(
        "promotion_id", "distributor_id", "sku_id", date_key(d).alias("date_id"), "full_date",
        label.alias("promo_window"), "secondary_units",
        (F.col("opening_units") + F.col("primary_units") - F.col("secondary_units"))
        .alias("closing_units"))
