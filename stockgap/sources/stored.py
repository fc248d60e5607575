"""Read the detectors' input from a materialized ledger (S3 then S8).

The reference builds its ledger once and every detector reads the stored
table.  :func:`with_stored_ledger` swaps a warehouse's movement facts for
the ledger's daily movements, whatever its layout (runs, dense, by month), so
the ledger-based jobs (stuffing, leakage, dump day, series) read the stored
table instead of re-rolling the raw facts.  Quiet days are skipped on read;
the jobs re-create them.  Delivery-grain jobs (route) still read the
deliveries.

:func:`stored_promo_stats` goes further for the leakage windows: it reads
only the runs that touch a promotion's range and takes the stock from the
stored balance.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_from_key, day_span
from ..operators.calendar import calendar_bounds, calendar_row, with_calendar
from ..operators.leakage import KEYS, PAIR, PROMO_COLS, valid_promotions
from ..params import LeakageParams
from .warehouse import Warehouse

VALUES = ("primary_units", "secondary_units")
DAYS = ("baseline_days", "promo_days", "post_days", "_window_days")
STATS = ("baseline_units", "promo_units", "post_units", "stock_at_promo_end", *DAYS)


def is_runs(ledger: DataFrame) -> bool:
    return "from_date" in ledger.columns


def with_stored_ledger(wh: Warehouse, ledger: DataFrame) -> Warehouse:
    """``wh`` with the stored ledger's movements (runs, dense or month layout).

    The calendar stays the warehouse's own: a stored ledger may lag behind
    the facts, and its days must not shrink the calendar."""
    moved = ledger.filter((F.col("primary_units") != 0) | (F.col("secondary_units") != 0))
    day = F.col("from_date") if is_runs(ledger) else date_from_key(F.col("date_id"))
    movements = moved.select(day.alias("full_date"), "distributor_id", "sku_id",
                             *[F.col(v).cast("bigint").alias(v) for v in VALUES])
    return replace(wh, movements=movements, calendar_spans_facts=False,
                   movements_are_lines=False)


def stored_promo_stats(wh: Warehouse, ledger: DataFrame, p: LeakageParams = LeakageParams(), moved_only: bool = False) -> DataFrame:
    """The window statistics of :func:`stockgap.operators.leakage.promo_stats`
    (those of C4) from a stored ledger of every pair, run-length or dense by
    month; only what lies in a promotion's range is read and joined.

    Run-length: the scan is pruned to runs that touch any promotion's range (two
    scalar subqueries); a pair's runs become one series by day, and every
    promotion of its SKU reads its windows there (:func:`_series_sums`).
    By month: promotions meet the rows of the months they touch, so the months
    that no promotion touches are pruned when the query runs (dynamic partition
    pruning on ``month``).
    ``moved_only``: leave out pairs that sold nothing in the baseline, for tests
    that they cannot pass (a baseline above 0).
    """
    a, b = F.col("promo_start"), F.col("promo_end")
    base_lo, post_hi = F.date_sub(a, p.pre_days), F.date_add(b, p.post_days)
    ranges = valid_promotions(wh).where(a <= b).select(*PROMO_COLS, base_lo.alias("_lo"), post_hi.alias("_hi"))
    if is_runs(ledger):
        first, last = ranges.agg(F.min("_lo")).scalar(), ranges.agg(F.max("_hi")).scalar()
        near = ledger.filter((F.col("to_date") >= first) & (F.col("from_date") <= last))
        lo, hi = calendar_bounds(wh)  # the promotions' size stays that of their table, so Spark sees whether it is small
        days = ranges.select("*", lo.alias("_cal_lo"), hi.alias("_cal_hi")).select("*", *_days(p, F.col("_cal_lo"), F.col("_cal_hi")))
        stats = _series_sums(near, days.drop("_cal_lo", "_cal_hi").distinct())
    else:
        start = F.trunc("_lo", "MM")
        months = ranges.withColumn("_month", F.explode(F.sequence(start, F.col("_hi"), F.expr("INTERVAL 1 MONTH")))).withColumn(
            "month", F.year("_month") * 100 + F.month("_month")).drop("_month")
        met = ledger.join(months, ["month", "sku_id"]).withColumn("full_date", date_from_key(F.col("date_id"))).where(
            (F.col("full_date") >= F.col("_lo")) & (F.col("full_date") <= F.col("_hi")))
        stats = with_calendar(_row_sums(p, met), calendar_row(wh)).select("*", *_days(p, F.col("_cal.lo"), F.col("_cal.hi")))
    if moved_only:
        stats = stats.where(F.col("baseline_units") > 0)
    return stats.select(*KEYS, *STATS)


def _series_sums(runs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Sums per promotion and pair from ``runs`` of any days.

    A pair's series is two arrays with an element a day (sales up to that day,
    closing balance), as long as the calendar at most.  It meets the promotions
    of its SKU after the only exchange of runs, and a window is the difference
    of two elements: no run is multiplied by promotions, and what pairs and
    promotions make is never shuffled."""
    w = Window.partitionBy(*PAIR).orderBy("from_date")
    until = F.coalesce(F.date_sub(F.lead("from_date").over(w), 1), F.col("to_date"))
    sold = F.coalesce(F.sum("secondary_units").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    steps = runs.where(F.col("from_date") <= F.col("to_date")).select(*PAIR, F.struct(
        "from_date", "to_date", until.alias("until"), sold.cast("bigint").alias("sold"), "closing_units").alias("step"))

    def days(a: Column, b: Column) -> Column:
        return F.greatest(F.datediff(b, a) + 1, F.lit(0))

    def gap(r: Column) -> Column:  # days without a run have no balance
        return F.array_repeat(F.lit(None).cast("bigint"), days(r["to_date"], r["until"]) - 1)

    def held(r: Column) -> Column:
        return F.array_repeat(r["closing_units"], days(r["from_date"], F.least(r["to_date"], r["until"])))

    of_pair = steps.groupBy(*PAIR).agg(F.array_sort(F.collect_list("step")).alias("steps"))
    series = of_pair.select(
        *PAIR, F.get("steps", F.lit(0))["from_date"].alias("_first"), F.element_at("steps", -1)["until"].alias("_last"),
        F.flatten(F.transform("steps", lambda r: F.array_repeat(r["sold"], days(r["from_date"], r["until"])))).alias("_sold"),
        F.flatten(F.transform("steps", lambda r: F.concat(held(r), gap(r)))).alias("_held"))
    met = series.join(ranges, "sku_id").where((F.col("_last") >= F.col("_lo")) & (F.col("_first") <= F.col("_hi")))

    def upto(day: Column) -> Column:
        at = F.least(F.datediff(day, F.col("_first")), F.size("_sold") - 1)
        return F.when(at < 0, F.lit(0).cast("bigint")).otherwise(F.get("_sold", at))

    a, b = F.col("promo_start"), F.col("promo_end")
    cuts = [upto(F.date_sub("_lo", 1)), upto(F.date_sub(a, 1)), upto(b), upto(F.col("_hi"))]
    return met.select(*KEYS, *DAYS, (cuts[1] - cuts[0]).alias("baseline_units"),
                      (cuts[2] - cuts[1]).alias("promo_units"), (cuts[3] - cuts[2]).alias("post_units"),
                      F.when((b >= F.col("_first")) & (b <= F.col("_last")), F.get("_held", F.datediff(b, F.col("_first")))).alias("stock_at_promo_end"))


def _row_sums(p: LeakageParams, met: DataFrame) -> DataFrame:
    """Sums per promotion and pair of dense ledger rows in its range."""
    d, a, b, s = F.col("full_date"), F.col("promo_start"), F.col("promo_end"), F.col("secondary_units")
    base_lo, post_hi = F.date_sub(a, p.pre_days), F.date_add(b, p.post_days)

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, s)), F.lit(0)).cast("bigint")

    return met.groupBy(*KEYS, "promo_start", "promo_end").agg(
        total((d >= base_lo) & (d < a)).alias("baseline_units"),
        total((d >= a) & (d <= b)).alias("promo_units"),
        total((d > b) & (d <= post_hi)).alias("post_units"),
        F.max(F.when(d == b, F.col("closing_units"))).alias("stock_at_promo_end"))


def _days(p: LeakageParams, lo: Column, hi: Column) -> list[Column]:
    """The calendar days of each window of a promotion."""
    a, b = F.col("promo_start"), F.col("promo_end")
    base_lo, post_hi = F.date_sub(a, p.pre_days), F.date_add(b, p.post_days)
    return [day_span(F.greatest(base_lo, lo), F.least(F.date_sub(a, 1), hi)).cast("bigint").alias("baseline_days"),
            day_span(F.greatest(a, lo), F.least(b, hi)).cast("bigint").alias("promo_days"),
            day_span(F.greatest(F.date_add(b, 1), lo), F.least(post_hi, hi)).cast("bigint").alias("post_days"),
            day_span(F.greatest(base_lo, lo), F.least(post_hi, hi)).alias("_window_days")]
