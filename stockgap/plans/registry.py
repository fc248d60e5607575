"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each binds the driver tables (lazily; nothing is read until an action) and
runs one operator with the driver parameters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..operators import leakage as lk
from ..operators import ledger as led
from ..operators import quality as dq
from ..operators import reports as rp
from ..operators import risk as rk
from ..operators import route as rt
from ..operators import stuffing as stf
from ..operators.calendar import calendar_bounds
from ..operators.refresh import refresh_ledger
from ..session import scratch_path
from ..sources.bindings import DRIVER_PROMOTIONS, bind_driver_tables
from ..sources.csv_io import export_csv, load_csv, write_table
from ..sources.snapshots import SnapshotTable
from ..sources.stored import stored_promo_stats, with_stored_ledger
from . import catalog
from .views import register_views

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str):
    """The driver tables, bound anew for every query (lazy plans only)."""
    return bind_driver_tables(spark, sf_dir)


def _on_wh(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_wh(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


D = P.DRIVER

# Several promotions on one SKU, overlapping ones too, and one on another.
SEVERAL = (
    ("PROMO001", "Spring sale", "PROMO", dt.date(1998, 4, 10), dt.date(1998, 4, 25), 20),
    ("PROMO002", "Late spring sale", "PROMO", dt.date(1998, 4, 20), dt.date(1998, 5, 10), 10),
    ("PROMO003", "Autumn sale", "PROMO", dt.date(1997, 9, 1), dt.date(1997, 9, 20), 15),
    ("PROMO004", "Economy week", "ECONOMY", dt.date(1998, 4, 12), dt.date(1998, 4, 18), 30),
)


def _several(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bind_driver_tables(spark, sf_dir, promotions=SEVERAL))
    return run


def _stored(layout: str, fn) -> Query:
    """Write the ledger to the shared folder, read it back, run on it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _wh(spark, sf_dir)
        path = scratch_path(spark, f"ledger-{layout}")
        led.materialize_ledger(wh, path, layout=layout)
        return fn(wh, spark.read.parquet(path))
    return run


def _daily_promotions(spark: SparkSession, sf_dir: str):
    """The warehouse with a promotion of 16 days from every day on which a SKU
    was shipped: thousands on each SKU, all overlapping."""
    wh = _wh(spark, sf_dir)
    days = wh.movements.where("primary_units > 0").select("sku_id", "full_date").distinct()
    promos = days.select(
        F.concat_ws(" ", "sku_id", "full_date").alias("promotion_id"), F.concat(F.lit("from "), "full_date").alias("promo_name"), "sku_id",
        F.col("full_date").alias("promo_start"), F.date_add("full_date", 15).alias("promo_end"), F.lit(10).alias("discount_pct"))
    path = scratch_path(spark, "promotions")  # a stored table: its size is known, and the facts are read for it once
    write_table(promos, path)
    return replace(wh, promotions=spark.read.parquet(path))


def _leaks_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks of thousands of overlapping promotions a SKU, from a
    stored run-length ledger."""
    wh = _daily_promotions(spark, sf_dir)
    path = scratch_path(spark, "ledger-runs")
    led.materialize_ledger(wh, path)
    stats = stored_promo_stats(wh, spark.read.parquet(path), D.leakage, moved_only=D.leakage.min_baseline > 0)
    # leaks are few: they alone are dealt anew, and the report's rounding and sort read them from there
    leaks = stats.where((F.col("_window_days") > 0) & lk.is_leak(D.leakage)).repartition("promotion_id", "distributor_id")
    return lk.promotion_leakage(wh, D.leakage, stats=leaks)


def _month_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month layout written twice, the second time from a calendar
    that lost its last year; what is stored then."""
    wh = _wh(spark, sf_dir)
    path = scratch_path(spark, "ledger-month")
    led.materialize_ledger(wh, path, layout="month")
    led.materialize_ledger(first_years(wh), path, layout="month")
    return spark.read.parquet(path).drop("month")


def _range_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of the years before the last one, brought up to date: only
    the months that changed are computed, from the stored balances before."""
    wh = _wh(spark, sf_dir)
    table = SnapshotTable(spark, scratch_path(spark, "ledger-snapshots"))
    refresh_ledger(first_years(wh), table)
    refresh_ledger(wh, table)
    return table.read().drop("month")


def first_years(wh):
    """The warehouse up to the year before its last one."""
    lo, hi = calendar_bounds(wh)
    end = F.make_date(F.year(hi) - 1, F.lit(12), F.lit(31))
    return replace(wh, calendar=wh.calendar.filter(F.col("full_date") <= end),
                   movements=wh.movements.filter(F.col("full_date") <= end),
                   bounds=None, calendar_spans_facts=False)


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar and the deliveries per day, exported as CSV and
    loaded by position."""
    wh = _wh(spark, sf_dir)
    days, sold = scratch_path(spark, "csv-days"), scratch_path(spark, "csv-sold")
    export_csv(wh.calendar.select(*S.DIM_DATE.names), days)
    export_csv(led.daily_secondary_units(wh), sold)
    d = load_csv(spark, days, S.DIM_DATE)
    s = load_csv(spark, sold, "day_key int, distributor_id bigint, sku_id string, secondary_units bigint")
    return s.join(d, s["day_key"] == d["date_id"]).select("full_date", "is_month_end", "distributor_id", "sku_id", "secondary_units")


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk view by name, in SQL."""
    register_views(spark, _wh(spark, sf_dir), D)
    return spark.sql("SELECT distributor_id, risk_score, risk_tier FROM vw_fraud_risk_score WHERE risk_score > 0")


#: stricter thresholds than the driver's
STRICT = replace(D, stuffing=replace(D.stuffing, ratio=Fraction(3)), route=replace(D.route, bulk_units=40),
                 risk=replace(D.risk, route_share_pct=Fraction(35)))


def _catalog_view(name: str) -> Query:
    """The risk view in the session's catalog, under a set of thresholds."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        catalog.install(spark, sf_dir, scratch_path(spark, "catalog"), DRIVER_PROMOTIONS, {"driver": D, "strict": STRICT})
        return catalog.risk_under(spark, name)
    return run


def _stores_of_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores hit by bulk drops over 16 months, from stored monthly bitmaps."""
    path = scratch_path(spark, "store-bitmaps")
    write_table(rt.store_bitmaps(_wh(spark, sf_dir), D.route), path, ("month",))
    return rt.bulk_stores_of(spark.read.parquet(path), 199703, 199806)


QUERIES: dict[str, Query] = {
    "calendar": _on_wh(lambda wh: wh.calendar),
    "spine": _on_wh(led.spine),
    "daily_primary_units": _on_wh(led.daily_primary_units),
    "daily_secondary_units": _on_wh(led.daily_secondary_units),
    "ledger_movements": _on_wh(led.ledger_movements),
    "running_balance": _on_wh(led.running_balance),
    "ledger": _on_wh(led.stock_ledger),
    "ledger_sanity": _on_wh(led.ledger_sanity),
    "negative_stock": _on_wh(led.negative_stock),
    "dist_day": _on_wh(stf.dist_day),
    "dist_day_named": _on_wh(stf.dist_day_named),
    "trailing_28d": _on_wh(lambda wh: stf.trailing_28d(wh, D.stuffing)),
    "stuffing": _on_wh(lambda wh: stf.channel_stuffing(wh, D.stuffing)),
    "stuffing_counts": _on_wh(lambda wh: stf.stuffing_counts(wh, D.stuffing)),
    "promo_calendar": _on_wh(lambda wh: lk.promo_calendar(wh, D.leakage)),
    "promo_window_rows": _on_wh(lambda wh: lk.promo_window_rows(wh, D.leakage)),
    "promo_windows": _on_wh(lambda wh: lk.promo_windows(wh, D.leakage)),
    "stock_at_promo_end": _on_wh(lambda wh: lk.stock_at_promo_end(wh, D.leakage)),
    "leakage": _on_wh(lambda wh: lk.promotion_leakage(wh, D.leakage)),
    "leaked_pairs": _on_wh(lambda wh: lk.leaked_pairs(wh, D.leakage)),
    "leak_counts": _on_wh(lambda wh: lk.leak_counts(wh, D.leakage)),
    "prev_day_units": _on_wh(lambda wh: lk.prev_day_units(wh, D.leakage)),
    "dump_day": _on_wh(lambda wh: lk.dump_day(wh, D.leakage)),
    "drop_stats": _on_wh(lambda wh: rt.drop_stats(wh, D.route)),
    "drop_zscore": _on_wh(lambda wh: rt.drop_zscore(wh, D.route)),
    "bulk_drops": _on_wh(lambda wh: rt.bulk_drops(wh, D.route)),
    "bulk_stores": _on_wh(lambda wh: rt.bulk_stores(wh, D.route)),
    "bulk_volume_share": _on_wh(lambda wh: rt.bulk_volume_share(wh, D.route)),
    "route": _on_wh(lambda wh: rt.route_falsification(wh, D.route)),
    "risk_score": _on_wh(lambda wh: rk.risk_score(wh, D)),
    "risk_top10": _on_wh(lambda wh: rk.risk_top(rk.risk_score(wh, D), 10)),
    "risk_top8": _on_wh(lambda wh: rk.risk_top(rk.risk_score(wh, D), 8)),
    "risk_kpis": _on_wh(lambda wh: rk.risk_kpis(rk.risk_score(wh, D))),
    "distributor_series": _on_wh(lambda wh: rp.distributor_series(wh, D)),
    "pair_series": _on_wh(lambda wh: rp.pair_series(wh, D)),
    "spike_overlay": _on_wh(lambda wh: rp.spike_overlay(wh, D)),
    "drop_size_buckets": _on_wh(lambda wh: rp.drop_size_buckets(wh, D)),
    "drop_size_pivot": lambda spark, sf_dir: rp.drop_size_pivot(spark, _wh(spark, sf_dir), D),
    "dq_duplicate_keys": _on_wh(dq.dq_duplicate_keys),
    "dq_null_counts": _on_wh(dq.dq_null_counts),
    "dq_orphans": _on_wh(dq.dq_orphans),
    "dq_range": _on_wh(dq.dq_range),
    "dq_ledger_identity": _stored("runs", dq.dq_ledger_identity),
    "ledger_runs": _on_wh(led.ledger_runs),
    "ledger_stored": _stored("runs", lambda wh, runs: led.ledger_from_runs(led.deal_runs(runs))),
    "ledger_month_rebuild": _month_rebuild,
    "ledger_range_rebuild": _range_rebuild,
    "dq_violations": _on_wh(dq.dq_violations),
    "stuffing_stored": _stored("runs", lambda wh, runs: stf.channel_stuffing(with_stored_ledger(wh, runs), D.stuffing)),
    "leakage_stored": _stored("runs", lambda wh, runs: lk.promotion_leakage(
        wh, D.leakage, stats=stored_promo_stats(wh, runs, D.leakage))),
    "leakage_month_stored": _stored("month", lambda wh, months: lk.promotion_leakage(
        wh, D.leakage, stats=stored_promo_stats(wh, months, D.leakage))),
    "leaks_of_many": _leaks_of_many,
    "risk_score_stored": _stored("runs", lambda wh, runs: rk.risk_score(with_stored_ledger(wh, runs), D)),
    "leakage_several": _several(lambda wh: lk.promotion_leakage(wh, D.leakage)),
    "promo_windows_several": _several(lambda wh: lk.promo_windows(wh, D.leakage)),
    "promo_window_rows_several": _several(lambda wh: lk.promo_window_rows(wh, D.leakage)),
    "dump_day_several": _several(lambda wh: lk.dump_day(wh, D.leakage)),
    "pair_series_subject": _on_wh(lambda wh: rp.pair_series(
        wh, D, distributor_id=3, sku_id="STANDARD", start=dt.date(1997, 1, 1), end=dt.date(1997, 12, 31))),
    "drop_size_buckets_subject": _on_wh(lambda wh: rp.drop_size_buckets(wh, D, distributor_id=3)),
    "csv_round_trip": _csv_round_trip,
    "view_risk": _view,
    "catalog_risk": _catalog_view("driver"),
    "catalog_risk_strict": _catalog_view("strict"),
    "bulk_stores_months": _stores_of_months,
}
