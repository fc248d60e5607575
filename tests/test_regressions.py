"""The three regressions the reference records in its comments, plus
promotion edge cases (calendar edge, two promotions on one SKU)."""

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from stockgap import params as P
from stockgap.operators import leakage as lk
from stockgap.operators import stuffing as stf
from stockgap.operators.calendar import calendar
from stockgap.sources.promotions import promotions_frame
from stockgap.sources.warehouse import Warehouse

REF = P.REFERENCE


def test_grain_mixed_case_sizes_no_phantom_spike(planted):
    # SKU002 ships 400 units a day, SKU001 200: at SKU grain a 400-unit day
    # against a trail averaged over both SKUs (300) would be a phantom; at
    # distributor-day grain honest distributors never flag.
    flagged = {r.distributor_id for r in stf.stuffing_flags(planted, REF.stuffing).collect()}
    assert flagged == {"D02", "D03"}


def test_unbounded_post_window_would_hide_the_leak(planted):
    # with the 15-day post window the hoarder is caught ...
    assert lk.leak_counts(planted, REF.leakage).collect()[0].distributor_id == "D05"
    # ... stretched to the end of the data (the bug the reference hit) it vanishes
    long_post = replace(REF.leakage, post_days=400)
    assert lk.leak_counts(planted, long_post).count() == 0


def test_promotion_needs_known_sku(spark, planted):
    promos = promotions_frame(spark, [
        ("P1", "known", "SKU001", dt.date(2023, 4, 10), dt.date(2023, 4, 25), 20),
        ("P2", "orphan", "NOPE", dt.date(2023, 4, 10), dt.date(2023, 4, 25), 20)])
    wh = replace(planted, promotions=promos)
    assert [r.promotion_id for r in lk.valid_promotions(wh).collect()] == ["P1"]
    from stockgap.operators.quality import orphans
    o = orphans(promos, "sku_id", planted.products, "sku_id", "promo sku").collect()[0]
    assert (o.orphan_keys, o.orphan_rows) == (1, 1)


def test_promotion_at_calendar_edge(spark, planted):
    # promotion ends 3 days before the calendar does: post window is clipped
    end = dt.date(2023, 6, 27)
    promos = promotions_frame(spark, [("P9", "edge", "SKU001", dt.date(2023, 6, 20), end, 10)])
    wh = replace(planted, promotions=promos)
    cal = lk.promo_calendar(wh, REF.leakage).collect()[0]
    assert (cal.baseline_days, cal.promo_days, cal.post_days) == (14, 8, 3)
    win = lk.promo_windows(wh, REF.leakage).filter("distributor_id = 'D01'").collect()[0]
    assert (win.post_days, win.post_units) == (3, 600)
    rows = lk.promo_window_rows(wh, REF.leakage).filter("distributor_id = 'D01'")
    assert rows.count() == 14 + 8 + 3


def test_two_promotions_on_one_sku_are_kept_apart(spark, planted):
    promos = promotions_frame(spark, [
        ("PA", "first", "SKU001", dt.date(2023, 4, 10), dt.date(2023, 4, 25), 20),
        ("PB", "second", "SKU001", dt.date(2023, 2, 10), dt.date(2023, 2, 20), 10)])
    wh = replace(planted, promotions=promos)
    st = lk.promo_windows(wh, REF.leakage).filter("distributor_id = 'D05'")
    got = {r.promotion_id: r.promo_units for r in st.collect()}
    assert got == {"PA": 0, "PB": 11 * 200}
    assert lk.leak_counts(wh, REF.leakage).collect()[0].leaked_skus == 1


def test_calendar_parts(spark):
    cal = calendar(spark, dt.date(2024, 2, 27), dt.date(2024, 3, 1)).collect()
    assert [(r.date_id, r.is_month_end) for r in cal] == [
        (20240227, False), (20240228, False), (20240229, True), (20240301, False)]


def test_first_day_of_series_has_no_trail(planted):
    t = stf.trailing_28d(planted, REF.stuffing).filter(
        (F.col("distributor_id") == "D01") & (F.col("date_id") <= 20230102)).collect()
    by = {r.date_id: r for r in t}
    assert by[20230101].trail_days == 0 and by[20230101].trail_28d_avg is None
    assert by[20230102].trail_days == 1 and by[20230102].trail_28d_avg == 600


def test_warehouse_is_plain_dataclass():
    assert {f for f in Warehouse.__dataclass_fields__} >= {"calendar", "movements", "drops"}
