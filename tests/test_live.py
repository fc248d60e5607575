"""Plans follow the data: new days and promotions without a new binding."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from stockgap.operators import leakage as lk
from stockgap.operators import ledger as led
from stockgap.params import DRIVER
from stockgap.plans.views import refresh_views, register_views
from stockgap.sources.bindings import bind_driver_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture()
def copy(spark, tmp_path):
    for name in ("lineitem", "orders", "part", "supplier", "nation", "region", "customer"):
        os.makedirs(tmp_path / f"{name}.parquet")
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet" / "a.parquet")
    return str(tmp_path)


def _append(spark, folder):
    later = spark.read.parquet(f"{SF}/lineitem.parquet").limit(200).withColumn(
        "l_shipdate", F.lit(dt.datetime(2001, 12, 15)).cast("timestamp_ntz"))
    later.write.mode("append").parquet(f"{folder}/lineitem.parquet")


def test_views_and_ledger_show_days_that_came_later(spark, copy):
    wh = bind_driver_tables(spark, copy)
    views = register_views(spark, wh, DRIVER)
    last = "SELECT max(date_id) AS d, count(*) AS n FROM fact_stock_reconciliation"
    before = spark.sql(last).first()
    _append(spark, copy)
    spark.catalog.refreshByPath(copy)
    refresh_views(spark, views)
    after = spark.sql(last).first()
    assert after.d == 20011215 and after.n > before.n
    fresh = led.stock_ledger(bind_driver_tables(spark, copy))
    assert after.n == fresh.count()
    assert spark.sql("SELECT count(*) FROM vw_fraud_risk_score").first()[0] == wh.distributors.count()


def test_promotions_that_came_later_show_up(spark, copy, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("promo") / "promotions")
    wh = bind_driver_tables(spark, copy)
    wh.promotions.write.parquet(path)
    view = "promotions_live"
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS SELECT * FROM parquet.`{path}`")
    wh.promotions = spark.table(view)
    more = wh.promotions.withColumn("promotion_id", F.lit("PROMO777")).withColumn("sku_id", F.lit("ECONOMY"))
    assert lk.promo_windows(wh, DRIVER.leakage).select("promotion_id").distinct().count() == 1
    more.write.mode("append").parquet(path)
    wh.promotions = spark.table(view)
    assert {r[0] for r in lk.promo_windows(wh, DRIVER.leakage).select("promotion_id").distinct().collect()} == {"PROMO001", "PROMO777"}


def test_building_a_query_starts_no_job(spark):
    from stockgap.plans.registry import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no action")
    for key in ("ledger", "spine", "leakage", "promo_window_rows", "dump_day", "risk_score", "pair_series", "drop_size_buckets", "dq_range"):
        QUERIES[key](spark, SF)
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_of_the_promotion_window_do_not_grow_with_promotions(spark, copy):
    from stockgap.sources.promotions import promotions_frame

    def probes(n):
        rows = [(f"P{i}", "x", "PROMO", dt.date(1998, 1, 1) + dt.timedelta(days=i), dt.date(1998, 1, 10) + dt.timedelta(days=i), 10) for i in range(n)]
        wh = bind_driver_tables(spark, copy)
        wh.promotions = promotions_frame(spark, rows)
        daily = lk.promoted_daily(wh).count()
        pairs = lk.promo_pairs(wh).count()
        assert lk.promo_stats(wh, DRIVER.leakage).count() == pairs
        return daily, pairs
    one, fifty = probes(1), probes(50)
    assert one[0] == fifty[0] and fifty[1] == 50 * one[1]  # daily rows once, probes per promotion
