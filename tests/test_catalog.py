"""Views of the session's catalog and mergeable store counts."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stockgap.operators import route
from stockgap.operators.risk import risk_score
from stockgap.params import DRIVER, REFERENCE, RouteParams, StuffingParams
from stockgap.plans import catalog
from stockgap.plans.registry import STRICT
from stockgap.sources.bindings import DRIVER_PROMOTIONS, bind_driver_tables

SF = "/root/testdata/sf0.001"


def test_views_outlive_the_session_and_take_thresholds(spark, tmp_path):
    names = catalog.install(spark, SF, str(tmp_path / "db"), DRIVER_PROMOTIONS, {"driver": DRIVER, "strict": STRICT}, db="risk_db")
    assert "risk_db.vw_fraud_risk_score" in names
    wh, other = bind_driver_tables(spark, SF), spark.newSession()
    for p, text in ((DRIVER, "vw_fraud_risk_score"), (STRICT, "vw_fraud_risk_scores WHERE threshold_set = 'strict'")):
        got = other.sql(f"SELECT distributor_id, risk_score, risk_tier, bulk_volume_pct, stuffing_flags FROM risk_db.{text}").collect()
        want = risk_score(wh, p).select("distributor_id", "risk_score", "risk_tier", "bulk_volume_pct", "stuffing_flags").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {r.risk_score for r in catalog.risk_under(spark, "driver", "risk_db").collect()} != {
        r.risk_score for r in catalog.risk_under(spark, "strict", "risk_db").collect()}
    # installed again with other thresholds, the same name gives other scores; a condition on the set reaches the thresholds
    catalog.install(spark, SF, str(tmp_path / "db"), DRIVER_PROMOTIONS, {"reference": REFERENCE}, db="risk_db")
    assert other.sql("SELECT * FROM risk_db.vw_fraud_risk_score").count() == 10
    with pytest.raises(ValueError, match="min_trail"):
        catalog.install(spark, SF, str(tmp_path / "db"), DRIVER_PROMOTIONS, {"x": replace(DRIVER, stuffing=StuffingParams(min_trail=0))})


def test_bitmaps_of_months_merge_to_the_direct_count(spark, planted):
    rows = [(d, 150, k, day) for d, k, day in [("A", 0, dt.date(2023, 1, 5)), ("A", 1, dt.date(2023, 1, 9)), ("A", 1, dt.date(2023, 2, 1)), ("A", 32768, dt.date(2023, 2, 2)),
            ("A", 32769, dt.date(2023, 3, 2)), ("A", -7, dt.date(2023, 3, 2)), ("A", 10**12, dt.date(2023, 3, 3)), ("B", 5, dt.date(2023, 1, 1)), ("C", None, dt.date(2023, 2, 1))]]
    rows.append(("B", 99, 6, dt.date(2023, 1, 1)))
    wh = replace(planted, drops=spark.createDataFrame(rows, "distributor_id string, qty_units bigint, kirana_id bigint, full_date date"))
    maps = route.store_bitmaps(wh, RouteParams())
    for first, last in ((202301, 202301), (202301, 202302), (202302, 202303), (202301, 202312), (202401, 202412)):
        of = replace(wh, drops=wh.drops.where((F.year("full_date") * 100 + F.month("full_date")).between(first, last)))
        assert sorted(route.bulk_stores_of(maps, first, last).collect()) == sorted(route.bulk_stores(of, RouteParams()).collect())
    with pytest.raises(TypeError):
        route.store_bitmaps(planted, RouteParams())
