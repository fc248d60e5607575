"""End to end on the planted-anomaly fixture, reference parameters."""

import datetime as dt
import os
from dataclasses import replace
from fractions import Fraction

from fixtures import BULK_DAYS, MILD_DAY, PROMO_END, STUFF_DAYS

from stockgap import params as P
from stockgap.operators import leakage as lk
from stockgap.operators import ledger as led
from stockgap.operators import quality as dq
from stockgap.operators import reports as rp
from stockgap.operators import risk as rk
from stockgap.operators import route as rt
from stockgap.operators import stuffing as stf

REF = P.REFERENCE


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_ledger_is_dense_and_consistent(planted):
    sanity = led.ledger_sanity(planted).collect()[0]
    assert sanity.recon_rows == 181 * 6 * 2 == sanity.expected_rows
    assert sanity.distributors == 6 and sanity.skus == 2 and sanity.is_complete
    checks = {r.check_name: r.violations for r in dq.dq_ledger_identity(planted, led.ledger_runs(planted)).collect()}
    negative = led.negative_stock(planted).count()      # D04 sells what never arrived
    assert checks.pop("ledger closing >= 0") == negative > 0
    assert set(checks.values()) == {0}


def test_ledger_values(planted):
    led_rows = led.stock_ledger(planted).filter("distributor_id = 'D05' AND sku_id = 'SKU001'")
    by_day = {r.date_id: r for r in led_rows.collect()}
    # hoarding: 16 promo days of +200 net from a flat stock
    assert by_day[20230425].closing_units == 16 * 200
    assert by_day[20230426].opening_units == 3200
    assert by_day[20230426].secondary_units == 600
    idle = led.stock_ledger(planted).filter("distributor_id = 'D06'")
    assert idle.count() == 181 * 2
    assert idle.filter("opening_units <> 0 OR closing_units <> 0").count() == 0


def test_negative_stock_exposes_falsifier(planted):
    neg = led.negative_stock(planted)
    assert {r.distributor_id for r in neg.select("distributor_id").distinct().collect()} == {"D04", "D05"}


def test_stuffing_flags(planted):
    got = rows(stf.channel_stuffing(planted, REF.stuffing), "distributor_id", "spike_date")
    want = sorted([("D02", d) for d in STUFF_DAYS] + [("D03", MILD_DAY)])
    assert got == want
    mild = stf.channel_stuffing(planted, REF.stuffing).filter("distributor_id = 'D03'").collect()[0]
    assert mild.trail_28d_avg == 600 and mild.spike_ratio == 4.0 and mild.primary_units == 2400


def test_stuffing_dense_equals_sparse(planted):
    for p in (REF.stuffing, replace(REF.stuffing, min_trail=Fraction(0)),
              replace(REF.stuffing, ratio=Fraction(3, 2), min_trail=Fraction(600))):
        dense = rows(stf.stuffing_flags(planted, p, "dense"), "distributor_id", "full_date",
                     "trail_days", "trail_primary_sum")
        if p.min_trail > 0:
            sparse = rows(stf.stuffing_flags(planted, p, "sparse"), "distributor_id", "full_date",
                          "trail_days", "trail_primary_sum")
            assert dense == sparse


def test_leakage(planted):
    out = {r.distributor_id: r for r in lk.promotion_leakage(planted, REF.leakage).collect()}
    assert set(out) == {"D01", "D02", "D03", "D04", "D05", "D06"}
    h = out["D05"]
    assert h.verdict == P.LEAK_VERDICT
    assert (h.baseline_daily_units, h.promo_daily_units, h.post_promo_units) == (200.0, 0.0, 600.0)
    assert h.stock_at_promo_end == 3200
    assert all(out[d].verdict == P.OK_VERDICT for d in out if d != "D05")
    assert out["D06"].baseline_daily_units == 0.0


def test_dump_day(planted):
    got = lk.dump_day(planted, REF.leakage).collect()
    assert [(r.distributor_id, r.sku_id, r.resumed_selling_on, r.units_sold_that_day)
            for r in got] == [("D05", "SKU001", PROMO_END + dt.timedelta(days=1), 600)]


def test_route(planted):
    out = {r.distributor_id: r for r in rt.route_falsification(planted, REF.route).collect()}
    assert "D06" not in out                      # no deliveries: no drop statistics
    f = out["D04"]
    assert f.bulk_dumps == len(BULK_DAYS) and f.kiranas_hit_by_dumps == 1
    assert f.max_drop_units == 150 and f.verdict == P.ROUTE_FALSIFIED
    assert out["D01"].verdict == P.OK_VERDICT and out["D01"].max_drop_z_score is None
    total = 181 * 600 + 1500
    assert f.bulk_volume_pct == round(100 * 1500 / total, 1)


def test_risk_reference_share_quirk(planted):
    # K1: the reference compares a percentage with 0.20, so any bulk share counts
    r = {x.distributor_id: x for x in rk.risk_score(planted, REF).collect()}
    assert (r["D02"].stuffing_flags, r["D02"].stuffing_pts, r["D02"].risk_tier) == (6, 40, "HIGH")
    assert (r["D03"].risk_score, r["D03"].risk_tier) == (10, "MEDIUM")
    assert (r["D04"].route_pts, r["D04"].risk_tier) == (30, "HIGH")
    assert (r["D05"].promo_pts, r["D05"].risk_score, r["D05"].risk_tier) == (30, 30, "HIGH")
    assert (r["D01"].risk_score, r["D06"].risk_score) == (0, 0)
    assert r["D06"].risk_tier == "CLEAN" and r["D06"].bulk_volume_pct == 0.0
    k = rk.risk_kpis(rk.risk_score(planted, REF)).collect()[0]
    assert (k.distributors, k.high_risk, k.stuffing, k.dumps) == (6, 3, 7, 10)


def test_risk_share_as_percent(planted):
    p = replace(REF, risk=replace(REF.risk, route_share_pct=Fraction(20)))
    r = {x.distributor_id: x for x in rk.risk_score(planted, p).collect()}
    assert (r["D04"].route_pts, r["D04"].risk_tier) == (12, "MEDIUM")


def test_risk_top(planted):
    top = rk.risk_top(rk.risk_score(planted, REF), 3).collect()
    assert [x.distributor_id for x in top] == ["D02", "D04", "D05"]


def test_reports(planted):
    s = rp.distributor_series(planted, REF).collect()
    assert len(s) == 181 and max(x.primary_units for x in s) == 6000   # D02 picked
    ps = rp.pair_series(planted, REF).collect()
    assert ps[0].full_date == dt.date(2023, 3, 20) and ps[-1].full_date == dt.date(2023, 5, 31)
    assert all(x.secondary_units == 0 for x in ps if dt.date(2023, 4, 10) <= x.full_date <= PROMO_END)
    b = {(x.bucket, x.cohort): x.drop_count for x in rp.drop_size_buckets(planted, REF).collect()}
    assert b[("101-150", "D04 (falsifier)")] == 10
    piv = rp.drop_size_pivot(planted.calendar.sparkSession, planted, REF).collect()
    assert [x.bucket for x in piv] == rp.bucket_labels(P.REFERENCE_BUCKET_EDGES)
    assert {x.bucket: x.falsifier_drops for x in piv}["101-150"] == 10
    assert {x.bucket: x.other_drops for x in piv}["300+"] == 0
    ov = rp.spike_overlay(planted, REF).filter("distributor_id = 'D01'").collect()
    first = min(ov, key=lambda x: x.full_date)
    assert first.trail_mean is None and first.flagged       # K7: day one flags


def test_quality_jobs(planted):
    dup = dq.duplicate_keys(planted.raw["fact_primary_sales"], ["primary_order_id"], "p").collect()[0]
    assert (dup.duplicate_keys, dup.excess_rows) == (0, 0)
    orph = dq.orphans(planted.raw["fact_secondary_sales"], "kirana_id",
                      planted.raw["dim_kirana"], "kirana_id", "k").collect()[0]
    assert orph.orphan_keys == 0
    bad = dq.violations(planted.raw["fact_secondary_sales"], [(planted.raw["fact_secondary_sales"]
                        .qty_units <= 100, "drop <= 100")]).collect()[0]
    assert bad.violations == len(BULK_DAYS)
    nulls = dq.null_counts(planted.raw["dim_product"], "dim_product", ["sku_id", "mrp"]).collect()
    assert {r.column_name: r.null_count for r in nulls} == {"sku_id": 0, "mrp": 0}


def test_sql_views(spark, planted):
    from stockgap.plans.views import register_views
    names = register_views(spark, planted, REF)
    assert "vw_fraud_risk_score" in names
    top = spark.sql("SELECT distributor_id, risk_score FROM vw_fraud_risk_score "
                    "ORDER BY risk_score DESC, distributor_id LIMIT 2").collect()
    assert [(r.distributor_id, r.risk_score) for r in top] == [("D02", 40), ("D04", 30)]
    n = spark.sql("SELECT COUNT(*) AS n FROM fact_stock_reconciliation").collect()[0].n
    assert n == 181 * 6 * 2


def test_reference_quality(planted):
    q = dq.reference_quality(planted)
    assert {r.check_name: r.duplicate_keys for r in q["duplicate_keys"].collect()}[
        "fact_primary_sales(primary_order_id)"] == 0
    orph = {r.check_name: r.orphan_rows for r in q["orphans"].collect()}
    assert len(orph) == 9 and set(orph.values()) == {0}        # 2 of 11 need dim_sales_rep
    assert {r.violations for r in q["range"].collect()} == {0}
    assert {r.null_count for r in q["null_counts"].collect()} == {0}


def test_cli(tmp_path, planted):
    import subprocess
    import sys
    from fixtures import write_planted_csvs
    folder = tmp_path / "csv"
    folder.mkdir()
    write_planted_csvs(str(folder))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "stockgap", "--csv", str(folder), "--local", "2",
                          "risk", "--top", "3"], cwd=root, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "D02" in out.stdout and "HIGH" in out.stdout


def test_cli_rebuild_check_and_subjects(spark, tmp_path, monkeypatch, capsys):
    from fixtures import write_planted_csvs

    from stockgap import __main__ as cli
    folder = tmp_path / "csv"
    folder.mkdir()
    write_planted_csvs(str(folder))
    cli.main(["--csv", f"file://{folder}", "rebuild", "--out", str(tmp_path / "all")])
    runs = spark.read.parquet(str(tmp_path / "all" / "ledger"))
    assert led.ledger_from_runs(runs).count() == 181 * 6 * 2
    assert spark.read.parquet(str(tmp_path / "all" / "fact_secondary_sales")).count() > 0
    cli.main(["--csv", str(folder), "check", "--ledger", str(tmp_path / "all" / "ledger")])
    assert "ledger closing >= 0" in capsys.readouterr().out
    cli.main(["--csv", str(folder), "export", "--out", str(tmp_path / "csv-out"), "--stuffer", "D03", "--dumper", "D05",
              "--hoarder", "D01", "SKU001", "--from", "2023-02-01", "--to", "2023-02-10"])
    read = lambda name: spark.read.option("header", True).csv(str(tmp_path / "csv-out" / name)).collect()
    assert len(read("pair_series")) == 10 and len(read("distributor_series")) == 181
    assert {r.cohort for r in read("drop_size_buckets")} == {"D05 (falsifier)", "All other distributors"}


def test_active_scope_is_full_ledger_of_pairs_that_moved(planted):
    full = led.stock_ledger(planted).filter("distributor_id <> 'D06'")
    active = led.stock_ledger(planted, scope="active")
    assert active.count() == 181 * 5 * 2
    assert active.exceptAll(full).count() == 0 and full.exceptAll(active).count() == 0


def test_detectors_over_stored_ledger(spark, planted, tmp_path):
    from stockgap.sources.stored import with_stored_ledger
    path = str(tmp_path / "ledger")
    led.materialize_ledger(planted, path, layout="month")
    stored = with_stored_ledger(planted, spark.read.parquet(path))
    for job in (lambda w: stf.channel_stuffing(w, REF.stuffing),
                lambda w: lk.promotion_leakage(w, REF.leakage),
                lambda w: lk.dump_day(w, REF.leakage),
                lambda w: rk.risk_score(w, REF)):
        a, b = job(planted), job(stored)
        assert sorted(a.collect()) == sorted(b.collect())
    assert led.stock_ledger(stored).exceptAll(led.stock_ledger(planted)).count() == 0


def test_leakage_parts(planted):
    leaked = lk.leaked_pairs(planted, REF.leakage).collect()
    assert [(r.distributor_id, r.sku_id, r.promo_end) for r in leaked] == [("D05", "SKU001", PROMO_END)]
    prev = {r.full_date: r for r in lk.prev_day_units(planted, REF.leakage).collect()}
    assert len(prev) == 181 and prev[dt.date(2023, 1, 1)].prev_day_units is None
    day = prev[PROMO_END + dt.timedelta(days=1)]
    assert (day.prev_day_units, day.secondary_units) == (0, 600)
    rows = lk.promo_window_rows(planted, REF.leakage).filter("distributor_id = 'D05'").collect()
    by = {r.promo_window: 0 for r in rows}
    for r in rows:
        by[r.promo_window] += 1
    assert by == {"baseline": 14, "promo": 16, "post": 15}
    end = [r for r in rows if r.full_date == PROMO_END][0]
    assert end.closing_units == 3200
    stock = {r.distributor_id: r.stock_at_promo_end
             for r in lk.stock_at_promo_end(planted, REF.leakage).collect()}
    assert stock["D05"] == 3200 and stock["D06"] == 0
    cal = lk.promo_calendar(planted, REF.leakage).collect()[0]
    assert (cal.baseline_days, cal.promo_days, cal.post_days) == (14, 16, 15)


def test_ledger_runs_round_trip(spark, planted, tmp_path):
    runs = led.ledger_runs(planted)
    dense = led.stock_ledger(planted)
    back = led.ledger_from_runs(runs)
    assert back.exceptAll(dense).count() == 0 and dense.exceptAll(back).count() == 0
    # idle D06 is one run per SKU covering the whole calendar
    idle = runs.filter("distributor_id = 'D06'").collect()
    assert len(idle) == 2 and all((r.from_date, r.to_date) == (dt.date(2023, 1, 1),
                                                              dt.date(2023, 6, 30)) for r in idle)
    path = str(tmp_path / "runs")
    led.materialize_ledger(planted, path, layout="runs")
    stored = led.ledger_from_runs(spark.read.parquet(path))
    assert stored.exceptAll(dense).count() == 0 and stored.count() == dense.count()


def test_ledger_checks_runs_and_dense_agree(planted):
    from pyspark.sql import functions as F
    dense = led.stock_ledger(planted)
    a = sorted(tuple(r) for r in dq.dq_ledger_identity(planted, led.ledger_runs(planted)).collect())
    b = sorted(tuple(r) for r in dq.dq_ledger_identity(planted, dense).collect())
    assert a == b
    assert sorted(led.ledger_sanity(planted).collect()) == sorted(
        led.ledger_sanity(planted, dense).collect())
    assert led.negative_stock(planted).exceptAll(led.negative_stock(planted, dense)).count() == 0
    # a stored ledger with one corrupted closing balance fails both checks once
    bad = dense.withColumn("closing_units", F.when(
        (F.col("distributor_id") == "D01") & (F.col("sku_id") == "SKU001")
        & (F.col("date_id") == 20230301), F.col("closing_units") + 1)
        .otherwise(F.col("closing_units")))
    got = {r.check_name: r.violations for r in dq.dq_ledger_identity(planted, bad).collect()}
    assert got["ledger closing = opening + primary - secondary"] == 1
    assert got["ledger opening = previous closing"] == 1
