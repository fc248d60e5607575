"""Edge cases of FIXTURES.md section 4 on small literal inputs."""

import datetime as dt
from dataclasses import replace
from fractions import Fraction

import pytest
from fixtures import MILD_DAY as MILD

from stockgap import params as P
from stockgap.operators import reports as rp
from stockgap.operators import risk as rk
from stockgap.operators import route as rt
from stockgap.operators import stuffing as stf

REF = P.REFERENCE


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame(
        [(f"X{i}", f"x{i}", "R") for i in range(10)],
        "distributor_id string, distributor_name string, region string")


def _score(spark, dims, stuffing, leaks, route, p=REF):
    st = spark.createDataFrame(stuffing, "distributor_id string, spike_days bigint")
    pl = spark.createDataFrame(leaks, "distributor_id string, leaked_skus bigint")
    ro = spark.createDataFrame(route, "distributor_id string, bulk_dumps bigint, "
                                      "total_units bigint, bulk_units bigint")
    return {r.distributor_id: r for r in rk.score(dims, st, pl, ro, p).collect()}


def test_points_and_tiers(spark, dims):
    out = _score(spark, dims,
                 stuffing=[("X1", 1), ("X2", 4), ("X3", 7), ("X6", 3), ("X7", 4)],
                 leaks=[("X4", 2), ("X6", 1), ("X7", 1)],
                 route=[("X5", 5, 100000, 1), ("X7", 9, 1000, 500), ("X8", 0, 0, 0)],
                 p=replace(REF, risk=replace(REF.risk, route_share_pct=Fraction(20))))
    got = {k: (v.stuffing_pts, v.promo_pts, v.route_pts, v.risk_score, v.risk_tier)
           for k, v in out.items()}
    assert got["X0"] == (0, 0, 0, 0, "CLEAN")
    assert got["X1"] == (10, 0, 0, 10, "MEDIUM")
    assert got["X2"] == (40, 0, 0, 40, "HIGH")
    assert got["X3"] == (40, 0, 0, 40, "HIGH")            # cap at 40
    assert got["X4"] == (0, 30, 0, 30, "HIGH")
    assert got["X5"] == (0, 0, 12, 12, "MEDIUM")          # repeated dumps, tiny share
    assert got["X6"] == (30, 30, 0, 60, "CRITICAL")       # exactly 60
    assert got["X7"] == (40, 30, 30, 100, "CRITICAL")     # share 50 % >= 20
    assert got["X8"] == (0, 0, 0, 0, "CLEAN")             # all-zero deliveries: no error
    assert out["X8"].bulk_volume_pct == 0.0


def test_high_boundary_at_25(spark, dims):
    p = replace(REF, risk=replace(REF.risk, points_per_spike=25, stuffing_cap=40))
    out = _score(spark, dims, stuffing=[("X1", 1)], leaks=[], route=[], p=p)
    assert (out["X1"].risk_score, out["X1"].risk_tier) == (25, "HIGH")


@pytest.mark.parametrize("pct,threshold,points", [
    ("0.1", Fraction(1, 5), 0), ("0.2", Fraction(1, 5), 30), ("5", Fraction(1, 5), 30),
    ("5", Fraction(20), 0), ("20", Fraction(20), 30), ("19.9", Fraction(20), 0)])
def test_share_thresholds(spark, dims, pct, threshold, points):
    bulk = int(Fraction(pct) * 1000)                      # of 100000 units
    p = replace(REF, risk=replace(REF.risk, route_share_pct=threshold))
    out = _score(spark, dims, [], [], [("X1", 1, 100000, bulk)], p)
    assert out["X1"].route_pts == points


def test_drop_statistics_edges(spark, planted):
    drops = spark.createDataFrame(
        [("A", 5, "k1")] + [("B", q, f"k{q}") for q in (0, 100, 301, 20)] +
        [("Z", 0, "k"), ("Z", 0, "k")],
        "distributor_id string, qty_units bigint, kirana_id string")
    names = spark.createDataFrame([(x, x, "R") for x in "ABZ"],
                                  "distributor_id string, distributor_name string, region string")
    wh = replace(planted, drops=drops, drop_sizes=drops.select("distributor_id", "qty_units"),
                 distributors=names)
    r = {x.distributor_id: x for x in rt.route_falsification(wh, REF.route).collect()}
    assert r["A"].max_drop_z_score is None and r["A"].total_drops == 1   # one delivery
    assert r["B"].bulk_dumps == 2 and r["B"].kiranas_hit_by_dumps == 2   # 100 counts
    assert r["B"].verdict == P.ROUTE_SUSPECT
    assert r["Z"].bulk_volume_pct is None                                # 0 units in total
    b = {(x.bucket, x.cohort): x.drop_count for x in rp.drop_size_buckets(wh, REF).collect()}
    assert b[("1-20", "B (falsifier)")] == 2                             # 0 and 20
    assert b[("61-100", "B (falsifier)")] == 1                           # exactly 100
    assert b[("300+", "B (falsifier)")] == 1


def test_trailing_mean_at_floor(planted):
    at = replace(REF.stuffing, min_trail=Fraction(600))
    above = replace(REF.stuffing, min_trail=Fraction(601))
    got_at = {(r.distributor_id, r.full_date) for r in stf.stuffing_flags(planted, at).collect()}
    got_above = {(r.distributor_id, r.full_date)
                 for r in stf.stuffing_flags(planted, above).collect()}
    assert ("D03", MILD) in got_at and ("D03", MILD) not in got_above
    assert len(got_at) == 7
    # above the floor only Feb 28 stays: its window holds the Jan 31 spike
    assert got_above == {("D02", dt.date(2023, 2, 28))}


def test_zero_trailing_mean_gives_null_ratio(planted):
    p = replace(REF.stuffing, min_trail=Fraction(0))
    idle = stf.channel_stuffing(planted, p).filter("distributor_id = 'D06'").collect()
    assert len(idle) == 6                                  # every month end
    assert all(r.spike_ratio is None and r.trail_28d_avg == 0 for r in idle)

