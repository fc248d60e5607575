"""Property tests: densify and exact rounding against plain Python."""

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockgap.functions.exact import round_ratio
from stockgap.operators.densify import densify

D0 = dt.date(2024, 2, 20)          # spans a month end and a leap day
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

movement = st.tuples(st.sampled_from(["a", "b", "c", "orphan"]), st.integers(0, 20),
                     st.integers(-3, 9), st.integers(0, 9))


@SETTINGS
@given(st.lists(movement, max_size=25), st.integers(0, 5), st.integers(5, 15))
def test_densify_equals_dense_ledger(spark, rows, lo_off, span):
    lo = D0 + dt.timedelta(days=lo_off)
    hi = lo + dt.timedelta(days=span)
    events = {}
    for k, off, p, s in rows:                 # one row per key-day, as after a roll-up
        d = D0 + dt.timedelta(days=off)
        ep, es = events.get((k, d), (0, 0))
        events[(k, d)] = (ep + p, es + s)
    sparse = spark.createDataFrame(
        [(k, d, p, s) for (k, d), (p, s) in events.items()],
        "k string, full_date date, primary_units bigint, secondary_units bigint")
    keys = ["a", "b", "c", "never"]
    anchors = spark.createDataFrame([(k,) for k in keys], "k string")
    dense = densify(sparse, ["k"], ["primary_units", "secondary_units"], F.lit(lo), F.lit(hi),
                    anchors=anchors,
                    opening=("opening", F.col("primary_units") - F.col("secondary_units")))
    got = {(r.k, r.full_date): (r.primary_units, r.secondary_units, r.opening)
           for r in dense.collect()}
    want = {}
    for k in keys:
        bal, d = 0, lo
        while d <= hi:
            p, s = events.get((k, d), (0, 0))
            want[(k, d)] = (p, s, bal)
            bal += p - s
            d += dt.timedelta(days=1)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**6)), min_size=1,
                max_size=20))
def test_round_ratio_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.select(round_ratio(F.col("n"), F.col("d")).alias("r0"),
                    round_ratio(F.col("n"), F.col("d"), 1).alias("r1")).collect()
    for (n, d), r in zip(pairs, got):
        q = Fraction(n, d)
        assert r.r0 == int(q + Fraction(1, 2))
        assert r.r1 == int(q * 10 + Fraction(1, 2)) / 10.0


def _exact_round_sqrt(num, den):
    """round(sqrt(num/den), 1) half up, in integers: the largest k with
    (2k-1)^2 <= 400 num / den."""
    from math import isqrt
    return ((isqrt(400 * num // den) + 1) // 2) / 10.0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**15), st.integers(1, 10**9)), min_size=1,
                max_size=20))
def test_round_sqrt_ratio_exact(spark, pairs):
    from stockgap.functions.exact import round_sqrt_ratio
    ties = [(9, 400), (1, 400), (225, 10000), (2025, 40000), (3 * 3 * 17, 400 * 17), (0, 5)]
    rows = pairs + ties
    df = spark.createDataFrame(rows, "n bigint, d bigint")
    got = df.select(round_sqrt_ratio(F.col("n"), F.col("d"), 1).alias("r")).collect()
    for (n, d), r in zip(rows, got):
        assert r.r == _exact_round_sqrt(n, d), (n, d)
