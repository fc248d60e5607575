"""Densify against a brute-force dense ledger on a hand-sized input."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stockgap.operators.densify import densify

D0 = dt.date(2024, 1, 1)


def brute(events, keys, lo, hi):
    out = {}
    for k in keys:
        bal = 0
        d = lo
        while d <= hi:
            p, s = events.get((k, d), (0, 0))
            out[(k, d)] = (p, s, bal)
            bal += p - s
            d += dt.timedelta(days=1)
    return out


def test_densify_matches_brute_force(spark):
    rnd = random.Random(7)
    lo, hi = D0 + dt.timedelta(days=3), D0 + dt.timedelta(days=40)
    keys = ["a", "b", "c", "quiet"]
    events = {}
    for k in ["a", "b", "c", "orphan"]:
        for _ in range(12):
            d = D0 + dt.timedelta(days=rnd.randint(0, 45))   # some before lo / after hi
            events[(k, d)] = (rnd.randint(0, 9), rnd.randint(0, 9))
    events[("a", lo)] = (5, 1)                                # first day has movement
    sparse = spark.createDataFrame(
        [(k, d, p, s) for (k, d), (p, s) in events.items()],
        "k string, full_date date, primary_units bigint, secondary_units bigint")
    anchors = spark.createDataFrame([(k,) for k in keys], "k string")
    dense = densify(sparse, ["k"], ["primary_units", "secondary_units"], F.lit(lo), F.lit(hi),
                    anchors=anchors,
                    opening=("opening", F.col("primary_units") - F.col("secondary_units")))
    got = {(r.k, r.full_date): (r.primary_units, r.secondary_units, r.opening)
           for r in dense.collect()}
    in_range = {key: v for key, v in events.items() if lo <= key[1] <= hi and key[0] != "orphan"}
    assert got == brute(in_range, keys, lo, hi)


def test_densify_with_history(spark):
    lo, hi = D0 + dt.timedelta(days=10), D0 + dt.timedelta(days=12)
    sparse = spark.createDataFrame(
        [("a", D0, 7, 0), ("a", D0 + dt.timedelta(days=9), 0, 2), ("a", hi, 1, 0)],
        "k string, full_date date, primary_units bigint, secondary_units bigint")
    anchors = spark.createDataFrame([("a",)], "k string")
    dense = densify(sparse, ["k"], ["primary_units", "secondary_units"], F.lit(lo), F.lit(hi),
                    anchors=anchors, history_from=F.lit(D0),
                    opening=("opening", F.col("primary_units") - F.col("secondary_units")))
    got = sorted((r.full_date, r.primary_units, r.opening) for r in dense.collect())
    assert got == [(lo, 0, 5), (lo + dt.timedelta(days=1), 0, 5), (hi, 1, 5)]
