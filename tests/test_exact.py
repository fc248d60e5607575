"""Exact means, rounding and moments."""

from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from stockgap.functions import exact as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).collect()[0].v


def test_round_ratio_half_away_from_zero(spark):
    assert one(spark, X.round_ratio(F.lit(5), F.lit(2))) == 3        # 2.5 -> 3
    assert one(spark, X.round_ratio(F.lit(7), F.lit(2), 1)) == 3.5
    assert one(spark, X.round_ratio(F.lit(1), F.lit(20), 1)) == 0.1  # 0.05 -> 0.1
    assert one(spark, X.round_ratio(F.lit(1), F.lit(3), 1)) == 0.3
    assert one(spark, X.round_ratio(F.lit(2), F.lit(3))) == 1
    assert one(spark, X.round_ratio(F.lit(1), F.lit(0))) is None


def test_mean_thresholds_are_exact(spark):
    # 0.1 * 3 / 1 in floating point is 0.30000000000000004; exact compare is not fooled
    assert one(spark, X.mean_le_k_mean(F.lit(3), F.lit(10), F.lit(3), F.lit(1), Fraction(1, 10)))
    assert one(spark, X.mean_ge(F.lit(1000), F.lit(2), Fraction(500)))
    assert not one(spark, X.mean_ge(F.lit(999), F.lit(2), Fraction(500)))
    assert one(spark, X.mean_ge(F.lit(5), F.lit(0), Fraction(1))) is None
    assert one(spark, X.value_ge_k_mean(F.lit(2400), F.lit(16800), F.lit(28), Fraction(4)))


def test_sample_stddev_matches_numpy(spark):
    xs = [5, 10, 20, 20, 150, 7]
    n, s1, s2 = len(xs), sum(xs), sum(x * x for x in xs)
    got = one(spark, X.round_sqrt_ratio(F.lit(n * s2 - s1 * s1), F.lit(n * (n - 1)), 1))
    assert got == round(float(np.std(xs, ddof=1)), 1)
    assert one(spark, X.round_sqrt_ratio(F.lit(5), F.lit(0), 1)) is None


def test_sqrt_rounding_ties_go_up(spark):
    # sqrt(9/400) = 0.15 exactly: rounds to 0.2 as in exact decimal arithmetic
    assert one(spark, X.round_sqrt_ratio(F.lit(9), F.lit(400), 1)) == 0.2
    assert one(spark, X.round_sqrt_ratio(F.lit(1), F.lit(400), 1)) == 0.1


def _exact(num, den):
    """sqrt(num / den) to one digit, half up, in Python integers."""
    from math import isqrt
    return ((isqrt(400 * num // den) + 1) // 2) / 10.0


def test_deviation_and_zscore_at_every_size(spark):
    from decimal import Decimal

    from stockgap.operators.route import _with_stats
    rows = []
    for n in (2, 10**6, 10**6 + 1, 10**9, 10**12):
        for mx, mean, var in ((50, 10, 200), (5000, 2500, 5000), (5000, 1, 1), (50, 49, 2), (7, 7, 0)):
            s1 = n * mean
            s2 = (n - 1) * var + n * mean * mean
            rows.append((f"{n}-{mx}-{mean}", n, s1, s2, mx, 0, 0))
    # ties: n = 4, z^2 and var at k + 1/2 tenths
    rows += [("tie", 400, 400 * 10, 400 * 100 + 399 * 9, 11, 0, 0)]
    df = spark.createDataFrame([(*r[:3], Decimal(r[3]), *r[4:]) for r in rows],
                               "distributor_id string, total_drops bigint, _s1 bigint, _s2 decimal(38,0),"
                               " max_drop_units bigint, bulk_dumps bigint, _bulk_s bigint")
    got = {r.distributor_id: r for r in _with_stats(df).collect()}
    for d, n, s1, s2, mx, *_ in rows:
        num, a = n * s2 - s1 * s1, n * mx - s1
        assert got[d].std_drop_units == _exact(num, n * (n - 1)), d
        want = _exact(a * a * (n - 1), n * num) if num else None
        assert got[d].max_drop_z_score == want, d


def test_zscore_ties_go_up_at_every_size(spark):
    from decimal import Decimal

    from stockgap.operators.route import _with_stats
    # A = 3n and num = 4 n (n-1) give z^2 = 9/4 ... a spread of values around ties
    rows = []
    for n in (4, 10**6, 10**6 + 4, 10**12):
        num = 400 * (n - 1) * n
        s1 = n * 1000 - 3 * n  # z = 3/20 = 0.15 exactly
        rows.append((str(n), n, s1, Decimal((num + s1 * s1) // n), 1000, 0, 0))
        num = 4 * (n - 1) * n  # z = 3/2
        s1 = n * 1000 - 3 * n
        rows.append((f"b{n}", n, s1, Decimal((num + s1 * s1) // n), 1000, 0, 0))
    df = spark.createDataFrame(rows, "distributor_id string, total_drops bigint, _s1 bigint, _s2 decimal(38,0),"
                               " max_drop_units bigint, bulk_dumps bigint, _bulk_s bigint")
    got = {r.distributor_id: r.max_drop_z_score for r in _with_stats(df).collect()}
    assert all(got[str(n)] == 0.2 for n in (4, 10**6, 10**6 + 4, 10**12))
    for d, n, s1, s2, mx, *_ in rows:
        s2 = int(s2)
        num, a = n * s2 - s1 * s1, n * mx - s1
        assert got[d] == _exact(a * a * (n - 1), n * num), d


def test_negative_ratios_round_away_from_zero(spark):
    assert one(spark, X.round_ratio(F.lit(-15), F.lit(10))) == -2
    assert one(spark, X.round_ratio(F.lit(-25), F.lit(100), 1)) == -0.3
    assert one(spark, X.round_ratio(F.lit(-1), F.lit(3), 1)) == -0.3


def test_squares_of_large_sums_do_not_overflow(spark):
    from dataclasses import replace

    from stockgap.operators.route import drop_moments
    from stockgap.sources.warehouse import Warehouse
    df = spark.createDataFrame([("A", 2_000_000_000)] * 5, "distributor_id string, qty_units bigint")
    wh = Warehouse(*[df] * 7)
    assert int(drop_moments(replace(wh, drop_sizes=df)).first()["_s2"]) == 5 * 2_000_000_000**2
