"""Joins of days and ranges by bins against plain comparisons."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stockgap.operators import intervals
from stockgap.operators.ledger import materialize_ledger
from stockgap.operators.leakage import promotion_leakage
from stockgap.params import REFERENCE
from stockgap.sources.stored import stored_promo_stats

DAY0 = dt.date(1969, 11, 1)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def _runs(rng, n, longest):
    out = []
    for i in range(n):
        a = rng.randrange(0, 3000)
        out.append((i, rng.choice("ab"), day(a), day(a + rng.choice([0, 0, 1, 15, 16, 17, 100, longest, -1]))))
    return out


def test_days_in_ranges_against_plain_comparisons(spark):
    rng = random.Random(1)
    points = [(i, rng.choice("abc"), day(rng.randrange(0, 3000))) for i in range(400)] + [(900, "a", None), (901, None, day(5))]
    spans = _runs(rng, 60, 400) + [(900, "a", None, day(4)), (901, None, day(0), day(9))]
    p = spark.createDataFrame(points, "i int, k string, d date")
    s = spark.createDataFrame(spans, "j int, k string, lo date, hi date")
    for width in (1, 7, 16, 5000):
        got = intervals.days_in_ranges(p, s, ["k"], "d", "lo", "hi", width).select("i", "j").collect()
        want = sorted((i, j) for i, k, d in points for j, q, lo, hi in spans if d and lo and k and k == q and lo <= d <= hi)
        assert sorted(map(tuple, got)) == want


def test_overlapping_against_plain_comparisons(spark):
    rng = random.Random(2)
    runs, spans = _runs(rng, 200, 2900), _runs(rng, 60, 400)
    r = spark.createDataFrame(runs, "i int, k string, a date, b date")
    s = spark.createDataFrame(spans, "j int, k string, lo date, hi date")
    want = sorted((i, j) for i, k, a, b in runs for j, q, lo, hi in spans if k == q and a <= b and lo <= hi and a <= hi and lo <= b)
    for levels in (intervals.LEVELS, (4, 5), (0, 3, 20)):
        got = intervals.overlapping(r, s, ["k"], ("a", "b"), ("lo", "hi"), levels).select("i", "j").collect()
        assert sorted(map(tuple, got)) == want


def test_ten_thousand_promotions_on_one_sku(spark):
    """Rows made are in proportion to matches: pairs proposed by the bins, against all pairs of the SKU."""
    runs = spark.range(4000).select(F.lit("s").alias("sku_id"), F.date_add(F.lit(DAY0), (F.col("id") % 2500).cast("int")).alias("from_date")).withColumn(
        "to_date", F.date_add("from_date", (F.xxhash64("from_date") % 3 + 3).cast("int")))
    ranges = spark.range(10_000).select(F.col("id").alias("promotion_id"), F.lit("s").alias("sku_id"),
                                        F.date_add(F.lit(DAY0), (F.col("id") / 4).cast("int")).alias("lo")).withColumn("hi", F.date_add("lo", 45))
    matches = intervals.overlapping(runs, ranges, ["sku_id"], ("from_date", "to_date"), ("lo", "hi")).count()
    points = intervals.days_in_ranges(runs, ranges, ["sku_id"], "from_date", "lo", "hi").count()
    # the same joins without their conditions: what the bins propose
    wide = ranges.withColumn("_bin", intervals._bins("lo", "hi", 16))
    proposed = runs.withColumn("_bin", intervals._bin("from_date", 16)).join(wide, ["sku_id", "_bin"]).count()
    assert points <= proposed < 2 * points and proposed < 4000 * 10_000 / 25
    assert matches == runs.join(ranges, (F.col("to_date") >= F.col("lo")) & (F.col("from_date") <= F.col("hi"))).count()


def test_month_ledger_is_read_only_where_promotions_are(spark, tmp_path, planted):
    materialize_ledger(planted, f"{tmp_path}/m", layout="month", files_per_month=1)
    stored = spark.read.parquet(f"{tmp_path}/m")
    job = lambda t: promotion_leakage(planted, REFERENCE.leakage, stats=stored_promo_stats(planted, t, REFERENCE.leakage))
    assert "dynamicpruning" in job(stored)._jdf.queryExecution().executedPlan().toString()
    want = sorted(promotion_leakage(planted, REFERENCE.leakage).collect())
    for month in ("202301", "202302", "202306"):    # the promotion's range is 27 March to 10 May
        for f in (tmp_path / "m" / f"month={month}").iterdir():
            f.write_bytes(b"not a parquet file")
    assert sorted(job(stored).collect()) == want
