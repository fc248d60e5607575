"""Results and plan shapes of the steps that were too large at size."""

from __future__ import annotations

import datetime as dt
import io
from contextlib import redirect_stdout
from dataclasses import replace

from pyspark.sql import functions as F

from stockgap.operators import ledger as led
from stockgap.operators import route
from stockgap.operators.densify import densify
from stockgap.operators.leakage import promo_stats
from stockgap.params import REFERENCE, RouteParams
from stockgap.plans import registry
from stockgap.sources.snapshots import _broken_keys
from stockgap.sources.stored import stored_promo_stats


def plan(df) -> str:
    with redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_promotions_meet_stored_runs_without_a_shuffle_of_the_pairs(spark, planted, tmp_path):
    sku = planted.products.first().sku_id
    lo, hi = planted.span().first()
    starts = [lo - dt.timedelta(days=d) for d in (60, 31, 16, 3)] + [lo + dt.timedelta(days=d) for d in (0, 9, 40, 41)] + [
        hi - dt.timedelta(days=d) for d in (20, 2, 0)] + [hi + dt.timedelta(days=d) for d in (5, 40)]
    promos = spark.createDataFrame([(f"P{i}-{n}", "x", sku, a, a + dt.timedelta(days=n), 10) for i, a in enumerate(starts) for n in (0, 15)],
                                   planted.promotions.schema)
    wh = replace(planted, promotions=promos)
    led.materialize_ledger(wh, f"{tmp_path}/runs")
    got = stored_promo_stats(wh, spark.read.parquet(f"{tmp_path}/runs"), REFERENCE.leakage)
    want = promo_stats(wh, REFERENCE.leakage)
    cols = [c for c in got.columns if c in want.columns]
    of = lambda df: sorted(map(tuple, df.where("_window_days > 0").select(*cols).collect()), key=str)
    assert of(got) == of(want) and len(cols) >= 10
    assert "hashpartitioning(promotion_id" not in plan(got)
    moved = stored_promo_stats(wh, spark.read.parquet(f"{tmp_path}/runs"), REFERENCE.leakage, moved_only=True)
    assert of(moved) == [r for r in of(got) if r[cols.index("baseline_units")] > 0]


def test_month_layout_deals_runs_and_not_days(spark, planted):
    runs = led.ledger_runs(planted)
    got = led.spread_by_month(runs, 2)
    want = led.stock_ledger(planted)
    assert sorted(map(tuple, got.drop("month").collect())) == sorted(map(tuple, want.collect()))
    assert got.where(F.col("month") != F.floor(F.col("date_id") / 100)).isEmpty()
    text = plan(got)
    assert text.index("BroadcastHashJoin") < text.index("hashpartitioning(month")  # the join makes the days


def test_month_layout_keeps_its_files(spark, planted, tmp_path):
    led.materialize_ledger(planted, f"{tmp_path}/m", layout="month", files_per_month=1)
    rows = spark.read.parquet(f"{tmp_path}/m").select("month", F.input_file_name().alias("f"))
    files = rows.groupBy("month").agg(F.count_distinct("f").alias("n"))
    assert {r.n for r in files.collect()} == {1}


def test_repeated_keys_are_counted_whole(spark):
    rows = [(1, d) for d in (20230101, 20230102, -1, -64, -65, 63, 64)] + [(2, 20230101), (2, 20230101), (2, 20230102), (3, None), (4, None), (4, None), (None, 5), (None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "k int, d int")
    assert _broken_keys(df, ["k", "d"]) == {"unique (k, d)": 6}
    assert _broken_keys(df.distinct(), ["k", "d"]) == {}
    assert _broken_keys(df, ["d"]) == {"unique (d)": 10}


def test_store_bitmaps_are_small(spark, planted):
    rows = [("A", 150, 10**9 * i - 3, dt.date(2023, 1, 5)) for i in range(50)]
    wh = replace(planted, drops=spark.createDataFrame(rows, "distributor_id string, qty_units bigint, kirana_id bigint, full_date date"))
    maps = route.store_bitmaps(wh, RouteParams())
    assert maps.schema["stores"].dataType.simpleString() == "bigint"
    assert route.bulk_stores_of(maps, 202301, 202301).collect()[0].kiranas_hit_by_dumps == 50


def test_days_of_a_stored_ledger_are_made_by_evenly_dealt_tasks(spark, planted, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "_wh", lambda spark, sf_dir: planted)
    got = registry.QUERIES["ledger_stored"](spark, "")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert got.rdd.getNumPartitions() == n > 1  # a scan of the small files alone is one task
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, led.stock_ledger(planted).collect()))
    lines = plan(got).splitlines()
    days = next(i for i, s in enumerate(lines) if "Generate explode(sequence(from_date" in s)
    assert not any("Exchange" in s for s in lines[:days]) and any("hashpartitioning(distributor_id" in s for s in lines[days:])


def test_ledger_takes_its_range_from_the_rows_it_shuffles(spark, planted):
    wh = replace(planted, calendar_spans_facts=True)
    runs = led.ledger_runs(wh)
    runs.collect()
    lines = runs._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("ReusedExchange" in s and "_kind" in s for s in lines)  # the bounds read it again: the facts are not rolled up twice


def test_range_of_the_rows_themselves(spark):
    day = lambda n: dt.date(2024, 1, n)
    rows = [("a", day(3), 5), ("a", day(5), 2), ("b", day(7), 1), ("orphan", day(2), 9)]
    keys = [("a",), ("a",), ("b",), ("quiet",)]  # a key that comes twice
    sparse = spark.createDataFrame(rows, "k string, full_date date, v long")
    anchors = spark.createDataFrame(keys, "k string")

    def of(sparse, lo, hi):
        df = densify(sparse, ["k"], ["v"], lo, hi, anchors=anchors, opening=("open", F.col("v")), in_range=True)
        return sorted(map(tuple, df.collect()))

    got = of(sparse, None, None)
    assert got == of(sparse, F.lit(day(2)), F.lit(day(7)))
    assert len(got) == 3 * 6 and {r[0] for r in got} == {"a", "b", "quiet"}
    assert ("a", day(7), 0, 7) in got and ("quiet", day(2), 0, 0) in got
    assert of(sparse.where("false"), None, None) == []
    # a movement without a day: as with bounds of which the first is unknown
    undated = sparse.union(spark.createDataFrame([("a", None, 100)], sparse.schema))
    assert of(undated, None, None) == of(undated, F.lit(None).cast("date"), F.lit(day(7)))
