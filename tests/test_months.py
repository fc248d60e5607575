"""The month layout written by Arrow columns."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stockgap.operators import ledger as led
from stockgap.sources import months
from stockgap.sources.files import Files

RUN = "distributor_id bigint, sku_id string, from_date date, to_date date, opening_units bigint, primary_units bigint, secondary_units bigint, closing_units bigint"


def files_of(path) -> list[str]:
    return [f"{at}/{f}" for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def days_of(df):
    return sorted(map(tuple, df.select("date_id", *led.PAIR, "opening_units", "primary_units", "secondary_units", "closing_units").collect()), key=str)


def test_days_are_written_as_columns(spark, planted, tmp_path):
    path = f"{tmp_path}/m"
    led.materialize_ledger(planted, path, layout="month", files_per_month=2)
    assert {pq.read_metadata(f).created_by.split()[0] for f in files_of(path)} == {"parquet-cpp-arrow"}  # not row by row by Spark's writer
    back = spark.read.parquet(path)
    assert days_of(back) == days_of(led.stock_ledger(planted))
    assert back.drop("month").dtypes == led.stock_ledger(planted).dtypes
    assert back.where(F.col("month") != F.floor(F.col("date_id") / 100)).isEmpty()
    assert {len([x for x in os.listdir(f"{path}/{m}")]) for m in os.listdir(path) if m[0] == "m"} <= {1, 2}


def test_runs_of_any_length_and_keys_without_value(spark, tmp_path, monkeypatch):
    d = dt.date
    rows = [(1, "a", d(1969, 11, 30), d(1972, 3, 1), 5, 7, None, 12), (1, "a", d(1972, 3, 2), d(1972, 3, 2), 12, 0, 2, 10),
            (1, "a", d(1972, 3, 3), d(1972, 3, 31), 10, 0, 1, 9), (None, "a", d(2000, 2, 28), d(2000, 3, 1), 0, 1, 0, 1), (2, None, d(2000, 2, 29), d(2000, 2, 29), 0, 0, 3, -3),
            (3, "", d(2001, 1, 1), d(2000, 12, 31), 1, 1, 1, 1), (4, "x", None, d(2000, 1, 1), 1, 1, 1, 1), (5, "x", d(2000, 1, 1), None, 1, 1, 1, 1),
            (6, "b", d(2000, 1, 31), d(2000, 2, 1), None, 4, 0, None)]
    runs = spark.createDataFrame(rows, RUN)
    want = days_of(led.spread_by_month(runs))
    assert len(want) == 823 + 1 + 29 + 3 + 1 + 2
    for group in (1 << 19, 40):  # also where a month takes many row groups
        monkeypatch.setattr(months, "GROUP", group)
        assert months.write_months(runs, f"{tmp_path}/m{group}", led.PAIR, 3)
        assert days_of(spark.read.parquet(f"{tmp_path}/m{group}")) == want


def test_a_pairs_days_lie_in_order(spark, planted, tmp_path):
    led.materialize_ledger(planted, f"{tmp_path}/m", layout="month", files_per_month=1)
    for f in files_of(f"{tmp_path}/m"):
        t = pq.ParquetFile(f).read().to_pandas()
        pair = t.distributor_id + t.sku_id
        assert (pair != pair.shift()).sum() == pair.nunique() and t.groupby(pair).date_id.apply(lambda x: x.is_monotonic_increasing).all()


def test_a_build_that_fails_leaves_the_earlier_one(spark, planted, tmp_path):
    path = f"{tmp_path}/m"
    led.materialize_ledger(planted, path, layout="month")
    broken = replace(planted, movements=planted.movements.withColumn(
        "primary_units", F.when(F.col("full_date") >= "2023-06-01", F.raise_error(F.lit("no such line"))).otherwise(F.col("primary_units")).cast("bigint")))
    with pytest.raises(Exception, match="no such line"):
        led.materialize_ledger(broken, path, layout="month")
    assert days_of(spark.read.parquet(path)) == days_of(led.stock_ledger(planted))
    assert os.listdir(tmp_path) == ["m"]


def test_files_of_attempts_that_did_not_finish_are_left_out(spark, planted, tmp_path, monkeypatch):
    def with_a_dead_attempt(folder, keys):
        write = writer(folder, keys)

        def task(batches):
            os.makedirs(f"{folder}/month=202301", exist_ok=True)
            pq.write_table(pa.table({"date_id": pa.array([20230101], pa.int32())}), f"{folder}/month=202301/part-dead{os.getpid()}.parquet")
            yield from write(batches)
        return task

    writer = months.file_writer
    monkeypatch.setattr(months, "file_writer", with_a_dead_attempt)
    led.materialize_ledger(planted, f"{tmp_path}/m", layout="month")
    assert files_of(f"{tmp_path}/m") and not [f for f in files_of(f"{tmp_path}/m") if "dead" in f]
    assert days_of(spark.read.parquet(f"{tmp_path}/m")) == days_of(led.stock_ledger(planted))


def test_other_file_systems_take_sparks_writer(spark, planted, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.months.link./at", f"file://{tmp_path}")
    assert Files(spark, str(tmp_path)).local("x") == f"{tmp_path}/x" and Files(spark, "viewfs://months/at").local("x") is None
    led.materialize_ledger(planted, "viewfs://months/at/m", layout="month", files_per_month=1)
    assert {pq.read_metadata(f).created_by.split()[0] for f in files_of(f"{tmp_path}/m")} == {"parquet-mr"}
    assert days_of(spark.read.parquet("viewfs://months/at/m")) == days_of(led.stock_ledger(planted))


def test_the_sessions_batches_stay_as_they_were(spark):
    was = spark.conf.get(months.BATCH_BYTES, None)
    with months.batches_by_rows(spark):
        assert spark.conf.get(months.BATCH_BYTES) == str((1 << 31) - 1)
    assert spark.conf.get(months.BATCH_BYTES, None) == was
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        spark.conf.set(months.BATCH_BYTES, "1000000")
        with pytest.raises(ValueError), months.batches_by_rows(spark):
            raise ValueError
        assert spark.conf.get(months.BATCH_BYTES) == "1000000"
        spark.conf.set(rows, "0")  # without a bound of rows that of bytes stays
        with months.batches_by_rows(spark):
            assert spark.conf.get(months.BATCH_BYTES) == "1000000"
    finally:
        spark.conf.unset(rows)
        spark.conf.unset(months.BATCH_BYTES) if was is None else spark.conf.set(months.BATCH_BYTES, was)
