"""Write a run-length ledger as dense rows, a folder a month, by Arrow columns.

Spark's parquet writer takes a row at a time, which for days x pairs rows costs
many times the work that made them.  Here runs are dealt and sorted by the file
they go to; a task makes the days of some hundred thousand rows at once, as
columns, and writes those.  No day passes through Spark.

The files are written into a folder beside the table, which then takes its
place in one step; only files that a finished task names are part of it.
Functions that run in tasks are shipped by value, so executors need numpy and
pyarrow but not this package.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOVED = ("primary_units", "secondary_units")
BALANCES = ("opening_units", "closing_units")
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: dense rows of a row group, and of what a task holds
GROUP = 1 << 19


def dealt_by_month(runs: DataFrame, keys: Sequence[str], files_per_month: int) -> DataFrame:
    """A row per run and month it touches (``_month``, months since year 0),
    dealt by month and bucket of keys, sorted by them, by key and by day.

    The order is one number (month and bucket, 27 bits of the keys' hash, day of
    the month): Spark sorts by a single number without comparing rows."""
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = lambda d: F.year(d) * 12 + F.month(d) - 1
    month, hashed = F.col("_month"), F.xxhash64(*keys)
    bucket = F.pmod(hashed, F.lit(files_per_month))
    day = F.when(month == number("from_date"), F.dayofmonth("from_date")).otherwise(F.lit(0))
    order = (month.cast("bigint") * files_per_month + bucket) * (1 << 32) + F.shiftrightunsigned(hashed, 37) * 32 + day
    cut = runs.where(F.col("from_date") <= F.col("to_date")).select(
        *keys, "from_date", "to_date", "opening_units", *MOVED, "closing_units",
        F.explode(F.sequence(number("from_date"), number("to_date"))).alias("_month"))
    return cut.repartition(n, "_month", bucket).sortWithinPartitions(order)


def dense(month: int, t: pa.Table, keys: Sequence[str]) -> pa.Table:
    """The ledger's rows of ``month`` (months since year 0) for the runs ``t``."""
    first = (np.datetime64(month - 1970 * 12, "M")).astype("datetime64[D]").astype(int)
    end = (np.datetime64(month - 1970 * 12 + 1, "M")).astype("datetime64[D]").astype(int)
    col = {c: t[c].combine_chunks() for c in t.column_names}
    since = col["from_date"].cast(pa.int32()).to_numpy()
    start = np.maximum(since, first)
    days = np.minimum(col["to_date"].cast(pa.int32()).to_numpy(), end - 1) - start + 1
    rows, stops = len(days), np.cumsum(days, dtype=np.int64)
    at = np.repeat(np.arange(rows, dtype=np.int32), days)
    key = (month // 12 * 10000 + (month % 12 + 1) * 100 + 1 + start - first - (stops - days)).astype(np.int64)
    date_id = (key[at] + np.arange(len(at))).astype(np.int32)
    # the rows of a run's own day: they open at its opening balance and carry its movements
    moves = (stops - days)[since >= first]
    opening, moved = at + np.int32(rows), np.full(len(at), rows, np.int32)
    opening[moves], moved[moves] = at[moves], at[moves]

    def key_column(a: pa.Array) -> pa.Array:
        text = pa.types.is_string(a.type) or pa.types.is_large_string(a.type)
        return (a.dictionary_encode() if text else a).take(pa.array(at))

    out = {"date_id": pa.array(date_id), **{k: key_column(col[k]) for k in keys}}
    out["opening_units"] = pa.concat_arrays([col["opening_units"], col["closing_units"]]).take(pa.array(opening))
    for c in MOVED:
        out[c] = pa.concat_arrays([col[c], pa.array([0], col[c].type)]).take(pa.array(moved))
    out["closing_units"] = col["closing_units"].take(pa.array(at))
    return pa.table(out)


def file_writer(folder: str, keys: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task: batches of :func:`dealt_by_month` become files, one a month; their names."""
    keys = list(keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, names = uuid.uuid4().hex, []
        now, out, held, rows = None, None, [], 0

        def flush() -> None:
            nonlocal out, held, rows
            if not held:
                return
            t = dense(now, pa.Table.from_batches(held), keys)
            held, rows = [], 0
            if out is None:
                at = f"month={now // 12 * 100 + now % 12 + 1}"
                names.append(f"{at}/part-{attempt}.snappy.parquet")
                os.makedirs(f"{folder}/{at}", exist_ok=True)
                # balances rarely repeat beyond a run: a dictionary of them only fills up
                out = pq.ParquetWriter(f"{folder}/{names[-1]}", t.schema, store_schema=False, compression="snappy",
                                       use_dictionary=[c for c in t.column_names if c not in BALANCES])
            out.write_table(t, row_group_size=2 * GROUP)

        def close() -> None:
            nonlocal out
            flush()
            if out is not None:
                out.close()
                out = None

        for b in batches:
            months = b.column(b.schema.get_field_index("_month")).to_numpy()
            cuts = [0, *(np.flatnonzero(months[1:] != months[:-1]) + 1).tolist(), len(months)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if months[i] != now:
                    close()
                    now = int(months[i])
                # a run has 31 days in a month at most
                for k in range(i, j, GROUP // 31):
                    part = b.slice(k, min(GROUP // 31, j - k))
                    held.append(part)
                    rows += 31 * len(part)
                    if rows >= GROUP:
                        flush()
        close()
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    return write


@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """Arrow batches bounded by their rows alone, where the session bounds those.

    For the bound of bytes Spark adds up the sizes of all columns at every row,
    which takes longer than all else it does to hand over a row of numbers."""
    bounded, before = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 0, spark.conf.get(BATCH_BYTES, None)
    if bounded:
        spark.conf.set(BATCH_BYTES, str((1 << 31) - 1))
    try:
        yield
    finally:
        if bounded and before is None:
            spark.conf.unset(BATCH_BYTES)
        elif bounded:
            spark.conf.set(BATCH_BYTES, before)


def write_months(runs: DataFrame, path: str, keys: Sequence[str], files_per_month: int) -> bool:
    """Write the dense ledger of ``runs`` by month to ``path`` in place of what
    is there, at most ``files_per_month`` files a month; False, and nothing
    done, if ``path`` is not on a file system that tasks can open as files."""
    spark = runs.sparkSession
    parent, name = os.path.split(path.rstrip("/"))
    files, new = Files(spark, parent or "."), f"_{name}-{uuid.uuid4().hex}"
    folder = files.local(new)
    if folder is None:
        return False
    try:
        files.write_new(f"{new}/_SUCCESS", "")
        with batches_by_rows(spark):
            got = dealt_by_month(runs, keys, files_per_month).mapInArrow(file_writer(folder, keys), "name string").collect()
        named = {r.name for r in got}
        for month in files.names(new, folders=True):  # what attempts left that did not finish
            for left in {f"{month}/{f}" for f in files.names(f"{new}/{month}")} - named:
                files.delete(f"{new}/{left}")
        files.replace(new, name)
    finally:
        files.delete(new)
    spark.catalog.refreshByPath(path)
    return True
