"""Helpers shared by the operators: table reads, lineage cuts, text columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a folder of our own, only for local sessions that name none
_LOCAL: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset on a local session (tests): one temporary folder per process.
    Unset on a cluster: an error, since a machine-local folder would be
    invisible to the other executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="stockgap-llm-"))
    return _LOCAL[0]


def _own_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/stockgap-llm/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession) -> str:
    """The path of a new folder in the shared one, under this application's."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> None:
    """Remove every table this application has staged.  Call it when the
    results that were read from them have been written: a DataFrame that still
    depends on one fails afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    Cuts the lineage: whatever follows reads files that outlive any executor.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def own_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (Spark compares
    them without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


TEXT_BATCH = 1024


def text_batches(df: DataFrame, rows: int = TEXT_BATCH) -> DataFrame:
    """``df``, after lowering the session's Arrow batches to ``rows`` rows if
    they are larger: texts go to Python a few MB at a time, also long ones."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a stream of batches sorted by ``keys``, whole, one by one
    (for groups of bounded size)."""
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        key = b[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()]
        for i, j in zip(cuts, cuts[1:]):
            yield b.iloc[i:j]
        rest = b.iloc[cuts[-1]:]
    if rest is not None and len(rest):
        yield rest
