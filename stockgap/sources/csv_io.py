"""CSV load by column position, CSV export.

The reference's loads map CSV columns to table columns by position and skip
the header (its date CSV names the first column ``date``, the table
``full_date``).  ``enforceSchema=True`` applies the declared schema by
position and ignores header names, which is exactly that.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Files


def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header skipped, columns by position, declared types; CR LF, ``True``/
    ``False`` booleans and ISO dates parse; a blank file gives zero rows."""
    return (spark.read.option("header", True).option("enforceSchema", True)
            .option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd")
            .schema(schema).csv(path))


class RejectedError(ValueError):
    """A load had more rejects than allowed; ``rejects`` are those found."""

    def __init__(self, path: str, n: int, limit: int, rejects: DataFrame):
        self.rejects = rejects
        super().__init__(f"{path}: {n} lines rejected, at most {limit} allowed")


@dataclass
class CsvLoad:
    """What :func:`load_csv_checked` read: typed ``rows``, and ``rejects``
    (file, line, reason, text)."""
    rows: DataFrame
    rejects: DataFrame


def load_csv_checked(spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None) -> CsvLoad:
    """S1 with quarantine: lines that fit the schema become rows, all others
    rejects with their file, line number and reason: not as many values as
    columns, a value that is none of its column's type (the column is named), or
    no value in a NOT NULL column.

    ``limit``  RejectedError if more lines are rejected (0: any)

    Files are read line by line, in parallel and split like any text, so a
    quoted value must not hold a line end.  Each file's first line is its
    header; blank lines are skipped.  Line numbers come from counting the
    lines of each split, a row per split; only the rejects' lines meet them.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    splits = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    # a file's header is the first line of its first split
    heads = splits.where("before = 0").select(F.col("first").alias("id"))
    text = lines.where(F.trim(F.regexp_replace("value", "\r", "")) != "").join(heads, "id", "left_anti").withColumn(
        "value", F.regexp_replace("value", "\r$", ""))
    cells = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField("_bad", T.StringType())])
    raw = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = text.select("value", "file", "block", "id", raw.alias("c"))

    def typed(f: T.StructField):
        cell = F.trim(F.col(f"c.`{f.name}`")) if not isinstance(f.dataType, T.StringType) else F.col(f"c.`{f.name}`")
        return cell if isinstance(f.dataType, T.StringType) else F.try_to_date(cell, "yyyy-MM-dd") if isinstance(f.dataType, T.DateType) else cell.try_cast(f.dataType)

    given = {f.name: F.coalesce(F.col(f"c.`{f.name}`"), F.lit("")) != "" for f in schema}
    wrong = [F.when(F.col("c._bad").isNotNull(), F.lit(f"not {len(schema)} values"))]
    wrong += [F.when(given[f.name] & typed(f).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")) for f in schema]
    wrong += [F.when(~given[f.name], F.lit(f"{f.name} is missing")) for f in schema if not f.nullable]
    judged = parsed.withColumn("reason", F.coalesce(*wrong))
    # in PERMISSIVE mode an empty value is null; it stays null in columns that may be
    rows = judged.where("reason IS NULL").select(*[F.when(given[f.name], typed(f)).alias(f.name) for f in schema])
    rejects = judged.where("reason IS NOT NULL").join(splits, ["file", "block"]).select(
        "file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "reason", F.col("value").alias("text"))
    if limit is not None and (n := rejects.count()) > limit:
        raise RejectedError(path, n, limit, rejects)
    return CsvLoad(rows, rejects)


def export_csv_file(df: DataFrame, path: str) -> None:
    """One CSV file of exactly that name, with a header, in ``df``'s order.

    The parts are written in parallel, each in its place of the order, and
    joined by the file system, stream to stream; the file appears under its
    name at the end, in place of an earlier one.  Nothing is coalesced, so an
    ``orderBy`` of many partitions stays parallel.
    """
    folder, name = path.rstrip("/").rsplit("/", 1)
    files, parts = Files(df.sparkSession, folder), f"_{name}-{uuid.uuid4().hex}"
    quoted = [c if c.replace("_", "").isalnum() else '"' + c.replace('"', '""') + '"' for c in df.columns]
    try:
        df.write.option("header", False).option("escape", '"').csv(files.uri(parts))
        found = sorted((n for n in files.names(parts) if n.startswith("part-")), key=lambda n: int(n.split("-")[1]))
        files.join([f"{parts}/{n}" for n in found], f"{parts}/joined", ",".join(quoted) + "\n")
        files.replace(f"{parts}/joined", name)
    finally:
        files.delete(parts)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header, replacing earlier output (idempotent rebuild).

    ``single_file`` coalesces to one partition: only for small extracts
    (a ranked list, a series); big outputs stay partitioned.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                only_present: bool = False) -> None:
    """Materialize a result as parquet, replacing the previous build
    whole; nothing of it stays.  ``only_present`` replaces the partitions that
    ``df`` has and leaves the others (a rebuild of some months)."""
    mode = "dynamic" if only_present else "static"
    w = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
