"""Tables that are replaced in one step, whole or by partition.

A table is a folder with Parquet files under ``data/`` and a manifest per
version under ``manifests/``.  A write puts its files into a folder of its own
and then creates the manifest, which names for every partition the folder that
holds it: new ones for the partitions written, the earlier version's for those
kept.  Files of an earlier version are never touched, so

* a write that fails, at any point, leaves the earlier version as it was;
* a reader resolves the newest manifest once and sees one version, whole;
* of two writers from the same version the second fails (the manifest's
  name is created exclusively), and the first one's version stands.

Versions no longer wanted are removed by :meth:`SnapshotTable.expire`.

A write can carry the table's constraints.  CHECKs and NOT NULLs are counted by
``DataFrame.observe`` in the very job that writes; keys and references are
looked up in the written files.  If one is broken, the version is not committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Files


class ConstraintError(ValueError):
    """A load broke constraints; ``broken`` counts the rows by constraint."""

    def __init__(self, table: str, broken: Mapping[str, int]):
        self.broken = dict(broken)
        super().__init__(f"{table}: " + "; ".join(f"{name}: {n} rows" for name, n in broken.items()))


class ConflictError(RuntimeError):
    """Another writer committed a version in the meantime."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [int(n.removesuffix(".json")) for n in self.files.names("manifests") if self._load(n) is not None]

    def _load(self, name: str) -> dict | None:
        """A manifest, or None if its writer died while writing it."""
        try:
            found = json.loads(self.files.read(f"manifests/{name}"))
        except ValueError:
            return None
        return found if found.get("complete") else None

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version (default: the newest committed one)."""
        names = self.files.names("manifests")
        if version is not None:
            names = [n for n in names if int(n.removesuffix(".json")) == version]
        for n in reversed(names):
            if (found := self._load(n)) is not None:
                return found
        return None

    def info(self) -> dict:
        """What the newest version's writer noted."""
        return (self.manifest() or {}).get("info", {})

    def read(self, version: int | None = None) -> DataFrame:
        found = self.manifest(version)
        if found is None:
            raise FileNotFoundError(f"{self.files.uri()}: no {'version' if version is None else f'version {version}'}")
        return self._scan(T.StructType.fromJson(found["schema"]), list(found["folders"].values()))

    def _scan(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        return (self.spark.read.schema(full).option("basePath", self.files.uri("data"))
                .parquet(*[self.files.uri(f"data/{f}") for f in folders]).select(*schema.names))

    def write(self, df: DataFrame, partition_by: str | None = None, keep: Callable[[str], bool] | None = None,
              info: Mapping | None = None, checks: Mapping[str, Column] | None = None, keys: Sequence[str] = (),
              references: Mapping[str, tuple[str, DataFrame, str]] | None = None, conf: Mapping | None = None) -> int:
        """Write and commit a new version; its number.

        partition_by  one column, a folder per value
        keep          which partitions of the newest version stay (by value, as
                      text) unless ``df`` has them; default: none
        checks        name -> condition on a row (NULL passes, as in SQL)
        keys          columns that identify a row of ``df``
        references    name -> (column, parent table, its key): non-null values must be there
        """
        last = self.manifest()
        number = max([last["version"] if last else 0, *[int(n.split("-")[0].removeprefix("version=")) for n in self.files.names("data")],
                      *[int(n.removesuffix(".json")) for n in self.files.names("manifests")]]) + 1
        folder = f"version={number}-{uuid.uuid4().hex[:8]}"
        try:
            broken = self._write_files(df, folder, partition_by, checks or {})
            written = {n: f"{folder}/{n}" for n in self.files.names(f"data/{folder}", folders=True)} if partition_by else {"": folder}
            schema = T.StructType([*[f for f in df.schema if f.name != partition_by], *[f for f in df.schema if f.name == partition_by]])
            new = self._scan(schema, list(written.values()))
            broken |= _broken_keys(new, keys) | _broken_references(new, references or {})
            if broken:
                raise ConstraintError(self.files.uri(), broken)
        except Exception:
            self.files.delete(f"data/{folder}")
            raise
        kept = {n: f for n, f in (last["folders"] if last else {}).items()
                if keep is not None and n and n not in written and keep(n.split("=", 1)[1])}
        self._commit({"version": number, "schema": json.loads(schema.json()), "partition_by": partition_by,
                      "folders": dict(sorted({**kept, **written}.items())), "info": dict(info or {}), "complete": True},
                     last["version"] if last else 0)
        return number

    def _write_files(self, df: DataFrame, folder: str, partition_by: str | None, checks: Mapping[str, Column]) -> dict[str, int]:
        seen = Observation()
        counts = [F.count_if(~F.coalesce(ok, F.lit(True))).alias(f"c{i}") for i, ok in enumerate(checks.values())]
        out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write
        (out.partitionBy(partition_by) if partition_by else out).parquet(self.files.uri(f"data/{folder}"))
        found = seen.get
        return {name: found[f"c{i}"] for i, name in enumerate(checks) if found.get(f"c{i}")}

    def _commit(self, manifest: dict, based_on: int) -> None:
        now = self.manifest()
        if (now["version"] if now else 0) != based_on:
            self.files.delete(f"data/{_own(manifest)}")
            raise ConflictError(f"{self.files.uri()}: version {now['version']} was committed meanwhile")
        try:
            self.files.write_new(f"manifests/{manifest['version']:012d}.json", json.dumps(manifest))
        except FileExistsError as e:
            raise ConflictError(f"{self.files.uri()}: version {manifest['version']} was committed meanwhile") from e

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the newest ``keep`` versions, the files that no
        remaining one names, and what failed writes left; the versions removed.

        Manifests go first, so no new reader finds a version that is going.
        Files of a write under way carry a higher number than the newest
        version and stay."""
        names = self.files.names("manifests")
        whole = [n for n in names if self._load(n) is not None]
        stay = whole[-keep:] if keep else whole[-1:]
        if not stay:
            return []
        gone = [n for n in names if n < stay[-1] and n not in stay]
        held = {f for n in stay for f in self._load(n)["folders"].values()}
        for n in gone:
            self.files.delete(f"manifests/{n}")
        newest = int(stay[-1].removesuffix(".json"))
        for folder in self.files.names("data", folders=True):
            if int(folder.split("-")[0].removeprefix("version=")) > newest or folder in held:
                continue
            parts = [f"{folder}/{n}" for n in self.files.names(f"data/{folder}", folders=True)]
            if not held.intersection(parts):
                self.files.delete(f"data/{folder}")
            else:
                for p in parts:
                    if p not in held:
                        self.files.delete(f"data/{p}")
        return [int(n.removesuffix(".json")) for n in gone if n in whole]


def _own(manifest: dict) -> str:
    """The data folder that a manifest's own write made."""
    own = f"version={manifest['version']}-"
    return next(f.split("/")[0] for f in manifest["folders"].values() if f.startswith(own))


def _broken_keys(df: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Rows that share their key with another one.

    Where the last column is whole, groups of 64 values of it are counted
    first, as the bits of one number: neighbouring rows melt before the exchange
    (a ledger's days of a month into one or two).  Only groups with more rows
    than bits are then counted by the whole key."""
    if not keys:
        return {}
    used = df.select(*keys)
    if isinstance(df.schema[keys[-1]].dataType, T.IntegralType):
        last = F.col(keys[-1]).cast("bigint")
        of = [*keys[:-1], "_of"]
        used = used.withColumn("_of", F.shiftright(last, 6))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(last, F.lit(64)).cast("int"))
        more = used.groupBy(*of).agg(F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits")).where(
            F.col("n") > F.coalesce(F.bit_count("bits"), F.lit(0))).select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(of)])
        if more.isEmpty():
            return {}
        same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(of)]
        used = used.join(more, reduce(Column.__and__, same), "left_semi").select(*keys)
    twice = used.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    n = twice.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return {f"unique ({', '.join(keys)})": n} if n else {}


def _broken_references(df: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]) -> dict[str, int]:
    out = {}
    for name, (column, parent, key) in references.items():
        used = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
        n = used.join(parent.select(F.col(key).alias("_k")).distinct(), "_k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if n:
            out[name] = n
    return out
