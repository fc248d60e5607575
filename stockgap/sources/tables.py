"""Parquet scans of the driver tables (one file or folder per table).

The columns this engine uses are declared, so opening a table reads no file
footer on the driver and every scan is pruned to those columns by
construction.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")

_L, _I, _S, _D = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


# Columns of the driver tables read by this engine.
DRIVER_SCHEMAS = {
    "lineitem": _st(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                    ("l_linenumber", _I), ("l_quantity", _D), ("l_linestatus", _S),
                    ("l_shipdate", T.TimestampNTZType())),
    "orders": _st(("o_orderkey", _L), ("o_custkey", _L)),
    "part": _st(("p_partkey", _L), ("p_type", _S), ("p_size", _I)),
    "supplier": _st(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I)),
    "customer": _st(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I)),
    "nation": _st(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "region": _st(("r_regionkey", _I), ("r_name", _S)),
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; later ``select``/``filter`` calls prune and push down."""
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


class LazyTables(Mapping):
    """Name -> DataFrame, each opened on first use and then kept."""

    def __init__(self, names, opener: Callable[[str], DataFrame]):
        self._names, self._open, self._cache = tuple(names), opener, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = self._open(name)
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)
