"""Key sets: every row of one dimension paired with every row of another.

One plan for every size: a grid equi-join.  Rows of either side are dealt to
``GRID`` buckets and copied to all buckets of the other side, so each of the
``GRID * GRID`` cells joins a share of one with a share of the other; no cell
holds a whole side.  A side that Spark measures to be small is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID = 16


def attach_all(large: DataFrame, small: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every row of ``large`` with every row of ``small[cols]``."""
    cols = list(cols)
    share = lambda names: F.pmod(F.xxhash64(*names), F.lit(GRID)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(GRID - 1)))
    a = large.select("*", share(large.columns).alias("_a")).select("*", every.alias("_b"))
    b = small.select(*cols).select("*", share(cols).alias("_b")).select("*", every.alias("_a"))
    return a.join(b, ["_a", "_b"]).select(*large.columns, *cols)
