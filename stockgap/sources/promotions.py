"""The promotion calendar seed (literal rows, like an INSERT ... VALUES)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DIM_PROMOTION


def promotions_frame(spark: SparkSession, rows) -> DataFrame:
    """Literal rows inlined into the plan: Spark knows their exact (tiny)
    size, so joins broadcast them without a hint."""
    fields = DIM_PROMOTION.fields
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)])
               for r in rows]
    if not structs:
        return spark.createDataFrame([], DIM_PROMOTION)
    return spark.range(1).select(F.inline(F.array(*structs)))
