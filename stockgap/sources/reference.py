"""Bind tables in the reference's own star-schema shapes to a Warehouse.

Input DataFrames follow :mod:`stockgap.schemas` (e.g. loaded with
:func:`stockgap.sources.csv_io.load_csv`): dim_date, dim_product,
dim_distributor, dim_promotion, fact_primary_sales, fact_secondary_sales.
Primary cases are converted to units with the product's ``units_per_case``
(the product dimension is joined by key; AQE broadcasts it when small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import date_from_key
from ..params import REFERENCE_PROMO
from .csv_io import load_csv, load_csv_checked
from .promotions import promotions_frame
from .warehouse import Warehouse

CSV_TABLES = {
    "dim_date": S.DIM_DATE,
    "dim_product": S.DIM_PRODUCT,
    "dim_sales_rep": S.DIM_SALES_REP,
    "dim_distributor": S.DIM_DISTRIBUTOR,
    "dim_kirana": S.DIM_KIRANA,
    "dim_promotion": S.DIM_PROMOTION,
    "fact_primary_sales": S.FACT_PRIMARY,
    "fact_secondary_sales": S.FACT_SECONDARY,
}
REQUIRED = ("dim_date", "dim_product", "dim_distributor", "fact_primary_sales", "fact_secondary_sales")


def load_reference_csvs(spark: SparkSession, folder: str, max_rejects: int | None = None) -> dict[str, DataFrame]:
    """Every ``<table>.csv`` in ``folder`` (a path or URI of any file system
    that Spark reads), by position and schema.  A table that the jobs need
    and the folder lacks is an error.

    ``max_rejects``: lines that do not fit their table are left out, up to so
    many a table (:func:`stockgap.sources.csv_io.load_csv_checked`); by default
    the first one ends the job."""
    out = {}
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    for name, schema in CSV_TABLES.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(base, f"{name}.csv")
        if fs.exists(path):
            out[name] = (load_csv(spark, path.toString(), schema) if max_rejects is None
                         else load_csv_checked(spark, path.toString(), schema, max_rejects).rows)
    missing = [n for n in REQUIRED if n not in out]
    if missing:
        raise FileNotFoundError(f"{folder}: no {', '.join(f'{n}.csv' for n in missing)}")
    return out


def bind_reference_tables(t: dict[str, DataFrame], promotions=(REFERENCE_PROMO,)) -> Warehouse:
    """The warehouse over star-schema tables.  Where there is no
    ``dim_promotion`` table, ``promotions`` (rows of its columns) seed it."""
    product = t["dim_product"]
    if "dim_promotion" not in t:
        t = {**t, "dim_promotion": promotions_frame(product.sparkSession, promotions)}
    prim = (t["fact_primary_sales"]
            .join(product.select("sku_id", "units_per_case"), "sku_id")
            .select(date_from_key(F.col("date_id")).alias("full_date"), "distributor_id",
                    "sku_id",
                    (F.col("qty_cases").cast("bigint") * F.col("units_per_case"))
                    .cast("bigint").alias("primary_units"),
                    F.lit(None).cast("bigint").alias("secondary_units")))
    sec_fact = t["fact_secondary_sales"]
    sec = sec_fact.select(date_from_key(F.col("date_id")).alias("full_date"), "distributor_id",
                          "sku_id", F.lit(None).cast("bigint").alias("primary_units"),
                          F.col("qty_units").cast("bigint").alias("secondary_units"))
    drops = sec_fact.select("distributor_id", F.col("qty_units").cast("bigint").alias("qty_units"),
                            "kirana_id", date_from_key(F.col("date_id")).alias("full_date"))
    return Warehouse(
        calendar=t["dim_date"].select("date_id", "full_date", "year", "month", "day",
                                      "is_month_end"),
        products=product, distributors=t["dim_distributor"],
        promotions=t["dim_promotion"], movements=prim.unionByName(sec),
        drop_sizes=drops.select("distributor_id", "qty_units"), drops=drops, raw=dict(t))
