"""Bind the TPC-H-shaped driver tables to the warehouse concepts.

=============  ==========================================================
calendar       every day from the first to the last movement
distributor    ``supplier`` (id ``s_suppkey``, name ``s_name``), rep =
               ``s_nationkey``, region = region name via nation
sku            ``p_type`` of ``part``; units per case = ``p_size``,
               applied per line because it varies inside a type
primary        ``lineitem`` lines with ``l_linestatus = 'F'``, quantity in
               cases
secondary      lines with ``l_linestatus = 'O'``, quantity in units
store          ``o_custkey`` of the line's order
promotion      a parameter row (see :data:`DRIVER_PROMOTIONS`)
=============  ==========================================================
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import calendar_between
from .promotions import promotions_frame
from .tables import LazyTables, read_table
from .warehouse import Warehouse

# One promotion on the PROMO product type, inside the driver data's span.
DRIVER_PROMOTIONS = (
    ("PROMO001", "Spring sale on PROMO lines", "PROMO",
     dt.date(1998, 4, 10), dt.date(1998, 4, 25), 20),
)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a line without a supplier belongs to no distributor
    return read_table(spark, sf_dir, "lineitem").where("l_suppkey is not null").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus",
        F.to_date("l_shipdate").alias("full_date"))


def bind_driver_tables(spark: SparkSession, sf_dir: str,
                       promotions=DRIVER_PROMOTIONS) -> Warehouse:
    lines = _lines(spark, sf_dir)
    # a line belongs to a SKU only through a part with a type
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("sku_id"), "p_size").where(F.col("sku_id").isNotNull())
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    orders = read_table(spark, sf_dir, "orders")

    # dimension keys are NOT NULL (primary keys in the reference)
    products = part.select("sku_id").distinct()
    supplier = supplier.where(F.col("s_suppkey").isNotNull())
    distributors = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(F.col("s_suppkey").alias("distributor_id"),
                F.col("s_name").alias("distributor_name"),
                F.col("s_nationkey").alias("rep_id"),
                F.col("r_name").alias("region")))

    # units are whole: a fraction ends the job instead of being cut off
    q = F.col("l_quantity")
    qty = F.when(q != F.floor(q), F.raise_error(F.lit("l_quantity is not whole"))).otherwise(q).cast("bigint")

    def sold(status: str) -> DataFrame:
        """Lines of one status whose part is known: movements and drops are
        the same lines."""
        of = lines.filter(F.col("l_linestatus").isin("F", "O") if status == "FO" else F.col("l_linestatus") == status)
        return of.join(part, lines.l_partkey == part.p_partkey)

    movements = sold("FO").select(
        "full_date", F.col("l_suppkey").alias("distributor_id"), "sku_id",
        F.when(F.col("l_linestatus") == "F", qty * F.col("p_size"))
         .cast("bigint").alias("primary_units"),
        F.when(F.col("l_linestatus") == "O", qty)
         .cast("bigint").alias("secondary_units"))
    bounds = movements.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
    calendar = calendar_between(bounds)

    deliveries = sold("O")
    drop_sizes = deliveries.select(F.col("l_suppkey").alias("distributor_id"),
                                   qty.alias("qty_units"))
    drops = (deliveries.join(orders.select("o_orderkey", "o_custkey"),
                             deliveries.l_orderkey == orders.o_orderkey, "left")
             .select(F.col("l_suppkey").alias("distributor_id"), qty.alias("qty_units"),
                     F.col("o_custkey").alias("kirana_id"), "full_date"))

    raw = LazyTables(("lineitem", "orders", "part", "supplier", "customer", "nation", "region"),
                     lambda name: read_table(spark, sf_dir, name))
    return Warehouse(calendar=calendar, products=products, distributors=distributors,
                     promotions=promotions_frame(spark, promotions),
                     movements=movements, drop_sizes=drop_sizes, drops=drops, raw=raw,
                     bounds=bounds, calendar_spans_facts=True,
                     distributor_ids=supplier.select(F.col("s_suppkey").alias("distributor_id")),
                     distributor_names=supplier.select(
                         F.col("s_suppkey").alias("distributor_id"),
                         F.col("s_name").alias("distributor_name")))
