"""Declared schemas of the warehouse tables and of the main outputs."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, H, D, B = (T.StringType(), T.IntegerType(), T.LongType(), T.ShortType(),
                    T.DateType(), T.BooleanType())


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# Dimension and fact tables in CSV column order (loads map by position).
DIM_DATE = _schema(("full_date", D, False), ("date_id", I, False), ("year", H, False),
                   ("month", H, False), ("day", H, False), ("is_month_end", B, False))
DIM_PRODUCT = _schema(("sku_id", S, False), ("brand", S, False), ("category", S, False),
                      ("mrp", T.DecimalType(8, 2), False), ("units_per_case", I, False))
DIM_SALES_REP = _schema(("rep_id", S, False), ("rep_name", S, False), ("region", S, False))
DIM_DISTRIBUTOR = _schema(("distributor_id", S, False), ("distributor_name", S, False),
                          ("rep_id", S, False), ("region", S, False))
DIM_KIRANA = _schema(("kirana_id", S, False), ("kirana_name", S, False),
                     ("distributor_id", S, False), ("pin_code", I, False))
DIM_PROMOTION = _schema(("promotion_id", S, False), ("promo_name", S, False),
                        ("sku_id", S, False), ("promo_start", D, False),
                        ("promo_end", D, False), ("discount_pct", I, False))
FACT_PRIMARY = _schema(("primary_order_id", L, False), ("date_id", I, False),
                       ("distributor_id", S, False), ("sku_id", S, False),
                       ("rep_id", S, False), ("qty_cases", I, False))
FACT_SECONDARY = _schema(("secondary_order_id", L, False), ("date_id", I, False),
                         ("kirana_id", S, False), ("distributor_id", S, False),
                         ("sku_id", S, False), ("qty_units", I, False))

LEDGER_COLUMNS = ("date_id", "distributor_id", "sku_id", "opening_units",
                  "primary_units", "secondary_units", "closing_units")

# Declared keys (primary and composite), as data for the quality jobs.
PRIMARY_KEYS = {
    "dim_date": ("date_id",),
    "dim_product": ("sku_id",),
    "dim_sales_rep": ("rep_id",),
    "dim_distributor": ("distributor_id",),
    "dim_kirana": ("kirana_id",),
    "dim_promotion": ("promotion_id",),
    "fact_primary_sales": ("primary_order_id",),
    "fact_secondary_sales": ("secondary_order_id",),
    "fact_stock_reconciliation": ("distributor_id", "sku_id", "date_id"),
}
