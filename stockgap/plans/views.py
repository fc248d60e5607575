"""Named live views for SQL users.

``register_views`` registers lazy DataFrames as temporary views, so each
``SELECT`` re-runs the plan, calendar bounds and promotions included, like
the reference's ``CREATE OR REPLACE VIEW``.  Spark keeps the file listing of a
table read by path; after files were added, ``refresh_views`` lists them
again.  Names follow the reference's tables and view.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import leakage, ledger, risk, route, stuffing
from ..params import Params
from ..sources.warehouse import Warehouse


def register_views(spark: SparkSession, wh: Warehouse, p: Params = Params()) -> list[str]:
    views = {
        "dim_date": wh.calendar,
        "dim_product": wh.products,
        "dim_distributor": wh.distributors,
        "dim_promotion": wh.promotions,
        "fact_stock_reconciliation": ledger.stock_ledger(wh),
        "vw_channel_stuffing": stuffing.channel_stuffing(wh, p.stuffing),
        "vw_promotion_leakage": leakage.promotion_leakage(wh, p.leakage),
        "vw_dump_day": leakage.dump_day(wh, p.leakage),
        "vw_route_falsification": route.route_falsification(wh, p.route),
        "vw_fraud_risk_score": risk.risk_score(wh, p),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def refresh_views(spark: SparkSession, views: list[str]) -> None:
    """List the files under the views again (after new data was appended)."""
    for name in views:
        spark.catalog.refreshTable(name)
