"""The warehouse the operators read: dimensions and facts as DataFrames.

Every operator takes a :class:`Warehouse`, whatever its origin (the
reference's CSV shapes, or the TPC-H-shaped driver tables bound in
:mod:`stockgap.sources.bindings`).  All fields are lazy DataFrames; nothing
is read until an operator's result is acted on.

Column contracts
----------------
calendar      date_id INT, full_date DATE, year, month, day SMALLINT,
              is_month_end BOOLEAN; one row per day, no gaps.
products      sku_id (+ descriptive columns)
distributors  distributor_id, distributor_name, rep_id, region
promotions    promotion_id, promo_name, sku_id, promo_start DATE,
              promo_end DATE, discount_pct INT
movements     full_date DATE, distributor_id, sku_id, primary_units BIGINT,
              secondary_units BIGINT; one row per fact line, primary already
              converted from cases to units; the measure of the other kind
              of line is NULL.
drop_sizes    distributor_id, qty_units BIGINT; one row per delivery.
drops         distributor_id, qty_units BIGINT, kirana_id, full_date DATE;
              one row per delivery (store key may need a join, so it is kept apart).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Warehouse:
    calendar: DataFrame
    products: DataFrame
    distributors: DataFrame
    promotions: DataFrame
    movements: DataFrame
    drop_sizes: DataFrame
    drops: DataFrame
    # raw tables for the data-quality jobs, by name
    raw: Mapping[str, DataFrame] = field(default_factory=dict)
    # distributor ids alone, when cheaper than projecting ``distributors``
    # (which may carry joins for names and regions)
    distributor_ids: DataFrame | None = None
    distributor_names: DataFrame | None = None

    # one row (lo, hi): the calendar's first and last day, when that is
    # cheaper than asking ``calendar``
    bounds: DataFrame | None = None
    # the calendar runs from the first to the last movement by construction,
    # so no movement lies outside it
    calendar_spans_facts: bool = False
    # a movement is one fact line (a secondary one a delivery), not a daily sum
    movements_are_lines: bool = True

    def span(self) -> DataFrame:
        """(lo, hi): the calendar's first and last day, a lazy one-row frame."""
        if self.bounds is not None:
            return self.bounds
        return self.calendar.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))

    def dist_names(self) -> DataFrame:
        """(distributor_id, distributor_name), from the leanest source."""
        if self.distributor_names is not None:
            return self.distributor_names
        return self.distributors.select("distributor_id", "distributor_name")

    def dist_keys(self) -> DataFrame:
        if self.distributor_ids is not None:
            return self.distributor_ids
        return self.distributors.select("distributor_id")
