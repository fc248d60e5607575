"""The stored ledger brought up to date from the first day that changed.

The ledger of a day is the balance of the day before and that day's movements.
So a ledger stored by month need only be recomputed from the first month whose
movements changed, with the stored closing balances before it as the anchors
of every pair; earlier months stay as they are.

What changed is found from a digest per month (lines, units, a hash sum over
the lines), noted with the version that was built from them: a late line for an
earlier month moves the cut there by itself.  The digests cost one pass over
the facts with map-side aggregation, and a row per month reaches the driver.  A
change of the calendar's start, or of the set of distributors or SKUs, changes
rows of every month: then everything is recomputed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.snapshots import SnapshotTable
from ..sources.warehouse import Warehouse
from .calendar import in_calendar
from .densify import day_runs
from .ledger import LEDGER_KEY, PAIR, daily_movements, pair_keys, spread_by_month

VALUES = ["primary_units", "secondary_units"]


def _hash_sum(*cols: str) -> Column:
    """A number for a multiset of rows, whatever their order."""
    return F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(38,0)")), F.lit(0)).cast("string")


def fact_digests(wh: Warehouse) -> dict[str, str]:
    """month (yyyymm) -> digest of its movements."""
    m = in_calendar(wh.movements, wh)
    month = (F.year("full_date") * 100 + F.month("full_date")).cast("string")
    rows = m.groupBy(month.alias("month")).agg(F.concat_ws(
        " ", F.count(F.lit(1)), F.sum("primary_units"), F.sum("secondary_units"),
        _hash_sum("full_date", *PAIR, *VALUES)).alias("digest"))
    return {r.month: r.digest for r in rows.collect()}


def dimension_digest(wh: Warehouse) -> str:
    """The set of pairs the ledger has rows for."""
    parts = [wh.dist_keys().select(F.col("distributor_id").alias("k")).distinct(),
             wh.products.select(F.col("sku_id").alias("k")).distinct()]
    return " ".join(df.agg(F.concat_ws(" ", F.count(F.lit(1)), _hash_sum("k"))).first()[0] for df in parts)


def _month(d: dt.date) -> str:
    return f"{d.year}{d.month:02d}"


def first_changed(now: dict, before: dict) -> dt.date | None:
    """The first day to recompute (a month's first), ``date.min`` for
    everything, None if nothing changed.  ``now`` and ``before`` are notes of
    :func:`ledger_note`."""
    if not before or any(now[k] != before.get(k) for k in ("pairs", "first_day")):
        return dt.date.min
    a, b = now["months"], before["months"]
    months = [m for m in {**a, **b} if a.get(m) != b.get(m)]
    if now["last_day"] != before["last_day"]:  # days were added or taken away
        months.append(_month(dt.date.fromisoformat(min(now["last_day"], before["last_day"]))))
    return dt.date(int(min(months)[:4]), int(min(months)[4:]), 1) if months else None


def ledger_note(wh: Warehouse) -> dict:
    """What a ledger of ``wh`` depends on, small enough for a manifest."""
    lo, hi = wh.span().first()
    return {"first_day": str(lo), "last_day": str(hi), "pairs": dimension_digest(wh), "months": fact_digests(wh)}


def ledger_from(wh: Warehouse, cut: dt.date, last_day: dt.date, balances: DataFrame) -> DataFrame:
    """The ledger from ``cut`` to ``last_day`` in run-length form; ``balances``
    (distributor_id, sku_id, closing_units) are those of the day before, and
    pairs without one start at 0."""
    anchors = pair_keys(wh).join(balances, list(PAIR), "left").select(
        *PAIR, F.coalesce("closing_units", F.lit(0)).alias("primary_units"))
    daily = daily_movements(wh).where(F.col("full_date") >= F.lit(cut))
    net = F.col("primary_units") - F.col("secondary_units")
    runs = day_runs(daily, PAIR, VALUES, F.lit(cut), F.lit(last_day), anchors=anchors, opening=("opening_units", net))
    return runs.withColumn("closing_units", F.col("opening_units") + net)


def refresh_ledger(wh: Warehouse, table: SnapshotTable, since: dt.date | None = None, files_per_month: int = 8) -> int | None:
    """Bring a ledger stored by month up to date; the new version's number, or
    None if the newest one is already that of ``wh``.

    since  recompute from this day on in any case (an earlier change moves it back)

    Only months from the cut on are computed and written; the version takes the
    others from the one before.  The write is checked against the ledger's own
    constraints (identity, key), and is not committed if they fail.
    """
    now = ledger_note(wh)
    lo, hi = dt.date.fromisoformat(now["first_day"]), dt.date.fromisoformat(now["last_day"])
    cut = first_changed(now, table.info())
    if since is not None:
        cut = min(since.replace(day=1), cut or since)
    if cut is None:
        return None
    cut = max(cut, lo)
    spark = wh.movements.sparkSession
    if cut > lo:
        before = cut - dt.timedelta(days=1)
        balances = table.read().where((F.col("month") == int(_month(before))) & (F.col("date_id") == int(before.strftime("%Y%m%d"))))
    else:
        balances = spark.createDataFrame([], wh_pair_schema(wh))
    rows = spread_by_month(ledger_from(wh, cut, hi, balances.select(*PAIR, "closing_units")), files_per_month)
    identity = F.col("closing_units") == F.col("opening_units") + F.col("primary_units") - F.col("secondary_units")
    return table.write(rows, "month", keep=lambda m: m < _month(cut), info=now,
                       checks={"closing = opening + primary - secondary": identity}, keys=LEDGER_KEY)


def wh_pair_schema(wh: Warehouse):
    """The schema of balances for the warehouse's keys."""
    return pair_keys(wh).withColumn("closing_units", F.lit(0).cast("bigint")).schema
