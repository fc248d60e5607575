"""The daily stock ledger and its parts (spine, roll-ups, running total).

``closing = opening + primary_in - secondary_out`` for every
(distributor, sku, day); ``opening`` is the net of all earlier days.

Plan shape: fact lines are rolled up to (distributor, sku, day) with a
map-side partial aggregate (one exchange), then partitioned by
(distributor, sku) for the running window (second exchange, over rolled-up
rows only).  Dense rows are generated after the last exchange, see
:mod:`stockgap.operators.densify`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..sources.csv_io import write_table
from ..sources.warehouse import Warehouse
from .calendar import calendar_bounds, in_calendar
from .densify import day_runs, densify, expand_runs
from .keys import attach_all

PAIR = ("distributor_id", "sku_id")
LEDGER_KEY = (*PAIR, "date_id")


def daily_movements(wh: Warehouse) -> DataFrame:
    """A1+A2: one row per (distributor, sku, day) with movement, in units."""
    return (wh.movements.groupBy("distributor_id", "sku_id", "full_date")
            .agg(F.coalesce(F.sum("primary_units"), F.lit(0)).cast("bigint").alias("primary_units"),
                 F.coalesce(F.sum("secondary_units"), F.lit(0)).cast("bigint")
                 .alias("secondary_units")))


def daily_primary_units(wh: Warehouse) -> DataFrame:
    """A1 + P3: primary shipments per day, cases converted to units per line."""
    m = wh.movements.filter(F.col("primary_units").isNotNull())
    out = (m.groupBy("distributor_id", "sku_id", "full_date")
           .agg(F.sum("primary_units").cast("bigint").alias("primary_units")))
    return in_calendar(out, wh).select(date_key(F.col("full_date")).alias("date_id"),
                                        *PAIR, "primary_units")


def daily_secondary_units(wh: Warehouse) -> DataFrame:
    """A2: secondary deliveries per day, in units."""
    m = wh.movements.filter(F.col("secondary_units").isNotNull())
    out = (m.groupBy("distributor_id", "sku_id", "full_date")
           .agg(F.sum("secondary_units").cast("bigint").alias("secondary_units")))
    return in_calendar(out, wh).select(date_key(F.col("full_date")).alias("date_id"),
                                        *PAIR, "secondary_units")


def pair_keys(wh: Warehouse) -> DataFrame:
    """Every (distributor, sku) pair of the dimensions (the spine's keys)."""
    skus = wh.products.select("sku_id").distinct()
    return attach_all(wh.dist_keys(), skus, ["sku_id"])


def spine(wh: Warehouse) -> DataFrame:
    """Every day x distributor x sku (dense), generated, not joined.

    The pairs are spread over the shuffle partitions first, so each task
    generates the days of its share of pairs (a small file split of the
    distributor table does not fan out into one huge task)."""
    lo, hi = calendar_bounds(wh)
    n = int(wh.movements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pair_keys(wh).repartition(n, *PAIR)
    days = pairs.select(*PAIR, F.explode(F.sequence(lo, hi)).alias("full_date"))
    return days.select(date_key(F.col("full_date")).alias("date_id"), *PAIR)


def _range(wh: Warehouse, daily: DataFrame) -> tuple[Column | None, Column | None]:
    """The calendar's bounds; none where they are those of ``daily`` itself."""
    return (None, None) if wh.calendar_spans_facts else calendar_bounds(wh, daily)


def _net() -> Column:
    return F.col("primary_units") - F.col("secondary_units")


def stock_ledger_by_date(wh: Warehouse, scope: str = "full") -> DataFrame:
    """Dense ledger keyed by ``full_date`` (internal form used by detectors).

    scope="full"   every distributor x sku pair of the dimensions (reference)
    scope="active" only pairs with at least one movement in the calendar
    """
    daily = daily_movements(wh)
    lo, hi = _range(wh, daily)
    anchors = pair_keys(wh) if scope == "full" else None
    dense = densify(daily, PAIR, ["primary_units", "secondary_units"], lo, hi, anchors=anchors,
                    opening=("opening_units", _net()), in_range=wh.calendar_spans_facts)
    if scope == "active":
        known = wh.dist_keys()
        dense = dense.join(known, "distributor_id", "left_semi")
    return dense.withColumn("closing_units",
                            F.col("opening_units") + _net())


def ledger_runs(wh: Warehouse, scope: str = "full") -> DataFrame:
    """The ledger in run-length form: one row per (distributor, sku) and
    movement day, plus one leading run per pair, with the day range the row
    stands for.

    ``from_date`` carries that day's movements, ``opening_units`` and
    ``closing_units``; every later day up to ``to_date`` has no movement and
    opens and closes at ``closing_units``.  Its size follows the facts (the
    dense ledger is days x pairs), so this is the form to store at scale;
    :func:`ledger_from_runs` gives the dense rows back.
    """
    daily = daily_movements(wh)
    lo, hi = _range(wh, daily)
    anchors = pair_keys(wh) if scope == "full" else None
    runs = day_runs(daily, PAIR, ["primary_units", "secondary_units"], lo, hi, anchors=anchors,
                    opening=("opening_units", _net()), in_range=wh.calendar_spans_facts)
    if scope == "active":
        runs = runs.join(wh.dist_keys(), "distributor_id", "left_semi")
    return runs.select(*PAIR, "from_date", "to_date", "opening_units", "primary_units",
                       "secondary_units", (F.col("opening_units") + _net()).alias("closing_units"))


def deal_runs(runs: DataFrame) -> DataFrame:
    """Stored :func:`ledger_runs` dealt by pair over the shuffle partitions.

    A scan packs files by their bytes into about as many tasks as there are
    cores, often one more, so one core makes its days when the others are done.
    A pair has the same number of days whatever its runs, so tasks of as many
    pairs make as many days; only runs move."""
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(n, *PAIR)


def ledger_from_runs(runs: DataFrame) -> DataFrame:
    """The dense ledger (reference columns) from :func:`ledger_runs` rows;
    a local explode, no shuffle.  Rows read back from storage are dealt
    first (:func:`deal_runs`)."""
    dense = expand_runs(runs, PAIR, ["primary_units", "secondary_units"],
                        opening=("opening_units", _net()))
    return dense.select(date_key(F.col("full_date")).alias("date_id"), *PAIR,
                        "opening_units", "primary_units", "secondary_units",
                        (F.col("opening_units") + _net()).alias("closing_units"))


def stock_ledger(wh: Warehouse, scope: str = "full") -> DataFrame:
    """The ledger in the reference's column order."""
    led = stock_ledger_by_date(wh, scope)
    return led.select(date_key(F.col("full_date")).alias("date_id"), *PAIR,
                      "opening_units", "primary_units", "secondary_units", "closing_units")


def ledger_movements(wh: Warehouse) -> DataFrame:
    """Dense daily movements (spine left-joined to both roll-ups)."""
    daily = daily_movements(wh)
    lo, hi = _range(wh, daily)
    dense = densify(daily, PAIR, ["primary_units", "secondary_units"], lo, hi,
                    anchors=pair_keys(wh), in_range=wh.calendar_spans_facts)
    return dense.select(date_key(F.col("full_date")).alias("date_id"), *PAIR,
                        "primary_units", "secondary_units")


def running_balance(wh: Warehouse) -> DataFrame:
    """Opening stock = net movement of all earlier days."""
    led = stock_ledger_by_date(wh)
    return led.select(date_key(F.col("full_date")).alias("date_id"), *PAIR,
                      _net().alias("net_units"), "opening_units")


def ledger_sanity(wh: Warehouse, ledger: DataFrame | None = None) -> DataFrame:
    """A5 + Q7: row and key counts of the ledger against the dimensions.

    Without a stored ``ledger`` the counts come from the run-length form
    (rows = sum of run lengths), so no dense row is generated."""
    daily = daily_movements(wh)
    lo, hi = calendar_bounds(wh, daily.select(*PAIR, "full_date"))
    if ledger is None:
        keys = daily.select(*PAIR, "full_date")
        runs = day_runs(keys, PAIR, [], lo, hi, anchors=pair_keys(wh), in_range=wh.calendar_spans_facts)
        got = runs.agg(
            F.sum(F.datediff("to_date", "from_date") + 1).cast("bigint").alias("recon_rows"),
            F.count_distinct("distributor_id").alias("distributors"),
            F.count_distinct("sku_id").alias("skus"))
    else:
        got = ledger.agg(F.count(F.lit(1)).alias("recon_rows"),
                         F.count_distinct("distributor_id").alias("distributors"),
                         F.count_distinct("sku_id").alias("skus"))
    days = F.datediff(hi, lo).cast("bigint") + 1
    dists = wh.distributors.agg(F.count_distinct("distributor_id")).scalar()
    skus = wh.products.agg(F.count_distinct("sku_id")).scalar()
    expected = (days * dists * skus).cast("bigint")
    return got.select("*", expected.alias("expected_rows"),
                      (F.col("recon_rows") == expected).alias("is_complete"))


def negative_stock(wh: Warehouse, ledger: DataFrame | None = None) -> DataFrame:
    """Q6: ledger rows whose closing stock is below zero (stock sold that
    never arrived).

    Without a stored ``ledger``: a run's closing balance holds for every day
    of the run, so only negative runs are expanded to days."""
    if ledger is None:
        return ledger_from_runs(ledger_runs(wh).filter(F.col("closing_units") < 0))
    return ledger.filter(F.col("closing_units") < 0)


def month_pieces(runs: DataFrame) -> DataFrame:
    """:func:`ledger_runs` cut at month ends: a row per run and month it touches,
    with ``month`` (yyyymm), the key of its first day and its number of days."""
    number = lambda d: F.year(d) * 12 + F.month(d) - 1
    cut = runs.where(F.col("from_date") <= F.col("to_date")).select("*", F.explode(F.sequence(number("from_date"), number("to_date"))).alias("_m"))
    start = F.make_date(F.floor(F.col("_m") / 12).cast("int"), F.pmod("_m", F.lit(12)) + 1, F.lit(1))
    cut = cut.withColumn("_start", F.greatest("from_date", start))
    moves = F.col("_start") == F.col("from_date")
    values = [F.when(moves, F.col(v)).otherwise(F.lit(0)).cast("bigint").alias(v) for v in ("primary_units", "secondary_units")]
    return cut.select(
        *PAIR, F.when(moves, F.col("opening_units")).otherwise(F.col("closing_units")).alias("opening_units"), *values, "closing_units",
        (F.floor(F.col("_m") / 12) * 100 + F.pmod("_m", F.lit(12)) + 1).cast("int").alias("month"), date_key(F.col("_start")).alias("_key"),
        (F.datediff(F.least(F.col("to_date"), F.last_day("_start")), "_start") + 1).alias("_days"))


def spread_by_month(runs: DataFrame, files_per_month: int = 8) -> DataFrame:
    """The dense ledger of ``runs`` (:func:`ledger_runs`) with ``month`` (yyyymm),
    dealt for a table with a folder a month: at most ``files_per_month`` files each.

    Runs are dealt, not days: the days are made afterwards, by a join with the
    496 numbers (days, day) of months of up to 31 days.  The optimizer drops the
    sort below the join, so the write sorts the days by month."""
    spark = runs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*PAIR), F.lit(files_per_month)).cast("int")
    dealt = month_pieces(runs).withColumn("_bucket", bucket).repartition(n, "month", "_bucket").sortWithinPartitions(
        "month", "_bucket", *PAIR, "_key")
    days = spark.range(1, 32).select(F.col("id").cast("int").alias("_days")).select(
        "_days", F.explode(F.sequence(F.lit(0), F.col("_days") - 1)).alias("_day"))
    first = F.col("_day") == 0
    on_first = [F.when(first, F.col(v)).otherwise(F.lit(0)).cast("bigint").alias(v) for v in ("primary_units", "secondary_units")]
    return dealt.join(F.broadcast(days), "_days").select(
        (F.col("_key") + F.col("_day")).alias("date_id"), *PAIR,
        F.when(first, F.col("opening_units")).otherwise(F.col("closing_units")).alias("opening_units"), *on_first, "closing_units", "month")


def materialize_ledger(wh: Warehouse, path: str, layout: str = "runs", scope: str = "full",
                       files_per_month: int = 8) -> None:
    """Write the ledger as parquet; the previous build goes whole.

    layout="runs"       the run-length form (:func:`ledger_runs`): one row per
                        pair and movement day; read back with
                        :func:`deal_runs` and :func:`ledger_from_runs`.  The
                        form to store at scale.
    layout="generated"  dense rows stay in the partitions they were generated
                        in (keys clustered, days in order): no extra shuffle,
                        row groups prune well on distributor and SKU.
    layout="month"      dense rows in one folder per month (``month`` =
                        yyyymm): the runs are dealt by (month, pair bucket)
                        and become days as they are written, by Arrow columns
                        (:mod:`stockgap.sources.months`) or, where tasks
                        cannot open the path as files, by Spark's writer: at
                        most ``files_per_month`` files a month.
    """
    if layout == "runs":
        write_table(ledger_runs(wh, scope), path)
        return
    if layout == "month":
        from ..sources.months import write_months  # the only part of the ledger that needs pyarrow
        runs = ledger_runs(wh, scope)
        if not write_months(runs, path, PAIR, files_per_month):
            write_table(spread_by_month(runs, files_per_month), path, ("month",))
    else:
        write_table(stock_ledger(wh, scope), path)
