"""Dense day-by-day rows from sparse per-day rows, without a dense shuffle.

The reference builds its ledger by cross-joining every day with every key
and left-joining the facts.  At scale that shuffles the dense product.  Here
only sparse rows are shuffled (once, partitioned by the key); each sparse
row then expands locally into itself plus the quiet days up to the next
movement.  One *anchor* row per key, dated the day before the range starts,
produces the leading quiet days and keys that never moved; keys without an
anchor (orphans, unknown to the dimension) are dropped, as the reference's
spine-driven join drops them.  Optional *history* rows (movements before the
range) feed the running balance but emit nothing.

A key's partition holds at most one row per calendar day plus its anchor,
so a hot key cannot grow a task beyond the calendar's length.

The exchange before the window has an explicit partition count (the
session's ``spark.sql.shuffle.partitions`` unless given): AQE would otherwise
merge partitions by their *sparse* size, and each merged task would then
emit many times that in dense rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT, ANCHOR, HISTORY = 0, 1, 2


def day_runs(sparse: DataFrame, keys: Sequence[str], values: Sequence[str],
             lo: Column | None, hi: Column | None, anchors: DataFrame | None = None,
             opening: tuple[str, Column] | None = None,
             carry: Sequence[str] = (), history_from: Column | None = None,
             partitions: int | None = None, in_range: bool = False) -> DataFrame:
    """The dense series of :func:`densify` in run-length form.

    One row per key and run ``[from_date, to_date]``: the values apply to
    ``from_date`` only (0 on the other days of the run), and ``opening``
    (when asked) is the balance before ``from_date``; every later day of the
    run opens and closes at ``opening + net``.  Rows: one per movement day
    plus one leading run per key, so the size follows the facts, not the
    calendar.  Arguments as for :func:`densify`.
    """
    keys, values, carry = list(keys), list(values), list(carry)
    d = F.col("full_date")
    own = lo is None  # the range is that of ``sparse``
    in_range = in_range or own
    start = lo if history_from is None else history_from
    kind = F.lit(EVENT) if in_range else F.when(d >= lo, F.lit(EVENT)).otherwise(F.lit(HISTORY))
    rows = sparse.select(*keys, *carry, "full_date", *values)
    if not in_range:
        rows = rows.filter((d >= start) & (d <= hi))
    rows = rows.select("*", kind.alias("_kind"))
    if anchors is not None:
        # without a day an anchor sorts first as well, and the exchange needs no bounds
        day_before = F.lit(None).cast("date") if own else F.date_sub(lo, 1)
        rows = rows.unionByName(anchors.select(
            *keys, *carry, day_before.alias("full_date"),
            *[(F.col(v) if v in anchors.columns else F.lit(0)).cast("bigint").alias(v) for v in values],
            F.lit(ANCHOR).alias("_kind")))

    if partitions is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, *keys)
    if own:
        lo, hi = _own_range(rows)
    w = Window.partitionBy(*keys).orderBy("full_date", "_kind")
    extra = [F.lead("full_date").over(w).alias("_next")]
    if anchors is not None:
        extra.append(F.max((F.col("_kind") == ANCHOR).cast("int")).over(
            w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_known"))
        if own:  # what comes before an anchor emits nothing, nor does an anchor that comes twice
            extra.append(F.coalesce(F.lead("_kind").over(w) != ANCHOR, F.lit(True)).alias("_emits"))
    if opening is not None:
        name, net = opening
        extra.append(F.coalesce(F.sum(net).over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint").alias("_open"))
    # the bounds once, after the exchange: they may be subqueries
    rows = rows.select("*", *extra).select("*", lo.alias("_first"), hi.alias("_last"))
    if anchors is not None:
        rows = rows.filter((F.col("_known") == 1) & (F.col("_emits") if own else F.lit(True)))

    first = F.greatest(d, F.col("_first"))
    last = F.least(F.coalesce(F.date_sub(F.col("_next"), 1), F.col("_last")), F.col("_last"))
    is_event = F.col("_kind") == EVENT
    out = [*keys, *carry, first.alias("from_date"), last.alias("to_date")]
    out += [F.when(is_event, F.col(v)).otherwise(F.lit(0)).cast("bigint").alias(v)
            for v in values]
    if opening is not None:
        name, net = opening
        # anchor and history rows start a quiet run at the balance after them
        out.append(F.when(is_event, F.col("_open"))
                   .otherwise(F.col("_open") + net).cast("bigint").alias(name))
    return rows.filter(first <= last).select(*out)


def _own_range(rows: DataFrame) -> tuple[Column, Column]:
    """First and last day of the events in ``rows`` (scalar subqueries); no
    first day if an event has none.

    ``rows`` are those of the exchange: the bounds name all their columns, so
    Spark reads the exchange again instead of rolling up the facts once more."""
    d = F.col("full_date")
    undated = F.count_if(d.isNull() & (F.col("_kind") == EVENT))
    pick = rows.agg(F.when(undated == 0, F.min(d)).alias("lo"), F.max(d).alias("hi"),
                    F.expr(f"count({', '.join(f'`{c}`' for c in rows.columns)})").alias("n")).select(
        F.struct("lo", "hi", "n").alias("_range")).scalar()
    return pick["lo"], pick["hi"]


def expand_runs(runs: DataFrame, keys: Sequence[str], values: Sequence[str],
                opening: tuple[str, Column] | None = None,
                carry: Sequence[str] = ()) -> DataFrame:
    """Dense rows from :func:`day_runs` output, one per day of each run.

    A local ``explode``: the runs keep their partitioning, nothing moves.
    ``opening`` is ``(name, net)`` as given to :func:`day_runs`.
    """
    day = F.col("_day")
    rows = runs.select("*", F.explode(F.sequence("from_date", "to_date")).alias("_day"))
    on_first = day == F.col("from_date")
    out = [*keys, *carry, day.alias("full_date")]
    out += [F.when(on_first, F.col(v)).otherwise(F.lit(0)).cast("bigint").alias(v)
            for v in values]
    if opening is not None:
        name, net = opening
        out.append(F.when(on_first, F.col(name))
                   .otherwise(F.col(name) + net).cast("bigint").alias(name))
    return rows.select(*out)


def densify(sparse: DataFrame, keys: Sequence[str], values: Sequence[str],
            lo: Column | None, hi: Column | None, anchors: DataFrame | None = None,
            opening: tuple[str, Column] | None = None,
            carry: Sequence[str] = (), history_from: Column | None = None,
            partitions: int | None = None, in_range: bool = False) -> DataFrame:
    """Expand ``sparse`` (keys, full_date, values; one row per key-day) to
    every day in ``[lo, hi]``.

    lo, hi        range bounds; scalar columns, or expressions over ``carry``;
                  both ``None``: from the first to the last day of ``sparse``
                  (without history)
    anchors       keys (+ carry) to emit in full; ``None`` emits only keys
                  present in ``sparse`` (from their first day in range on).
                  Value columns it has are movements of the day before the
                  range (an opening balance)
    opening       ``(name, net)``: adds ``name`` = sum of ``net`` over all
                  earlier days (the running balance before the day); ``net``
                  is an expression over the value columns
    carry         extra columns present in ``sparse`` and ``anchors``,
                  passed through to the output
    history_from  movements in ``[history_from, lo)`` count towards
                  ``opening`` but are not emitted (default: none)
    partitions    tasks that generate the dense rows (default: the session's
                  shuffle partitions; not coalesced by AQE).  See
                  :func:`stockgap.session.dense_partitions`
    in_range      no row of ``sparse`` lies outside the range
    Quiet days carry 0 in every value column.
    """
    runs = day_runs(sparse, keys, values, lo, hi, anchors=anchors, opening=opening,
                    carry=carry, history_from=history_from, partitions=partitions,
                    in_range=in_range)
    return expand_runs(runs, keys, values, opening=opening, carry=carry)
