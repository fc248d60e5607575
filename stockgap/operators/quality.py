"""Q1-Q7: the reference's declared constraints, re-aimed as check jobs.

PostgreSQL enforced keys, NOT NULL, foreign keys and CHECKs at write time.
Parquet tables have no such enforcement, so each constraint becomes a job
that counts violations; every report has one row per check, so a clean
table reads as zeros rather than as an empty result.  All checks are
aggregations (child keys are pre-aggregated before any anti-join, so a hot
key costs one row per map task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PRIMARY_KEYS
from ..sources.warehouse import Warehouse


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, keys: Sequence[str], check: str) -> DataFrame:
    """Q1: key values held by more than one row; (check, keys, excess rows)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.lit(check).alias("check_name"),
                   F.count(F.lit(1)).alias("duplicate_keys"),
                   F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"))


def null_counts(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """Q2: NULLs per column, all columns of a table in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "null_count").select(
        F.lit(table).alias("table_name"), "column_name", "null_count")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, check: str) -> DataFrame:
    """Q3: child rows whose non-NULL key is missing from the parent."""
    keys = (child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k"))
            .agg(F.count(F.lit(1)).alias("_n")))
    miss = keys.join(parent.select(F.col(pk).alias("_k")).distinct(), "_k", "left_anti")
    return miss.agg(F.lit(check).alias("check_name"),
                    F.count(F.lit(1)).alias("orphan_keys"),
                    F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"))


def many_orphans(child: DataFrame, fks: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Q3 for several foreign keys (column, parent, parent key, check name) of
    one child table, whose rows are read once: keys are counted per foreign
    key, and the parents' keys are tagged alike and joined away."""
    tagged = child.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(fk).cast("string").alias("_k"))
        for fk, _, _, name in fks])).alias("x")).select("x.*").filter(F.col("_k").isNotNull())
    keys = tagged.groupBy("check_name", "_k").agg(F.count(F.lit(1)).alias("_n"))
    known = _union([parent.select(F.lit(name).alias("check_name"), F.col(pk).cast("string").alias("_k"))
                    for _, parent, pk, name in fks]).distinct()
    miss = keys.join(known, ["check_name", "_k"], "left_anti").groupBy("check_name").agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.sum("_n").cast("bigint").alias("orphan_rows"))
    names = child.sparkSession.createDataFrame([(name,) for *_, name in fks], "check_name string")
    return names.join(miss, "check_name", "left").select(
        "check_name", F.coalesce("orphan_keys", F.lit(0)).cast("bigint").alias("orphan_keys"),
        F.coalesce("orphan_rows", F.lit(0)).cast("bigint").alias("orphan_rows"))


def violations(df: DataFrame, checks: Sequence[tuple[Column, str]], weight: Column | None = None) -> DataFrame:
    """Q4/Q5: rows failing each CHECK (condition, name), all in one pass over
    the table (NULL results count as passing, as in SQL).  ``weight``: how
    many rows a row stands for."""
    w = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    n = F.coalesce(F.sum(w), F.lit(0)).alias("_n")
    bad = [F.coalesce(F.sum(F.when(~F.coalesce(ok, F.lit(True)), w)), F.lit(0)).alias(f"_{i}")
           for i, (ok, _) in enumerate(checks)]
    return df.agg(n, *bad).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col("_n").cast("bigint").alias("checked_rows"),
                 F.col(f"_{i}").cast("bigint").alias("violations")) for i, (_, name) in enumerate(checks)])))


# -- the checks for the driver binding ------------------------------------

def dq_duplicate_keys(wh: Warehouse) -> DataFrame:
    r = wh.raw
    return _union([
        duplicate_keys(r["lineitem"], ["l_orderkey", "l_linenumber"], "lineitem(l_orderkey, l_linenumber)"),
        duplicate_keys(r["orders"], ["o_orderkey"], "orders(o_orderkey)"),
        duplicate_keys(r["part"], ["p_partkey"], "part(p_partkey)"),
        duplicate_keys(r["supplier"], ["s_suppkey"], "supplier(s_suppkey)"),
        duplicate_keys(r["customer"], ["c_custkey"], "customer(c_custkey)"),
        duplicate_keys(r["nation"], ["n_nationkey"], "nation(n_nationkey)"),
        duplicate_keys(r["region"], ["r_regionkey"], "region(r_regionkey)"),
        duplicate_keys(wh.calendar, ["date_id"], "calendar(date_id)"),
        duplicate_keys(wh.calendar, ["full_date"], "calendar(full_date)"),
        duplicate_keys(wh.promotions, ["promotion_id"], "promotion(promotion_id)"),
    ])


NOT_NULL = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_linestatus", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey"],
    "part": ["p_partkey", "p_type", "p_size"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
}


def orders_with_lines(wh: Warehouse) -> DataFrame:
    """orders LEFT JOIN lineitem: orders without a line have NULL in columns
    that are NOT NULL in lineitem."""
    o, li = wh.raw["orders"], wh.raw["lineitem"]
    return o.join(li, o["o_orderkey"] == li["l_orderkey"], "left").select(
        "o_orderkey", "l_orderkey", "l_partkey", "l_quantity")


def dq_null_counts(wh: Warehouse) -> DataFrame:
    return _union([null_counts(wh.raw[t], t, cols) for t, cols in NOT_NULL.items()]
                  + [null_counts(orders_with_lines(wh), "orders left join lineitem",
                                 ["o_orderkey", "l_orderkey", "l_partkey", "l_quantity"])])


def dq_orphans(wh: Warehouse) -> DataFrame:
    r = wh.raw
    return _union([
        many_orphans(r["lineitem"], [
            ("l_orderkey", r["orders"], "o_orderkey", "lineitem.l_orderkey -> orders"),
            ("l_partkey", r["part"], "p_partkey", "lineitem.l_partkey -> part"),
            ("l_suppkey", r["supplier"], "s_suppkey", "lineitem.l_suppkey -> supplier")]),
        many_orphans(r["orders"], [
            ("o_custkey", r["customer"], "c_custkey", "orders.o_custkey -> customer"),
            ("o_orderkey", r["lineitem"], "l_orderkey", "orders.o_orderkey -> lineitem")]),
        orphans(r["supplier"], "s_nationkey", r["nation"], "n_nationkey", "supplier.s_nationkey -> nation"),
        orphans(r["customer"], "c_nationkey", r["nation"], "n_nationkey", "customer.c_nationkey -> nation"),
        orphans(r["nation"], "n_regionkey", r["region"], "r_regionkey", "nation.n_regionkey -> region"),
        orphans(wh.promotions, "sku_id", wh.products, "sku_id", "promotion.sku_id -> product"),
    ])


def dq_range(wh: Warehouse) -> DataFrame:
    r = wh.raw
    q = F.col("l_quantity")
    return _union([
        violations(r["lineitem"], [(q >= 0, "lineitem.l_quantity >= 0"),
                                   (q == F.floor(q), "lineitem.l_quantity is whole"),
                                   (q <= 45, "lineitem.l_quantity <= 45 (no bulk drop)")]),
        violations(r["part"], [(F.col("p_size") > 0, "part.p_size > 0 (units per case)")]),
        violations(wh.promotions, [(F.col("discount_pct").between(0, 100),
                                    "promotion.discount_pct between 0 and 100")]),
    ])


def dq_ledger_identity(wh: Warehouse, ledger: DataFrame) -> DataFrame:
    """Q5 on a *stored* ledger (run-length or dense): closing = opening + in -
    out; opening = previous closing, the first day opens at 0; closing stock
    is not negative; and promotions end on or after they start.

    In a run-length ledger every later day of a run opens and closes at the
    run's closing balance, so only its first day and the hand-over between
    runs can break an identity; counts are of days all the same."""
    runs = "from_date" in ledger.columns
    days = F.datediff("to_date", "from_date") + 1 if runs else F.lit(1)
    w = Window.partitionBy("distributor_id", "sku_id").orderBy("from_date" if runs else "date_id")
    prev = F.lag("closing_units").over(w)
    checked = ledger.select(
        days.alias("_days"),
        (F.col("closing_units") == F.col("opening_units") + F.col("primary_units")
         - F.col("secondary_units")).alias("_c"),
        F.coalesce(F.col("opening_units") == prev, F.col("opening_units") == 0).alias("_o"),
        (F.col("closing_units") >= 0).alias("_p"))
    # an identity breaks on the first day of a run, a negative stock on all its days
    one = checked.agg(
        F.coalesce(F.sum("_days"), F.lit(0)).cast("bigint").alias("n"),
        F.count_if(~F.col("_c")).alias("c"), F.count_if(~F.col("_o")).alias("o"),
        F.coalesce(F.sum(F.when(~F.col("_p"), F.col("_days"))), F.lit(0)).cast("bigint").alias("p"))
    named = (("ledger closing = opening + primary - secondary", "c"), ("ledger opening = previous closing", "o"),
             ("ledger closing >= 0", "p"))
    both = one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col("n").alias("checked_rows"), F.col(c).alias("violations"))
        for name, c in named])))
    return _union([both, violations(wh.promotions, [(F.col("promo_end") >= F.col("promo_start"),
                                                     "promotion.promo_end >= promo_start")])])


# -- the rows themselves ----------------------------------------------------

def tagged_rows(df: DataFrame, table: str, key: Sequence[str], checks: Sequence[tuple[str, Column]],
                fks: Sequence[tuple[str, str, DataFrame, str]] = ()) -> DataFrame:
    """Q1-Q5 for one table in one pass: (table_name, row_key, n_rows, checks).

    key     columns that ought to identify a row
    checks  (name, condition a row must meet; NULL passes, as in SQL)
    fks     (name, column, parent table, its key): non-null values must be there

    Each row gets a bitmap of the checks it fails; a parent's keys are joined
    once, as a flag.  The rows of a key then fold into one, with their bitmaps
    or-ed and counted, so a hot key is one row per map task.  What remains is a
    row per key value with a failed check or more than one row; ``checks`` names
    them in the order given, uniqueness last.
    """
    names = [name for name, _ in checks] + [name for name, *_ in fks] + [f"unique({', '.join(key)})"]
    if len(names) > 63:
        raise ValueError(f"{table}: more than 63 checks do not fit a bitmap")
    bit = lambda i, bad: F.when(bad, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
    rows = df
    found = []
    for i, (_, fk, parent, pk) in enumerate(fks):
        known = parent.where(F.col(pk).isNotNull()).select(F.col(pk).alias(f"_k{i}")).distinct()
        rows = rows.join(known, F.col(fk) == F.col(f"_k{i}"), "left")
        found.append(F.col(fk).isNotNull() & F.col(f"_k{i}").isNull())
    failed = [~F.coalesce(ok, F.lit(True)) for _, ok in checks] + found
    bits = reduce(lambda a, b: a.bitwiseOR(b), [bit(i, bad) for i, bad in enumerate(failed)], F.lit(0).cast("bigint"))
    per_key = rows.select(*key, bits.alias("_bits")).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.bit_or("_bits").alias("_bits"))
    all_bits = F.col("_bits").bitwiseOR(bit(len(names) - 1, F.col("n_rows") > 1))
    said = F.array_compact(F.array(*[F.when(all_bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(names)]))
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in key])
    return per_key.where((F.col("_bits") != 0) | (F.col("n_rows") > 1)).select(
        F.lit(table).alias("table_name"), text.alias("row_key"), "n_rows", F.array_join(said, ",").alias("checks"))


def _not_null(*cols: str) -> list[tuple[str, Column]]:
    return [(f"{c} not null", F.col(c).isNotNull()) for c in cols]


def dq_violations(wh: Warehouse) -> DataFrame:
    """Q1-Q5: the violating rows of the driver tables by their keys, each table
    read once (and once more for its keys where another refers to it)."""
    r, q = wh.raw, F.col("l_quantity")
    fk = lambda col, parent, pk: (f"{col} -> {parent}", col, r[parent], pk)
    return _union([
        tagged_rows(r["lineitem"], "lineitem", ["l_orderkey", "l_linenumber"], [
            *_not_null(*NOT_NULL["lineitem"]), ("l_quantity >= 0", q >= 0), ("l_quantity is whole", q == F.floor(q)),
            ("l_quantity <= 45", q <= 45)],
            [fk("l_orderkey", "orders", "o_orderkey"), fk("l_partkey", "part", "p_partkey"), fk("l_suppkey", "supplier", "s_suppkey")]),
        tagged_rows(r["orders"], "orders", ["o_orderkey"], _not_null(*NOT_NULL["orders"]),
                    [fk("o_custkey", "customer", "c_custkey"), fk("o_orderkey", "lineitem", "l_orderkey")]),
        tagged_rows(r["part"], "part", ["p_partkey"], [*_not_null(*NOT_NULL["part"]), ("p_size > 0", F.col("p_size") > 0)]),
        tagged_rows(r["supplier"], "supplier", ["s_suppkey"], _not_null(*NOT_NULL["supplier"]), [fk("s_nationkey", "nation", "n_nationkey")]),
        tagged_rows(r["customer"], "customer", ["c_custkey"], _not_null(*NOT_NULL["customer"]), [fk("c_nationkey", "nation", "n_nationkey")]),
        tagged_rows(r["nation"], "nation", ["n_nationkey"], _not_null(*NOT_NULL["nation"]), [fk("n_regionkey", "region", "r_regionkey")]),
        tagged_rows(r["region"], "region", ["r_regionkey"], _not_null(*NOT_NULL["region"])),
    ])


# -- the checks for tables in the reference's own star schema ----------------

REFERENCE_FKS = (
    ("dim_distributor", "rep_id", "dim_sales_rep", "rep_id"),
    ("dim_kirana", "distributor_id", "dim_distributor", "distributor_id"),
    ("dim_promotion", "sku_id", "dim_product", "sku_id"),
    ("fact_primary_sales", "date_id", "dim_date", "date_id"),
    ("fact_primary_sales", "distributor_id", "dim_distributor", "distributor_id"),
    ("fact_primary_sales", "sku_id", "dim_product", "sku_id"),
    ("fact_primary_sales", "rep_id", "dim_sales_rep", "rep_id"),
    ("fact_secondary_sales", "date_id", "dim_date", "date_id"),
    ("fact_secondary_sales", "kirana_id", "dim_kirana", "kirana_id"),
    ("fact_secondary_sales", "distributor_id", "dim_distributor", "distributor_id"),
    ("fact_secondary_sales", "sku_id", "dim_product", "sku_id"),
)
REFERENCE_CHECKS = (
    ("dim_product", "units_per_case > 0"),
    ("dim_promotion", "discount_pct BETWEEN 0 AND 100"),
    ("dim_promotion", "promo_end >= promo_start"),
    ("fact_primary_sales", "qty_cases >= 0"),
    ("fact_secondary_sales", "qty_units >= 0"),
)


def reference_quality(wh: Warehouse) -> dict[str, DataFrame]:
    """Q1-Q5 over reference-shaped tables (those present in ``wh.raw``)."""
    t = wh.raw
    dup = [duplicate_keys(t[n], list(k), f"{n}({', '.join(k)})")
           for n, k in PRIMARY_KEYS.items() if n in t]
    nulls = [null_counts(t[n], n, t[n].columns) for n in t]
    fks = [orphans(t[c], fk, t[p], pk, f"{c}.{fk} -> {p}")
           for c, fk, p, pk in REFERENCE_FKS if c in t and p in t]
    rng = [violations(t[n], [(F.expr(c), f"{n}: {c}") for m, c in REFERENCE_CHECKS if m == n])
           for n in dict(REFERENCE_CHECKS) if n in t]
    return {"duplicate_keys": _union(dup), "null_counts": _union(nulls),
            "orphans": _union(fks), "range": _union(rng)}


def reference_rules(tables: Mapping[str, DataFrame], name: str) -> dict:
    """The declared constraints of a star-schema table, as the arguments of
    :meth:`stockgap.sources.snapshots.SnapshotTable.write`: NOT NULL and CHECKs,
    the key, and references to the tables at hand."""
    checks = {f"{c} not null": F.col(c).isNotNull() for c in tables[name].columns}
    checks |= {c: F.expr(c) for n, c in REFERENCE_CHECKS if n == name}
    fks = {f"{fk} -> {parent}": (fk, tables[parent], pk)
           for child, fk, parent, pk in REFERENCE_FKS if child == name and parent in tables}
    return {"checks": checks, "keys": PRIMARY_KEYS.get(name, ()), "references": fks}
