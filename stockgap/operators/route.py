"""Route / beat falsification from the size of single deliveries.

Per distributor: drop count, mean, sample deviation, largest drop and its
z-score, bulk drops (>= ``bulk_units``), stores hit by them, and the bulk
share of volume.  Everything is an algebraic aggregate (count, sum, sum of
squares, max), so Spark combines map-side and a distributor holding a third
of all deliveries costs one partial row per map task.  The distinct store
count needs the store key, which may sit behind a join: it is computed on
bulk deliveries only, filtered before that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import _wide, idiv, round_ratio, round_sqrt, sqrt_estimate
from ..params import OK_VERDICT, ROUTE_FALSIFIED, ROUTE_SUSPECT, RouteParams
from ..sources.warehouse import Warehouse


def drop_moments(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """Raw per-distributor aggregates: n, sum, sum of squares, max, bulk.

    The squares are summed in two parts (above and below 2^16), which stay
    bigints where their whole sum would overflow one."""
    q = F.col("qty_units")
    bulk = q >= p.bulk_units
    sums = wh.drop_sizes.groupBy("distributor_id").agg(
        F.count(F.lit(1)).alias("total_drops"),
        F.sum(q).cast("bigint").alias("_s1"),
        F.sum(F.shiftright(q * q, 16)).alias("_high"),
        F.sum((q * q).bitwiseAND(F.lit(0xFFFF))).alias("_low"),
        F.max(q).alias("max_drop_units"),
        F.count_if(bulk).alias("bulk_dumps"),
        F.coalesce(F.sum(F.when(bulk, q)), F.lit(0)).cast("bigint").alias("_bulk_s"))
    return sums.withColumn("_s2", _wide(F.col("_high")) * (1 << 16) + _wide(F.col("_low"))).drop("_high", "_low")


def bulk_stores(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """Distinct stores that received a bulk drop, per distributor."""
    b = wh.drops.filter(F.col("qty_units") >= p.bulk_units)
    return b.groupBy("distributor_id").agg(
        F.count_distinct("kirana_id").alias("kiranas_hit_by_dumps"))


def store_bitmaps(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """A11/A5, mergeable: (distributor_id, month, bucket, stores): the stores
    that received a bulk drop in a month (yyyymm), as exact bitmaps of their
    numbers, 64 a bucket in one bigint, so a row costs the same whether its
    distributor reaches few stores or many.  A table of this form answers for
    any range of months without the deliveries (:func:`bulk_stores_of`), and a
    new month is a new partition of it.  Store keys must be whole numbers."""
    if not isinstance(wh.drops.schema["kirana_id"].dataType, T.IntegralType):
        raise TypeError("bitmaps need store keys of an integral type")
    b = wh.drops.filter(F.col("qty_units") >= p.bulk_units).select(
        "distributor_id", (F.year("full_date") * 100 + F.month("full_date")).alias("month"),
        F.col("kirana_id").cast("bigint").alias("_store"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_store", F.lit(64)).cast("int"))
    return b.groupBy("distributor_id", "month", F.shiftright("_store", 6).alias("bucket")).agg(F.bit_or(bit).alias("stores"))


def bulk_stores_of(bitmaps: DataFrame, first_month: int, last_month: int) -> DataFrame:
    """Distinct stores with a bulk drop per distributor over the months from
    ``first_month`` to ``last_month``, from :func:`store_bitmaps` rows."""
    of = bitmaps.filter(F.col("month").between(first_month, last_month))
    merged = of.groupBy("distributor_id", "bucket").agg(F.bit_or("stores").alias("stores"))
    return merged.groupBy("distributor_id").agg(  # drops whose store is unknown count for none
        F.coalesce(F.sum(F.bit_count("stores")), F.lit(0)).cast("bigint").alias("kiranas_hit_by_dumps"))


def _with_stats(m: DataFrame) -> DataFrame:
    """Rounded mean, deviation, z-score of the largest drop, bulk share.

    With ``var = num / (n(n-1))``, ``num = n*s2 - s1^2``:
    ``std = sqrt(num / (n(n-1)))`` and, for ``A = n*max - s1``,
    ``z = (max - mean) / std = sqrt(A^2 (n-1) / (n * num))``.  Both are
    rounded exactly from integers, by one path for every n: with
    ``Q = 400 A^2`` the floor that ``round_sqrt`` needs is
    ``floor((Q - ceil(Q / n)) / num)``, so nothing larger than ``Q`` and
    ``400 num`` is ever formed (38 digits hold 10^12 drops of 10^5 units).
    """
    # each step names its result, so that no expression enters the plan twice
    n, wide_n, num, quad = F.col("total_drops"), F.col("_n"), F.col("_num"), F.col("_quad")
    m = m.withColumn("_n", _wide(n)).withColumns({
        "_num": wide_n * _wide(F.col("_s2")) - _wide(F.col("_s1")) * _wide(F.col("_s1")),
        "_a": wide_n * _wide(F.col("max_drop_units")) - _wide(F.col("_s1"))})
    m = m.withColumns({"_quad": F.col("_a") * F.col("_a") * 400, "_num400": _wide(num * 400),
                       "_den": F.when(n > 1, _wide(wide_n * (wide_n - 1))), "_pos": F.when((n > 1) & (num > 0), num)})
    m = m.withColumns({"_std": idiv(F.col("_num400"), F.col("_den")), "_part": quad - idiv(quad + wide_n - 1, wide_n)})
    m = m.withColumn("_z", idiv(F.col("_part"), F.col("_pos")))
    m = m.withColumns({"_std_k": sqrt_estimate(F.col("_std")), "_z_k": sqrt_estimate(F.col("_z"))})
    return m.select(
        "*",
        round_ratio(F.col("_s1"), n, 1).alias("avg_drop_units"),
        round_sqrt(F.col("_std"), 1, F.col("_std_k")).alias("std_drop_units"),
        round_sqrt(F.col("_z"), 1, F.col("_z_k")).alias("max_drop_z_score"),
        round_ratio(F.col("_bulk_s") * 100, F.col("_s1"), 1).alias("bulk_volume_pct"))


def drop_stats(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """A4+A6: count, mean, deviation and maximum of drop sizes (K8 exposed)."""
    return _with_stats(drop_moments(wh, p)).select(
        "distributor_id", "total_drops", "avg_drop_units", "std_drop_units", "max_drop_units")


def drop_zscore(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """How many deviations the largest drop sits above the mean."""
    return _with_stats(drop_moments(wh, p)).select("distributor_id", "max_drop_z_score")


def bulk_drops(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """A10: number of bulk drops per distributor."""
    return drop_moments(wh, p).select("distributor_id", "bulk_dumps")


def bulk_volume_share(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """Bulk drops' share of the distributor's volume, percent, 1 digit
    (NULL when the distributor delivered 0 units in total)."""
    return _with_stats(drop_moments(wh, p)).select("distributor_id", "bulk_volume_pct")


def route_falsification(wh: Warehouse, p: RouteParams = RouteParams()) -> DataFrame:
    """The detector's report, most bulk drops first."""
    st = _with_stats(drop_moments(wh, p))
    stores = bulk_stores(wh, p)
    names = wh.dist_names()
    verdict = (F.when(F.col("bulk_dumps") >= p.repeat_dumps, F.lit(ROUTE_FALSIFIED))
               .when(F.col("bulk_dumps") > 0, F.lit(ROUTE_SUSPECT))
               .otherwise(F.lit(OK_VERDICT)))
    out = (st.join(stores, "distributor_id", "left").join(names, "distributor_id")
           .select("distributor_id", "distributor_name", "total_drops", "avg_drop_units",
                   "max_drop_units", "max_drop_z_score", "bulk_dumps",
                   F.coalesce(F.col("kiranas_hit_by_dumps"), F.lit(0)).alias("kiranas_hit_by_dumps"),
                   "bulk_volume_pct", verdict.alias("verdict")))
    return out.orderBy(F.desc("bulk_dumps"), F.desc("max_drop_units"), "distributor_id")
