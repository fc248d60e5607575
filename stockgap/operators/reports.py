"""The dashboard's extracts, computed where the data lives.

The reference exports fixed distributors' series to CSV and post-processes
them in pandas.  Here a subject may be named; otherwise it is picked from the
detectors' own results (the top stuffer, the top hoarder, the top bulk
dumper) as a one-row frame, so an extract follows the data it explains.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exact import value_ge_k_mean
from ..params import COHORT_OTHERS, COHORT_SUFFIX, Params
from ..sources.csv_io import export_csv, export_csv_file
from ..sources.warehouse import Warehouse
from .calendar import calendar_bounds
from .densify import densify
from .leakage import KEYS, is_leak, promo_stats
from .ledger import daily_movements
from .risk import risk_score
from .stuffing import dist_day_dense, dist_day_sparse, stuffing_counts


def top_stuffer(wh: Warehouse, p: Params = Params()) -> DataFrame:
    """Distributor with the most stuffing flags (ties: lowest id); if none is
    flagged, the lowest id.  One row."""
    ranked = (wh.dist_keys().join(stuffing_counts(wh, p.stuffing), "distributor_id", "left")
              .orderBy(F.desc_nulls_last("spike_days"), "distributor_id").limit(1))
    return ranked.select("distributor_id")


def distributor_series(wh: Warehouse, p: Params = Params(),
                       distributor_id=None) -> DataFrame:
    """One distributor's daily primary total over the whole calendar."""
    one = top_stuffer(wh, p) if distributor_id is None else wh.dist_keys().filter(
        F.col("distributor_id") == F.lit(distributor_id)).distinct()
    daily = dist_day_sparse(wh).select("distributor_id", "full_date", "primary_units")  # the roll-up that the pick reads
    lo, hi = calendar_bounds(wh, daily)
    mine = daily.join(one, "distributor_id")
    dense = densify(mine, ["distributor_id"], ["primary_units"], lo, hi, anchors=one)
    return dense.select("full_date", "primary_units").orderBy("full_date")


def top_leak_pair(wh: Warehouse, p: Params = Params()) -> DataFrame:
    """The leakage row to chart: leaked first, then distributor, promotion."""
    st = promo_stats(wh, p.leakage).filter(F.col("_window_days") > 0)
    ranked = st.select(*KEYS, "promo_start", "promo_end",
                       F.coalesce(is_leak(p.leakage), F.lit(False)).alias("_leak"))
    return ranked.orderBy(F.desc("_leak"), "distributor_id", "promotion_id").limit(1)


def pair_series(wh: Warehouse, p: Params = Params(), distributor_id=None, sku_id=None,
                start=None, end=None) -> DataFrame:
    """One distributor's daily secondary sales of one SKU.

    Without a subject: the top hoarder's, around its promotion
    ``[start - series_days_before, end + series_days_after]``.  With
    ``distributor_id`` and ``sku_id``: theirs, from ``start`` to ``end``
    (dates; the calendar's first and last day if not given)."""
    r = p.report
    lo, hi = calendar_bounds(wh)
    if distributor_id is None:
        a, b = F.col("promo_start"), F.col("promo_end")
        subject = top_leak_pair(wh, p).select(
            "distributor_id", "sku_id",
            F.greatest(F.date_sub(a, r.series_days_before), lo).alias("_lo"),
            F.least(F.date_add(b, r.series_days_after), hi).alias("_hi"))
    else:
        day = lambda x, bound: bound if x is None else F.lit(x).cast("date")
        subject = wh.dist_keys().filter(F.col("distributor_id") == F.lit(distributor_id)).distinct().select(
            "distributor_id", F.lit(sku_id).alias("sku_id"),
            F.greatest(day(start, lo), lo).alias("_lo"), F.least(day(end, hi), hi).alias("_hi"))
    keys = ["distributor_id", "sku_id"]
    mv = daily_movements(wh).join(subject, keys).filter(
        (F.col("full_date") >= F.col("_lo")) & (F.col("full_date") <= F.col("_hi")))
    dense = densify(mv, keys, ["secondary_units"], F.col("_lo"), F.col("_hi"),
                    anchors=subject, carry=["_lo", "_hi"], in_range=True)
    return dense.select("full_date", "secondary_units").orderBy("full_date")


def spike_overlay(wh: Warehouse, p: Params = Params()) -> DataFrame:
    """C13 (quirk K7): the chart's own spike definition for every distributor:
    mean of up to 28 previous days (NULL on the first day) and a flag
    ``primary >= ratio * coalesce(mean, 0)``, with no month-end test and no
    floor."""
    s = p.stuffing
    w = (Window.partitionBy("distributor_id").orderBy("full_date")
         .rowsBetween(-s.trail_days, -1))
    dd = dist_day_dense(wh)
    n = F.count(F.lit(1)).over(w)
    tot = F.sum("primary_units").over(w)
    t = dd.select("distributor_id", "full_date", "primary_units",
                  n.alias("_n"), F.coalesce(tot, F.lit(0)).cast("bigint").alias("_t"))
    mean = F.when(F.col("_n") > 0, F.col("_t").cast("double") / F.col("_n").cast("double"))
    flag = F.coalesce(value_ge_k_mean(F.col("primary_units"), F.col("_t"), F.col("_n"), s.ratio),
                      F.col("primary_units") >= 0)
    return t.select("distributor_id", "full_date", "primary_units",
                    mean.alias("trail_mean"), flag.alias("flagged"))


def bucket_labels(edges) -> list[str]:
    """``1-e1``, ``e1+1-e2``, ..., ``ek+`` (0 lands in the first bucket)."""
    labels, prev = [], 0
    for e in edges:
        labels.append(f"{prev + 1}-{e}")
        prev = e
    labels.append(f"{prev}+")
    return labels


def _bucket(q: Column, edges) -> Column:
    labels = bucket_labels(edges)
    expr = F.when(q <= edges[0], F.lit(labels[0]))
    for e, lab in zip(edges[1:], labels[1:-1]):
        expr = expr.when(q <= e, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def drop_size_buckets(wh: Warehouse, p: Params = Params(), distributor_id=None) -> DataFrame:
    """Drop counts by size bucket, one distributor versus everyone
    else: ``distributor_id``, or the one with the most bulk drops (ties: the
    lowest id).

    One aggregate per distributor carries the bulk count and a count per
    bucket; the subject and both cohorts follow from it in a second one."""
    edges, q = p.report.bucket_edges, F.col("qty_units")
    labels = bucket_labels(edges)
    bucket = _bucket(q, edges)
    per = wh.drop_sizes.groupBy("distributor_id").agg(
        F.count_if(q >= p.route.bulk_units).alias("_bulk"),
        F.array(*[F.count_if(bucket == lab) for lab in labels]).alias("_n"))
    if distributor_id is None:
        top = F.min(F.struct((-F.col("_bulk")).alias("rank"), "distributor_id", "_n"))
    else:
        top = F.max(F.when(F.col("distributor_id") == F.lit(distributor_id), F.struct("distributor_id", "_n")))
    one = per.agg(top.alias("_top"), *[F.sum(F.col("_n")[i]).alias(f"_{i}") for i in range(len(labels))])
    mine = [F.coalesce(F.col("_top._n")[i], F.lit(0)) for i in range(len(labels))]
    subject = F.concat(F.col("_top.distributor_id").cast("string"), F.lit(COHORT_SUFFIX))
    rows = F.array(*[F.struct(F.lit(lab).alias("bucket"), c.alias("cohort"), n.cast("bigint").alias("drop_count"))
                     for i, lab in enumerate(labels)
                     for c, n in ((subject, mine[i]), (F.lit(COHORT_OTHERS), F.col(f"_{i}") - mine[i]))])
    return one.select(F.inline(rows)).filter(F.col("drop_count") > 0)


def drop_size_pivot(spark: SparkSession, wh: Warehouse, p: Params = Params(),
                    distributor_id=None) -> DataFrame:
    """Buckets in their fixed order, one column per cohort,
    missing combinations 0."""
    labels = bucket_labels(p.report.bucket_edges)
    order = spark.createDataFrame([(lab, i) for i, lab in enumerate(labels)],
                                  "bucket string, bucket_order int")
    b = drop_size_buckets(wh, p, distributor_id).withColumn(
        "side", F.when(F.col("cohort") == F.lit(COHORT_OTHERS), F.lit("other_drops"))
        .otherwise(F.lit("falsifier_drops")))
    piv = b.groupBy("bucket").pivot("side", ["falsifier_drops", "other_drops"]).agg(
        F.sum("drop_count"))
    return (F.broadcast(order).join(piv, "bucket", "left")
            .select("bucket", "bucket_order",
                    F.coalesce(F.col("falsifier_drops"), F.lit(0)).cast("bigint")
                    .alias("falsifier_drops"),
                    F.coalesce(F.col("other_drops"), F.lit(0)).cast("bigint").alias("other_drops"))
            .orderBy("bucket_order"))



def export_dashboard_extracts(spark: SparkSession, wh: Warehouse, folder: str,
                              p: Params = Params(), stuffer=None, hoarder=None,
                              dumper=None, files: bool = False) -> dict[str, str]:
    """The four extracts as headed CSV folders (ranked risk list, the top
    stuffer's series, the top hoarder's series, drop-size buckets).

    ``stuffer`` (a distributor id), ``hoarder`` (arguments of
    :func:`pair_series`) and ``dumper`` (a distributor id) name other subjects.

    The ranked list has one row per distributor and stays partitioned (its
    order is kept by a range-partitioned sort); the other three are bounded
    (days of one distributor, buckets) and are written as one file each.
    ``files``: plain files ``<name>.csv`` instead of folders, the ranked list
    too, in its order.
    """
    risk = risk_score(wh, p).orderBy(F.desc("risk_score"), "distributor_id")
    out = {
        "risk_list": (risk, False),
        "distributor_series": (distributor_series(wh, p, stuffer), True),
        "pair_series": (pair_series(wh, p, **(hoarder or {})), True),
        "drop_size_buckets": (drop_size_buckets(wh, p, dumper), True),
    }
    paths = {}
    for name, (df, single) in out.items():
        paths[name] = os.path.join(folder, name) + (".csv" if files else "")
        if files:
            export_csv_file(df, paths[name])
        else:
            export_csv(df, paths[name], single_file=single)
    return paths
