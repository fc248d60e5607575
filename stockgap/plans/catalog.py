"""The risk score as SQL views in the session's catalog.

``install`` declares the tables over their files, views of the concepts
(distributors, promotions, movements), the sets of thresholds as rows of
``dim_threshold``, the view ``vw_fraud_risk_scores`` with the score under every
set, and ``vw_fraud_risk_score`` with that under the first.  They are text in the
catalog, not plans of one session: every session of the catalog finds them by
name, and with a metastore they outlive the application.  Each use reads the
tables anew, and a condition on ``threshold_set`` reaches the thresholds before
anything is joined with them.

The SQL follows the spine-free forms of the operators: a flagged day has
movement, and a pair that leaks has a baseline above 0, so only days and pairs
with movement are looked at.  ``min_trail`` and ``min_baseline`` must therefore
be above 0 (``install`` checks it).  Thresholds are integer ratios, and means are
compared by cross-multiplied sums, exactly, as decimals.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from ..params import TIER_CLEAN, TIER_CRITICAL, TIER_HIGH, TIER_MEDIUM, Params
from ..sources.tables import DRIVER_SCHEMAS, table_path

DATABASE = "stockgap"

_MOVEMENTS = """
SELECT CAST(l_shipdate AS DATE) AS full_date, l_suppkey AS distributor_id, p_type AS sku_id,
       CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) * p_size END AS primary_units,
       CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) END AS secondary_units
FROM {db}.lineitem JOIN {db}.part ON p_partkey = l_partkey
WHERE l_linestatus IN ('F', 'O') AND l_suppkey IS NOT NULL AND p_type IS NOT NULL"""

_DISTRIBUTORS = """
SELECT s_suppkey AS distributor_id, s_name AS distributor_name, r_name AS region
FROM {db}.supplier LEFT JOIN {db}.nation ON n_nationkey = s_nationkey LEFT JOIN {db}.region ON r_regionkey = n_regionkey
WHERE s_suppkey IS NOT NULL"""

#: thresholds of a parameter set, each an exact ratio
_THRESHOLDS = (
    ("spike_ratio", lambda p: p.stuffing.ratio), ("min_trail", lambda p: p.stuffing.min_trail),
    ("max_promo_share", lambda p: p.leakage.max_promo_share), ("min_baseline", lambda p: p.leakage.min_baseline),
    ("min_post_lift", lambda p: p.leakage.min_post_lift), ("bulk_units", lambda p: p.route.bulk_units),
    ("repeat_dumps", lambda p: p.route.repeat_dumps), ("route_share_pct", lambda p: p.risk.route_share_pct))


def _thresholds(sets: Mapping[str, Params]) -> str:
    """The rows of ``dim_threshold``: numerator and denominator of each."""
    rows = [", ".join([_quoted(name), *[f"{Fraction(value(p)).numerator}L, {Fraction(value(p)).denominator}L" for _, value in _THRESHOLDS]])
            for name, p in sets.items()]
    columns = ", ".join(["threshold_set", *[f"{n}, {n}_per" for n, _ in _THRESHOLDS]])
    return f"SELECT * FROM VALUES {', '.join(f'({r})' for r in rows)} AS t({columns})"


def _at_least(left: str, ratio: str, right: str = "1") -> str:
    """``left >= ratio * right`` for whole numbers and the ratio of a threshold."""
    wide = "CAST({} AS DECIMAL(38,0))"
    return f"{wide.format(left)} * {ratio}_per >= {ratio} * {wide.format(right)}"


def _risk(p: Params) -> str:
    """The scores under every set; window lengths, points and tiers are ``p``'s."""
    lk, r = p.leakage, p.risk
    product = "(CAST({} AS DECIMAL(19,0)) * {})".format
    return f"""
WITH cal AS (SELECT min(full_date) AS lo, max(full_date) AS hi FROM {{db}}.fact_movements),
th AS (SELECT * FROM {{db}}.dim_threshold),
days AS (
    SELECT threshold_set, distributor_id, full_date, coalesce(sum(primary_units), 0) AS bought, coalesce(sum(secondary_units), 0) AS sold,
           count_if({_at_least("secondary_units", "bulk_units")}) AS dumps,
           coalesce(sum(secondary_units) FILTER (WHERE {_at_least("secondary_units", "bulk_units")}), 0) AS dumped
    FROM {{db}}.fact_movements CROSS JOIN th GROUP BY threshold_set, distributor_id, full_date),
trail AS (
    SELECT days.*, least({p.stuffing.trail_days}, datediff(full_date, lo)) AS n,
           coalesce(sum(bought) OVER (PARTITION BY threshold_set, distributor_id ORDER BY unix_date(full_date)
                                      RANGE BETWEEN {p.stuffing.trail_days} PRECEDING AND 1 PRECEDING), 0) AS before
    FROM days CROSS JOIN cal),
totals AS (
    SELECT threshold_set, distributor_id, sum(dumps) AS dumps, sum(sold) AS sold, sum(dumped) AS dumped,
           count_if(full_date = last_day(full_date) AND n > 0 AND {_at_least("before", "min_trail", "n")}
                    AND {_at_least(product("bought", "n"), "spike_ratio", "before")}) AS spikes
    FROM trail JOIN th USING (threshold_set) GROUP BY threshold_set, distributor_id),
spans AS (
    SELECT promotion_id, sku_id, promo_start, promo_end,
           greatest(0, datediff(least(date_sub(promo_start, 1), hi), greatest(date_sub(promo_start, {lk.pre_days}), lo)) + 1) AS base_days,
           greatest(0, datediff(least(promo_end, hi), greatest(promo_start, lo)) + 1) AS promo_days,
           greatest(0, datediff(least(date_add(promo_end, {lk.post_days}), hi), greatest(date_add(promo_end, 1), lo)) + 1) AS post_days
    FROM {{db}}.dim_promotion CROSS JOIN cal WHERE sku_id IN (SELECT p_type FROM {{db}}.part)),
windows AS (
    SELECT m.distributor_id, s.sku_id, s.promotion_id, base_days, promo_days, post_days,
           coalesce(sum(secondary_units) FILTER (WHERE full_date < promo_start), 0) AS base,
           coalesce(sum(secondary_units) FILTER (WHERE full_date BETWEEN promo_start AND promo_end), 0) AS promo,
           coalesce(sum(secondary_units) FILTER (WHERE full_date > promo_end), 0) AS post
    FROM {{db}}.fact_movements m JOIN spans s
      ON s.sku_id = m.sku_id AND full_date BETWEEN date_sub(promo_start, {lk.pre_days}) AND date_add(promo_end, {lk.post_days})
    GROUP BY ALL),
leaks AS (
    SELECT threshold_set, distributor_id, count(DISTINCT sku_id) AS skus FROM windows CROSS JOIN th
    WHERE base_days > 0 AND promo_days > 0 AND post_days > 0 AND {_at_least("base", "min_baseline", "base_days")}
      AND {product("base", "promo_days")} * max_promo_share >= max_promo_share_per * {product("promo", "base_days")}
      AND {_at_least(product("post", "base_days"), "min_post_lift", product("base", "post_days"))}
    GROUP BY threshold_set, distributor_id),
points AS (
    SELECT threshold_set, d.distributor_id, d.distributor_name, d.region, coalesce(spikes, 0) AS stuffing_flags,
           coalesce(skus, 0) AS promo_leak_flags, coalesce(dumps, 0) AS route_dump_events,
           coalesce((2000 * dumped + sold) div nullif(2 * sold, 0), 0) / 10.0D AS bulk_volume_pct,
           least({r.stuffing_cap}, {r.points_per_spike} * coalesce(spikes, 0)) AS stuffing_pts,
           if(coalesce(skus, 0) > 0, {r.promo_points}, 0) AS promo_pts,
           CASE WHEN if(coalesce(sold, 0) > 0, {_at_least(product("100", "dumped"), "route_share_pct", "sold")}, 0 >= route_share_pct) THEN {r.route_share_points}
                WHEN {_at_least("coalesce(dumps, 0)", "repeat_dumps")} THEN {r.route_repeat_points} ELSE 0 END AS route_pts
    FROM {{db}}.dim_distributor d CROSS JOIN th LEFT JOIN totals USING (threshold_set, distributor_id) LEFT JOIN leaks USING (threshold_set, distributor_id))
SELECT threshold_set, distributor_id, distributor_name, region, stuffing_flags, promo_leak_flags, route_dump_events, bulk_volume_pct,
       stuffing_pts, promo_pts, route_pts, stuffing_pts + promo_pts + route_pts AS risk_score,
       CASE WHEN stuffing_pts + promo_pts + route_pts >= {r.critical_at} THEN '{TIER_CRITICAL}'
            WHEN stuffing_pts + promo_pts + route_pts >= {r.high_at} THEN '{TIER_HIGH}'
            WHEN stuffing_pts + promo_pts + route_pts > 0 THEN '{TIER_MEDIUM}' ELSE '{TIER_CLEAN}' END AS risk_tier
FROM points"""


def _quoted(x) -> str:
    return "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"


def install(spark: SparkSession, sf_dir: str, location: str, promotions, sets: Mapping[str, Params], db: str = DATABASE) -> list[str]:
    """Declare tables and views in database ``db`` (its folder is ``location``),
    in place of earlier ones; their names.

    ``promotions`` are rows of the promotion table, ``sets`` the thresholds by
    name.  The sets may differ in thresholds only: windows, points and tiers are
    those of the first."""
    first = next(iter(sets.values()))
    for name, p in sets.items():
        if p.stuffing.min_trail <= 0 or p.leakage.min_baseline <= 0:
            raise ValueError(f"{name}: min_trail and min_baseline must be above 0")
    run = lambda text: spark.sql(text.replace("{db}", db))
    run(f"CREATE DATABASE IF NOT EXISTS {{db}} LOCATION {_quoted(location)}")
    for name, schema in DRIVER_SCHEMAS.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        run(f"DROP TABLE IF EXISTS {{db}}.{name}")
        run(f"CREATE TABLE {{db}}.{name} ({columns}) USING parquet LOCATION {_quoted(table_path(sf_dir, name))}")
    rows = ", ".join("(" + ", ".join([_quoted(i), _quoted(n), _quoted(s), f"DATE'{a}'", f"DATE'{b}'", str(d)]) + ")" for i, n, s, a, b, d in promotions)
    views = {
        "dim_promotion": f"SELECT * FROM VALUES {rows} AS t(promotion_id, promo_name, sku_id, promo_start, promo_end, discount_pct)",
        "dim_threshold": _thresholds(sets),
        "dim_distributor": _DISTRIBUTORS,
        "fact_movements": _MOVEMENTS,
        "vw_fraud_risk_scores": _risk(first),
        "vw_fraud_risk_score": f"SELECT * EXCEPT (threshold_set) FROM {{db}}.vw_fraud_risk_scores WHERE threshold_set = {_quoted(next(iter(sets)))}",
    }
    for name, text in views.items():
        run(f"CREATE OR REPLACE VIEW {{db}}.{name} AS {text}")
    return [f"{db}.{n}" for n in (*DRIVER_SCHEMAS, *views)]


def risk_under(spark: SparkSession, name: str, db: str = DATABASE) -> DataFrame:
    """The score under a named set of thresholds, by the view's name."""
    return spark.sql(f"SELECT * EXCEPT (threshold_set) FROM {db}.vw_fraud_risk_scores WHERE threshold_set = {_quoted(name)}")
