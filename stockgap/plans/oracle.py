"""DuckDB oracle SQL for every registered query.

Written from the definitions, by other means than the Spark code: dense
days, the balance as an inclusive cumulative sum (opening = closing - net),
window means from lists of labelled days, points as joined rule rows, and
rounded roots found by comparing squares.  Means are compared exactly by
cross-multiplying sums and counts.  Parameters are the driver values of
:data:`stockgap.params.DRIVER`.
"""

from __future__ import annotations

ONE = """VALUES ('PROMO001', 'Spring sale on PROMO lines', 'PROMO', DATE '1998-04-10', DATE '1998-04-25', 20)"""
SEVERAL = """VALUES ('PROMO001', 'Spring sale', 'PROMO', DATE '1998-04-10', DATE '1998-04-25', 20),
             ('PROMO002', 'Late spring sale', 'PROMO', DATE '1998-04-20', DATE '1998-05-10', 10),
             ('PROMO003', 'Autumn sale', 'PROMO', DATE '1997-09-01', DATE '1997-09-20', 15),
             ('PROMO004', 'Economy week', 'ECONOMY', DATE '1998-04-12', DATE '1998-04-18', 30)"""


def _root(num: str, den: str) -> str:
    """sqrt(num / den) to one digit, half up: the largest k tenths whose lower
    rounding edge, squared, does not exceed it."""
    return (f"(SELECT coalesce(max(k), 0) FROM range(1, 1001) AS r(k)"
            f" WHERE (2 * k - 1)::HUGEINT * (2 * k - 1) * ({den}) <= 400 * ({num})) / 10.0")


#: a promotion of 16 days from every day on which a SKU was shipped
DAILY = """SELECT sku_id || ' ' || d, 'from ' || d, sku_id, d, d + 15, 10
           FROM (SELECT DISTINCT sku_id, d FROM li WHERE st = 'F' AND qty * p_size > 0)"""


def base(promotions: str = ONE) -> str:
    return """
WITH
li AS (
    SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS distributor_id, p_type AS sku_id, l_linestatus AS st,
           CAST(l_quantity AS BIGINT) AS qty, p_size, l_orderkey
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE p_type IS NOT NULL AND l_linestatus IN ('F', 'O')),
dim_date AS (
    SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_id, CAST(day AS DATE) AS full_date,
           CAST(year(day) AS SMALLINT) AS year, CAST(month(day) AS SMALLINT) AS month,
           CAST(day(day) AS SMALLINT) AS day,
           month(day + INTERVAL 1 DAY) <> month(day) AS is_month_end
    FROM (SELECT unnest(generate_series(min(d)::TIMESTAMP, max(d)::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM li) g),
dim_product AS (SELECT DISTINCT p_type AS sku_id FROM part WHERE p_type IS NOT NULL),
dim_distributor AS (
    SELECT s_suppkey AS distributor_id, s_name AS distributor_name, s_nationkey AS rep_id, r_name AS region
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    WHERE s_suppkey IS NOT NULL),
dim_promotion AS (
    SELECT * FROM (""" + promotions + """)
           AS t(promotion_id, promo_name, sku_id, promo_start, promo_end, discount_pct)),
moved AS (
    SELECT d, distributor_id, sku_id,
           CAST(sum(CASE st WHEN 'F' THEN qty * p_size ELSE 0 END) AS BIGINT) AS bought,
           CAST(sum(CASE st WHEN 'O' THEN qty ELSE 0 END) AS BIGINT) AS sold
    FROM li GROUP BY ALL),
ledger AS (
    SELECT date_id, full_date, distributor_id, sku_id, closing_units - bought + sold AS opening_units,
           bought AS primary_units, sold AS secondary_units, closing_units
    FROM (SELECT c.date_id, c.full_date, k.distributor_id, s.sku_id,
                 coalesce(bought, 0) AS bought, coalesce(sold, 0) AS sold,
                 CAST(sum(coalesce(bought - sold, 0)) OVER (PARTITION BY k.distributor_id, s.sku_id
                      ORDER BY c.full_date) AS BIGINT) AS closing_units
          FROM dim_distributor k, dim_product s, dim_date c
          LEFT JOIN moved m ON m.d = c.full_date AND m.distributor_id = k.distributor_id AND m.sku_id = s.sku_id)),
dist_day AS (
    SELECT c.date_id, c.full_date, c.is_month_end, k.distributor_id, coalesce(m.p, 0) AS primary_units,
           coalesce(m.s, 0) AS secondary_units
    FROM dim_distributor k, dim_date c
    LEFT JOIN (SELECT d, distributor_id, CAST(sum(bought) AS BIGINT) AS p, CAST(sum(sold) AS BIGINT) AS s
               FROM moved GROUP BY ALL) m ON m.d = c.full_date AND m.distributor_id = k.distributor_id),
trail AS (
    SELECT *, count(*) OVER w AS trail_n, CAST(sum(primary_units) OVER w AS BIGINT) AS trail_p,
           CAST(sum(secondary_units) OVER w AS BIGINT) AS trail_s
    FROM dist_day
    WINDOW w AS (PARTITION BY distributor_id ORDER BY full_date
                 RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
stuffing AS (
    SELECT t.distributor_id, distributor_name, full_date AS spike_date, primary_units,
           (2 * trail_p + trail_n) // (2 * trail_n) AS trail_28d_avg,
           CAST((20 * primary_units * trail_n + trail_p) // (2 * trail_p) AS DOUBLE) / 10.0 AS spike_ratio,
           secondary_units, (2 * trail_s + trail_n) // (2 * trail_n) AS trail_sec_avg
    FROM trail t JOIN dim_distributor k ON k.distributor_id = t.distributor_id
    WHERE is_month_end AND trail_p >= 50 * trail_n AND primary_units * trail_n >= 4 * trail_p AND trail_n > 0),
stuffing_counts AS (SELECT distributor_id, count(*) AS spike_days FROM stuffing GROUP BY 1),
marked AS (
    SELECT pr.*, full_date, date_id,
           CASE WHEN full_date < promo_start THEN 'baseline' WHEN full_date <= promo_end THEN 'promo' ELSE 'post' END AS part
    FROM dim_promotion pr JOIN dim_product USING (sku_id)
    JOIN dim_date ON full_date BETWEEN promo_start - 14 AND promo_end + 15),
part_days AS (
    SELECT promotion_id, sku_id, promo_start, promo_end, count(*) FILTER (part = 'baseline') AS base_n,
           count(*) FILTER (part = 'promo') AS promo_n, count(*) FILTER (part = 'post') AS post_n
    FROM marked GROUP BY ALL),
part_units AS (
    SELECT promotion_id, distributor_id, sum(sold) FILTER (part = 'baseline') AS b,
           sum(sold) FILTER (part = 'promo') AS p, sum(sold) FILTER (part = 'post') AS q
    FROM marked k JOIN moved m ON m.d = k.full_date AND m.sku_id = k.sku_id GROUP BY ALL),
windowed AS (
    SELECT n.*, k.distributor_id, CAST(coalesce(b, 0) AS BIGINT) AS base_s, CAST(coalesce(p, 0) AS BIGINT) AS promo_s,
           CAST(coalesce(q, 0) AS BIGINT) AS post_s, l.closing_units AS stock_at_promo_end
    FROM part_days n, dim_distributor k
    LEFT JOIN part_units u ON u.promotion_id = n.promotion_id AND u.distributor_id = k.distributor_id
    LEFT JOIN ledger l ON l.full_date = n.promo_end AND l.distributor_id = k.distributor_id AND l.sku_id = n.sku_id),
leak_flag AS (
    SELECT *, (least(promo_n, base_n, post_n) > 0 AND 10 * promo_s * base_n <= base_s * promo_n
               AND 2 * base_s >= base_n AND 2 * post_s * base_n >= 3 * base_s * post_n) AS is_leak
    FROM windowed),
leak_counts AS (
    SELECT distributor_id, count(DISTINCT sku_id) AS leaked_skus FROM leak_flag WHERE is_leak GROUP BY 1),
leaked AS (
    SELECT w.promotion_id, w.distributor_id, w.sku_id, w.promo_end
    FROM windowed w
    JOIN (SELECT promotion_id, count(full_date) AS n FROM dim_promotion
          LEFT JOIN dim_date ON full_date < promo_start GROUP BY 1) e ON e.promotion_id = w.promotion_id
    LEFT JOIN (SELECT promotion_id, distributor_id, sum(sold) AS s FROM dim_promotion pr
               JOIN moved m ON m.sku_id = pr.sku_id AND d < promo_start GROUP BY ALL) f
         ON f.promotion_id = w.promotion_id AND f.distributor_id = w.distributor_id
    WHERE promo_n > 0 AND n > 0 AND 10 * promo_s * n <= coalesce(s, 0) * promo_n AND 2 * coalesce(s, 0) >= n),
drops AS (
    SELECT distributor_id, o_custkey AS kirana_id, qty AS qty_units
    FROM li LEFT JOIN orders ON o_orderkey = l_orderkey WHERE st = 'O'),
route_stats AS (
    SELECT distributor_id, count(*) AS n, CAST(sum(qty_units) AS BIGINT) AS s1, sum(qty_units ** 2)::HUGEINT AS s2,
           max(qty_units) AS mx, count(*) FILTER (qty_units >= 45) AS bulk_dumps,
           CAST(coalesce(sum(qty_units) FILTER (qty_units >= 45), 0) AS BIGINT) AS bulk_s,
           count(DISTINCT kirana_id) FILTER (qty_units >= 45) AS kiranas_hit_by_dumps
    FROM drops GROUP BY 1),
spread AS (
    SELECT *, n::HUGEINT * s2 - s1::HUGEINT * s1 AS num, n::HUGEINT * mx - s1 AS a FROM route_stats),
route_r AS (
    SELECT *, CASE WHEN n > 1 THEN """ + _root("num", "n::HUGEINT * (n - 1)") + """ END AS std_drop_units,
           CASE WHEN n > 1 AND num > 0 THEN """ + _root("a * a * (n - 1)", "n * num") + """ END AS max_drop_z_score
    FROM spread),
route AS (
    SELECT distributor_id, distributor_name, n AS total_drops,
           CAST((20 * s1 + n) // (2 * n) AS DOUBLE) / 10.0 AS avg_drop_units, mx AS max_drop_units, max_drop_z_score,
           bulk_dumps, kiranas_hit_by_dumps,
           CAST((2000 * bulk_s + s1) // nullif(2 * s1, 0) AS DOUBLE) / 10.0 AS bulk_volume_pct,
           (SELECT arg_max(v, floor_) FROM (VALUES (0, 'OK'), (1, 'SUSPECT - INVESTIGATE'),
            (5, 'FALSIFIED - BULK DUMPING')) AS t(floor_, v) WHERE floor_ <= bulk_dumps) AS verdict
    FROM route_r JOIN dim_distributor USING (distributor_id)),
points AS (
    SELECT distributor_id, 'stuffing' AS rule, 10 AS pts FROM stuffing_counts JOIN range(1, 5) AS r(i) ON spike_days >= i
    UNION ALL SELECT distributor_id, 'promo', 30 FROM leak_counts WHERE leaked_skus > 0
    UNION ALL SELECT distributor_id, 'route', max(pts) FROM (
        SELECT distributor_id, 30 AS pts FROM route_stats WHERE s1 > 0 AND 100 * bulk_s >= 20 * s1
        UNION ALL SELECT distributor_id, 12 FROM route_stats WHERE bulk_dumps >= 5) GROUP BY 1),
tallied AS (
    SELECT distributor_id, sum(pts) FILTER (rule = 'stuffing') AS st, sum(pts) FILTER (rule = 'promo') AS pr,
           sum(pts) FILTER (rule = 'route') AS ro, sum(pts) AS total FROM points GROUP BY 1),
risk AS (
    SELECT k.distributor_id, distributor_name, region, coalesce(spike_days, 0) AS stuffing_flags,
           coalesce(leaked_skus, 0) AS promo_leak_flags, coalesce(bulk_dumps, 0) AS route_dump_events,
           coalesce(CAST((2000 * bulk_s + s1) // nullif(2 * s1, 0) AS DOUBLE) / 10.0, 0.0) AS bulk_volume_pct,
           CAST(coalesce(st, 0) AS BIGINT) AS stuffing_pts, CAST(coalesce(pr, 0) AS INTEGER) AS promo_pts,
           CAST(coalesce(ro, 0) AS INTEGER) AS route_pts, CAST(coalesce(total, 0) AS BIGINT) AS risk_score,
           (SELECT arg_max(tier, floor_) FROM (VALUES (0, 'CLEAN'), (1, 'MEDIUM'), (25, 'HIGH'), (60, 'CRITICAL'))
            AS t(floor_, tier) WHERE floor_ <= coalesce(total, 0)) AS risk_tier
    FROM dim_distributor k
    LEFT JOIN tallied USING (distributor_id) LEFT JOIN stuffing_counts USING (distributor_id)
    LEFT JOIN leak_counts USING (distributor_id) LEFT JOIN route_stats USING (distributor_id))
"""


BASE = base()


def _q(select: str) -> str:
    return BASE + select


_LEDGER = ("SELECT date_id, distributor_id, sku_id, opening_units, primary_units, secondary_units,"
           " closing_units FROM ledger")
ORACLE: dict[str, str] = {}

ORACLE.update({
    "calendar": _q("SELECT * FROM dim_date"),
    "spine": _q("SELECT date_id, distributor_id, sku_id FROM ledger"),
    "daily_primary_units": _q(
        "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, distributor_id, sku_id,"
        " CAST(sum(qty * p_size) AS BIGINT) AS primary_units FROM li WHERE st = 'F' GROUP BY ALL"),
    "daily_secondary_units": _q(
        "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, distributor_id, sku_id,"
        " CAST(sum(qty) AS BIGINT) AS secondary_units FROM li WHERE st = 'O' GROUP BY ALL"),
    "ledger_movements": _q(
        "SELECT date_id, distributor_id, sku_id, primary_units, secondary_units FROM ledger"),
    "running_balance": _q(
        "SELECT date_id, distributor_id, sku_id, closing_units - opening_units AS net_units,"
        " opening_units FROM ledger"),
    "ledger": _q(_LEDGER),
    "ledger_stored": _q(_LEDGER),
    "ledger_range_rebuild": _q(_LEDGER),
    "ledger_month_rebuild": _q(_LEDGER + " WHERE year(full_date) < (SELECT max(year) FROM dim_date)"),
    "ledger_runs": _q(
        "SELECT distributor_id, sku_id, full_date AS from_date, CAST(coalesce(lead(full_date) OVER ("
        "  PARTITION BY distributor_id, sku_id ORDER BY full_date) - 1, (SELECT max(full_date) FROM dim_date)) AS DATE)"
        "  AS to_date, opening_units, primary_units, secondary_units, closing_units"
        " FROM ledger l WHERE full_date = (SELECT min(full_date) FROM dim_date) OR EXISTS (SELECT 1 FROM moved m"
        "  WHERE m.d = l.full_date AND m.distributor_id = l.distributor_id AND m.sku_id = l.sku_id)"),
    "ledger_sanity": _q(
        "SELECT l.*, e.n AS expected_rows, recon_rows = e.n AS is_complete FROM"
        " (SELECT count(*) AS recon_rows, count(DISTINCT distributor_id) AS distributors,"
        "  count(DISTINCT sku_id) AS skus FROM ledger) l,"
        " (SELECT CAST((SELECT count(*) FROM dim_date) * (SELECT count(*) FROM dim_product)"
        "  * count(DISTINCT distributor_id) AS BIGINT) AS n FROM dim_distributor) e"),
    "negative_stock": _q(_LEDGER + " WHERE closing_units < 0"),
    "dist_day": _q("SELECT date_id, distributor_id, primary_units, secondary_units FROM dist_day"),
    "dist_day_named": _q(
        "SELECT date_id, full_date, is_month_end, distributor_id, distributor_name, primary_units, secondary_units"
        " FROM dist_day JOIN dim_distributor USING (distributor_id)"),
    "trailing_28d": _q(
        "SELECT distributor_id, date_id, primary_units, secondary_units, trail_n AS trail_days,"
        " coalesce(trail_p, 0) AS trail_primary_sum, coalesce(trail_s, 0) AS trail_secondary_sum,"
        " (2 * trail_p + trail_n) // nullif(2 * trail_n, 0) AS trail_28d_avg,"
        " (2 * trail_s + trail_n) // nullif(2 * trail_n, 0) AS trail_sec_avg FROM trail"),
    "stuffing": _q("SELECT * FROM stuffing"),
    "stuffing_stored": _q("SELECT * FROM stuffing"),
    "stuffing_counts": _q("SELECT * FROM stuffing_counts"),
    "csv_round_trip": _q(
        "SELECT full_date, is_month_end, distributor_id, sku_id, CAST(sum(qty) AS BIGINT) AS secondary_units"
        " FROM li JOIN dim_date ON full_date = d WHERE st = 'O' GROUP BY ALL"),
    "view_risk": _q("SELECT distributor_id, risk_score, risk_tier FROM risk WHERE risk_score > 0"),
})


def _round1(num: str, den: str) -> str:
    return f"CAST((20 * ({num}) + ({den})) // NULLIF(2 * ({den}), 0) AS DOUBLE) / 10.0"


_WINDOW_ROWS = (
    "SELECT promotion_id, l.distributor_id, l.sku_id, l.date_id, l.full_date, part AS promo_window,"
    " secondary_units, closing_units FROM marked k JOIN ledger l ON l.full_date = k.full_date AND l.sku_id = k.sku_id")
_WINDOWS = (
    "SELECT promotion_id, distributor_id, sku_id,"
    " base_n AS baseline_days, base_s AS baseline_units,"
    f" {_round1('base_s', 'base_n')} AS baseline_daily_units,"
    " promo_n AS promo_days, promo_s AS promo_units,"
    f" {_round1('promo_s', 'promo_n')} AS promo_daily_units,"
    " post_n AS post_days, post_s AS post_units,"
    f" {_round1('post_s', 'post_n')} AS post_promo_units FROM windowed")
_LEAKAGE = (
    "SELECT promotion_id, distributor_id, sku_id,"
    f" {_round1('base_s', 'base_n')} AS baseline_daily_units,"
    f" {_round1('promo_s', 'promo_n')} AS promo_daily_units,"
    f" {_round1('post_s', 'post_n')} AS post_promo_units,"
    " stock_at_promo_end, if(is_leak, 'LEAKAGE - HOARD & DUMP', 'OK') AS verdict FROM leak_flag")
_YESTERDAY = (
    "SELECT promotion_id, distributor_id, sku_id, promo_end, full_date, secondary_units, lag(secondary_units) OVER ("
    "PARTITION BY promotion_id, distributor_id, sku_id ORDER BY full_date) AS prev_day_units"
    " FROM leaked JOIN ledger USING (distributor_id, sku_id)")
_DUMP = (
    "SELECT distributor_id, sku_id, min(full_date) AS resumed_selling_on,"
    " arg_min(secondary_units, full_date) AS units_sold_that_day"
    f" FROM ({_YESTERDAY}) x WHERE prev_day_units = 0 AND secondary_units > 0 AND full_date > promo_end GROUP BY ALL")

ORACLE.update({
    "promo_calendar": _q(
        "SELECT promotion_id, promo_name, sku_id, promo_start, promo_end, discount_pct,"
        " count(*) FILTER (full_date BETWEEN promo_start - 14 AND promo_start - 1) AS baseline_days,"
        " count(*) FILTER (full_date BETWEEN promo_start AND promo_end) AS promo_days,"
        " count(*) FILTER (full_date BETWEEN promo_end + 1 AND promo_end + 15) AS post_days"
        " FROM dim_promotion JOIN dim_product USING (sku_id), dim_date GROUP BY ALL"),
    "promo_window_rows": _q(_WINDOW_ROWS),
    "promo_window_rows_several": base(SEVERAL) + _WINDOW_ROWS,
    "promo_windows": _q(_WINDOWS),
    "promo_windows_several": base(SEVERAL) + _WINDOWS,
    "stock_at_promo_end": _q(
        "SELECT promotion_id, distributor_id, sku_id, stock_at_promo_end FROM windowed"),
    "leakage": _q(_LEAKAGE),
    "leakage_stored": _q(_LEAKAGE),
    "leakage_month_stored": _q(_LEAKAGE),
    "leaks_of_many": base(DAILY) + "SELECT * FROM (" + _LEAKAGE + ") WHERE verdict <> 'OK'",
    "leakage_several": base(SEVERAL) + _LEAKAGE,
    "leaked_pairs": _q("SELECT * FROM leaked"),
    "leak_counts": _q("SELECT * FROM leak_counts"),
    "prev_day_units": _q(_YESTERDAY),
    "dump_day": _q(_DUMP),
    "dump_day_several": base(SEVERAL) + _DUMP,
})

_TOP = ("SELECT distributor_id, distributor_name, region, stuffing_flags, promo_leak_flags,"
        " route_dump_events, stuffing_pts, promo_pts, route_pts, risk_score, risk_tier"
        " FROM risk ORDER BY risk_score DESC, distributor_id LIMIT {n}")

ORACLE.update({
    "drop_stats": _q(
        "SELECT distributor_id, n AS total_drops,"
        f" {_round1('s1', 'n')} AS avg_drop_units,"
        " std_drop_units, mx AS max_drop_units FROM route_r"),
    "drop_zscore": _q("SELECT distributor_id, max_drop_z_score FROM route"),
    "bulk_drops": _q("SELECT distributor_id, bulk_dumps FROM route_stats"),
    "bulk_stores": _q(
        "SELECT distributor_id, COUNT(DISTINCT kirana_id) AS kiranas_hit_by_dumps"
        " FROM drops WHERE qty_units >= 45 GROUP BY distributor_id"),
    "bulk_volume_share": _q(
        f"SELECT distributor_id, {_round1('100 * bulk_s', 's1')} AS bulk_volume_pct"
        " FROM route_stats"),
    "route": _q("SELECT * FROM route"),
    "risk_score": _q("SELECT * FROM risk"),
    "risk_score_stored": _q("SELECT * FROM risk"),
    "risk_top10": _q(_TOP.format(n=10)),
    "risk_top8": _q(_TOP.format(n=8)),
    "risk_kpis": _q(
        "SELECT COUNT(*) AS distributors, COUNT(*) FILTER (WHERE risk_tier = 'HIGH') AS high_risk,"
        " CAST(COALESCE(SUM(stuffing_flags), 0) AS BIGINT) AS stuffing,"
        " CAST(COALESCE(SUM(route_dump_events), 0) AS BIGINT) AS dumps FROM risk"),
})

_BUCKET = ("CASE WHEN qty_units <= 5 THEN '1-5' WHEN qty_units <= 10 THEN '6-10'"
           " WHEN qty_units <= 15 THEN '11-15' WHEN qty_units <= 20 THEN '16-20'"
           " WHEN qty_units <= 25 THEN '21-25' WHEN qty_units <= 30 THEN '26-30'"
           " WHEN qty_units <= 40 THEN '31-40' ELSE '40+' END")
_DUMPER = "(SELECT distributor_id FROM route_stats ORDER BY bulk_dumps DESC, distributor_id LIMIT 1)"
_BUCKETS = (
    "SELECT " + _BUCKET + " AS bucket,"
    " CASE WHEN distributor_id = " + _DUMPER + " THEN CAST(" + _DUMPER + " AS VARCHAR)"
    " || ' (falsifier)' ELSE 'All other distributors' END AS cohort,"
    " COUNT(*) AS drop_count FROM drops GROUP BY 1, 2")

ORACLE.update({
    "pair_series_subject": _q(
        "SELECT full_date, secondary_units FROM ledger WHERE distributor_id = 3 AND sku_id = 'STANDARD'"
        " AND full_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"),
    "drop_size_buckets_subject": _q(_BUCKETS.replace(_DUMPER, "3")),
    # the distributor first, then its days only
    "distributor_series": _q(
        ", pick AS MATERIALIZED (SELECT d.distributor_id FROM dim_distributor d"
        "   LEFT JOIN stuffing_counts st ON st.distributor_id = d.distributor_id"
        "   ORDER BY st.spike_days DESC NULLS LAST, d.distributor_id LIMIT 1)"
        " SELECT full_date, CAST(coalesce(sum(bought), 0) AS BIGINT) AS primary_units"
        " FROM dim_date LEFT JOIN (SELECT moved.* FROM moved JOIN pick USING (distributor_id)) m ON m.d = full_date GROUP BY full_date"),
    "pair_series": _q(
        "SELECT r.full_date, r.secondary_units FROM ledger r,"
        " (SELECT lf.distributor_id, lf.sku_id, pr.promo_start, pr.promo_end FROM leak_flag lf"
        "  JOIN dim_promotion pr ON pr.promotion_id = lf.promotion_id"
        "  ORDER BY lf.is_leak DESC, lf.distributor_id, lf.promotion_id LIMIT 1) k"
        " WHERE r.distributor_id = k.distributor_id AND r.sku_id = k.sku_id"
        " AND r.full_date BETWEEN CAST(k.promo_start - INTERVAL 21 DAY AS DATE)"
        " AND CAST(k.promo_end + INTERVAL 36 DAY AS DATE) ORDER BY r.full_date"),
    "spike_overlay": _q(
        "SELECT distributor_id, full_date, primary_units,"
        " CASE WHEN trail_n > 0 THEN CAST(trail_p AS DOUBLE) / CAST(trail_n AS DOUBLE) END"
        " AS trail_mean,"
        " CASE WHEN trail_n > 0 THEN primary_units * trail_n >= 4 * trail_p"
        " ELSE primary_units >= 0 END AS flagged FROM trail"),
    "drop_size_buckets": _q(_BUCKETS),
    "drop_size_pivot": _q(
        "SELECT o.bucket, o.bucket_order,"
        " CAST(COALESCE(SUM(b.drop_count) FILTER (WHERE b.cohort <> 'All other distributors'), 0)"
        " AS BIGINT) AS falsifier_drops,"
        " CAST(COALESCE(SUM(b.drop_count) FILTER (WHERE b.cohort = 'All other distributors'), 0)"
        " AS BIGINT) AS other_drops"
        " FROM (VALUES ('1-5', 0), ('6-10', 1), ('11-15', 2), ('16-20', 3), ('21-25', 4),"
        " ('26-30', 5), ('31-40', 6), ('40+', 7)) AS o(bucket, bucket_order)"
        " LEFT JOIN (" + _BUCKETS + ") b ON b.bucket = o.bucket"
        " GROUP BY o.bucket, o.bucket_order ORDER BY o.bucket_order"),
})


def _dup(table: str, keys: str, name: str) -> str:
    return (f"SELECT '{name}' AS check_name, COUNT(*) AS duplicate_keys,"
            f" CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows"
            f" FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1) x")


def _nulls(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name,"
        f" COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {table}" for c in cols)


def _orphan(child: str, fk: str, parent: str, pk: str, name: str) -> str:
    return (f"SELECT '{name}' AS check_name, COUNT(*) AS orphan_keys,"
            f" CAST(COALESCE(SUM(n), 0) AS BIGINT) AS orphan_rows FROM"
            f" (SELECT {fk} AS k, COUNT(*) AS n FROM {child} WHERE {fk} IS NOT NULL GROUP BY {fk}) c"
            f" WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.k)")


def _check(table: str, ok: str, name: str) -> str:
    return (f"SELECT '{name}' AS check_name, COUNT(*) AS checked_rows,"
            f" COUNT(*) FILTER (WHERE NOT COALESCE({ok}, TRUE)) AS violations FROM {table}")


ORACLE.update({
    "dq_duplicate_keys": _q(" UNION ALL ".join([
        _dup("lineitem", "l_orderkey, l_linenumber", "lineitem(l_orderkey, l_linenumber)"),
        _dup("orders", "o_orderkey", "orders(o_orderkey)"),
        _dup("part", "p_partkey", "part(p_partkey)"),
        _dup("supplier", "s_suppkey", "supplier(s_suppkey)"),
        _dup("customer", "c_custkey", "customer(c_custkey)"),
        _dup("nation", "n_nationkey", "nation(n_nationkey)"),
        _dup("region", "r_regionkey", "region(r_regionkey)"),
        _dup("dim_date", "date_id", "calendar(date_id)"),
        _dup("dim_date", "full_date", "calendar(full_date)"),
        _dup("dim_promotion", "promotion_id", "promotion(promotion_id)"),
    ])),
    "dq_null_counts": _q(" UNION ALL ".join([
        _nulls("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                            "l_linestatus", "l_shipdate"]),
        _nulls("orders", ["o_orderkey", "o_custkey"]),
        _nulls("part", ["p_partkey", "p_type", "p_size"]),
        _nulls("supplier", ["s_suppkey", "s_name", "s_nationkey"]),
        _nulls("customer", ["c_custkey", "c_name", "c_nationkey"]),
        _nulls("nation", ["n_nationkey", "n_name", "n_regionkey"]),
        _nulls("region", ["r_regionkey", "r_name"]),
        *(f"SELECT 'orders left join lineitem' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL)"
          " AS null_count FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"
          for c in ("o_orderkey", "l_orderkey", "l_partkey", "l_quantity")),
    ])),
    "dq_orphans": _q(" UNION ALL ".join([
        _orphan("lineitem", "l_orderkey", "orders", "o_orderkey", "lineitem.l_orderkey -> orders"),
        _orphan("lineitem", "l_partkey", "part", "p_partkey", "lineitem.l_partkey -> part"),
        _orphan("lineitem", "l_suppkey", "supplier", "s_suppkey", "lineitem.l_suppkey -> supplier"),
        _orphan("orders", "o_custkey", "customer", "c_custkey", "orders.o_custkey -> customer"),
        _orphan("orders", "o_orderkey", "lineitem", "l_orderkey", "orders.o_orderkey -> lineitem"),
        _orphan("supplier", "s_nationkey", "nation", "n_nationkey", "supplier.s_nationkey -> nation"),
        _orphan("customer", "c_nationkey", "nation", "n_nationkey", "customer.c_nationkey -> nation"),
        _orphan("nation", "n_regionkey", "region", "r_regionkey", "nation.n_regionkey -> region"),
        _orphan("dim_promotion", "sku_id", "dim_product", "sku_id", "promotion.sku_id -> product"),
    ])),
    "dq_range": _q(" UNION ALL ".join([
        _check("lineitem", "l_quantity >= 0", "lineitem.l_quantity >= 0"),
        _check("lineitem", "l_quantity = floor(l_quantity)", "lineitem.l_quantity is whole"),
        _check("lineitem", "l_quantity <= 45", "lineitem.l_quantity <= 45 (no bulk drop)"),
        _check("part", "p_size > 0", "part.p_size > 0 (units per case)"),
        _check("dim_promotion", "discount_pct BETWEEN 0 AND 100",
               "promotion.discount_pct between 0 and 100"),
    ])),
    "dq_ledger_identity": _q(
        "SELECT 'ledger closing = opening + primary - secondary' AS check_name,"
        " COUNT(*) AS checked_rows,"
        " COUNT(*) FILTER (WHERE closing_units <> opening_units + primary_units - secondary_units)"
        " AS violations FROM ledger"
        " UNION ALL SELECT 'ledger opening = previous closing', COUNT(*),"
        " COUNT(*) FILTER (WHERE opening_units <> COALESCE(prev_closing, 0)) FROM"
        " (SELECT opening_units, LAG(closing_units) OVER (PARTITION BY distributor_id, sku_id"
        "  ORDER BY date_id) AS prev_closing FROM ledger) x"
        " UNION ALL " + _check("ledger", "closing_units >= 0", "ledger closing >= 0") +
        " UNION ALL " + _check("dim_promotion", "promo_end >= promo_start",
                               "promotion.promo_end >= promo_start")),
})


def _bad(table: str, key: list[str], rules: list[tuple[str, str]]) -> str:
    """Key values with rows that break a rule (name, condition of breaking)."""
    text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in key)
    twice = f"unique({', '.join(key)})"
    marks = ", ".join(f"CASE WHEN bool_or({cond}) THEN '{name}' END" for name, cond in rules)
    return (f"SELECT '{table}' AS table_name, {text} AS row_key, count(*) AS n_rows,"
            f" array_to_string(list_filter([{marks}, CASE WHEN count(*) > 1 THEN '{twice}' END], lambda x: x IS NOT NULL), ',') AS checks"
            f" FROM {table} GROUP BY {', '.join(key)} HAVING checks <> ''")


def _gone(fk: str, parent: str, pk: str) -> tuple[str, str]:
    return f"{fk} -> {parent}", f"{fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)"


def _null(*cols: str) -> list[tuple[str, str]]:
    return [(f"{c} not null", f"{c} IS NULL") for c in cols]


ORACLE["dq_violations"] = " UNION ALL ".join([
    _bad("lineitem", ["l_orderkey", "l_linenumber"], [
        *_null("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus", "l_shipdate"),
        ("l_quantity >= 0", "l_quantity < 0"), ("l_quantity is whole", "l_quantity <> floor(l_quantity)"),
        ("l_quantity <= 45", "l_quantity > 45"),
        _gone("l_orderkey", "orders", "o_orderkey"), _gone("l_partkey", "part", "p_partkey"), _gone("l_suppkey", "supplier", "s_suppkey")]),
    _bad("orders", ["o_orderkey"], [*_null("o_orderkey", "o_custkey"), _gone("o_custkey", "customer", "c_custkey"),
                                    _gone("o_orderkey", "lineitem", "l_orderkey")]),
    _bad("part", ["p_partkey"], [*_null("p_partkey", "p_type", "p_size"), ("p_size > 0", "p_size <= 0")]),
    _bad("supplier", ["s_suppkey"], [*_null("s_suppkey", "s_name", "s_nationkey"), _gone("s_nationkey", "nation", "n_nationkey")]),
    _bad("customer", ["c_custkey"], [*_null("c_custkey", "c_name", "c_nationkey"), _gone("c_nationkey", "nation", "n_nationkey")]),
    _bad("nation", ["n_nationkey"], [*_null("n_nationkey", "n_name", "n_regionkey"), _gone("n_regionkey", "region", "r_regionkey")]),
    _bad("region", ["r_regionkey"], _null("r_regionkey", "r_name")),
])


def _swap(text: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        if old not in text:
            raise ValueError(old)
        text = text.replace(old, new)
    return text


ORACLE.update({
    "catalog_risk": _q("SELECT * FROM risk"),
    "catalog_risk_strict": _swap(_q("SELECT * FROM risk"), ("primary_units * trail_n >= 4 * trail_p", "primary_units * trail_n >= 3 * trail_p"),
                                 ("qty_units >= 45", "qty_units >= 40"), ("100 * bulk_s >= 20 * s1", "100 * bulk_s >= 35 * s1")),
    "bulk_stores_months": _q(
        "SELECT distributor_id, COUNT(DISTINCT kirana_id) AS kiranas_hit_by_dumps FROM drops"
        " WHERE qty_units >= 45 AND d BETWEEN DATE '1997-03-01' AND DATE '1998-06-30' GROUP BY distributor_id").replace(
        "SELECT distributor_id, o_custkey AS kirana_id, qty AS qty_units", "SELECT distributor_id, o_custkey AS kirana_id, qty AS qty_units, d"),
})
