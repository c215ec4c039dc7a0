"""SQL for the named queries, in DuckDB's dialect, over the same Parquet tables."""

from __future__ import annotations

from trolley.sources.order_lines import COLUMNS

ORACLES: dict[str, str] = {}

HISTORY = """
history AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
         ROW_NUMBER() OVER visits AS order_number,
         DATE_DIFF('day', LAG(CAST(o_orderdate AS DATE)) OVER visits, CAST(o_orderdate AS DATE)) AS days
  FROM orders
  WINDOW visits AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
)"""

RELATION = f"""{HISTORY},
global_relation AS (
  SELECT l_orderkey AS order_id, o_custkey AS user_id,
         CAST(order_number AS INTEGER) AS order_number,
         CAST(DAYOFWEEK(order_date) AS INTEGER) AS order_dow,
         CAST(l_orderkey % 24 AS INTEGER) AS order_hour_of_day,
         CAST(days AS DOUBLE) AS days_since_prior_order,
         l_partkey AS product_id,
         CAST(l_linenumber AS INTEGER) AS add_to_cart_order,
         CAST(order_number > MIN(order_number) OVER (PARTITION BY o_custkey, p_name) AS INTEGER) AS reordered,
         CAST(SPLIT_PART(p_brand, '#', 2) AS INTEGER) AS department_id,
         p_brand AS department, p_name AS product_name, order_date
  FROM lineitem
  LEFT JOIN history ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

COLUMN_LIST = ", ".join(COLUMNS)

_in_site_1 = "department IN (" + ", ".join(f"'Brand#{n}'" for n in range(1, 9)) + ")"
_in_site_2 = "department IN (" + ", ".join(f"'Brand#{n}'" for n in range(9, 26)) + ")"
SITES = f"""{RELATION},
h_site_1 AS (SELECT {COLUMN_LIST} FROM global_relation WHERE {_in_site_1}),
h_site_2 AS (SELECT {COLUMN_LIST} FROM global_relation WHERE {_in_site_2})"""

_digest = "MD5(" + " || ".join(
    f"COALESCE(LENGTH(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in COLUMNS
) + ")"
KEYED = f"""{RELATION},
keyed AS (
  SELECT ROW_NUMBER() OVER (ORDER BY {_digest}) - 1 AS _row_id, {COLUMN_LIST} FROM global_relation
),
v_site_1 AS (
  SELECT _row_id, order_id, user_id, product_id, order_number, order_dow, order_hour_of_day, days_since_prior_order
  FROM keyed
),
v_site_2 AS (
  SELECT _row_id, order_id, user_id, product_id, add_to_cart_order, reordered, department_id, department, product_name
  FROM keyed
)"""

# The median covers half of the known values: the value at rank ceil(n / 2).
MEDIAN = """
known AS (
  SELECT days_since_prior_order AS v, ROW_NUMBER() OVER (ORDER BY days_since_prior_order) AS place,
         COUNT(*) OVER () AS n
  FROM global_relation WHERE days_since_prior_order IS NOT NULL
),
median AS (SELECT MIN(v) AS m FROM known WHERE place >= CEIL(0.5 * n))"""

CLEAN = f"""{RELATION},{MEDIAN},
clean AS (
  SELECT order_id, user_id, order_number, order_dow, order_hour_of_day,
         COALESCE(days_since_prior_order, (SELECT m FROM median)) AS days_since_prior_order,
         product_id, add_to_cart_order, reordered, department_id,
         COALESCE(department, 'unknown') AS department, COALESCE(product_name, 'unknown') AS product_name
  FROM global_relation
  WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
)"""


def define(name: str, tables: str, text: str) -> None:
    ORACLES[name] = f"WITH {tables}\n{text}" if tables else text


def half_up(part: str, whole: str, digits: int, scale: int = 1) -> str:
    """scale * part / whole rounded half up, in whole numbers."""
    power = 10**digits
    return (
        f"CAST((CAST({part} AS BIGINT) * {2 * scale * power} + {whole}) // ({whole} * 2) AS DOUBLE) / {power}.0"
    )


def rate(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / {whole}"


# --- sources, sinks, views ------------------------------------------------

WHOLE = f"SELECT {COLUMN_LIST} FROM global_relation"
for name in ("scan_csv_typed", "sink_parquet", "reconstruct_horizontal"):
    define(name, RELATION, WHOLE)
define("load_fragments", RELATION, WHOLE)
define("reconstruct_vertical", RELATION, WHOLE)
# Whole numbers of an inferred schema come back as 32-bit where they fit.
define(
    "scan_csv_inferred",
    RELATION,
    "SELECT CAST(order_id AS INTEGER) AS order_id, CAST(user_id AS INTEGER) AS user_id, order_number, order_dow, "
    "order_hour_of_day, days_since_prior_order, CAST(product_id AS INTEGER) AS product_id, add_to_cart_order, "
    "reordered, department_id, department, product_name FROM global_relation",
)
define("scan_parquet", "", "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem")

SHARES = f"""
SELECT site, n AS row_count, {rate('n * 100', '(SELECT COUNT(*) FROM global_relation)')} AS percentage
FROM (SELECT 'site_1' AS site, COUNT(*) AS n FROM h_site_1
      UNION ALL SELECT 'site_2', COUNT(*) FROM h_site_2) AS sizes"""
define("save_fragments", SITES, SHARES)
define("fragment_shares", SITES, SHARES)
define(
    "register_views",
    SITES,
    """
SELECT 'global_relation' AS view_name, COUNT(*) AS row_count FROM global_relation
UNION ALL SELECT 'h_site_1', COUNT(*) FROM h_site_1
UNION ALL SELECT 'h_site_2', COUNT(*) FROM h_site_2
UNION ALL SELECT 'v_site_1', COUNT(*) FROM global_relation
UNION ALL SELECT 'v_site_2_product_info', COUNT(*) FROM global_relation""",
)
define(
    "bootstrap_fragments",
    SITES,
    """
SELECT 'relation' AS table_name, COUNT(*) AS row_count FROM global_relation
UNION ALL SELECT 'site_1', COUNT(*) FROM h_site_1
UNION ALL SELECT 'site_2', COUNT(*) FROM h_site_2
UNION ALL SELECT 'site_1_order_info', COUNT(*) FROM global_relation
UNION ALL SELECT 'site_2_product_info', COUNT(*) FROM global_relation""",
)
define(
    "run_sql",
    RELATION,
    """
SELECT department, order_dow, COUNT(*) AS line_count, CAST(SUM(reordered) AS BIGINT) AS reorders
FROM global_relation GROUP BY department, order_dow ORDER BY department, order_dow LIMIT 200""",
)
define("repartition", RELATION, "SELECT department, COUNT(*) AS line_count FROM global_relation GROUP BY department")

# --- profiling and cleaning -----------------------------------------------

define(
    "null_profile",
    RELATION,
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls FROM global_relation" for c in COLUMNS
    )
    + ") AS profile WHERE nulls > 0",
)
define(
    "null_cause_orders",
    RELATION,
    "SELECT DISTINCT order_number FROM global_relation WHERE days_since_prior_order IS NULL",
)
define(
    "impute_median",
    f"{RELATION},{MEDIAN}",
    "SELECT order_id, product_id, add_to_cart_order, "
    "COALESCE(days_since_prior_order, (SELECT m FROM median)) AS days_since_prior_order FROM global_relation",
)
define(
    "impute_sentinel",
    RELATION,
    "SELECT order_id, product_id, add_to_cart_order, "
    "COALESCE(days_since_prior_order, -1.0) AS days_since_prior_order FROM global_relation",
)
define(
    "impute_unknown",
    RELATION,
    """
SELECT CASE WHEN department_id % 3 = 0 THEN 'unknown' ELSE department END AS department, COUNT(*) AS line_count
FROM global_relation GROUP BY 1""",
)
define(
    "drop_null_keys",
    RELATION,
    "SELECT order_id, user_id, order_number, product_id FROM global_relation WHERE order_number > 1",
)
define(
    "cast_ids",
    RELATION,
    """
SELECT CASE WHEN department_id <> 1 THEN order_id END AS order_id,
       CASE WHEN department_id <> 1 THEN product_id END AS product_id,
       CASE WHEN department_id <> 1 THEN department_id END AS department_id
FROM global_relation""",
)
define("clean_data", CLEAN, "SELECT * FROM clean")
define(
    "cleaning_report",
    CLEAN,
    """
SELECT (SELECT COUNT(*) FROM global_relation) AS rows_before, COUNT(*) AS rows_after,
       (SELECT COUNT(*) FROM global_relation) - COUNT(*) AS rows_removed FROM clean""",
)
POSITIONS = f"""{RELATION},
placed AS (
  SELECT add_to_cart_order AS v, ROW_NUMBER() OVER (ORDER BY add_to_cart_order) AS place, COUNT(*) OVER () AS n
  FROM global_relation
),
bounds AS (
  SELECT MIN(CASE WHEN place >= CEIL(0.25 * n) THEN v END) AS q1,
         MIN(CASE WHEN place >= CEIL(0.75 * n) THEN v END) AS q3
  FROM placed
)"""
define("approx_quantiles", POSITIONS, "SELECT q1, q3 FROM bounds")
define(
    "iqr_outlier_report",
    POSITIONS,
    """
SELECT CAST(q1 AS DOUBLE) AS q1, CAST(q3 AS DOUBLE) AS q3, CAST(q3 - q1 AS DOUBLE) AS iqr,
       CAST(q3 + 1.5 * (q3 - q1) AS DOUBLE) AS threshold, CAST(MAX(v) AS DOUBLE) AS max_value,
       COUNT(*) FILTER (WHERE v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM placed, bounds GROUP BY q1, q3""",
)
define(
    "relation_profile",
    RELATION,
    f"SELECT COUNT(*) AS row_count, CAST({len(COLUMNS)} AS INTEGER) AS column_count FROM global_relation",
)

# --- feature tables -------------------------------------------------------

define(
    "user_features",
    CLEAN,
    f"""
SELECT user_id, COUNT(DISTINCT order_id) AS total_orders, COUNT(product_id) AS total_items_purchased,
       {rate('SUM(days_since_prior_order)', 'COUNT(*)')} AS avg_days_between_orders,
       {rate('SUM(reordered)', 'COUNT(*)')} AS avg_reorder_rate,
       COUNT(DISTINCT department) AS unique_departments
FROM clean GROUP BY user_id""",
)
define(
    "user_features_nb",
    RELATION,
    f"""
SELECT user_id, MAX(order_number) AS total_orders,
       SUM(days_since_prior_order) / NULLIF(COUNT(days_since_prior_order), 0) AS avg_days_between_orders,
       COUNT(product_id) AS total_items_purchased, {rate('SUM(reordered)', 'COUNT(*)')} AS avg_reorder_rate
FROM (SELECT user_id, order_number, product_id, reordered,
             NULLIF(COALESCE(days_since_prior_order, -1), -1) AS days_since_prior_order
      FROM global_relation) AS filled
GROUP BY user_id""",
)
define(
    "order_features",
    RELATION,
    f"""
SELECT order_id, MIN(user_id) AS user_id, MIN(order_dow) AS order_dow, MIN(order_hour_of_day) AS order_hour_of_day,
       COUNT(product_id) AS basket_size, {rate('SUM(reordered)', 'COUNT(*)')} AS reorder_ratio,
       COUNT(DISTINCT department) AS department_count
FROM global_relation GROUP BY order_id""",
)
define(
    "order_features_nb",
    RELATION,
    "SELECT order_id, user_id, COUNT(product_id) AS total_items FROM global_relation GROUP BY order_id, user_id",
)


def rfm_over(days: str) -> str:
    return f"""
rfm AS (
  SELECT user_id, MAX(order_number) AS frequency,
         COALESCE(SUM(CASE WHEN {days} >= 0 THEN {days} END) / NULLIF(COUNT(CASE WHEN {days} >= 0 THEN 1 END), 0), 0)
           AS recency,
         COUNT(product_id) AS monetary
  FROM global_relation GROUP BY user_id
)"""


RFM = f"{RELATION},{MEDIAN},{rfm_over('COALESCE(days_since_prior_order, (SELECT m FROM median))')}"
define("rfm", RFM, "SELECT * FROM rfm")
define("rfm_nb", f"{RELATION},{rfm_over('COALESCE(days_since_prior_order, -1)')}", "SELECT * FROM rfm")
SCORED = f"""{RFM},
scored AS (
  SELECT user_id, frequency, recency, monetary,
         (frequency - AVG(frequency) OVER ()) / STDDEV_SAMP(frequency) OVER () AS frequency_zscore,
         (recency - AVG(recency) OVER ()) / STDDEV_SAMP(recency) OVER () AS recency_zscore,
         (monetary - AVG(monetary) OVER ()) / STDDEV_SAMP(monetary) OVER () AS monetary_zscore
  FROM rfm
)"""
_scores = """
SELECT user_id, frequency, recency, monetary, ROUND(frequency_zscore, 6) AS frequency_zscore,
       ROUND(recency_zscore, 6) AS recency_zscore, ROUND(monetary_zscore, 6) AS monetary_zscore FROM scored"""
_inside = "ABS(frequency_zscore) < 3 AND ABS(recency_zscore) < 3 AND ABS(monetary_zscore) < 3"
define("rfm_zscores", SCORED, _scores)
define("rfm_trimmed", f"{SCORED}, inside AS (SELECT * FROM scored WHERE {_inside})", _scores.replace("FROM scored", "FROM inside"))
define(
    "rfm_trim_report",
    SCORED,
    f"""
SELECT COUNT(*) AS users_before, COUNT(*) FILTER (WHERE {_inside}) AS users_after,
       COUNT(*) - COUNT(*) FILTER (WHERE {_inside}) AS users_removed FROM scored""",
)

# --- exploration ----------------------------------------------------------

define(
    "top_departments",
    RELATION,
    "SELECT department, COUNT(product_id) AS count FROM global_relation "
    "GROUP BY department ORDER BY count DESC, department LIMIT 15",
)
define(
    "top_departments_nb",
    RELATION,
    "SELECT department, COUNT(*) AS count FROM global_relation GROUP BY department ORDER BY count DESC, department LIMIT 10",
)
define(
    "top_products",
    RELATION,
    "SELECT product_name, COUNT(*) AS count FROM global_relation "
    "GROUP BY product_name ORDER BY count DESC, product_name LIMIT 20",
)
define(
    "orders_by_dow",
    RELATION,
    """
SELECT order_dow, COUNT(DISTINCT order_id) AS orders,
       ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][order_dow + 1] AS day
FROM global_relation GROUP BY order_dow""",
)
define(
    "orders_by_dow_share",
    RELATION,
    """
SELECT order_dow, count,
       ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][order_dow + 1] AS day_name,
       CAST(count * 100 AS DOUBLE) / SUM(count) OVER () AS percentage
FROM (SELECT order_dow, COUNT(DISTINCT order_id) AS count FROM global_relation GROUP BY order_dow) AS days""",
)
define(
    "orders_by_hour",
    RELATION,
    "SELECT order_hour_of_day, COUNT(DISTINCT order_id) AS orders FROM global_relation GROUP BY order_hour_of_day",
)
define(
    "reorder_rate_by_department",
    RELATION,
    f"SELECT department, {rate('SUM(reordered)', 'COUNT(*)')} AS reorder_rate, COUNT(product_id) AS total_orders "
    "FROM global_relation GROUP BY department",
)

# --- horizontal fragments -------------------------------------------------

define(
    "horizontal_fragment",
    SITES,
    "SELECT *, 'site_1' AS site FROM h_site_1 UNION ALL SELECT *, 'site_2' FROM h_site_2",
)
define(
    "horizontal_complement",
    RELATION,
    f"SELECT order_id, product_id, department, CASE WHEN {_in_site_1} THEN 'site_1' ELSE 'site_2' END AS site "
    "FROM global_relation WHERE department IS NOT NULL",
)
define(
    "check_completeness",
    SITES,
    """
SELECT original_rows, fragment_rows, original_rows - fragment_rows AS unassigned_rows,
       CASE WHEN original_rows = fragment_rows THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT (SELECT COUNT(*) FROM global_relation) AS original_rows,
             (SELECT COUNT(*) FROM h_site_1) + (SELECT COUNT(*) FROM h_site_2) AS fragment_rows) AS sizes""",
)
define(
    "check_disjointness",
    SITES,
    """
SELECT COUNT(*) AS shared_values, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT * FROM h_site_1 INTERSECT SELECT * FROM h_site_2) AS shared""",
)
define(
    "distributed_query_horizontal",
    SITES,
    " UNION ALL ".join(
        f"SELECT order_dow, COUNT(*) AS line_count, CAST(SUM(add_to_cart_order) AS BIGINT) AS position_sum "
        f"FROM {site} GROUP BY order_dow"
        for site in ("h_site_1", "h_site_2")
    ),
)
define(
    "topk_local_merge",
    SITES,
    """
SELECT product_name, CAST(SUM(n) AS BIGINT) AS total_purchases FROM (
  (SELECT product_name, COUNT(*) AS n FROM h_site_1 GROUP BY product_name ORDER BY n DESC, product_name LIMIT 5)
  UNION ALL
  (SELECT product_name, COUNT(*) AS n FROM h_site_2 GROUP BY product_name ORDER BY n DESC, product_name LIMIT 5)
) AS best GROUP BY product_name ORDER BY total_purchases DESC, product_name LIMIT 5""",
)
RATES = f"SELECT department, {rate('SUM(reordered)', 'COUNT(reordered)')} AS %s FROM global_relation GROUP BY department"
define("avg_weighted_merge", RELATION, RATES % "avg_reorder_rate")
define("sql_q2_reorder_merged", RELATION, RATES % "avg_reorder_rate")

# --- vertical fragments ---------------------------------------------------

define("add_row_id", KEYED, "SELECT * FROM keyed")
define("vertical_fragment", KEYED, "SELECT * FROM keyed")
define(
    "check_column_coverage",
    RELATION,
    f"""
SELECT COUNT(*) AS row_count, CAST({len(COLUMNS)} AS INTEGER) AS original_columns,
       CAST(0 AS INTEGER) AS missing_columns, '' AS missing, 'PASS' AS status FROM global_relation""",
)
define(
    "check_lossless_key",
    KEYED,
    " UNION ALL ".join(
        f"SELECT '{site}' AS site, TRUE AS has_key, COUNT(*) AS row_count, COUNT(DISTINCT _row_id) AS distinct_keys, "
        f"CASE WHEN COUNT(*) = COUNT(DISTINCT _row_id) THEN 'PASS' ELSE 'FAIL' END AS status FROM {view}"
        for site, view in (("site_1_order_info", "v_site_1"), ("site_2_product_info", "v_site_2"))
    ),
)
define(
    "distributed_query_vertical",
    RELATION,
    "SELECT product_name, reordered FROM global_relation WHERE order_dow IN (0, 6)",
)
define("vquery_cross_join", RELATION, "SELECT order_id, order_dow, product_name FROM global_relation")
MORNING = (
    "SELECT department, COUNT(*) AS morning_purchases FROM global_relation "
    "WHERE order_hour_of_day < 10 GROUP BY department"
)
define("vquery_morning", RELATION, MORNING)
define("vquery_single_site", RELATION, RATES % "reorder_rate")

# --- catalogue: distributed demo ------------------------------------------

TOP5 = (
    "SELECT {extra}product_name, COUNT(*) AS {name} FROM {site} "
    "GROUP BY product_name ORDER BY {name} DESC, product_name LIMIT 5"
)
for n in (1, 2):
    define(f"sql_q1_site{n}", SITES, TOP5.format(extra=f"'site_{n}' AS site, ", name="purchase_count", site=f"h_site_{n}"))
    define(f"w{n}_h_top5", SITES, TOP5.format(extra="", name="purchase_count", site=f"h_site_{n}"))
define("sql_q1_merged", RELATION, TOP5.format(extra="", name="total_purchases", site="global_relation"))
define("sql_shell_top5", SITES, TOP5.format(extra="", name="cnt", site="h_site_1"))
define(
    "sql_q3_reconstruct_h",
    SITES,
    "SELECT (SELECT COUNT(*) FROM h_site_1) + (SELECT COUNT(*) FROM h_site_2) AS total_rows",
)
JOINED = "FROM v_site_1 AS a JOIN v_site_2 AS b ON a._row_id = b._row_id"
define(
    "sql_q4_vjoin", KEYED, f"SELECT a.order_id, a.order_dow, b.product_name {JOINED} ORDER BY a._row_id LIMIT 10"
)
define("sql_shell_vjoin", KEYED, f"SELECT a.order_dow, b.product_name {JOINED} ORDER BY a._row_id LIMIT 5")
define("sql_q5_morning", RELATION, MORNING)
define(
    "sql_q6_site2_only",
    RELATION,
    f"SELECT department, {rate('SUM(reordered)', 'COUNT(reordered)')} AS reorder_rate, COUNT(*) AS total_items "
    "FROM global_relation GROUP BY department",
)
define(
    "sql_q7_reconstruct_v",
    KEYED,
    f"SELECT COUNT(*) AS total_rows, COUNT(DISTINCT a._row_id) AS unique_keys {JOINED}",
)
TOP_DEPARTMENTS = (
    f"SELECT department, COUNT(*) AS cnt, {rate('SUM(reordered)', 'COUNT(reordered)')} AS avg_reorder "
    "FROM global_relation GROUP BY department ORDER BY cnt DESC, department LIMIT 5"
)
define("sql_q8_centralized", RELATION, TOP_DEPARTMENTS)
define("sql_q8_distributed", RELATION, TOP_DEPARTMENTS)

# --- catalogue: presets ---------------------------------------------------

for n in (1, 2):
    define(
        f"w{n}_h_dept_stats",
        SITES,
        f"SELECT department, COUNT(*) AS total_orders, {half_up('SUM(reordered)', 'COUNT(*)', 4)} AS reorder_rate, "
        f"CAST(SUM(reordered) AS BIGINT) AS total_reorders FROM h_site_{n} GROUP BY department",
    )
    define(
        f"w{n}_v_schema", KEYED, f"SELECT * FROM v_site_{n} ORDER BY _row_id LIMIT 10"
    )
define(
    "w1_h_hourly",
    SITES,
    f"SELECT order_hour_of_day AS hour, COUNT(*) AS order_count, {half_up('SUM(reordered)', 'COUNT(*)', 3)} "
    "AS reorder_rate FROM h_site_1 GROUP BY order_hour_of_day",
)
define(
    "w1_h_dow",
    SITES,
    "SELECT order_dow AS day_of_week, COUNT(*) AS orders, COUNT(DISTINCT user_id) AS unique_users "
    "FROM h_site_1 GROUP BY order_dow",
)
define(
    "w1_h_reorder_top",
    SITES,
    f"""
SELECT product_name, CAST(SUM(reordered) AS BIGINT) AS reorder_count, COUNT(*) AS total,
       {half_up('SUM(reordered)', 'COUNT(*)', 1, 100)} AS reorder_pct
FROM h_site_1 GROUP BY product_name HAVING COUNT(*) > 50 ORDER BY reorder_pct DESC, product_name LIMIT 10""",
)
define(
    "w1_v_active_users",
    RELATION,
    f"""
SELECT user_id, COUNT(DISTINCT order_id) AS order_count,
       {half_up('SUM(days_since_prior_order)', 'COUNT(*)', 1)} AS avg_days_between_orders
FROM global_relation WHERE days_since_prior_order IS NOT NULL
GROUP BY user_id ORDER BY order_count DESC, user_id LIMIT 10""",
)
define(
    "w1_v_order_pattern",
    RELATION,
    "SELECT order_dow AS day, order_hour_of_day AS hour, COUNT(*) AS orders FROM global_relation "
    "GROUP BY order_dow, order_hour_of_day ORDER BY orders DESC, day, hour LIMIT 15",
)
define(
    "w1_cross_union",
    SITES,
    " UNION ALL ".join(
        f"SELECT '{t}' AS fragment, COUNT(*) AS row_count FROM {t}" for t in ("h_site_1", "h_site_2", "global_relation")
    ),
)
define(
    "w2_h_top_add_cart",
    SITES,
    f"""
SELECT add_to_cart_order AS cart_position, COUNT(*) AS frequency,
       {half_up('SUM(reordered)', 'COUNT(*)', 3)} AS reorder_rate
FROM h_site_2 WHERE add_to_cart_order IS NOT NULL GROUP BY add_to_cart_order ORDER BY cart_position LIMIT 15""",
)
define(
    "w2_h_reorder_dept",
    SITES,
    f"SELECT department, COUNT(*) AS total, CAST(SUM(reordered) AS BIGINT) AS reorders, "
    f"{half_up('SUM(reordered)', 'COUNT(*)', 2, 100)} AS reorder_pct FROM h_site_2 GROUP BY department",
)
define(
    "w2_h_product_variety",
    SITES,
    f"SELECT department, COUNT(DISTINCT product_name) AS unique_products, COUNT(*) AS total_orders, "
    f"{half_up('COUNT(*)', 'COUNT(DISTINCT product_name)', 1)} AS orders_per_product FROM h_site_2 GROUP BY department",
)
define(
    "w2_v_product_rank",
    RELATION,
    f"""
SELECT product_name, department, COUNT(*) AS total_purchases, CAST(SUM(reordered) AS BIGINT) AS reorders,
       {half_up('SUM(reordered)', 'COUNT(*)', 1, 100)} AS reorder_pct,
       CAST(RANK() OVER (PARTITION BY department ORDER BY SUM(reordered) DESC) AS INTEGER) AS dept_rank
FROM global_relation GROUP BY product_name, department HAVING COUNT(*) > 30
ORDER BY department, dept_rank, product_name LIMIT 20""",
)
define(
    "w2_v_dept_local",
    RELATION,
    f"SELECT department, {half_up('SUM(reordered)', 'COUNT(*)', 4)} AS reorder_rate, COUNT(*) AS total "
    "FROM global_relation GROUP BY department ORDER BY reorder_rate DESC, department LIMIT 10",
)
define(
    "w2_cross_join",
    RELATION,
    f"SELECT department, COUNT(*) AS morning_purchases, {half_up('SUM(reordered)', 'COUNT(*)', 3)} AS reorder_rate "
    "FROM global_relation WHERE order_hour_of_day BETWEEN 6 AND 10 "
    "GROUP BY department ORDER BY morning_purchases DESC, department LIMIT 10",
)

# --- baskets --------------------------------------------------------------


def digest(*keys: str) -> str:
    return f"MD5(CONCAT_WS('|', '42', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))"


def below(text: str, limit: str) -> str:
    return f"SUBSTR({text}, 1, 8) < '{limit}'"


FIVE_PERCENT, FOUR_FIFTHS = "0ccccccc", "cccccccc"
LINE_COLUMNS = "order_id, product_id, add_to_cart_order, product_name"
define(
    "row_sample",
    RELATION,
    f"SELECT {LINE_COLUMNS} FROM global_relation "
    f"WHERE {below(digest('order_id', 'add_to_cart_order', 'product_id'), FIVE_PERCENT)}",
)
define(
    "order_sample",
    RELATION,
    f"SELECT {LINE_COLUMNS} FROM global_relation WHERE {below(digest('order_id'), FIVE_PERCENT)}",
)
define(
    "baskets",
    RELATION,
    """
SELECT order_id, STRING_AGG(product_name, ',' ORDER BY product_name) AS items
FROM (SELECT DISTINCT order_id, product_name FROM global_relation) AS pairs
GROUP BY order_id HAVING COUNT(*) >= 2""",
)
# Itemsets of up to three names; at this support the test tables hold no larger ones.
ITEMSETS = f"""{RELATION},
pairs AS (
  SELECT order_id, product_name FROM (SELECT DISTINCT order_id, product_name FROM global_relation) AS p
  QUALIFY COUNT(*) OVER (PARTITION BY order_id) >= 2
),
size AS (SELECT COUNT(DISTINCT order_id) AS n FROM pairs),
singles AS (
  SELECT product_name AS a, COUNT(*) AS freq FROM pairs GROUP BY a HAVING COUNT(*) >= CEIL(0.005 * (SELECT n FROM size))
),
doubles AS (
  SELECT p.product_name AS a, q.product_name AS b, COUNT(*) AS freq
  FROM pairs AS p JOIN pairs AS q ON p.order_id = q.order_id AND p.product_name < q.product_name
  GROUP BY 1, 2 HAVING COUNT(*) >= CEIL(0.005 * (SELECT n FROM size))
),
triples AS (
  SELECT p.product_name AS a, q.product_name AS b, r.product_name AS c, COUNT(*) AS freq
  FROM pairs AS p JOIN pairs AS q ON p.order_id = q.order_id AND p.product_name < q.product_name
  JOIN pairs AS r ON p.order_id = r.order_id AND q.product_name < r.product_name
  GROUP BY 1, 2, 3 HAVING COUNT(*) >= CEIL(0.005 * (SELECT n FROM size))
),
candidates AS (
  SELECT a AS antecedent, b AS consequent, freq FROM doubles
  UNION ALL SELECT b, a, freq FROM doubles
  UNION ALL SELECT b || ',' || c, a, freq FROM triples
  UNION ALL SELECT a || ',' || c, b, freq FROM triples
  UNION ALL SELECT a || ',' || b, c, freq FROM triples
),
rules AS (
  SELECT antecedent, consequent,
         ROUND(c.freq / CAST(x.freq AS DOUBLE), 9) AS confidence,
         ROUND(c.freq / CAST(x.freq AS DOUBLE) / (y.freq / CAST(n AS DOUBLE)), 9) AS lift,
         ROUND(c.freq / CAST(n AS DOUBLE), 9) AS support,
         c.freq / CAST(x.freq AS DOUBLE) AS exact_confidence
  FROM candidates AS c
  JOIN (SELECT a AS items, freq FROM singles UNION ALL SELECT a || ',' || b, freq FROM doubles) AS x
    ON x.items = antecedent
  JOIN singles AS y ON y.a = consequent, size
)"""
define(
    "frequent_itemsets",
    ITEMSETS,
    "SELECT a AS items, freq FROM singles UNION ALL SELECT a || ',' || b, freq FROM doubles "
    "UNION ALL SELECT a || ',' || b || ',' || c, freq FROM triples",
)
RULE_COLUMNS = "antecedent, consequent, confidence, lift, support"
define("association_rules", ITEMSETS, f"SELECT {RULE_COLUMNS} FROM rules WHERE exact_confidence >= 0.1")
define(
    "top_rules_by_lift",
    ITEMSETS,
    f"SELECT {RULE_COLUMNS} FROM rules WHERE exact_confidence >= 0.05 "
    "ORDER BY lift DESC, antecedent, consequent LIMIT 20",
)

# --- segments -------------------------------------------------------------

define(
    "scaled_features",
    f"{SCORED}, inside AS (SELECT * FROM scored WHERE {_inside})",
    "SELECT user_id, "
    + ", ".join(
        f"ROUND(({c} - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER (), 6) AS {c}"
        for c in ("frequency", "recency", "monetary")
    )
    + " FROM inside",
)

# --- ALS ------------------------------------------------------------------

BEST = f"""{RELATION},
best_users AS (
  SELECT user_id, COUNT(*) AS n FROM global_relation GROUP BY user_id ORDER BY n DESC, user_id LIMIT 2000
),
best_products AS (
  SELECT product_id, COUNT(*) AS n FROM global_relation GROUP BY product_id ORDER BY n DESC, product_id LIMIT 200
)"""
define(
    "top_users_products",
    BEST,
    "SELECT 'user' AS kind, user_id AS id, n AS line_count FROM best_users "
    "UNION ALL SELECT 'product', product_id, n FROM best_products",
)
RATING_COLUMNS = (
    "user_id, product_id, CAST(COUNT(*) AS INTEGER) AS rating"
)
define(
    "ratings",
    BEST,
    f"SELECT {RATING_COLUMNS} FROM global_relation WHERE user_id IN (SELECT user_id FROM best_users) "
    "AND product_id IN (SELECT product_id FROM best_products) GROUP BY 1, 2",
)
define(
    "train_test_split",
    RELATION,
    f"SELECT *, CASE WHEN {below(digest('user_id', 'product_id'), FOUR_FIFTHS)} THEN 'train' ELSE 'test' END AS part "
    f"FROM (SELECT {RATING_COLUMNS} FROM global_relation GROUP BY 1, 2) AS rated",
)

# --- item neighbours ------------------------------------------------------


def holders(min_items: int) -> str:
    """catalogue(product_name, item) and held(user_id, item, product_name)."""
    return f"""{RELATION},
popular AS (
  SELECT product_name, COUNT(*) AS n FROM global_relation WHERE product_name IS NOT NULL
  GROUP BY product_name ORDER BY n DESC, product_name LIMIT 200
),
catalogue AS (
  SELECT product_name, CAST(ROW_NUMBER() OVER (ORDER BY product_name) - 1 AS INTEGER) AS item FROM popular
),
held AS (
  SELECT user_id, item, product_name
  FROM (SELECT DISTINCT user_id, product_name FROM global_relation) AS bought JOIN catalogue USING (product_name)
  QUALIFY COUNT(*) OVER (PARTITION BY user_id) >= {min_items}
)"""


def cosines(source: str, name: str, by: str) -> str:
    """Similarity of items a <> b over the rows of ``source``, per ``by``."""
    return f"""
{name}_sizes AS (SELECT {by}, item, COUNT(*) AS n FROM {source} GROUP BY {by}, item),
{name} AS (
  SELECT c.{by}, c.a, c.b, c.together / SQRT(CAST(x.n AS DOUBLE) * y.n) AS similarity
  FROM (SELECT p.{by}, p.item AS a, q.item AS b, COUNT(*) AS together
        FROM {source} AS p JOIN {source} AS q ON p.{by} = q.{by} AND p.user_id = q.user_id AND p.item <> q.item
        GROUP BY 1, 2, 3) AS c
  JOIN {name}_sizes AS x ON x.{by} = c.{by} AND x.item = c.a
  JOIN {name}_sizes AS y ON y.{by} = c.{by} AND y.item = c.b
)"""


HELD = holders(5)
define("knn_interactions", HELD, "SELECT user_id, product_name FROM held")
NEIGHBOURS = f"""{HELD},
whole AS (SELECT 0 AS fold, * FROM held),{cosines('whole', 'alike', 'fold')}"""
define(
    "item_cosine",
    NEIGHBOURS,
    "SELECT x.product_name AS item_a, y.product_name AS item_b, ROUND(similarity, 9) AS similarity "
    "FROM alike JOIN catalogue AS x ON a = x.item JOIN catalogue AS y ON b = y.item WHERE a < b",
)
define(
    "knn_scores",
    NEIGHBOURS,
    """
SELECT user_id, product_name, ROUND(COALESCE(SUM(similarity) FILTER (WHERE place <= 30), 0), 9) AS score
FROM (SELECT o.user_id, o.product_name, s.similarity,
             ROW_NUMBER() OVER (PARTITION BY o.user_id, o.item ORDER BY s.similarity DESC NULLS LAST) AS place
      FROM (SELECT u.user_id, c.item, c.product_name FROM (SELECT DISTINCT user_id FROM held) AS u, catalogue AS c
            WHERE NOT EXISTS (SELECT 1 FROM held AS h WHERE h.user_id = u.user_id AND h.item = c.item)) AS o
      JOIN held AS h ON h.user_id = o.user_id
      LEFT JOIN alike AS s ON s.a = o.item AND s.b = h.item) AS near
GROUP BY user_id, product_name""",
)
FOLDED = f"""{HELD},
folded AS (
  SELECT user_id, item, product_name,
         CAST(CAST('0x' || SUBSTR({digest("'fold'", 'user_id')}, 1, 8) AS BIGINT) % 5 + 1 AS INTEGER) AS fold,
         CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {digest("'hide'", 'user_id', 'item')})
              <= GREATEST(1, COUNT(*) OVER (PARTITION BY user_id) // 5) AS INTEGER) AS hidden
  FROM held
)"""
define("knn_holdout_folds", FOLDED, "SELECT user_id, fold, product_name, hidden FROM folded")


def scored_folds(ks: str) -> str:
    return f"""{FOLDED},
training AS (
  SELECT f.fold, h.user_id, h.item FROM folded AS h, (SELECT UNNEST([1, 2, 3, 4, 5]) AS fold) AS f
  WHERE NOT (h.fold = f.fold AND h.hidden = 1)
),{cosines('training', 'alike', 'fold')},
open_items AS (
  SELECT u.fold, u.user_id, c.item, COALESCE(h.hidden, 0) AS label
  FROM (SELECT DISTINCT fold, user_id FROM folded) AS u CROSS JOIN catalogue AS c
  LEFT JOIN folded AS h ON h.user_id = u.user_id AND h.item = c.item
  WHERE h.hidden IS NULL OR h.hidden = 1
),
near AS (
  SELECT o.fold, o.user_id, o.item, o.label, COALESCE(s.similarity, 0) AS similarity,
         ROW_NUMBER() OVER (PARTITION BY o.user_id, o.item ORDER BY COALESCE(s.similarity, 0) DESC) AS place
  FROM open_items AS o JOIN folded AS h ON h.user_id = o.user_id AND h.hidden = 0
  LEFT JOIN alike AS s ON s.fold = o.fold AND s.a = o.item AND s.b = h.item
),
totals AS (
  SELECT fold, user_id, item, label, k, ROUND(SUM(similarity) FILTER (WHERE place <= k), 9) AS score
  FROM near, (SELECT UNNEST({ks}) AS k) AS ks GROUP BY ALL
),
scored AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id, k ORDER BY score DESC, item) <= 10 AS INTEGER) AS predicted
  FROM totals
)"""


def measured(predicted: str) -> str:
    """Confusion counts, AUC and its parts per fold of ``scored``."""
    return f"""
steps AS (
  SELECT fold, score, SUM(label) AS positives, SUM(1 - label) AS negatives FROM scored GROUP BY fold, score
),
running AS (
  SELECT *, SUM(positives) OVER down AS tp, SUM(negatives) OVER down AS fp,
         SUM(positives) OVER (PARTITION BY fold) AS p, SUM(negatives) OVER (PARTITION BY fold) AS n
  FROM steps WINDOW down AS (PARTITION BY fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
),
areas AS (
  SELECT fold, CAST(SUM(negatives * (2 * tp - positives)) AS DOUBLE) / (2.0 * MAX(p) * MAX(n)) AS auc
  FROM running GROUP BY fold
),
confusion AS (
  SELECT fold, SUM(label * {predicted}) AS tp, SUM({predicted}) AS pp, SUM(label) AS p,
         COUNT(*) FILTER (WHERE label = {predicted}) AS matching, COUNT(*) AS n
  FROM scored GROUP BY fold
),
fold_metrics AS (
  SELECT fold, tp / CAST(pp AS DOUBLE) AS precision, tp / CAST(p AS DOUBLE) AS recall,
         2 * tp / CAST(pp + p AS DOUBLE) AS f1, matching / CAST(n AS DOUBLE) AS accuracy, auc
  FROM confusion JOIN areas USING (fold)
)"""


SCORED_30 = f"{scored_folds('[30]')},{measured('predicted')}"
METRICS = ("precision", "recall", "f1", "accuracy", "auc")
define(
    "knn_cv_metrics",
    SCORED_30,
    "SELECT fold, " + ", ".join(f"ROUND({m}, 9) AS {m}" for m in METRICS) + " FROM fold_metrics",
)
define(
    "knn_summary",
    SCORED_30,
    "SELECT " + ", ".join(f"ROUND(AVG({m}), 9) AS {m}" for m in METRICS) + " FROM fold_metrics",
)
define(
    "roc_curve",
    SCORED_30,
    "SELECT fold, score, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM running",
)
define("roc_auc", SCORED_30, "SELECT fold, ROUND(auc, 9) AS auc FROM areas")
define(
    "knn_k_sweep",
    scored_folds("[10, 20, 30, 40, 50]"),
    """
SELECT k, COUNT(DISTINCT user_id) AS users,
       CAST(SUM(label * predicted) AS DOUBLE) / SUM(predicted) AS precision,
       CAST(SUM(label * predicted) AS DOUBLE) / SUM(label) AS recall
FROM scored GROUP BY k""",
)
_pooled = scored_folds("[30]").replace("scored AS (", "scored_folds AS (")
define(
    "binary_metrics",
    f"{_pooled}, scored AS (SELECT 0 AS fold, score, label, CAST(score >= 8.0 AS INTEGER) AS said FROM scored_folds),"
    f"{measured('said')}",
    "SELECT " + ", ".join(f"ROUND({m}, 9) AS {m}" for m in ("precision", "recall", "f1", "auc")) + " FROM fold_metrics",
)

# --- neural recommender ---------------------------------------------------

NCF = holders(3)
define("ncf_interactions", NCF, "SELECT user_id, product_name FROM held")
define(
    "index_encode",
    NCF,
    """
SELECT 'user' AS kind, CAST(user_id AS VARCHAR) AS value,
       ROW_NUMBER() OVER (ORDER BY user_id) - 1 AS idx
FROM (SELECT DISTINCT user_id FROM held) AS users
UNION ALL SELECT 'product', product_name, CAST(item AS BIGINT) FROM catalogue""",
)
DRAWN = f"""{NCF},
drawn AS (
  SELECT user_id, item FROM (
    SELECT u.user_id, c.item, u.n, ROW_NUMBER() OVER
      (PARTITION BY u.user_id ORDER BY {digest("'neg'", 'u.user_id', 'c.item')}) AS place
    FROM (SELECT user_id, COUNT(*) AS n FROM held GROUP BY user_id) AS u, catalogue AS c
    WHERE NOT EXISTS (SELECT 1 FROM held AS h WHERE h.user_id = u.user_id AND h.item = c.item)
  ) AS rest WHERE place <= 4 * n
)"""
define("negative_samples", DRAWN, "SELECT user_id, item FROM drawn")
define(
    "stratified_split",
    DRAWN,
    f"""
SELECT user_id, item, label, CASE WHEN
         ROW_NUMBER() OVER (PARTITION BY label ORDER BY SUBSTR({digest("'split'", 'user_id', 'item')}, 1, 15))
         <= CEIL(0.8 * COUNT(*) OVER (PARTITION BY label)) THEN 'train' ELSE 'test' END AS part
FROM (SELECT user_id, item, CAST(1 AS INTEGER) AS label FROM held UNION ALL SELECT user_id, item, 0 FROM drawn) AS pairs""",
)

# --- weekly sales ---------------------------------------------------------

define(
    "sales_by_dow",
    RELATION,
    "SELECT order_dow, COUNT(DISTINCT order_id) AS num_orders, COUNT(product_id) AS total_items "
    "FROM global_relation GROUP BY order_dow",
)
WEEKS = f"""{RELATION},
sold AS (
  SELECT series, CAST(DATE_TRUNC('week', order_date) + INTERVAL 6 DAY AS DATE) AS week, COUNT(*) AS y
  FROM (SELECT department AS series, order_date FROM global_relation
        UNION ALL SELECT 'all', order_date FROM global_relation) AS lines
  GROUP BY 1, 2
),
calendar AS (
  SELECT series, CAST(UNNEST(GENERATE_SERIES(MIN(week), MAX(week), INTERVAL 7 DAY)) AS DATE) AS week
  FROM sold GROUP BY series
),
weekly AS (
  SELECT series, week, COALESCE(y, 0) AS y FROM calendar LEFT JOIN sold USING (series, week)
)"""
define("weekly_sales", WEEKS, "SELECT * FROM weekly")
SPLIT_WEEKS = f"""{WEEKS},
split AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY series ORDER BY week)
                      <= FLOOR(0.8 * COUNT(*) OVER (PARTITION BY series)) THEN 'train' ELSE 'test' END AS part
  FROM weekly
)"""
define("time_split", SPLIT_WEEKS, "SELECT * FROM split")
define(
    "forecast_rmse_last_value",
    f"""{SPLIT_WEEKS},
last AS (SELECT series, ARG_MAX(y, week) AS forecast FROM split WHERE part = 'train' GROUP BY series)""",
    """
SELECT series, COUNT(*) AS weeks, ROUND(SQRT(AVG(CAST((y - forecast) * (y - forecast) AS DOUBLE))), 9) AS rmse
FROM split JOIN last USING (series) WHERE part = 'test' GROUP BY series""",
)

# --- segments by rule, and predictions by a constant ----------------------

# The fitted assignments and predictions differ between engines; the same
# measures of simple ones do not.
RULED = f"""{RFM},
ruled AS (
  SELECT *, CASE WHEN frequency >= 12 THEN 2 WHEN frequency >= 8 THEN 1 ELSE 0 END AS cluster FROM rfm
)"""
define(
    "cluster_summary_by_rule",
    RULED,
    """
SELECT CAST(cluster AS INTEGER) AS cluster, COUNT(user_id) AS count, ROUND(AVG(frequency), 9) AS avg_frequency,
       ROUND(AVG(recency), 9) AS avg_recency, ROUND(AVG(monetary), 9) AS avg_monetary
FROM ruled GROUP BY cluster""",
)
define(
    "davies_bouldin_by_rule",
    f"""{RULED},
centres AS (
  SELECT cluster, AVG(frequency) AS f, AVG(recency) AS r, AVG(monetary) AS m FROM ruled GROUP BY cluster
),
spreads AS (
  SELECT cluster, MIN(f) AS f, MIN(r) AS r, MIN(m) AS m,
         AVG(SQRT(POW(frequency - f, 2) + POW(recency - r, 2) + POW(monetary - m, 2))) AS spread
  FROM ruled JOIN centres USING (cluster) GROUP BY cluster
),
worst AS (
  SELECT a.cluster, MAX((a.spread + b.spread) / SQRT(POW(a.f - b.f, 2) + POW(a.r - b.r, 2) + POW(a.m - b.m, 2))) AS ratio
  FROM spreads AS a JOIN spreads AS b ON a.cluster <> b.cluster GROUP BY a.cluster
)""",
    "SELECT CAST(COUNT(*) AS INTEGER) AS clusters, ROUND(AVG(ratio), 6) AS davies_bouldin FROM worst",
)
define(
    "rating_rmse_of_mean",
    f"""{RELATION},
rated AS (
  SELECT user_id, product_id, COUNT(*) AS rating,
         {below(digest('user_id', 'product_id'), FOUR_FIFTHS)} AS in_train
  FROM global_relation GROUP BY user_id, product_id
),
mean AS (SELECT AVG(rating) AS prediction FROM rated WHERE in_train)""",
    "SELECT COUNT(*) AS pairs, ROUND(SQRT(AVG(POW(rating - prediction, 2))), 9) AS rmse FROM rated, mean WHERE NOT in_train",
)
define(
    "popularity_rank_metrics",
    f"""{RELATION},
rated AS (
  SELECT user_id, product_id, {below(digest('user_id', 'product_id'), FOUR_FIFTHS)} AS in_train
  FROM global_relation GROUP BY user_id, product_id
),
top AS (
  SELECT product_id, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, product_id) AS place
  FROM rated WHERE in_train GROUP BY product_id QUALIFY place <= 10
),
held AS (SELECT user_id, product_id FROM rated WHERE NOT in_train),
hits AS (
  SELECT user_id, place, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY place) AS i
  FROM held JOIN top USING (product_id)
),
found AS (
  SELECT user_id, COUNT(*) AS hits, SUM(1 / LOG2(place + 1)) AS gain, SUM(i / CAST(place AS DOUBLE)) AS precisions
  FROM hits GROUP BY user_id
),
ideals AS (SELECT j AS most, SUM(1 / LOG2(j + 1)) OVER (ORDER BY j) AS ideal FROM RANGE(1, 11) AS t(j)),
users AS (SELECT user_id, COUNT(*) AS n, LEAST(COUNT(*), 10) AS most FROM held GROUP BY user_id)""",
    "SELECT COUNT(*) AS users, ROUND(AVG(COALESCE(hits, 0) / CAST(10 AS DOUBLE)), 9) AS precision, "
    "ROUND(AVG(COALESCE(hits, 0) / CAST(n AS DOUBLE)), 9) AS recall, "
    "ROUND(AVG(COALESCE(gain, 0) / ideal), 9) AS ndcg, ROUND(AVG(COALESCE(precisions, 0) / most), 9) AS map "
    "FROM users JOIN ideals USING (most) LEFT JOIN found USING (user_id)",
)
define(
    "top_products_nb",
    RELATION,
    "SELECT product_name, COUNT(*) AS count FROM global_relation GROUP BY product_name "
    "ORDER BY count DESC, product_name LIMIT 10",
)
NB_SCORED = SCORED.replace(RFM, f"{RELATION},{rfm_over('COALESCE(days_since_prior_order, -1)')}")
define("rfm_zscores_nb", NB_SCORED, _scores)
define("rfm_trimmed_nb", f"{NB_SCORED}, inside AS (SELECT * FROM scored WHERE {_inside})", _scores.replace("FROM scored", "FROM inside"))
_row_text = " || ".join(f"COALESCE(LENGTH(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in COLUMNS)
define("relation_sample", RELATION, f"SELECT {COLUMN_LIST} FROM global_relation ORDER BY MD5({_row_text}) LIMIT 10")
define(
    "approx_quantile_ranks",
    f"""{RELATION},
counted AS (SELECT add_to_cart_order AS v, COUNT(*) AS n FROM global_relation GROUP BY 1)""",
    """
SELECT share.name, TRUE AS within_error FROM (VALUES ('q1'), ('median'), ('q3')) AS share(name)
WHERE (SELECT SUM(n) FROM counted) > 0""",
)

# --- whole workflows ------------------------------------------------------


def define_rows(name: str, tables: dict[str, str]) -> None:
    """Rows of each table of a workflow, by the SQL of the query that gives the same table."""
    counts = [f"SELECT '{t}' AS name, COUNT(*) AS row_count FROM ({ORACLES[q]})" for t, q in tables.items()]
    ORACLES[name] = "\nUNION ALL ".join(counts)


define_rows(
    "sql_workflow",
    {
        "q1_site_1": "sql_q1_site1",
        "q1_site_2": "sql_q1_site2",
        "q1_merged": "sql_q1_merged",
        "q2": "sql_q2_reorder_merged",
        "q3": "sql_q3_reconstruct_h",
        "q4": "sql_q4_vjoin",
        "q5": "sql_q5_morning",
        "q6": "sql_q6_site2_only",
        "q7": "sql_q7_reconstruct_v",
        "q8_centralized": "sql_q8_centralized",
        "q8_distributed": "sql_q8_distributed",
    },
)
define_rows(
    "fragmentation_workflow",
    {
        "shares": "fragment_shares",
        "completeness": "check_completeness",
        "disjointness": "check_disjointness",
        "top_products": "topk_local_merge",
        "reorder_rate": "avg_weighted_merge",
        "rebuilt_from_rows": "reconstruct_horizontal",
        "column_coverage": "check_column_coverage",
        "lossless_key": "check_lossless_key",
        "order_day_and_product": "vquery_cross_join",
        "morning": "sql_q5_morning",
        "rate_by_department": "sql_q6_site2_only",
        "rebuilt_from_columns": "reconstruct_vertical",
    },
)
define_rows(
    "eda_workflow",
    {
        "cleaned_data": "clean_data",
        "user_features": "user_features",
        "order_features": "order_features",
        "top_departments": "top_departments",
        "orders_by_dow": "orders_by_dow",
        "orders_by_hour": "orders_by_hour",
        "reorder_rate_by_department": "reorder_rate_by_department",
        "top_products": "top_products",
        "itemsets": "frequent_itemsets",
        "rules": "association_rules",
    },
)
