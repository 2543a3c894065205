"""What each query must return, as SQL for DuckDB over the same tables.

Written from the rules of the feeds and operators, without use of the Spark code: the
SQL sorts whole partitions, uses plain windows and knows no skew.
"""

from __future__ import annotations

# --- feeds -------------------------------------------------------------------------

BRONZE_POS = """
bronze_pos AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS transaction_id,
    CAST(l_suppkey AS BIGINT) AS store_id, CAST(l_partkey AS BIGINT) AS product_id,
    CAST(CAST(l_quantity AS INTEGER) - CASE WHEN l_partkey % 97 = 0 THEN 60 ELSE 0 END
      AS INTEGER) AS quantity,
    l_extendedprice AS revenue,
    CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice * l_discount END AS discount_applied,
    epoch_us(l_shipdate) // 1000000 AS timestamp, l_linestatus
  FROM lineitem)"""

BRONZE_INVENTORY = """
bronze_inventory AS (
  SELECT CAST(p_partkey * 5 + w AS BIGINT) AS inventory_id,
    CAST(p_partkey AS BIGINT) AS product_id, CAST(w AS INTEGER) AS warehouse_id,
    CAST((p_partkey * 31 + w * 17 + g * 7) % 60 - 5 AS INTEGER) AS stock_level,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size % 25 - 1 AS INTEGER) END
      AS restock_threshold,
    CAST(897868800 + w * 3600 - g * 86400 AS BIGINT) AS last_updated, g
  FROM (SELECT *, unnest([0, 1, 2, 3, 4]) AS w FROM part) AS p,
    LATERAL (SELECT unnest(CASE WHEN p_partkey % 7 = 0 THEN [0, 1] ELSE [0] END) AS g))"""

INTERACTION_TYPE = """CASE event_type WHEN 'view' THEN 'Inquiry' WHEN 'click' THEN 'Loyalty_Action'
      WHEN 'error' THEN 'Complaint' WHEN 'purchase' THEN 'Resolution' ELSE 'Feedback' END"""

CHANNEL = """CASE event_id % 4 WHEN 0 THEN 'email' WHEN 1 THEN 'Phone' WHEN 2 THEN 'chat'
      ELSE NULL END"""

BRONZE_CRM = f"""
bronze_crm AS (
  SELECT event_id, CAST(user_id AS BIGINT) AS customer_id,
    {INTERACTION_TYPE} AS interaction_type,
    {CHANNEL} AS channel,
    CASE WHEN event_id % 6 = 5 THEN NULL ELSE CAST((event_id * 7) % 8 AS INTEGER) END AS rating,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS message_excerpt,
    epoch_us(ts) // 1000000 - (epoch_us(ts) // 1000000) % 60 AS timestamp, event_type
  FROM events)"""

BRONZE_WTL = """
bronze_wtl AS (
  SELECT concat(user_id, '-', CAST(ts AS DATE)) AS session_id,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(user_id AS BIGINT) END AS user_id,
    concat('/p/', (event_id + g) % 50) AS page,
    CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'DESKTOP' WHEN 2 THEN 'tablet'
      ELSE NULL END AS device_type,
    CASE event_id % 5 WHEN 0 THEN 'chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'SAFARI'
      WHEN 3 THEN 'edge' ELSE NULL END AS browser,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_type = 'view' THEN 'page_view'
      WHEN event_type = 'error' THEN 'bounce' ELSE event_type END AS event_type,
    epoch_us(ts) // 1000000 AS timestamp
  FROM (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS g
        FROM events) AS logged)"""

# Records as they are sent; the envelope of some of them is damaged.
LIVE = f"""
live AS (
  SELECT event_id,
    CASE WHEN event_id % 37 = 0 THEN 'empty' WHEN event_id % 29 = 0 THEN 'bad_base64'
      WHEN event_id % 41 = 0 THEN 'bad_utf8' WHEN event_id % 31 = 0 THEN 'bad_json'
      WHEN event_id % 17 = 3 THEN 'missing_field' ELSE 'valid' END AS outcome,
    CAST(user_id AS VARCHAR) AS customer_id,
    {INTERACTION_TYPE} AS interaction_type,
    {CHANNEL} AS channel,
    CASE WHEN event_id % 6 = 5 THEN NULL WHEN event_id % 9 = 4 THEN 'bad'
      ELSE CAST((event_id * 7) % 8 AS VARCHAR) END AS rating,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS message_excerpt,
    CASE WHEN event_id % 19 = 0 THEN NULL
      ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS timestamp
  FROM events)"""


# --- silver ------------------------------------------------------------------------


def one_per_key(source: str, target: str, keys: str, order: str) -> str:
    """Rows of ``source`` that come first in descending order within their key."""
    ranked = ", ".join(f"{c} DESC NULLS LAST" for c in order.split())
    return f"""
{target} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ranked}) AS place
    FROM {source}) AS ranked
  WHERE place = 1)"""


def pos_silver(source: str = "bronze_pos", name: str = "pos") -> str:
    order = "timestamp store_id product_id quantity revenue discount_applied"
    return (
        one_per_key(source, f"{name}_one", "transaction_id", order)
        + f""",
{name} AS (
  SELECT transaction_id, store_id, product_id, quantity, CAST(revenue AS FLOAT) AS revenue,
    CAST(coalesce(discount_applied, 0.0) AS FLOAT) AS discount_applied,
    CAST(revenue - coalesce(discount_applied, 0.0) AS FLOAT) AS net_revenue,
    make_timestamp(timestamp * 1000000) AS timestamp,
    CAST(make_timestamp(timestamp * 1000000) AS DATE) AS date
  FROM {name}_one WHERE quantity >= 0 AND revenue >= 0)"""
    )


def inventory_silver(source: str = "bronze_inventory", name: str = "inventory") -> str:
    order = "last_updated product_id warehouse_id stock_level restock_threshold"
    return (
        one_per_key(source, f"{name}_one", "inventory_id", order)
        + f""",
{name} AS (
  SELECT inventory_id, product_id, warehouse_id, stock_level,
    coalesce(restock_threshold, 0) AS restock_threshold,
    stock_level <= coalesce(restock_threshold, 0) AS needs_restock,
    make_timestamp(last_updated * 1000000) AS last_updated
  FROM {name}_one WHERE stock_level >= 0 AND coalesce(restock_threshold, 0) >= 0)"""
    )


CRM_ORDER = "interaction_type channel rating message_excerpt"


def crm_silver(source: str = "bronze_crm", name: str = "crm") -> str:
    feed = f"(SELECT * EXCLUDE (event_id, event_type) FROM {source})"
    return (
        one_per_key(feed, f"{name}_one", "customer_id, timestamp", CRM_ORDER)
        + f""",
{name} AS (
  SELECT customer_id, upper(interaction_type) AS interaction_type,
    coalesce(upper(channel), 'UNKNOWN') AS channel, rating,
    CASE WHEN message_excerpt IS NULL THEN '' ELSE sha256(message_excerpt) END AS message_excerpt,
    make_timestamp(timestamp * 1000000) AS timestamp,
    CAST(make_timestamp(timestamp * 1000000) AS DATE) AS date
  FROM {name}_one WHERE rating IS NULL OR rating BETWEEN 1 AND 5)"""
    )


CRM = f"{BRONZE_CRM},{crm_silver()}"

WTL_ONE = one_per_key(
    "bronze_wtl", "wtl_one", "session_id, timestamp",
    "user_id page device_type browser event_type",
)


def title(column: str) -> str:
    return f"coalesce(upper({column}[1]) || lower({column}[2:]), 'UNKNOWN') AS {column}"


WTL = f"""{BRONZE_WTL},{WTL_ONE},
wtl AS (
  SELECT session_id, user_id, sha256(CAST(user_id AS VARCHAR)) AS hashed_user_id, page,
    {title('device_type')}, {title('browser')},
    coalesce(upper(event_type), 'UNKNOWN') AS event_type,
    make_timestamp(timestamp * 1000000) AS timestamp,
    CAST(make_timestamp(timestamp * 1000000) AS DATE) AS date, user_id IS NULL AS is_anonymous
  FROM wtl_one)"""

POS = f"{BRONZE_POS},{pos_silver()}"
INVENTORY = f"{BRONZE_INVENTORY},{inventory_silver()}"


# --- output forms ------------------------------------------------------------------


def iso_date(column: str = "date") -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def iso_time(column: str = "timestamp", name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


def number(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) AS {name}"


def calendar(column: str, hour: bool) -> str:
    parts = ["year", "month", "day"] + (["hour"] if hour else [])
    return ", ".join(f"CAST({p}({column}) AS INTEGER) AS {p}" for p in parts)


POS_MONEY = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("revenue", "discount_applied", "net_revenue")
)
POS_COLUMNS = f"""transaction_id, store_id, product_id, quantity, {POS_MONEY},
  {calendar('timestamp', hour=False)},
  {iso_time()}, {iso_date()}"""
INVENTORY_COLUMNS = f"""inventory_id, product_id, warehouse_id, stock_level, restock_threshold,
  needs_restock, {calendar('last_updated', hour=True)}, {iso_time('last_updated')}"""
CRM_COLUMNS = f"""customer_id, interaction_type, channel, rating, message_excerpt,
  {calendar('timestamp', hour=True)}, {iso_time()}, {iso_date()}"""
WTL_COLUMNS = f"""session_id, user_id, hashed_user_id, page, device_type, browser, event_type,
  is_anonymous, {calendar('timestamp', hour=True)}, {iso_time()}, {iso_date()}"""
CRM_FEED_COLUMNS = "customer_id, interaction_type, channel, rating, message_excerpt, timestamp"

ORACLES: dict[str, str] = {}

# --- sources -----------------------------------------------------------------------

ORACLES["bronze_json_scan"] = f"""WITH {BRONZE_CRM}
SELECT {CRM_FEED_COLUMNS}, unnest(['lines', 'array']) AS layout FROM bronze_crm"""

ORACLES["bronze_catalog_scan"] = f"""WITH {BRONZE_CRM}
SELECT {CRM_FEED_COLUMNS}, {calendar('make_timestamp(timestamp * 1000000)', hour=False)}
FROM bronze_crm"""

ORACLES["landing_partitions"] = f"""WITH {BRONZE_INVENTORY}
SELECT inventory_id, product_id, warehouse_id, stock_level, restock_threshold, last_updated,
  'part.parquet' AS source_file, 2024 AS year, 5 AS month, 8 AS day,
  unnest([10, 11]) AS hour,
  unnest(['2024-05-08 10:40:00', '2024-05-08 11:05:00']) AS ingest_ts
FROM bronze_inventory"""

LIVE_FIELDS = "customer_id interaction_type channel rating message_excerpt timestamp".split()
ORACLES["envelope_decode"] = f"""WITH {LIVE}
SELECT event_id, outcome,
  {', '.join(f"CASE WHEN outcome = 'valid' THEN {c} END AS {c}" for c in LIVE_FIELDS)}
FROM live"""

ORACLES["keyed_json_latest"] = f"""WITH {BRONZE_CRM},
{one_per_key('bronze_crm', 'latest', 'customer_id, timestamp', 'event_id')}
SELECT {CRM_FEED_COLUMNS}, event_id,
  concat(customer_id, '_', timestamp, '.json') AS object_name
FROM latest"""

ORACLES["load_audit"] = f"""WITH {CRM}
SELECT 'bronze' AS stage, count(*) AS row_count FROM bronze_crm
UNION ALL SELECT 'deduplicated', count(*) FROM crm_one
UNION ALL SELECT 'silver', count(*) FROM crm
UNION ALL SELECT 'rejected', count(*) FROM crm_one WHERE NOT (rating BETWEEN 1 AND 5)"""

# --- silver ------------------------------------------------------------------------

ORACLES["silver_pos"] = f"WITH {POS} SELECT {POS_COLUMNS} FROM pos"
ORACLES["silver_inventory"] = f"WITH {INVENTORY} SELECT {INVENTORY_COLUMNS} FROM inventory"
ORACLES["silver_crm"] = f"WITH {CRM} SELECT {CRM_COLUMNS} FROM crm"
ORACLES["silver_wtl"] = f"WITH {WTL} SELECT {WTL_COLUMNS} FROM wtl"

ORACLES["silver_pos_rejects"] = f"""WITH {POS}
SELECT transaction_id, store_id, product_id, quantity, {number('revenue', 'revenue')},
  {number('discount_applied', 'discount_applied')}, timestamp,
  CASE WHEN quantity >= 0 THEN 'bad_revenue' ELSE 'bad_quantity' END AS reject_reason
FROM pos_one WHERE NOT coalesce(quantity >= 0 AND revenue >= 0, FALSE)"""

ORACLES["silver_inventory_rejects"] = f"""WITH {INVENTORY}
SELECT inventory_id, product_id, warehouse_id, stock_level, restock_threshold, last_updated,
  CASE WHEN stock_level >= 0 THEN 'bad_restock_threshold' ELSE 'bad_stock_level' END
    AS reject_reason
FROM inventory_one
WHERE NOT coalesce(stock_level >= 0, FALSE) OR restock_threshold < 0"""

ORACLES["silver_crm_rejects"] = f"""WITH {CRM}
SELECT {CRM_FEED_COLUMNS}, 'rating_out_of_range' AS reject_reason
FROM crm_one WHERE rating < 1 OR rating > 5"""

ORACLES["silver_partition_scan"] = f"""WITH {CRM} SELECT {CRM_COLUMNS} FROM crm
WHERE year(timestamp) = 2024 AND month(timestamp) = 1"""

ORACLES["merge_pos"] = f"""WITH {BRONZE_POS},
settled_raw AS (SELECT * FROM bronze_pos WHERE l_linestatus = 'F'),
open_raw AS (SELECT * FROM bronze_pos WHERE l_linestatus = 'O'),
{pos_silver('settled_raw', 'settled')},
{pos_silver('open_raw', 'still_open')},
merged AS (
  SELECT * FROM still_open
  UNION ALL
  SELECT * FROM settled
  WHERE transaction_id NOT IN (SELECT transaction_id FROM still_open))
SELECT {POS_COLUMNS} FROM merged"""

ORACLES["merge_inventory_moved"] = f"""WITH {BRONZE_INVENTORY},
older_raw AS (SELECT * FROM bronze_inventory WHERE g = 1),
newer_raw AS (SELECT * FROM bronze_inventory WHERE g = 0),
{inventory_silver('older_raw', 'older')},
{inventory_silver('newer_raw', 'newer')},
merged AS (
  SELECT * FROM newer
  UNION ALL
  SELECT * FROM older WHERE inventory_id NOT IN (SELECT inventory_id FROM newer))
SELECT {INVENTORY_COLUMNS} FROM merged"""

ORACLES["merge_crm"] = f"""WITH {BRONZE_CRM},
browsing_raw AS (SELECT * FROM bronze_crm WHERE event_type NOT IN ('purchase', 'signup')),
buying_raw AS (SELECT * FROM bronze_crm WHERE event_type IN ('purchase', 'signup')),
{crm_silver('browsing_raw', 'browsing')},
{crm_silver('buying_raw', 'buying')},
merged AS (
  SELECT * FROM buying
  UNION ALL
  SELECT * FROM browsing AS b WHERE NOT EXISTS (
    SELECT 1 FROM buying AS n WHERE n.customer_id = b.customer_id AND n.timestamp = b.timestamp))
SELECT {CRM_COLUMNS} FROM merged"""

ORACLES["merge_wtl"] = f"""WITH {WTL},
again AS (
  SELECT * REPLACE ('Tv' AS device_type) FROM wtl
  WHERE epoch_us(timestamp) // 1000000 % 2 = 0)
SELECT {WTL_COLUMNS} FROM (
  SELECT * FROM again
  UNION ALL
  SELECT * FROM wtl WHERE epoch_us(timestamp) // 1000000 % 2 <> 0) AS merged"""

ORACLES["merge_pos_stored"] = f"""WITH {BRONZE_POS},
moved_raw AS (
  SELECT * REPLACE (timestamp + 40 * 86400 AS timestamp) FROM bronze_pos
  WHERE product_id % 3 = 0),
{pos_silver('bronze_pos', 'stored')},
{pos_silver('moved_raw', 'moved')},
merged AS (
  SELECT * FROM moved
  UNION ALL
  SELECT * FROM stored WHERE transaction_id NOT IN (SELECT transaction_id FROM moved))
SELECT {POS_COLUMNS} FROM merged"""

# --- jobs --------------------------------------------------------------------------


def refused(status: str) -> str:
    raw, name = f"raw_{status}", f"sold_{status}"
    return f"""
{raw} AS (
  SELECT * FROM bronze_pos WHERE l_linestatus = '{status}' AND product_id % 50 <> 0),
{pos_silver(raw, name)},
refused_{status} AS (
  SELECT transaction_id, store_id, product_id, quantity,
    CASE WHEN quantity >= 0 THEN 'bad_revenue' ELSE 'bad_quantity' END AS reject_reason
  FROM {name}_one WHERE NOT coalesce(quantity >= 0 AND revenue >= 0, FALSE)
  UNION ALL
  SELECT NULL, store_id, product_id, quantity, 'null_key' FROM bronze_pos
  WHERE l_linestatus = '{status}' AND product_id % 50 = 0)"""


ORACLES["job_rejects_pos"] = f"""WITH {BRONZE_POS},{refused('F')},{refused('O')}
SELECT transaction_id, store_id, product_id, CAST(quantity AS BIGINT) AS quantity,
  reject_reason, run
FROM (SELECT *, 'F' AS run FROM refused_F UNION ALL SELECT *, 'O' FROM refused_O) AS refused"""

# --- support -----------------------------------------------------------------------

ORACLES["feedback_score"] = f"""WITH {CRM}
SELECT 'average_feedback_score' AS metric_name, {number('avg(rating)', 'value')}
FROM crm WHERE interaction_type = 'FEEDBACK'"""

VOLUMES = f"""WITH {CRM}
SELECT interaction_type, count(*) AS volume FROM crm GROUP BY interaction_type"""
ORACLES["interaction_volume"] = VOLUMES
ORACLES["gold_csv_single"] = VOLUMES

ORACLES["feedback_trend"] = f"""WITH {CRM}
SELECT {iso_date()}, {number('avg(rating)', 'feedback_score')}, count(rating) AS ratings
FROM crm WHERE interaction_type = 'FEEDBACK' GROUP BY date"""


def previous_time(source: str) -> str:
    return f"""
timed AS (
  SELECT *, epoch(timestamp) - epoch(lag(timestamp) OVER (
      PARTITION BY customer_id ORDER BY timestamp, upper(interaction_type) = 'RESOLUTION'))
    AS wait
  FROM {source} WHERE customer_id IS NOT NULL AND timestamp IS NOT NULL)"""


ORACLES["time_to_resolution"] = f"""WITH {CRM},{previous_time('crm')}
SELECT {number('coalesce(avg(wait) / 60.0, 0)', 'avg_time_to_resolution_minutes')},
  count(wait) AS resolutions
FROM timed WHERE interaction_type = 'RESOLUTION'"""

ORACLES["customer_support_mart"] = f"""WITH {CRM},{previous_time('crm')}
SELECT customer_id, {number('avg(rating)', 'avg_rating')},
  count(*) FILTER (interaction_type = 'COMPLAINT') AS complaint_count,
  count(*) FILTER (interaction_type = 'FEEDBACK') AS feedback_count,
  count(*) FILTER (interaction_type = 'LOYALTY_ACTION') AS loyalty_count,
  {number("avg(wait) FILTER (interaction_type = 'RESOLUTION') / 3600.0", 'avg_resolution_hours')},
  '2024-01-31' AS date
FROM timed GROUP BY customer_id"""



def stored_support(day: str, date: str) -> str:
    """The mart as loaded from CSV: decimals are rounded from text."""
    rating = "CAST(CAST(avg(rating) AS VARCHAR) AS DECIMAL(3, 1))"
    hours = "avg(wait) FILTER (interaction_type = 'RESOLUTION') / 3600.0"
    hours = f"CAST(CAST({hours} AS VARCHAR) AS DECIMAL(6, 2))"
    counts = ", ".join(
        f"CAST(count(*) FILTER (interaction_type = '{kind}') AS INTEGER) AS {name}_count"
        for kind, name in (
            ("COMPLAINT", "complaint"), ("FEEDBACK", "feedback"), ("LOYALTY_ACTION", "loyalty")
        )
    )
    return f"""WITH {CRM},{previous_time('crm')}
SELECT customer_id, {number(rating, 'avg_rating')}, {counts},
  {number(hours, 'avg_resolution_hours')}, '{date}' AS date
FROM timed WHERE {day} GROUP BY customer_id"""


ORACLES["mart_roundtrip_support"] = stored_support("TRUE", "2024-01-31")
ORACLES["job_support_mart"] = stored_support("date = DATE '2024-01-20'", "2024-01-20")

SNAPSHOT = f"""WITH {LIVE},
cleaned AS (
  SELECT customer_id, interaction_type, TRY_CAST(rating AS DOUBLE) AS rating,
    make_timestamp(CAST(timestamp AS BIGINT) * 1000000) AS timestamp
  FROM live
  WHERE outcome = 'valid' AND customer_id NOT IN ('', '0') AND timestamp IS NOT NULL
    AND (TRY_CAST(rating AS DOUBLE) IS NULL OR TRY_CAST(rating AS DOUBLE) BETWEEN 1 AND 5)),
{previous_time('cleaned')},
volumes AS (SELECT interaction_type AS kind, count(*) AS n FROM cleaned GROUP BY 1)
SELECT {number('(SELECT coalesce(avg(rating), 0) FROM cleaned)', 'feedback_score')},
  (SELECT '{{' || string_agg('"' || kind || '":' || n, ',' ORDER BY kind) || '}}' FROM volumes)
    AS interaction_volume_by_type,
  {number(
    "(SELECT coalesce(avg(wait) / 60.0, 0) FROM timed WHERE interaction_type = 'Resolution')",
    'avg_time_to_resolution_minutes')}"""
ORACLES["support_snapshot"] = f"{SNAPSHOT}, '2024-01-31 00:00:00' AS kpi_date"
# All files present at the start form one micro-batch.
ORACLES["stream_support_batches"] = SNAPSHOT

ORACLES["stream_support_volumes"] = SNAPSHOT.split("volumes AS")[0].rstrip().rstrip(",") + """
SELECT interaction_type || '-' || customer_id AS interaction_type, count(*) AS volume,
  '2024-01-31 00:00:00' AS kpi_date
FROM cleaned GROUP BY interaction_type, customer_id"""

# Three arrivals; waits reach back into earlier ones. Times of the month are in order, so a
# window over all of them sees what the batches know.
ORACLES["stream_support_arrivals"] = SNAPSHOT.split("volumes AS")[0] + f"""
batched AS (
  SELECT *, CASE WHEN timestamp < TIMESTAMP '2024-01-11' THEN 1
    WHEN timestamp < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS batch FROM timed),
volumes AS (SELECT batch, interaction_type AS kind, count(*) AS n FROM batched GROUP BY 1, 2),
texts AS (
  SELECT batch, '{{' || string_agg('"' || kind || '":' || n, ',' ORDER BY kind) || '}}'
    AS interaction_volume_by_type
  FROM volumes GROUP BY batch),
figures AS (
  SELECT batch, coalesce(avg(rating), 0) AS score,
    coalesce(avg(wait) FILTER (interaction_type = 'Resolution') / 60.0, 0) AS minutes
  FROM batched GROUP BY batch)
SELECT {number('score', 'feedback_score')}, interaction_volume_by_type,
  {number('minutes', 'avg_time_to_resolution_minutes')}
FROM figures JOIN texts USING (batch)"""

# --- marketing ---------------------------------------------------------------------

ORACLES["web_session_rates"] = f"""WITH {WTL},
rates AS (
  SELECT session_id, user_id,
    avg(CASE WHEN event_type = 'PAGE_VIEW' THEN 1 ELSE 0 END) AS page_views,
    avg(CASE WHEN event_type = 'BOUNCE' THEN 1 ELSE 0 END) AS bounces
  FROM wtl GROUP BY session_id, user_id)
SELECT session_id, user_id, {number('page_views', 'page_views')}, {number('bounces', 'bounces')},
  CAST(0 AS DOUBLE) AS avg_session_duration,
  {number('CASE WHEN page_views > 0 THEN bounces / page_views ELSE 0 END', 'bounce_rate')}
FROM rates"""

ENGAGEMENT = """
engagement AS (
  SELECT customer_id, avg(coalesce(rating, 0)) AS engagement_score,
    count(*) FILTER (interaction_type = 'LOYALTY_ACTION') AS loyalty_actions,
    count(*) AS total_interactions
  FROM crm GROUP BY customer_id)"""
ORACLES["crm_engagement"] = f"""WITH {CRM},{ENGAGEMENT}
SELECT customer_id, {number('engagement_score', 'engagement_score')}, loyalty_actions,
  total_interactions
FROM engagement"""


def marketing(duration: str, decimals: bool) -> str:
    score, length = "engagement_score", duration
    actions = "loyalty_actions"
    if decimals:
        # The mart is loaded from CSV, so the decimal is rounded from text.
        score = f"CAST(CAST({score} AS VARCHAR) AS DECIMAL(5, 2))"
        length = f"CAST(CAST({length} AS VARCHAR) AS DECIMAL(10, 2))"
        actions = "CAST(loyalty_actions AS INTEGER) AS loyalty_actions"
    return f"""WITH {CRM},{WTL},{ENGAGEMENT},
lengths AS (
  SELECT user_id, session_id, epoch(max(timestamp)) - epoch(min(timestamp)) AS seconds
  FROM wtl GROUP BY user_id, session_id),
mean_lengths AS (SELECT user_id, avg(seconds) AS seconds FROM lengths GROUP BY user_id),
web AS (
  SELECT user_id, count(*) FILTER (event_type = 'PAGE_VIEW') AS views,
    count(*) FILTER (event_type = 'BOUNCE') AS bounces
  FROM wtl WHERE user_id IS NOT NULL GROUP BY user_id)
SELECT e.customer_id, {number(score, 'engagement_score')},
  {number(length, 'avg_session_duration')},
  {number('CASE WHEN views > 0 THEN bounces / views ELSE 0 END', 'bounce_rate')},
  {number('loyalty_actions / total_interactions', 'loyalty_activity_rate')},
  {actions}, '2024-01-31' AS date
FROM engagement AS e
JOIN web ON web.user_id = e.customer_id
JOIN mean_lengths AS m ON m.user_id = e.customer_id"""


ORACLES["marketing_mart"] = marketing("0.0", decimals=False)
ORACLES["marketing_mart_measured"] = marketing("m.seconds", decimals=False)
ORACLES["mart_roundtrip_marketing"] = marketing("0.0", decimals=True)

ORACLES["click_through_daily"] = f"""WITH {WTL},
daily AS (
  SELECT date, count(*) FILTER (event_type = 'CLICK') AS clicks,
    count(*) FILTER (event_type = 'PAGE_VIEW') AS page_views
  FROM wtl GROUP BY date)
SELECT {iso_date()}, clicks, page_views,
  {number('CASE WHEN page_views > 0 THEN clicks / page_views ELSE 0 END', 'click_through_rate')}
FROM daily"""

# --- sales -------------------------------------------------------------------------


def sales_mart(
    period: str = "TRUE", stock_period: str = "TRUE", units: str = "BIGINT"
) -> str:
    return f"""WITH {POS},{INVENTORY},
sold AS (
  SELECT product_id, store_id, sum(CAST(revenue AS DOUBLE)) AS total_sales,
    CAST(sum(quantity) AS {units}) AS total_units
  FROM pos WHERE {period} GROUP BY product_id, store_id),
stock AS (
  SELECT product_id, max(stock_level) AS stock_availability, max(restock_threshold) AS threshold
  FROM inventory WHERE {stock_period} GROUP BY product_id)
SELECT product_id, store_id, {number('total_sales', 'total_sales')}, total_units,
  stock_availability, stock_availability < threshold AS below_restock_threshold,
  {number(
    'CASE WHEN stock_availability > 0 THEN total_units / stock_availability ELSE 0 END',
    'product_turnover_rate')},
  '1998-06-15' AS date
FROM sold JOIN stock USING (product_id)"""


ORACLES["sales_mart"] = sales_mart()
ORACLES["sales_mart_month"] = sales_mart(
    "year(timestamp) = 1998 AND month(timestamp) = 6",
    "year(last_updated) = 1998 AND month(last_updated) = 6",
)
ORACLES["mart_roundtrip_sales"] = sales_mart()

ORACLES["sales_by_store"] = f"""WITH {POS},{INVENTORY},
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY timestamp, product_id) AS place
  FROM pos),
sold AS (
  SELECT store_id, sum(CAST(revenue AS DOUBLE)) AS total_sales,
    CAST(sum(quantity) AS BIGINT) AS total_units,
    max(product_id) FILTER (place = 1) AS product_id
  FROM ordered GROUP BY store_id),
stock AS (
  SELECT product_id, max(stock_level) AS stock_availability, max(restock_threshold) AS threshold
  FROM inventory GROUP BY product_id)
SELECT product_id, store_id, {number('total_sales', 'total_sales')}, total_units,
  stock_availability, stock_availability < threshold AS below_restock_threshold,
  {number(
    'CASE WHEN stock_availability > 0 THEN total_units / stock_availability ELSE 0 END',
    'product_turnover_rate')},
  '1998-06-15' AS date
FROM sold JOIN stock USING (product_id)"""


def revenue(by: str, shown: str) -> str:
    return f"""WITH {POS}
SELECT {shown}, {number('sum(CAST(revenue AS DOUBLE))', 'gross_revenue')},
  {number('sum(CAST(discount_applied AS DOUBLE))', 'discounts')},
  {number('sum(CAST(net_revenue AS DOUBLE))', 'net_sales')},
  CAST(sum(quantity) AS BIGINT) AS units, count(*) AS transactions
FROM pos GROUP BY {by}"""


ORACLES["daily_net_sales"] = revenue("date", iso_date())
ORACLES["store_revenue"] = revenue("store_id", "store_id")

ORACLES["mart_key_violations"] = f"""WITH {BRONZE_POS}
,
named AS (
  SELECT CASE WHEN product_id % 50 <> 0 THEN transaction_id END AS transaction_id FROM bronze_pos)
SELECT transaction_id, count(*) AS row_count,
  CASE WHEN transaction_id IS NULL THEN 'null_key' ELSE 'repeated_key' END AS problem
FROM named GROUP BY transaction_id HAVING count(*) > 1 OR transaction_id IS NULL"""

# --- operations --------------------------------------------------------------------


def turnover(day: str = "TRUE", stock_day: str = "TRUE") -> str:
    return f"""
sold AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units FROM pos WHERE {day}
  GROUP BY product_id),
mean_stock AS (
  SELECT product_id, avg(stock_level) AS level FROM inventory WHERE {stock_day}
  GROUP BY product_id),
turned AS (
  SELECT product_id, CASE WHEN level > 0 THEN units / level END AS inventory_turnover
  FROM sold LEFT JOIN mean_stock USING (product_id))"""


ORACLES["inventory_turnover"] = f"""WITH {POS},{INVENTORY},{turnover()}
SELECT product_id, {number('inventory_turnover', 'inventory_turnover')} FROM turned"""
SALES_DAY = turnover("date = DATE '1998-06-15'", "CAST(last_updated AS DATE) = DATE '1998-06-15'")
ORACLES["inventory_turnover_day"] = f"""WITH {POS},{INVENTORY},{SALES_DAY}
SELECT product_id, {number('inventory_turnover', 'inventory_turnover')} FROM turned"""

ORACLES["restock_frequency"] = f"""WITH {INVENTORY}
SELECT product_id, warehouse_id, count(*) AS restock_frequency FROM inventory
WHERE stock_level <= restock_threshold GROUP BY product_id, warehouse_id"""

ORACLES["stockout_alerts"] = f"""WITH {INVENTORY}
SELECT product_id, warehouse_id, count(*) AS stockout_count FROM inventory
WHERE stock_level <= 0 GROUP BY product_id, warehouse_id"""


def operations_mart(day: str = "TRUE", stock_day: str = "TRUE") -> str:
    return f"""WITH {POS},{INVENTORY},{turnover(day, stock_day)},
state AS (
  SELECT product_id, count(*) FILTER (stock_level <= restock_threshold) AS low,
    count(*) FILTER (stock_level <= 0) AS gone
  FROM inventory WHERE {stock_day} GROUP BY product_id)
SELECT product_id, {number('inventory_turnover', 'inventory_turnover')},
  coalesce(low, 0) AS restock_count,
  CASE WHEN gone > 0 THEN 'HIGH' WHEN low > 0 THEN 'MEDIUM' ELSE 'LOW' END AS stockout_risk,
  '1998-06-15' AS date
FROM turned FULL JOIN state USING (product_id)"""


def stored_operations(sql: str) -> str:
    return sql.replace(
        number("inventory_turnover", "inventory_turnover"),
        number("CAST(CAST(inventory_turnover AS VARCHAR) AS DECIMAL(10, 2))", "inventory_turnover"),
    ).replace("coalesce(low, 0) AS", "CAST(coalesce(low, 0) AS INTEGER) AS")


ORACLES["operations_mart"] = operations_mart()
ORACLES["mart_roundtrip_operations"] = stored_operations(ORACLES["operations_mart"])
SOLD_THEN, COUNTED_THEN = "date = DATE '1998-06-15'", "CAST(last_updated AS DATE) = DATE '1998-06-15'"
ORACLES["job_operations_mart"] = f"""
SELECT *, 'counted' AS stock FROM ({stored_operations(operations_mart(SOLD_THEN, COUNTED_THEN))}) AS c
UNION ALL
SELECT *, 'missing' AS stock FROM ({stored_operations(operations_mart(SOLD_THEN, "FALSE"))}) AS m"""
ORACLES["job_sales_mart"] = ORACLES["sales_mart_month"]

# --- streams -----------------------------------------------------------------------

ORACLES["stream_landing"] = f"""
SELECT event_id, event_id % 17 <> 3 AS accepted, CAST(user_id AS VARCHAR) AS partition_key,
  concat('{{"customer_id":', user_id,
    CASE WHEN event_id % 17 = 3 THEN ''
      ELSE concat(',"interaction_type":"', {INTERACTION_TYPE}, '"') END,
    ',"channel":', coalesce('"' || {CHANNEL} || '"', 'null'),
    ',"rating":', CASE WHEN event_id % 6 = 5 THEN 'null' WHEN event_id % 9 = 4 THEN '"bad"'
      ELSE concat('"', (event_id * 7) % 8, '"') END,
    ',"message_excerpt":', CASE WHEN event_id % 5 = 0 THEN 'null'
      ELSE coalesce('"' || replace(props, '"', '\\"') || '"', 'null') END,
    ',"timestamp":', CASE WHEN event_id % 19 = 0 THEN 'null'
      ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END, '}}') AS value
FROM events"""

# Groups are emitted once the newest event is ten minutes past them.
ORACLES["stream_volume_windows"] = f"""WITH {BRONZE_CRM},
spans AS (
  SELECT timestamp - timestamp % 600 AS start, upper(interaction_type) AS interaction_type,
    count(*) AS volume
  FROM bronze_crm GROUP BY 1, 2)
SELECT {iso_time('make_timestamp(start * 1000000)', 'window_start')},
  {iso_time('make_timestamp((start + 600) * 1000000)', 'window_end')}, interaction_type, volume
FROM spans WHERE start + 600 <= (SELECT max(timestamp) FROM bronze_crm) - 600"""

ORACLES["stream_dedup_late"] = f"""WITH {BRONZE_WTL},{WTL_ONE}
SELECT session_id, {iso_time('make_timestamp(timestamp * 1000000)', 'timestamp')}, user_id, page,
  device_type, browser, event_type
FROM wtl_one WHERE timestamp <= (SELECT max(timestamp) FROM bronze_wtl) - 600"""


def sessions(source: str) -> str:
    return f"""
marked AS (
  SELECT user_id, timestamp, CASE WHEN timestamp - lag(timestamp) OVER one_user > 1800
    THEN 1 ELSE 0 END AS opens
  FROM {source} WHERE user_id IS NOT NULL
  WINDOW one_user AS (PARTITION BY user_id ORDER BY timestamp)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY timestamp) AS session_no FROM marked),
sessions AS (
  SELECT user_id, min(timestamp) AS first, max(timestamp) AS last, count(*) AS events
  FROM numbered GROUP BY user_id, session_no)
SELECT user_id, {iso_time('make_timestamp(first * 1000000)', 'session_start')},
  {iso_time('make_timestamp(last * 1000000)', 'session_end')}, events
FROM sessions"""


ORACLES["web_sessions_gap"] = f"WITH {BRONZE_WTL},{WTL_ONE},{sessions('wtl_one')}"
# The newest event of all, anonymous or not, moves no watermark here: rows without a
# user are filtered before it.
ORACLES["stream_web_sessions"] = f"""WITH {BRONZE_WTL},{sessions('bronze_wtl')}
WHERE last + 1800 <=
  (SELECT max(timestamp) FROM bronze_wtl WHERE user_id IS NOT NULL) - 600"""

ORACLES["stream_volume_complete"] = ORACLES["stream_volume_windows"].split("FROM spans WHERE")[0] + "FROM spans"
ORACLES["stream_sessions_complete"] = f"WITH {BRONZE_WTL},{sessions('bronze_wtl')}"
ORACLES["stream_late_merge"] = ORACLES["merge_wtl"]
ORACLES["stream_lanes"] = """
SELECT CAST(user_id AS VARCHAR) AS partition_key,
  CAST(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 7) AS BIGINT) % 16 AS INTEGER) AS lane,
  count(*) AS records, min(event_id) AS first_event, max(event_id) AS last_event
FROM events GROUP BY user_id"""
ORACLES["stream_envelopes"] = f"""WITH {LIVE}
SELECT event_id, outcome, outcome <> 'valid' AS kept_raw,
  {', '.join(f"CASE WHEN outcome = 'valid' THEN {c} END AS {c}" for c in (
    'customer_id', 'interaction_type', 'channel', 'rating', 'message_excerpt', 'timestamp'))}
FROM live"""
ORACLES["stream_landing_web"] = f"""WITH {BRONZE_WTL.replace('AS timestamp', 'AS timestamp, event_id')},
judged AS (
  SELECT *, CASE WHEN event_id % 23 = 5 THEN 'missing_field' WHEN event_id % 31 = 2 THEN 'bad_json'
    ELSE 'accepted' END AS outcome FROM bronze_wtl)
SELECT event_id, outcome,
  {', '.join(f"CASE WHEN outcome <> 'bad_json' THEN CAST({c} AS VARCHAR) END AS {n}" for c, n in (
    ('session_id', 'partition_key'), ('session_id', 'session_id'), ('user_id', 'user_id'),
    ('device_type', 'device_type'), ('browser', 'browser'), ('event_type', 'event_type'),
    ('timestamp', 'timestamp')))},
  CASE WHEN outcome = 'accepted' THEN page END AS page
FROM judged"""

# --- quality and governance --------------------------------------------------------


def profile_line(column: str, kind: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) FILTER ({column} IS NULL) AS nulls,
  count(*) FILTER ({column} IS NOT NULL AND TRY_CAST({column} AS {kind}) IS NULL)
    AS type_mismatches, count(*) AS row_count,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer_id, timestamp FROM valid) AS k)
    AS surplus_copies
FROM valid"""


PROFILE_TYPES = {
    "customer_id": "BIGINT", "interaction_type": "VARCHAR", "channel": "VARCHAR",
    "rating": "INTEGER", "message_excerpt": "VARCHAR", "timestamp": "BIGINT",
}
ORACLES["dq_profile"] = f"WITH {LIVE}, valid AS (SELECT * FROM live WHERE outcome = 'valid') " + (
    " UNION ALL ".join(profile_line(c, k) for c, k in PROFILE_TYPES.items())
)

ORACLES["hashed_users"] = f"""WITH {WTL},
salted AS (
  SELECT * REPLACE (sha256('till-house-salt' || CAST(user_id AS VARCHAR)) AS hashed_user_id)
  FROM wtl)
SELECT {WTL_COLUMNS.replace('user_id, hashed', 'hashed')} FROM salted"""

ORACLES["team_view_sales_store"] = f"""WITH {POS}
SELECT transaction_id, store_id, product_id, quantity, {POS_MONEY}, {iso_date()}
FROM pos WHERE store_id IN (
  SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')"""

ORACLES["retention_purge"] = f"""WITH {CRM} SELECT {CRM_COLUMNS} FROM crm
WHERE date >= DATE '2024-01-10'
  AND customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""

ORACLES["retention_purge_stored"] = ORACLES["retention_purge"]

ORACLES["silver_day_scan"] = f"""WITH {CRM} SELECT {CRM_COLUMNS} FROM crm
WHERE date = DATE '2024-01-20'"""

ORACLES["team_view_marketing"] = f"""WITH {WTL},
salted AS (
  SELECT * REPLACE (sha256('till-house-salt' || CAST(user_id AS VARCHAR)) AS hashed_user_id)
  FROM wtl)
SELECT session_id, hashed_user_id, page, device_type, browser, event_type,
  {iso_time()}, {iso_date()}, is_anonymous
FROM salted"""

ORACLES["job_marketing_mart"] = (
    ORACLES["mart_roundtrip_marketing"]
    .replace("FROM events", "FROM (SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20') AS e")
    .replace("'2024-01-31' AS date", "'2024-01-20' AS date")
)
