"""The same queries as plain SQL, for checking values with another engine.

Written join-first and row by row, unlike the library, which rolls up before it
joins: equal results show that the two agree.
"""

_RANGE = "partition_date BETWEEN 20240105 AND 20240120"

# The three inputs, as in daybook.queries.inputs.
_INPUTS = """
user_events AS (
  SELECT CAST(event_id AS STRING) AS event_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN event_id % 71 = 0 THEN NULL ELSE ts END AS event_timestamp,
    CASE WHEN event_id % 53 = 0 THEN NULL
         ELSE concat(CAST(user_id AS STRING), '-', CAST(event_id % 7 AS STRING)) END AS session_id,
    concat('/page', CAST(event_id % 20 AS STRING)) AS page_url,
    CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id,
    CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS partition_date
  FROM events),
purchases AS (
  SELECT CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END
      AS transaction_id, CAST(l_partkey AS STRING) AS product_id,
    CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN -l_extendedprice
         ELSE l_extendedprice END AS purchase_amount,
    l_shipdate AS purchase_timestamp,
    CASE l_linenumber % 3 WHEN 0 THEN 'credit' WHEN 1 THEN 'paypal' ELSE 'debit' END
      AS payment_method,
    'USD' AS currency,
    CASE WHEN (l_orderkey + l_linenumber) % 29 = 0 THEN NULL ELSE l_returnflag = 'R' END AS is_refunded,
    CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS user_id,
    CAST(20240101 + l_orderkey % 30 AS INT) AS partition_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
profiles AS (
  SELECT c_custkey, CAST(c_custkey AS STRING) AS user_id, c_name AS username,
    CASE c_custkey % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
                       WHEN 3 THEN '45+' ELSE NULL END AS age_group,
    n_name AS country,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE lower(c_mktsegment) END AS subscription_tier,
    concat(lower(c_name), '@example.com') AS email,
    TIMESTAMP '2020-01-01 00:00:00' AS registration_date,
    c_acctbal >= 0 AS is_active
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
lookup_user AS (
  SELECT user_id, username, age_group, country, subscription_tier, email, registration_date, is_active
  FROM profiles
  UNION ALL
  SELECT user_id, username, age_group, country,
    CASE WHEN c_custkey % 13 = 0 THEN 'trial' ELSE subscription_tier END,
    email, registration_date, is_active
  FROM profiles WHERE c_custkey % 11 = 0 OR c_custkey % 13 = 0)"""

_RANKED = f"""
ranked_events AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, session_id, event_type
                               ORDER BY event_timestamp DESC NULLS LAST, event_id) AS row_number
  FROM user_events
  WHERE {_RANGE} AND event_type IS NOT NULL AND user_id IS NOT NULL),
ranked_purchases AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY purchase_timestamp DESC NULLS LAST,
                                 product_id, purchase_amount, payment_method) AS row_number
  FROM purchases
  WHERE {_RANGE} AND NOT is_refunded AND purchase_amount > 0)"""

_DEFAULTED = """coalesce(username, 'unknown') AS username,
    coalesce(age_group, 'unknown') AS age_group,
    coalesce(country, 'unknown') AS country,
    coalesce(subscription_tier, 'free') AS subscription_tier"""

_ENRICHED = f"""
active AS (
  SELECT user_id AS active_user, username, age_group, country, subscription_tier
  FROM lookup_user WHERE is_active),
enriched_events AS (
  SELECT event_id, event_type, event_timestamp, session_id, page_url, device_type, user_id,
    partition_date, {_DEFAULTED}
  FROM ranked_events LEFT JOIN active ON user_id = active_user
  WHERE row_number = 1),
enriched_purchases AS (
  SELECT transaction_id, product_id, purchase_amount, purchase_timestamp, payment_method,
    currency, is_refunded, user_id, partition_date, {_DEFAULTED}
  FROM ranked_purchases LEFT JOIN active ON user_id = active_user
  WHERE row_number = 1)"""

# Total in exact decimals; the average is not rounded further.
_MONEY = """count(*) AS total_purchases,
    CAST(sum(CAST(purchase_amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_purchase_amount,
    CAST(sum(CAST(purchase_amount AS DECIMAL(18, 2))) AS DOUBLE) / count(*)
      AS avg_purchase_amount"""

_GROUP = "user_id, username, age_group, country, subscription_tier, partition_date"


def _usual(source: str, attribute: str, group: str, name: str) -> str:
    """CTE: each group's most frequent non-null value, the lowest on a tie."""
    return f"""
{name} AS (
  SELECT {group}, {attribute} AS {name} FROM (
    SELECT {group}, {attribute}, row_number() OVER (
        PARTITION BY {group} ORDER BY count(*) DESC, {attribute}) AS place
    FROM {source} WHERE {attribute} IS NOT NULL
    GROUP BY {group}, {attribute}) AS counted
  WHERE place = 1)"""


_ROLLUPS = f"""{_usual("enriched_events", "device_type", _GROUP, "most_common_device")},
{_usual("enriched_events", "event_type", _GROUP, "most_common_event_type")},
event_totals AS (
  SELECT {_GROUP}, count(*) AS total_events, count(DISTINCT session_id) AS unique_sessions,
    min(event_timestamp) AS first_event_timestamp, max(event_timestamp) AS last_event_timestamp
  FROM enriched_events GROUP BY {_GROUP}),
event_rollup AS (
  SELECT * FROM event_totals
  LEFT JOIN most_common_device USING ({_GROUP})
  LEFT JOIN most_common_event_type USING ({_GROUP})),
purchase_rollup AS (
  SELECT user_id, {_MONEY}
  FROM enriched_purchases GROUP BY user_id)"""

_SUMMARY = f"""
SELECT {_GROUP}, total_events, unique_sessions,
  coalesce(total_purchases, 0) AS total_purchases,
  coalesce(total_purchase_amount, 0) AS total_purchase_amount,
  coalesce(avg_purchase_amount, 0) AS avg_purchase_amount,
  most_common_device, most_common_event_type, first_event_timestamp, last_event_timestamp
FROM event_rollup LEFT JOIN purchase_rollup USING (user_id)"""

_LINE = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(l_partkey AS STRING) AS l_partkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate
FROM lineitem"""


def _over_inputs(select: str) -> str:
    return f"WITH {_INPUTS}\n{select}"


def _over_ranked(select: str) -> str:
    return f"WITH {_INPUTS},{_RANKED}\n{select}"


def _over_enriched(select: str) -> str:
    return f"WITH {_INPUTS},{_RANKED},{_ENRICHED}\n{select}"


def _over_rollups(select: str) -> str:
    return f"WITH {_INPUTS},{_RANKED},{_ENRICHED},{_ROLLUPS}\n{select}"


def _by_day(measures: str) -> str:
    return _over_inputs(
        f"SELECT user_id, partition_date, {measures} FROM user_events"
        " GROUP BY user_id, partition_date"
    )


def _first_of_day(attribute: str, name: str) -> str:
    return f"max(CASE WHEN place = 1 THEN {attribute} END) AS {name}"


_EVENT_COLUMNS = """event_id, event_type, event_timestamp, session_id, page_url, device_type,
  user_id, partition_date"""
_PURCHASE_COLUMNS = """transaction_id, product_id, purchase_amount, purchase_timestamp,
  payment_method, currency, is_refunded, user_id, partition_date"""

ORACLE_SQL: dict[str, str] = {
    "src_scan_table": "SELECT * FROM orders",
    "src_typed_conform": _LINE,
    "src_project_columns": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem",
    "snk_overwrite_roundtrip": "SELECT * FROM orders",
    "snk_typed_roundtrip": _LINE,
    "snk_append": "SELECT * FROM customer",
    "snk_ignore": "SELECT * FROM orders",
    "snk_partitioned_pruned_read": _over_inputs(f"SELECT * FROM purchases WHERE {_RANGE}"),
    "snk_typed_partitioned": _over_inputs("SELECT * FROM user_events"),
    "snk_compact_roundtrip": "SELECT * FROM lineitem",
    "flt_date_range": _over_inputs(f"SELECT * FROM user_events WHERE {_RANGE}"),
    "flt_required_not_null": _over_inputs(
        "SELECT * FROM user_events WHERE event_type IS NOT NULL AND user_id IS NOT NULL"
    ),
    "flt_not_refunded": _over_inputs("SELECT * FROM purchases WHERE NOT is_refunded"),
    "flt_positive_amount": _over_inputs("SELECT * FROM purchases WHERE purchase_amount > 0"),
    "flt_active_profiles": _over_inputs("SELECT * FROM lookup_user WHERE is_active"),
    "win_event_recency_rank": _over_ranked("SELECT * FROM ranked_events"),
    "win_purchase_recency_rank": _over_ranked("SELECT * FROM ranked_purchases"),
    "dedup_latest_event": _over_ranked(
        f"SELECT {_EVENT_COLUMNS} FROM ranked_events WHERE row_number = 1"
    ),
    "dedup_latest_purchase": _over_ranked(
        f"SELECT {_PURCHASE_COLUMNS} FROM ranked_purchases WHERE row_number = 1"
    ),
    "fn_coalesce_defaults": _over_inputs(f"SELECT user_id, {_DEFAULTED} FROM lookup_user"),
    "fn_fill_zero": _over_inputs(f"""
SELECT user_id, username, coalesce(total_purchases, 0) AS total_purchases,
  coalesce(total_purchase_amount, 0) AS total_purchase_amount,
  coalesce(avg_purchase_amount, 0) AS avg_purchase_amount
FROM lookup_user LEFT JOIN (
  SELECT user_id, {_MONEY}
  FROM purchases GROUP BY user_id) AS totals USING (user_id)"""),
    "join_enrich_events": _over_enriched("SELECT * FROM enriched_events"),
    "join_enrich_purchases": _over_enriched("SELECT * FROM enriched_purchases"),
    "join_enrich_hot_key": _over_enriched(
        f"""SELECT bought.*, {_DEFAULTED}
FROM (
  SELECT * REPLACE (CASE WHEN payment_method = 'credit' THEN '22' ELSE user_id END AS user_id)
  FROM purchases) AS bought
LEFT JOIN active ON bought.user_id = active_user"""
    ),
    "join_event_purchase_rollups": _over_rollups(_SUMMARY),
    "join_inner_daily_activity": _over_inputs("""
SELECT user_id, partition_date, count(*) AS event_count,
  count(DISTINCT session_id) AS session_count
FROM user_events JOIN (SELECT user_id FROM lookup_user) AS known USING (user_id)
WHERE partition_date >= 20240105
GROUP BY user_id, partition_date"""),
    "agg_event_rollup": _over_rollups("SELECT * FROM event_rollup"),
    "agg_purchase_rollup": _over_rollups("SELECT * FROM purchase_rollup"),
    "agg_count_star": _by_day("count(*) AS total_events"),
    "agg_count_distinct": _by_day("count(DISTINCT session_id) AS unique_sessions"),
    "agg_mode": f"""WITH {_INPUTS},
days AS (SELECT DISTINCT user_id, partition_date FROM user_events),
{_usual("user_events", "device_type", "user_id, partition_date", "most_common_device_type")},
{_usual("user_events", "event_type", "user_id, partition_date", "most_common_event_type")}
SELECT days.user_id, days.partition_date, most_common_device_type, most_common_event_type
FROM days
LEFT JOIN most_common_device_type AS d
  ON days.user_id IS NOT DISTINCT FROM d.user_id AND days.partition_date = d.partition_date
LEFT JOIN most_common_event_type AS e
  ON days.user_id IS NOT DISTINCT FROM e.user_id AND days.partition_date = e.partition_date""",
    "agg_first": _over_inputs(f"""
SELECT user_id, partition_date, {_first_of_day("device_type", "first_device")},
  {_first_of_day("event_type", "first_event_type")}
FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, partition_date
                               ORDER BY event_timestamp NULLS FIRST, event_id) AS place
  FROM user_events) AS placed
GROUP BY user_id, partition_date"""),
    "agg_min_max": _by_day(
        "min(event_timestamp) AS first_event_timestamp,"
        " max(event_timestamp) AS last_event_timestamp"
    ),
    "agg_sum_avg": _over_inputs(f"SELECT user_id, {_MONEY} FROM purchases GROUP BY user_id"),
    "user_activity_summary": _over_rollups(_SUMMARY),
    "job_tables_roundtrip": _over_rollups(_SUMMARY),
}
