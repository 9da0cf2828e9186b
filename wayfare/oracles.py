"""The same queries as SQL over the given tables, for checking."""

from __future__ import annotations

# The raw inputs, as ``wayfare.sources.sample`` derives them.
VIEWS = {
    "raw_bookings": """
SELECT l_orderkey AS booking_id, l_suppkey AS user_id,
       concat('R', CAST(l_partkey % 25 AS VARCHAR)) AS route,
       CASE l_linenumber % 4 WHEN 0 THEN 'bus' WHEN 1 THEN 'train' WHEN 2 THEN 'ferry' ELSE 'flight' END AS transport_type,
       CASE l_returnflag WHEN 'A' THEN 'paid' WHEN 'N' THEN 'created' ELSE 'cancelled' END AS status,
       CASE WHEN l_linenumber = 7 AND l_discount >= 0.1 THEN -l_extendedprice ELSE l_extendedprice END AS price,
       'USD' AS currency, o_orderdate AS created_at, l_shipdate AS loaded_at, CAST(l_linenumber AS VARCHAR) AS run_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_ads": """
SELECT p_partkey AS campaign_id, p_name AS campaign_name,
       CAST((p_size - 1) * v AS BIGINT) AS clicks, CAST((p_partkey % 7) * 100 * v AS BIGINT) AS impressions,
       CASE WHEN p_partkey % 11 = 0 THEN CAST(0 AS DOUBLE) ELSE p_retailprice * v END AS spend,
       CASE WHEN p_partkey % 2 = 0 THEN 'google_ads' ELSE 'meta_ads' END AS platform,
       CASE v WHEN 1 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-03 00:00:00' END AS loaded_at
FROM part CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 AS v) versions""",
    "raw_user_events": """
SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
       CASE event_type WHEN 'view' THEN 'search_performed' WHEN 'click' THEN 'booking_started' ELSE 'payment_completed' END AS event_type,
       ts AS event_time, concat('{"route":"R', CAST(user_id % 25 AS VARCHAR), '"}') AS properties,
       'user.events' AS source_topic, ts AS ingested_at
FROM events WHERE event_type IN ('view','click','purchase')
UNION ALL
SELECT CAST(event_id AS VARCHAR), user_id, 'booking_started', ts,
       concat('{"route":"R', CAST(user_id % 25 AS VARCHAR), '"}'), 'user.events', TIMESTAMP '2024-02-15 00:00:00'
FROM events WHERE event_type IN ('view','click','purchase') AND event_id % 10 = 0""",
    "cdc_changes": """
SELECT o_orderkey AS order_id, o_custkey AS user_id, concat('R', CAST(o_orderkey % 25 AS VARCHAR)) AS route,
       CASE o_orderkey % 4 WHEN 0 THEN 'bus' WHEN 1 THEN 'train' WHEN 2 THEN 'ferry' ELSE 'flight' END AS transport_type,
       CASE WHEN v = 2 AND o_orderstatus = 'P' THEN 'cancelled' WHEN o_orderstatus = 'F' THEN 'completed'
            WHEN o_orderstatus = 'O' THEN 'paid' ELSE 'created' END AS status,
       o_totalprice AS price, 'USD' AS currency,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS campaign_id, o_orderdate AS created_at,
       CASE v WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'r' ELSE 'c' END WHEN 2 THEN 'u' ELSE 'd' END AS op,
       o_orderkey * 10 + v AS source_ts_ms
FROM orders CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 AS v UNION ALL SELECT 3 AS v) versions
WHERE v = 1 OR (v = 2 AND o_orderkey % 3 = 0) OR (v = 3 AND o_orderkey % 10 = 0)""",
    "incoming": r"""
SELECT ts, event_id AS n, event_type AS given, user_id,
       CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN concat('evt-', event_id)
            ELSE concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS VARCHAR), 12, '0')) END AS event_id,
       CASE WHEN event_id % 41 = 0 THEN 'page_scrolled' WHEN event_type IN ('signup', 'purchase') THEN 'payment_completed'
            WHEN event_type = 'click' THEN 'booking_started' ELSE 'search_performed' END AS event_type,
       CASE WHEN event_type = 'error' THEN 'not a time'
            WHEN event_id % 5 = 0 THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%f-05:00')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS time_text,
       CASE WHEN event_type = 'signup' THEN '"{broken"' WHEN event_id % 50 = 0 THEN '{"page":1}'
            WHEN event_id % 3 = 1 THEN concat('"{\"route\":\"R', user_id % 25, '\"}"')
            ELSE concat('{"route":"R', user_id % 25, '","extra":1}') END AS properties,
       (event_id % 7 = 0) AS number_as_text,
       concat_ws(',', CASE WHEN event_id % 41 = 0 THEN 'event_type' END,
                 CASE WHEN event_type = 'error' THEN 'event_time' END,
                 CASE WHEN event_type = 'signup' THEN 'properties' WHEN event_id % 50 = 0 THEN 'properties.route' END) AS fields
FROM events""",
    "letters": """
SELECT ts, event_id, event_type, user_id, time_text, properties, number_as_text, fields,
       concat('{"event_id":"', event_id, '","user_id":',
              CASE WHEN number_as_text THEN concat('" ', user_id, '.0"') ELSE CAST(user_id AS VARCHAR) END,
              ',"event_type":"', event_type, '","event_time":"', time_text, '","properties":', properties,
              ',"device_type":"web"}') AS raw_event,
       CASE WHEN given = 'signup' THEN 'JSONDecodeError' ELSE 'ValidationError' END AS error_type,
       date_trunc('millisecond', ts) AS failed_at,
       extract(minute FROM ts) % 5 = 0 AS recovered,
       CAST(extract(second FROM ts) % 4 AS INTEGER) AS replay_count
FROM incoming WHERE fields <> ''""",
    "candidates": """
SELECT * FROM letters WHERE NOT recovered AND replay_count < 3 ORDER BY failed_at, event_id, raw_event LIMIT 20""",
    "delivered": "SELECT * FROM candidates WHERE NOT number_as_text AND event_type <> 'page_scrolled'",
    "ad_records": """
SELECT *, campaign_id AS k,
       concat('{"platform":"', CASE WHEN campaign_id % 13 = 0 THEN 'other_ads' ELSE platform END,
              '","campaign_id":', CASE WHEN campaign_id % 31 = 0 THEN concat('"', campaign_id, '.0"') ELSE CAST(campaign_id AS VARCHAR) END,
              ',"campaign_name":"', CASE WHEN campaign_id % 17 = 0 THEN '  ' ELSE concat(' ', campaign_name, ' ') END, '"',
              CASE WHEN campaign_id % 23 = 0 THEN '' ELSE concat(',"impressions":', impressions) END,
              ',"clicks":', CASE WHEN campaign_id % 19 = 0 THEN -clicks - 1 ELSE clicks END,
              ',"spend":', CASE WHEN campaign_id % 29 = 0 THEN concat('"', spend, '"') ELSE CAST(spend AS VARCHAR) END,
              ',"note":"extra"}') AS value,
       concat_ws(',', CASE WHEN campaign_id % 13 = 0 THEN 'platform' END,
                 CASE WHEN campaign_id % 17 = 0 THEN 'campaign_name' END,
                 CASE WHEN campaign_id % 19 = 0 THEN 'clicks' END) AS fields
FROM raw_ads""",
    "stg_bookings": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY loaded_at DESC, run_id DESC, price DESC, user_id DESC,
         route DESC, status DESC, transport_type DESC, currency DESC, created_at DESC) AS rn FROM raw_bookings) WHERE rn = 1""",
    "bookings_ok": "SELECT * FROM raw_bookings WHERE booking_id <> 0 AND price >= 0",
    "staged_before": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY loaded_at DESC, run_id DESC, price DESC, user_id DESC,
         route DESC, status DESC, transport_type DESC, currency DESC, created_at DESC) AS rn
  FROM bookings_ok WHERE loaded_at <= TIMESTAMP '1998-01-01 00:00:00') WHERE rn = 1""",
    "bookings_new": """
SELECT * FROM bookings_ok
WHERE loaded_at > (SELECT coalesce(max(loaded_at), TIMESTAMP '1970-01-01 00:00:00') FROM staged_before)""",
    "stg_ads": """
SELECT platform, CAST(campaign_id AS VARCHAR) AS campaign_id, campaign_name, clicks, impressions, spend, loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY platform, campaign_id ORDER BY loaded_at DESC) AS rn FROM raw_ads)
WHERE rn = 1""",
    "stg_orders": """
SELECT order_id, user_id, route, transport_type, status, price, currency, coalesce(campaign_id, 0) AS campaign_id,
       created_at, created_at AS updated_at, source_ts_ms
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_ts_ms DESC) AS rn
      FROM cdc_changes WHERE op IN ('c', 'u', 'r')) WHERE rn = 1""",
    "stg_events": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rn FROM raw_user_events) WHERE rn = 1""",
    "outcomes": """
SELECT event_id, ts, CASE event_type WHEN 'signup' THEN 'dlq' WHEN 'error' THEN 'failed' ELSE 'processed' END AS outcome
FROM events""",
    "sliding": """
SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, outcome, count(*) AS events_count
FROM (SELECT date_trunc('minute', ts) - to_minutes(lag) AS w, outcome FROM outcomes, range(0, 5) AS lags(lag))
GROUP BY ALL""",
    "offsets": """
SELECT event_type AS consumer_group, user_id % 4 AS partition_id, count(*) AS end_offset,
       count(*) FILTER (event_id % 20 <> 0) AS committed_offset
FROM events GROUP BY ALL""",
}
VIEWS["dq_rows"] = """
SELECT 'raw_bookings_completeness' AS check_name, count(*) AS check_value, 1 AS check_threshold, 'raw' AS suite FROM raw_bookings
UNION ALL
SELECT 'raw_bookings_duplicates_within_run', count(*), 0, 'raw'
FROM (SELECT 1 FROM raw_bookings GROUP BY booking_id, run_id HAVING count(*) > 1)
UNION ALL
SELECT 'stg_bookings_completeness', count(*), 1, 'stg' FROM stg_bookings
UNION ALL
SELECT 'stg_bookings_uniqueness', count(*), 0, 'stg' FROM (SELECT 1 FROM stg_bookings GROUP BY booking_id HAVING count(*) > 1)
UNION ALL
SELECT 'stg_orders_not_empty', count(*), 1, 'orders' FROM stg_orders
UNION ALL
SELECT 'stg_orders_duplicate_order_ids', count(*), 0, 'orders' FROM (SELECT 1 FROM stg_orders GROUP BY order_id HAVING count(*) > 1)
UNION ALL
SELECT 'stg_orders_positive_price_for_revenue_orders', count(*), 0, 'orders' FROM stg_orders
WHERE status IN ('paid', 'completed') AND price <= 0
UNION ALL
SELECT 'stg_orders_valid_status', count(*), 0, 'orders' FROM stg_orders WHERE status NOT IN ('paid', 'completed', 'cancelled')"""

# Views each view reads.
NEEDS = {
    "letters": ["incoming"],
    "candidates": ["letters"],
    "delivered": ["candidates"],
    "ad_records": ["raw_ads"],
    "stg_bookings": ["raw_bookings"],
    "bookings_ok": ["raw_bookings"],
    "staged_before": ["bookings_ok"],
    "bookings_new": ["bookings_ok", "staged_before"],
    "stg_ads": ["raw_ads"],
    "stg_orders": ["cdc_changes"],
    "stg_events": ["raw_user_events"],
    "sliding": ["outcomes"],
    "dq_rows": ["raw_bookings", "stg_bookings", "stg_orders"],
}


def _with(body: str, *views: str) -> str:
    """A statement with the views it reads in front, each once and after those it needs."""
    ordered: list[str] = []

    def add(view: str) -> None:
        for needed in NEEDS.get(view, []):
            add(needed)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        add(view)
    heads = ",\n".join(f"{view} AS ({VIEWS[view].strip()})" for view in ordered)
    return f"WITH {heads}\n{body.strip()}" if heads else body.strip()


MONEY = "coalesce(CAST(sum(CAST({0} AS DECIMAL(30,8))) AS DOUBLE), 0)"
PAID_REVENUE = MONEY.format("CASE WHEN status = 'paid' THEN price END")
REVENUE = MONEY.format("price")
DAILY = f"""
SELECT CAST(created_at AS DATE) AS booking_date, count(*) AS total_bookings,
       count(*) FILTER (status = 'paid') AS paid_bookings, count(*) FILTER (status = 'created') AS created_bookings,
       count(*) FILTER (status = 'cancelled') AS cancelled_bookings, {PAID_REVENUE} AS total_revenue
FROM stg_bookings GROUP BY 1"""
ROUTES = f"""
SELECT route, transport_type, count(*) AS total_bookings, count(*) FILTER (status = 'paid') AS paid_bookings,
       {PAID_REVENUE} AS total_revenue
FROM stg_bookings GROUP BY route, transport_type"""
STATUSES = "SELECT status, count(*) AS total_bookings FROM stg_bookings GROUP BY status"
METRIC_SET = f"count(*) AS total_bookings, count(*) FILTER (status = 'paid') AS paid_bookings, {PAID_REVENUE} AS total_revenue"

CAMPAIGNS = f"""
SELECT platform, campaign_id, campaign_name, spend, clicks, impressions, bookings, revenue,
       CASE WHEN bookings = 0 THEN 0 ELSE spend / bookings END AS cpa,
       CASE WHEN spend = 0 THEN 0 ELSE revenue / spend END AS roas
FROM (SELECT a.platform, a.campaign_id, a.campaign_name, a.spend, a.clicks, a.impressions,
             count(*) FILTER (o.status IN ('paid', 'completed')) AS bookings,
             {MONEY.format("CASE WHEN o.status IN ('paid', 'completed') THEN o.price END")} AS revenue
      FROM stg_ads a LEFT JOIN stg_orders o ON a.campaign_id = CAST(o.campaign_id AS VARCHAR)
      GROUP BY ALL)"""


def _conversion(count: str, views: bool = True) -> str:
    def step(event_type: str) -> str:
        return f"(SELECT {count} FROM stg_events WHERE event_type = '{event_type}')"

    s, b, p = step("search_performed"), step("booking_started"), step("payment_completed")
    body = (
        f"""
SELECT 'searches' AS metric, CAST({s} AS DOUBLE) AS value
UNION ALL SELECT 'bookings', CAST({b} AS DOUBLE)
UNION ALL SELECT 'payments', CAST({p} AS DOUBLE)
UNION ALL SELECT 'search_to_booking_rate', CASE WHEN {s} = 0 THEN 0 ELSE {b} / CAST({s} AS DOUBLE) END
UNION ALL SELECT 'booking_to_payment_rate', CASE WHEN {b} = 0 THEN 0 ELSE {p} / CAST({b} AS DOUBLE) END"""
    )
    return _with(body, "stg_events") if views else body


def _dq(suite: str, at: str, fresh: str = "", view: str = "") -> str:
    """Results of a suite as SQL; ``fresh`` names its freshness check over ``view``."""
    freshness = f"""
UNION ALL SELECT '{fresh}', date_diff('minute', max(loaded_at), TIMESTAMP '{at}'), 120, '{suite}' FROM {view}""" if fresh else ""
    return f"""
SELECT check_name, CASE WHEN (check_threshold = 0 AND check_value = 0) OR (check_threshold = 1 AND check_value > 0)
                          OR (check_threshold = 120 AND check_value <= 120) THEN 'PASS' ELSE 'FAIL' END AS check_status,
       CAST(check_value AS DOUBLE) AS check_value, CAST(check_threshold AS DOUBLE) AS check_threshold,
       TIMESTAMP '{at}' AS checked_at
FROM (SELECT * FROM dq_rows WHERE suite = '{suite}'{freshness})"""


NOW = "2024-03-01 00:00:30"
EARLIER = "2024-02-20 12:00:00"

# Declared column tests, and where the column comes from.
MODEL_BODIES = {
    "stg_bookings_latest": "SELECT * FROM stg_bookings",
    "stg_ads_latest": "SELECT * FROM stg_ads",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_user_events": "SELECT * FROM stg_events",
    "mart_daily_bookings": DAILY,
    "mart_route_revenue": ROUTES,
    "mart_booking_status": STATUSES,
    "mart_campaign_performance": CAMPAIGNS,
    "mart_orders_status": f"SELECT status, count(*) AS orders_count, {REVENUE} AS total_revenue FROM stg_orders GROUP BY status",
    "mart_route_revenue_from_orders": f"""
SELECT route, count(*) AS orders_count, {REVENUE} AS total_revenue, {REVENUE} / count(*) AS avg_order_value
FROM stg_orders WHERE status IN ('paid', 'completed') GROUP BY route""",
    "mart_user_event_funnel": """
SELECT event_type, count(DISTINCT user_id) AS users_count, count(*) AS events_count FROM stg_events GROUP BY event_type""",
    "mart_booking_conversion": """
SELECT unnest(['searches', 'bookings', 'payments', 'search_to_booking_rate', 'booking_to_payment_rate']) AS metric, 0.0 AS value""",
}


# The declared column tests, written out so that a test the engine forgets is missed here.
MODEL_CHECKS = """
stg_bookings_latest.booking_id.not_null stg_bookings_latest.status.not_null stg_bookings_latest.booking_id.unique
stg_ads_latest.platform.not_null stg_ads_latest.campaign_id.not_null stg_ads_latest.campaign_name.not_null
stg_orders.order_id.not_null stg_orders.status.not_null stg_orders.price.not_null stg_orders.order_id.unique
stg_user_events.event_id.not_null stg_user_events.user_id.not_null stg_user_events.event_type.not_null stg_user_events.event_id.unique
mart_daily_bookings.booking_date.not_null mart_daily_bookings.total_bookings.not_null mart_daily_bookings.total_revenue.not_null
mart_route_revenue.route.not_null mart_route_revenue.transport_type.not_null mart_route_revenue.total_bookings.not_null
mart_route_revenue.total_revenue.not_null mart_booking_status.status.not_null mart_booking_status.total_bookings.not_null
mart_campaign_performance.platform.not_null mart_campaign_performance.campaign_id.not_null mart_campaign_performance.spend.not_null
mart_campaign_performance.revenue.not_null mart_orders_status.status.not_null mart_orders_status.orders_count.not_null
mart_orders_status.total_revenue.not_null mart_route_revenue_from_orders.route.not_null
mart_route_revenue_from_orders.orders_count.not_null mart_route_revenue_from_orders.total_revenue.not_null
mart_user_event_funnel.event_type.not_null mart_user_event_funnel.users_count.not_null mart_user_event_funnel.events_count.not_null
mart_booking_conversion.metric.not_null mart_booking_conversion.value.not_null mart_booking_conversion.metric.unique
"""


def _model_tests() -> str:
    parts = []
    for name in MODEL_CHECKS.split():
        model, column, kind = name.split(".")
        body = f"({MODEL_BODIES[model].strip()})"
        if kind == "not_null":
            parts.append(f"SELECT '{name}' AS check_name, count(*) AS n FROM {body} WHERE {column} IS NULL")
        else:
            parts.append(
                f"SELECT '{name}' AS check_name, count(*) AS n FROM (SELECT 1 FROM {body} WHERE {column} IS NOT NULL "
                f"GROUP BY {column} HAVING count(*) > 1)"
            )
    tests = "\nUNION ALL ".join(parts)
    return _with(
        f"""
SELECT check_name, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS check_status, CAST(n AS DOUBLE) AS check_value,
       CAST(0 AS DOUBLE) AS check_threshold, TIMESTAMP '{NOW}' AS checked_at
FROM ({tests})""",
        "stg_bookings", "stg_ads", "stg_orders", "stg_events",
    )


PRICE_TEXT = r"regexp_replace(CAST(price AS VARCHAR), '\.0$', '')"
BOOKING_LETTERS = f"""
SELECT booking_id,
       concat('{{"booking_id":"', booking_id, '","user_id":"', user_id, '","route":"', route, '","transport_type":"', transport_type,
              '","status":"', status, '","price":"', {PRICE_TEXT}, '","currency":"', currency,
              '","created_at":"', strftime(created_at, '%Y-%m-%d %H:%M:%S.%g'),
              '","loaded_at":"', strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%g'), '","run_id":"', run_id, '"}}') AS raw_record,
       CASE WHEN booking_id = 0 THEN 'booking_id is missing or zero' ELSE 'price is negative' END AS error_reason,
       TIMESTAMP '{NOW}' AS failed_at
FROM raw_bookings WHERE booking_id = 0 OR price < 0"""

VALID_EVENTS = """
SELECT event_id, user_id, event_type, date_trunc('second', ts) AS event_time,
       concat('{"route":"R', user_id % 25, '"}') AS properties, 'user.events.avro' AS source_topic{extra}
FROM incoming WHERE fields = ''"""

TUMBLING = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       outcome, count(*) AS events_count
FROM outcomes GROUP BY ALL"""

REPLAYED_PROPERTIES = (
    "CASE WHEN properties LIKE '\"%' THEN json_extract_string(properties, '$') ELSE properties END"
)


def _long(mart: str, body: str, key: str, *measures: str) -> str:
    """A mart as rows of (mart, key, measure, value)."""
    rows = [
        f"SELECT '{mart}' AS mart, {key} AS key, '{m}' AS measure, round(CAST({m} AS DOUBLE), 6) AS value FROM ({body.strip()})" for m in measures
    ]
    return "\nUNION ALL ".join(rows)


def _delta_marts() -> dict[str, str]:
    orders, routes = MODEL_BODIES["mart_orders_status"], MODEL_BODIES["mart_route_revenue_from_orders"]
    bookings = (
        _long("daily", DAILY, "CAST(booking_date AS VARCHAR)", "total_bookings", "paid_bookings", "created_bookings", "cancelled_bookings", "total_revenue"),
        _long("route", ROUTES, "concat(route, '|', transport_type)", "total_bookings", "paid_bookings", "total_revenue"),
        _long("status", STATUSES, "status", "total_bookings"),
    )
    order = (
        _long("status", orders, "status", "orders_count", "total_revenue"),
        _long("route", routes, "route", "orders_count", "total_revenue", "avg_order_value"),
        _long("campaign", CAMPAIGNS, "concat(platform, '|', campaign_id)", "spend", "bookings", "revenue", "cpa", "roas"),
    )
    event = [_long("funnel", MODEL_BODIES["mart_user_event_funnel"], "event_type", "users_count", "events_count")]
    for by, count in (("events", "count(*)"), ("users", "count(DISTINCT user_id)")):
        event.append(_long(f"by {by}", _conversion(count, views=False), "metric", "value"))
    return {
        "delta_booking_marts": _with("\nUNION ALL ".join(bookings), "stg_bookings"),
        "delta_order_marts": _with("\nUNION ALL ".join(order), "stg_ads", "stg_orders"),
        "delta_event_marts": _with("\nUNION ALL ".join(event), "stg_events"),
    }


EPISODES = """
WITH minutes AS (
  SELECT 'user-events-failed-last-5m' AS alert, 'user_events' AS subject, window_end AS seen, events_count AS value, 1 AS hold, 0 AS threshold
  FROM sliding WHERE outcome = 'failed' AND events_count > 0
  UNION ALL
  SELECT 'kafka-consumer-lag-high', consumer_group, TIMESTAMP '2024-02-01 00:00:00' + to_minutes(k), backlog, 2, 100
  FROM (SELECT consumer_group, k, CAST(sum(end_offset - least(end_offset, committed_offset + 5 * k)) AS BIGINT) AS backlog
        FROM offsets, range(0, 4) AS ks(k) GROUP BY ALL) WHERE backlog > 100),
runs AS (
  SELECT *, seen - to_minutes(row_number() OVER (PARTITION BY alert, subject ORDER BY seen)) AS run FROM minutes)
SELECT alert, 'warning' AS severity, subject, min(seen) AS pending_at, min(seen) + to_minutes(any_value(hold)) AS fired_at,
       max(seen) + INTERVAL 1 MINUTE AS resolved_at, count(*) AS minutes, max(value) AS peak, CAST(any_value(threshold) AS BIGINT) AS threshold
FROM runs GROUP BY alert, subject, run HAVING count(*) > any_value(hold)"""

EVERY_KEY = f"""
SELECT check_name, CASE WHEN (kind = 'rows' AND v > 0) OR (kind = 'zero' AND v = 0) OR (kind = 'fresh' AND v <= 120) THEN 'PASS' ELSE 'FAIL' END AS check_status,
       CAST(v AS DOUBLE) AS check_value, CAST(CASE kind WHEN 'rows' THEN 1 WHEN 'fresh' THEN 120 ELSE 0 END AS DOUBLE) AS check_threshold,
       TIMESTAMP '{NOW}' AS checked_at
FROM (
  SELECT 'rows' AS check_name, 'rows' AS kind, count(*) AS v FROM raw_bookings
  UNION ALL SELECT 'booking and run', 'zero', count(*) FROM (SELECT 1 FROM raw_bookings GROUP BY booking_id, run_id HAVING count(*) > 1)
  UNION ALL SELECT 'booking', 'zero', count(*) FROM (SELECT 1 FROM raw_bookings GROUP BY booking_id HAVING count(*) > 1)
  UNION ALL SELECT 'user and load', 'zero', count(*) FROM (SELECT 1 FROM raw_bookings GROUP BY user_id, loaded_at HAVING count(*) > 1)
  UNION ALL SELECT 'negative prices', 'zero', count(*) FROM raw_bookings WHERE price < 0
  UNION ALL SELECT 'freshness', 'fresh', date_diff('minute', max(loaded_at), TIMESTAMP '{NOW}') FROM raw_bookings)"""

LOAD = """CASE WHEN loaded_at <= TIMESTAMP '1998-01-01 00:00:00' AND booking_id % 7 <> 3 THEN 1
  WHEN booking_id % 5 <> 2 THEN 2 ELSE 3 END"""


def oracle_sql() -> dict[str, str]:
    """One statement per query that SQL can express."""
    sql = {
        "stg_bookings_latest": _with("SELECT * FROM stg_bookings", "stg_bookings"),
        "stg_ads_latest": _with("SELECT * FROM stg_ads", "stg_ads"),
        "stg_orders": _with("SELECT * FROM stg_orders", "stg_orders"),
        "stg_orders_legacy": _with(
            """
SELECT order_id, user_id, route, transport_type, status, price, currency, coalesce(campaign_id, 0) AS campaign_id,
       created_at, created_at AS updated_at, source_ts_ms
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_ts_ms DESC) AS rn
      FROM cdc_changes WHERE op IN ('c', 'u')) WHERE rn = 1""",
            "cdc_changes",
        ),
        "stg_user_events": _with("SELECT * FROM stg_events", "stg_events"),
        "incremental_bookings": _with("SELECT * FROM bookings_new", "bookings_new"),
        "upsert_bookings": _with(
            """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY loaded_at DESC, run_id DESC, price DESC, user_id DESC,
         route DESC, status DESC, transport_type DESC, currency DESC, created_at DESC) AS rn
  FROM (SELECT * FROM staged_before UNION ALL SELECT * FROM bookings_new)) WHERE rn = 1""",
            "bookings_new",
        ),
        "incremental_dlq_bookings": _with(
            BOOKING_LETTERS.replace(
                "FROM raw_bookings",
                "FROM (SELECT * FROM raw_bookings WHERE loaded_at > (SELECT max(loaded_at) FROM staged_before))",
            ),
            "raw_bookings",
            "staged_before",
        ),
        "upsert_orders": _with("SELECT * FROM stg_orders", "stg_orders"),
        "upsert_events": _with("SELECT * FROM stg_events", "stg_events"),
        "upsert_ads": _with("SELECT * FROM stg_ads", "stg_ads"),
        "mart_daily_bookings": _with(DAILY, "stg_bookings"),
        "mart_route_revenue": _with(ROUTES, "stg_bookings"),
        "mart_booking_status": _with(STATUSES, "stg_bookings"),
        "mart_ad_performance": _with(
            """
SELECT platform, campaign_id, campaign_name, clicks, impressions, spend,
       CASE WHEN impressions = 0 THEN 0 ELSE clicks / CAST(impressions AS DOUBLE) END AS ctr,
       CASE WHEN clicks = 0 THEN 0 ELSE spend / clicks END AS cpc
FROM stg_ads""",
            "stg_ads",
        ),
        "mart_campaign_performance": _with(CAMPAIGNS, "stg_ads", "stg_orders"),
        "mart_orders_status": _with(MODEL_BODIES["mart_orders_status"], "stg_orders"),
        "mart_route_revenue_from_orders": _with(MODEL_BODIES["mart_route_revenue_from_orders"], "stg_orders"),
        "mart_user_event_funnel": _with(MODEL_BODIES["mart_user_event_funnel"], "stg_events"),
        "mart_booking_conversion_events": _conversion("count(*)"),
        "mart_booking_conversion_users": _conversion("count(DISTINCT user_id)"),
        "dq_raw_bookings": _with(_dq("raw", NOW, "raw_bookings_freshness", "raw_bookings"), "dq_rows"),
        "dq_stg_bookings": _with(_dq("stg", NOW, "stg_bookings_freshness", "stg_bookings"), "dq_rows"),
        "dq_orders": _with(_dq("orders", NOW), "dq_rows"),
        "dq_duplicate_keys": _with(
            "SELECT booking_id, run_id, count(*) AS copies FROM raw_bookings GROUP BY ALL HAVING count(*) > 1",
            "raw_bookings",
        ),
        "dq_model_tests": _model_tests(),
        "dq_history": _with(
            f"SELECT *, true AS stopped FROM ({_dq('raw', NOW, 'raw_bookings_freshness', 'raw_bookings')}\n"
            f"UNION ALL {_dq('raw', EARLIER, 'raw_bookings_freshness', 'raw_bookings').strip()})",
            "dq_rows",
        ),
        "stream_event_counters": _with(
            """
SELECT 'user_events' AS query, count(*) AS received, count(*) FILTER (WHERE fields = '') AS processed,
       CAST(0 AS BIGINT) AS failed, count(*) FILTER (WHERE fields <> '') AS dlq FROM incoming""",
            "incoming",
        ),
        "metric_route_revenue_model": _with(ROUTES, "stg_bookings"),
        "metric_booking_status_model": _with(STATUSES, "stg_bookings"),
        "mart_dq_latest_results": _with(
            f"{_dq('raw', NOW, 'raw_bookings_freshness', 'raw_bookings')}\nUNION ALL {_dq('orders', EARLIER).strip()}",
            "dq_rows",
        ),
        "bookings_valid": _with("SELECT * FROM bookings_ok", "bookings_ok"),
        "dlq_bookings": _with(BOOKING_LETTERS, "raw_bookings"),
        "dlq_error_reasons": _with(
            f"SELECT error_reason, count(*) AS records_count FROM ({BOOKING_LETTERS}) GROUP BY error_reason",
            "raw_bookings",
        ),
        "dlq_count": _with(
            "SELECT count(*) AS records_count FROM raw_bookings WHERE booking_id = 0 OR price < 0", "raw_bookings"
        ),
        "last_load": _with("SELECT max(loaded_at) AS last_load FROM stg_bookings", "stg_bookings"),
        "bookings_ingested": _with("SELECT * FROM raw_bookings", "raw_bookings"),
        "ads_validated": _with(
            """
SELECT k AS campaign_id, campaign_name, clicks, CASE WHEN k % 23 = 0 THEN 0 ELSE impressions END AS impressions, spend, platform,
       TIMESTAMP '2024-01-04 00:00:00.123' AS loaded_at
FROM ad_records WHERE fields = ''""",
            "ad_records",
        ),
        "ads_rejected": _with("SELECT value, fields FROM ad_records WHERE fields <> ''", "ad_records"),
        "ads_payload_archive": _with(
            f"""
SELECT platform AS source, replace(platform, '_', '-') AS endpoint, TIMESTAMP '{NOW}' AS fetched_at, platform, campaign_id,
       campaign_name, impressions, clicks, spend
FROM raw_ads""",
            "raw_ads",
        ),
        "ads_payload_rows": _with(
            f"""
SELECT platform AS source, replace(platform, '_', '-') AS endpoint, TIMESTAMP '{NOW}' AS fetched_at,
       count(*) AS n_records, min(campaign_id) AS first_campaign
FROM raw_ads GROUP BY platform, loaded_at, campaign_id // 100""",
            "raw_ads",
        ),
        "revenue_with_fine_prices": """
SELECT l_returnflag, round(fsum(charge), 4) AS revenue, round(fsum(charge) / count(*), 6) AS mean_charge
FROM (SELECT l_returnflag, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 7 AS charge FROM lineitem)
GROUP BY l_returnflag""",
        "events_valid": _with(
            VALID_EVENTS.replace("{extra}", ", date_trunc('millisecond', ts) AS ingested_at"), "incoming"
        ),
        "dlq_user_events": _with(
            """
SELECT event_id, raw_event, error_type, fields, 'user.events.avro' AS source_topic, failed_at, false AS recovered,
       CAST(0 AS INTEGER) AS replay_count
FROM letters""",
            "letters",
        ),
        "dlq_replay_candidates": _with(
            "SELECT event_id, raw_event, 'user.events.avro' AS source_topic, failed_at FROM candidates", "candidates"
        ),
        "dlq_replay_messages": _with(
            f"SELECT event_id, user_id, event_type, time_text AS event_time, {REPLAYED_PROPERTIES} AS properties FROM delivered",
            "delivered",
        ),
        "dlq_after_replay": _with(
            f"""
SELECT event_id, failed_at, recovered, CAST(replay_count + CASE WHEN hit THEN 1 ELSE 0 END AS INTEGER) AS replay_count,
       hit AS replayed, CASE WHEN hit THEN TIMESTAMP '{NOW}' END AS replayed_at
FROM (SELECT *, event_id IN (SELECT event_id FROM delivered WHERE event_id LIKE '00000000-%') AS hit FROM letters)""",
            "letters", "delivered",
        ),
        "dlq_lifecycle": _with(
            f"""
SELECT event_id, failed_at, false AS recovered, CAST(CASE WHEN place <= 40 THEN 1 ELSE 0 END AS INTEGER) AS replay_count,
       place <= 40 AND sendable AS replayed, CASE WHEN place <= 40 AND sendable THEN TIMESTAMP '{NOW}' END AS replayed_at
FROM (SELECT *, row_number() OVER (ORDER BY failed_at, event_id, raw_event) AS place,
             NOT number_as_text AND event_type <> 'page_scrolled' AS sendable FROM letters)""",
            "letters",
        ),
        "dlq_after_recovery": _with(
            """
SELECT event_id, failed_at, hit AS recovered, CASE WHEN hit THEN failed_at + INTERVAL 1 HOUR END AS recovered_at
FROM (SELECT *, extract(minute FROM failed_at) % 2 = 0 AND event_id LIKE '00000000-%' AS hit FROM letters)""",
            "letters",
        ),
        "cdc_raw_rows": _with(
            """
SELECT order_id, op, source_ts_ms, CASE WHEN op IN ('u', 'd') THEN status END AS before_status,
       CASE WHEN op <> 'd' THEN status END AS after_status, 'orders.public.orders' AS source_topic,
       TIMESTAMP '2024-03-01 00:00:00' AS ingested_at
FROM cdc_changes""",
            "cdc_changes",
        ),
        "events_outcome_5m": _with(TUMBLING, "outcomes"),
        "events_outcome_5m_sliding": _with("SELECT * FROM sliding", "sliding"),
        "consumer_backlog": _with(
            "SELECT consumer_group, CAST(sum(end_offset - committed_offset) AS BIGINT) AS backlog FROM offsets GROUP BY ALL",
            "offsets",
        ),
        "health_alerts": _with(
            """
SELECT 'user-events-failed-last-5m' AS alert, 'warning' AS severity, 'user_events' AS subject, a.window_end AS fired_at,
       a.events_count AS value, CAST(0 AS BIGINT) AS threshold
FROM sliding a JOIN sliding b ON b.window_end = a.window_end - INTERVAL 1 MINUTE
WHERE a.outcome = 'failed' AND b.outcome = 'failed'
UNION ALL
SELECT 'kafka-consumer-lag-high', 'warning', consumer_group,
       TIMESTAMP '2024-02-01 00:00:00' + to_minutes(k), CAST(backlog AS BIGINT), 100
FROM (SELECT *, min(backlog) OVER (PARTITION BY consumer_group ORDER BY k ROWS 2 PRECEDING) AS low,
             count(*) OVER (PARTITION BY consumer_group ORDER BY k ROWS 2 PRECEDING) AS samples
      FROM (SELECT consumer_group, k, sum(end_offset - least(end_offset, committed_offset + 5 * k)) AS backlog
            FROM offsets, range(0, 4) AS ks(k) GROUP BY ALL))
WHERE samples = 3 AND low > 100""",
            "sliding", "offsets",
        ),
        "metric_totals": _with(f"SELECT {METRIC_SET} FROM stg_bookings", "stg_bookings"),
        "metric_by_dims": _with(
            f"SELECT transport_type, currency, {METRIC_SET} FROM stg_bookings GROUP BY transport_type, currency",
            "stg_bookings",
        ),
        "revenue_by_route": _with(
            f"SELECT route, {PAID_REVENUE} AS total_revenue FROM stg_bookings GROUP BY route", "stg_bookings"
        ),
        "revenue_by_transport_type": _with(
            f"SELECT transport_type, {PAID_REVENUE} AS total_revenue FROM stg_bookings GROUP BY transport_type",
            "stg_bookings",
        ),
        "top_routes_by_revenue": _with(
            f"""
SELECT route, transport_type, total_revenue FROM ({ROUTES})
ORDER BY total_revenue DESC, route, transport_type LIMIT 10""",
            "stg_bookings",
        ),
        "status_distribution": _with(f"{STATUSES} ORDER BY total_bookings DESC, status", "stg_bookings"),
        "paid_bookings_per_day": _with(
            f"SELECT booking_date, paid_bookings FROM ({DAILY}) ORDER BY booking_date", "stg_bookings"
        ),
        "daily_overview": _with(
            f"SELECT booking_date, total_bookings, total_revenue FROM ({DAILY}) ORDER BY booking_date", "stg_bookings"
        ),
        "stream_user_events": _with(VALID_EVENTS.replace("{extra}", ""), "incoming"),
        "stream_dead_letters": _with(
            """
SELECT event_id, raw_event, error_type, fields, 'user.events.avro' AS source_topic, false AS recovered,
       CAST(0 AS INTEGER) AS replay_count
FROM letters""",
            "letters",
        ),
        "stream_cdc_orders": _with("SELECT * FROM stg_orders", "stg_orders"),
        "stream_outcome_5m": _with(TUMBLING, "outcomes"),
        "stream_upsert_bookings": _with("SELECT * FROM stg_bookings", "stg_bookings"),
        "loads_taken_in": _with(
            f"SELECT booking_id, run_id, loaded_at, price, concat('load-', {LOAD}) AS load_id, CAST({LOAD} AS INTEGER) AS taken_in FROM raw_bookings",
            "raw_bookings",
        ),
        "loads_stg_bookings": _with("SELECT * FROM stg_bookings", "stg_bookings"),
        "loads_stg_orders": _with("SELECT * FROM stg_orders", "stg_orders"),
        "audience_rolling_week": _with(
            """
SELECT event_type, last_day, count(DISTINCT user_id) AS users_count
FROM stg_events JOIN (SELECT DISTINCT CAST(event_time AS DATE) AS last_day FROM stg_events)
  ON CAST(event_time AS DATE) BETWEEN last_day - 6 AND last_day GROUP BY ALL""",
            "stg_events",
        ),
        "alert_episodes": _with("SELECT * FROM (" + EPISODES.strip() + ")", "sliding", "offsets"),
        "dq_every_key": _with(EVERY_KEY, "raw_bookings"),
        "sink_appended": _with("SELECT * FROM bookings_ok", "bookings_ok"),
        "stream_outcome_windows": _with("SELECT * FROM sliding", "sliding"),
        "landing_bookings": _with(
            "SELECT booking_id, user_id, route, transport_type, status, price, currency, created_at FROM raw_bookings", "raw_bookings"
        ),
        "landing_json_rows": _with(
            "SELECT booking_id, user_id, route, transport_type, status, price, currency FROM raw_bookings", "raw_bookings"
        ),
    }
    sql |= _delta_marts()
    sql["stream_after_failures"] = sql["stream_user_events"]
    sql["stream_fallback_letters"] = sql["stream_dead_letters"]
    return sql
