"""Independent DuckDB SQL for every registered query.

Written from the data rules by other methods than the Spark plans (an as-of join for
the last touch, ``arg_max`` for the latest write, per-day totals joined to the spend, calendar
look-ups and row-number self-joins for the features), so a
match is evidence of correctness. The driver's tables are pre-registered
as views; the adapter views below re-derive the fact tables from
``events`` with the same fixed rules as ``adcredit.sources.driver``.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def money_sum(x: str) -> str:
    """Exact decimal sum returned as double (same rule as the Spark side)."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"

BASE_CTES = {
    "tagged": """
  tagged AS (
    SELECT event_id AS seq, event_type, value, ts,
           CASE WHEN user_id IS NULL THEN NULL
                ELSE 'customer_' || printf('%05d', user_id) END AS customer_id,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
  ),
  tagged2 AS (
    SELECT *, CASE WHEN k IS NULL OR k % 20 = 19 THEN NULL
                   ELSE 'camp_' || printf('%02d', k % 20) END AS campaign_id
    FROM tagged
  )""",
    "fact_orders": f"""
  fact_orders AS (
    SELECT 'ord_' || CAST(seq AS VARCHAR) AS order_id, customer_id, ts AS order_ts,
           CAST(ts AS DATE) AS order_date, value AS revenue, 'USD' AS currency,
           {AS_OF_SQL} AS inserted_at
    FROM tagged2 WHERE event_type = 'purchase'
  )""",
    "fact_events": f"""
  fact_events AS (
    SELECT 'evt_' || CAST(seq AS VARCHAR) AS event_id, seq, customer_id, ts AS event_ts,
           CAST(ts AS DATE) AS event_date, event_type, campaign_id, 'clickstream' AS source,
           {AS_OF_SQL} AS inserted_at
    FROM tagged2 WHERE event_type IN ('view', 'click', 'signup')
  )""",
    "ad_runs": """
  ad_runs AS (
    SELECT campaign_id, CAST(ts AS DATE) AS date, value AS spend,
           CAST(k * 100 AS BIGINT) AS impressions, CAST(k AS BIGINT) AS clicks,
           'ads' AS source, ts AS inserted_at, seq
    FROM tagged2 WHERE event_type = 'error' AND campaign_id IS NOT NULL
  )""",
    "fact_ad_spend": """
  fact_ad_spend AS (
    SELECT campaign_id, date, w.spend AS spend, w.impressions AS impressions, w.clicks AS clicks,
           w.source AS source, w.inserted_at AS inserted_at
    FROM (SELECT campaign_id, date,
                 arg_max(struct_pack(spend := spend, impressions := impressions, clicks := clicks,
                                     source := source, inserted_at := inserted_at),
                         CAST(epoch_us(inserted_at) AS HUGEINT) * 1000000000000 + seq) AS w
          FROM ad_runs GROUP BY campaign_id, date)
  )""",
    "fact_attribution": f"""
  touch_moments AS (
    SELECT customer_id, event_ts, arg_max(struct_pack(c := campaign_id), seq) AS t
    FROM fact_events GROUP BY customer_id, event_ts
  ),
  fact_attribution AS (
    SELECT o.order_id, o.customer_id, m.t.c AS campaign_id, m.event_ts AS touch_ts, o.revenue,
           {AS_OF_SQL} AS inserted_at, CAST(m.event_ts AS DATE) AS touch_date
    FROM (SELECT *, order_ts - INTERVAL 7 DAY AS earliest FROM fact_orders) o
    ASOF LEFT JOIN touch_moments n
      ON o.customer_id = n.customer_id AND o.order_ts >= n.event_ts
    LEFT JOIN touch_moments m
      ON m.customer_id = n.customer_id AND m.event_ts = n.event_ts AND n.event_ts >= o.earliest
  )""",
    "day_totals": """
  day_totals AS (
    SELECT campaign_id, touch_date, SUM(CAST(revenue AS DECIMAL(38,6))) AS day_revenue,
           COUNT(DISTINCT order_id) AS day_orders
    FROM fact_attribution GROUP BY campaign_id, touch_date
  )""",
    "fact_campaign_metrics": f"""
  fact_campaign_metrics AS (
    SELECT s.campaign_id, s.date AS metric_date, s.spend,
           COALESCE(CAST(d.day_revenue AS DOUBLE), 0) AS attributed_revenue,
           COALESCE(CAST(d.day_revenue AS DOUBLE), 0) / NULLIF(s.spend, 0) AS roas,
           s.spend / NULLIF(d.day_orders, 0) AS cac,
           CAST(COALESCE(d.day_orders, 0) AS BIGINT) AS conversions,
           {AS_OF_SQL} AS inserted_at
    FROM fact_ad_spend s
    LEFT JOIN day_totals d ON d.campaign_id = s.campaign_id AND d.touch_date = s.date
  )""",
}

_ORDER = ["tagged", "fact_orders", "fact_events", "ad_runs", "fact_ad_spend",
          "fact_attribution", "day_totals", "fact_campaign_metrics"]
_NEEDS = {
    "tagged": [],
    "fact_orders": ["tagged"],
    "fact_events": ["tagged"],
    "ad_runs": ["tagged"],
    "fact_ad_spend": ["ad_runs"],
    "fact_attribution": ["fact_orders", "fact_events"],
    "day_totals": ["fact_attribution"],
    "fact_campaign_metrics": ["fact_ad_spend", "day_totals"],
}


def with_facts(*needed: str, extra: str = "") -> str:
    """``WITH`` clause holding the needed adapter views (and their inputs)."""
    want: set[str] = set()

    def add(n):
        if n not in want:
            want.add(n)
            for d in _NEEDS[n]:
                add(d)

    for n in needed:
        add(n)
    parts = [BASE_CTES[n].strip("\n") for n in _ORDER if n in want]
    if extra:
        parts.append(extra.strip("\n"))
    return "WITH" + ",".join(parts) + "\n"
