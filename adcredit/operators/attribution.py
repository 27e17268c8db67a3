"""Last-touch attribution (as-of left join with a look-back window).

For each order, the customer's latest event with
``order_ts - lookback <= event_ts <= order_ts`` (both ends inclusive);
orders without such an event are kept with NULL campaign / touch.
Ties on ``event_ts`` are broken by ``event_id``, longer ids after shorter ones, then
as text (so ``evt_10`` beats ``evt_9``); batch, job and stream share this rule.
Several rows with one ``order_id`` collapse to the one with the latest
touch (the reference partitions its ranking by ``order_id`` only).

Plan shape (no pair fan-out, every hot group split or pre-aggregated):

1. Time is cut into buckets (default one hour) so that one customer's
   history is spread over many window partitions ``(customer, bucket)``
   instead of landing in one task.
2. Copies of an event (re-deliveries of the same row) collapse in a
   map-side hash aggregate before the shuffle.
3. ``carry``: the latest event of each customer *before* each bucket that
   holds orders. It comes from a pre-aggregated ``(customer, bucket)``
   table (at most one row per customer-bucket) and a running ``max`` over
   the buckets of a customer, so its size is bounded by time, not by volume.
4. One window per ``(customer, bucket)`` over carry + events + orders,
   ordered by time with events before orders at equal instants, keeps a
   running ``max(struct(event_ts, tie, ...))``: at an order row that is the
   latest touch at or before the order. A touch older than the look-back
   is dropped.
5. Per ``order_id`` the latest touch wins (``max(struct)``, partial
   aggregation, so a group of order copies collapses map-side).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.functions.scalar import MONEY

_US_PER_SECOND = 1_000_000


# One statement, so the whole operator is analysed once. {orders} and
# {events} are DataFrame arguments; numbers are formatted in by the caller after validation.
_LAST_TOUCH_SQL = """
WITH od AS (
  SELECT order_id, customer_id, order_ts, max(revenue) AS revenue,
         CAST(floor(unix_micros(order_ts) / {bucket_us}) AS BIGINT) AS b
  FROM {{orders}}
  WHERE customer_id IS NOT NULL AND order_ts IS NOT NULL
  GROUP BY order_id, customer_id, order_ts
),
ev AS (
  SELECT customer_id, event_ts,
         named_struct('event_ts', event_ts, 'tie', tie, 'event_id', event_id,
                      'campaign_id', campaign_id) AS touch,
         CAST(floor(unix_micros(event_ts) / {bucket_us}) AS BIGINT) AS b
  FROM (SELECT {distinct} customer_id, event_ts, length(CAST(event_id AS STRING)) AS tie,
               CAST(event_id AS STRING) AS event_id, CAST(campaign_id AS STRING) AS campaign_id
        FROM {{events}}
        WHERE customer_id IS NOT NULL AND event_ts IS NOT NULL)
),
cells AS (
  SELECT customer_id, b, max(touch) AS last_in_bucket, max(has_order) AS has_order
  FROM (SELECT customer_id, b, touch, 0 AS has_order FROM ev
        UNION ALL
        SELECT customer_id, b, NULL, 1 FROM od)
  GROUP BY customer_id, b
),
carry AS (
  SELECT customer_id, b, touch FROM (
    SELECT customer_id, b, has_order,
           max(last_in_bucket) OVER (PARTITION BY customer_id ORDER BY b
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS touch
    FROM cells)
  WHERE has_order = 1 AND touch IS NOT NULL
),
timeline AS (
  SELECT customer_id, b, touch.event_ts AS sort_ts, 0 AS kind, touch,
         CAST(NULL AS STRING) AS order_id, CAST(NULL AS TIMESTAMP) AS order_ts,
         CAST(NULL AS DOUBLE) AS revenue
  FROM carry
  UNION ALL
  SELECT customer_id, b, event_ts, 0, touch, NULL, NULL, NULL FROM ev
  UNION ALL
  SELECT customer_id, b, order_ts, 1, NULL, order_id, order_ts, revenue FROM od
),
matched AS (
  SELECT order_id, customer_id, order_ts, revenue,
         CASE WHEN unix_micros(seen.event_ts) >= unix_micros(order_ts) - {lookback_us}
              THEN seen END AS touch
  FROM (SELECT *, max(touch) OVER (PARTITION BY customer_id, b ORDER BY sort_ts, kind
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
        FROM timeline)
  WHERE kind = 1
  UNION ALL
  SELECT order_id, customer_id, order_ts, revenue, NULL
  FROM {{orders}}
  WHERE customer_id IS NULL OR order_ts IS NULL
),
best AS (
  SELECT order_id,
         max(named_struct('touch_ts', touch.event_ts, 'tie', touch.tie,
                          'event_id', touch.event_id, 'customer_id', customer_id,
                          'order_ts', order_ts, 'revenue', revenue,
                          'campaign_id', touch.campaign_id)) AS m
  FROM matched
  GROUP BY order_id
)
SELECT order_id, m.customer_id AS customer_id, m.campaign_id AS campaign_id,
       m.touch_ts AS touch_ts, m.revenue AS revenue, {inserted} AS inserted_at,
       to_date(m.touch_ts) AS touch_date
FROM best
"""


def last_touch(orders: DataFrame, events: DataFrame, lookback_days: int = 7,
               bucket_seconds: int = 3600,
               collapse_copies: bool = True, as_of=None) -> DataFrame:
    """J1 + W1: ``fact_attribution`` rows.

    ``orders``: order_id, customer_id, order_ts, revenue.
    ``events``: event_id, customer_id, event_ts, campaign_id.
    Returns order_id, customer_id, campaign_id, touch_ts, revenue,
    inserted_at, touch_date.
    """
    lookback_us = int(lookback_days) * 86_400 * _US_PER_SECOND
    bucket_us = int(bucket_seconds) * _US_PER_SECOND
    if bucket_us <= 0:
        raise ValueError("bucket_seconds must be positive")
    if as_of is None:
        inserted = "current_timestamp()"
    else:
        inserted = f"TIMESTAMP'{_dt.datetime.fromisoformat(str(as_of)).isoformat(sep=' ')}'"
    sql = _LAST_TOUCH_SQL.format(bucket_us=bucket_us, lookback_us=lookback_us,
                                 distinct="DISTINCT" if collapse_copies else "",
                                 inserted=inserted)
    return orders.sparkSession.sql(sql, orders=orders.select("order_id", "customer_id",
                                                             "order_ts", "revenue"),
                                   events=events)


def attribution_orphans(ad_spend: DataFrame, attribution: DataFrame) -> DataFrame:
    """Attributed revenue that no spend row of its touch date receives (D3).

    Returns campaign_id, touch_date, orphan_orders, orphan_revenue.
    """
    per_day = (attribution
               .filter(F.col("campaign_id").isNotNull() & F.col("touch_ts").isNotNull())
               .withColumn("touch_date", F.to_date("touch_ts"))
               .groupBy("campaign_id", "touch_date", "order_id")
               .agg(F.sum(F.col("revenue").cast(MONEY)).alias("revenue"))
               .groupBy("campaign_id", "touch_date")
               .agg(F.count("order_id").alias("orphan_orders"),
                    F.sum("revenue").cast("double").alias("orphan_revenue")))
    spend_keys = ad_spend.select(F.col("campaign_id"), F.col("date").alias("touch_date"))
    return per_day.join(spend_keys, ["campaign_id", "touch_date"], "left_anti")
