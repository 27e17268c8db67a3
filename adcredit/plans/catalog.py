"""Registered queries: ``(spark, sf_dir) -> DataFrame`` plus the SQL oracle.

Each query reads the given tables (through the adapter views) in full.
Outputs are edge-normalised the same way on both sides: doubles rounded
to 6 places (float sums differ in the last bit by summation order, D7)
and instants shown as UTC wall-clock timestamps.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.functions.scalar import iso_date, iso_timestamp, round_doubles, to_naive
from adcredit.operators import anomaly, drilldown, features, health, metrics, normalize, trends
from adcredit.operators.attribution import attribution_orphans
from adcredit.plans.oracle import AS_OF_SQL, money_sum, with_facts
from adcredit.sources.driver import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the parameterised API queries.
CAMPAIGN = "camp_03"
CUSTOMER = "customer_00042"
DATE_FROM = _dt.date(2024, 1, 8)
DATE_TO = _dt.date(2024, 1, 21)
RETENTION_AS_OF = _dt.date(2024, 7, 15)

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _out(df: DataFrame) -> DataFrame:
    return to_naive(df)


def _r(df: DataFrame, *cols: str) -> DataFrame:
    """Round columns whose last bits depend on the engine's algorithm
    (window averages, standard deviations); the oracle rounds the same."""
    return round_doubles(df, 6, only=cols)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _out(fn(Warehouse.of(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return deco


# --------------------------------------------------------------------------
# Attribution and campaign metrics
# --------------------------------------------------------------------------

@register("last_touch", with_facts("fact_attribution") + """
SELECT order_id, customer_id, campaign_id, touch_ts, revenue, touch_date FROM fact_attribution""")
def _last_touch(w: Warehouse):
    """J1 + W1: every order with its last touch within 7 days."""
    return w.fact_attribution.drop("inserted_at")


@register("attribution_orphans", with_facts("fact_attribution", "fact_ad_spend", extra="""
  per_order AS (
    SELECT campaign_id, CAST(touch_ts AS DATE) AS touch_date, order_id,
           SUM(CAST(revenue AS DECIMAL(38,6))) AS revenue
    FROM fact_attribution WHERE campaign_id IS NOT NULL AND touch_ts IS NOT NULL
    GROUP BY 1, 2, 3
  )""") + """
SELECT p.campaign_id, p.touch_date, CAST(COUNT(p.order_id) AS BIGINT) AS orphan_orders,
       CAST(SUM(p.revenue) AS DOUBLE) AS orphan_revenue
FROM per_order p
WHERE NOT EXISTS (SELECT 1 FROM fact_ad_spend a
                  WHERE a.campaign_id = p.campaign_id AND a.date = p.touch_date)
GROUP BY 1, 2""")
def _orphans(w: Warehouse):
    """D3: attributed revenue landing on a day without a spend row."""
    return attribution_orphans(w.fact_ad_spend, w.fact_attribution)


@register("latest_spend", with_facts("fact_ad_spend") + "SELECT * FROM fact_ad_spend")
def _latest_spend(w: Warehouse):
    """W2 on repeated spend writes."""
    return w.fact_ad_spend


_METRICS_COLS = "campaign_id, metric_date, spend, attributed_revenue, roas, cac, conversions"


@register("campaign_metrics", with_facts("fact_campaign_metrics") + f"""
SELECT {_METRICS_COLS} FROM fact_campaign_metrics""")
def _campaign_metrics(w: Warehouse):
    """A1 + A2 + J2 + F1 over unique spend rows."""
    return w.fact_campaign_metrics.drop("inserted_at")


@register("campaign_metrics_multirun", with_facts("ad_runs", "day_totals", extra="""
  writes AS (
    SELECT campaign_id, date, spend, COUNT(*) AS times FROM ad_runs GROUP BY ALL
  ),
  valued AS (
    SELECT w.campaign_id, w.date AS metric_date, w.spend,
           COALESCE(CAST(d.day_revenue * w.times AS DOUBLE), 0) AS attributed_revenue,
           COALESCE(d.day_orders, 0) AS orders
    FROM writes w LEFT JOIN day_totals d
      ON d.campaign_id = w.campaign_id AND d.touch_date = w.date
  )""") + """
SELECT campaign_id, metric_date, spend, attributed_revenue,
       attributed_revenue / NULLIF(spend, 0) AS roas, spend / NULLIF(orders, 0) AS cac,
       CAST(orders AS BIGINT) AS conversions
FROM valued""")
def _campaign_metrics_multirun(w: Warehouse):
    """A1 over every hourly spend write (repeated keys, D4)."""
    return metrics.campaign_metrics(w.ad_runs, w.fact_attribution).drop("inserted_at")


@register("daily_event_counts", with_facts("fact_events") + """
SELECT CAST(event_ts AS DATE) AS date, campaign_id, COUNT(*) AS events_count
FROM fact_events GROUP BY 1, 2""")
def _daily_event_counts(w: Warehouse):
    """A3."""
    return metrics.daily_event_counts(w.fact_events)


_LATEST_CTE = """
  latest AS (
    SELECT campaign_id, metric_date,
           COALESCE(spend, 0) AS spend, COALESCE(attributed_revenue, 0) AS attributed_revenue,
           COALESCE(roas, 0) AS roas, COALESCE(cac, 0) AS cac,
           CAST(COALESCE(conversions, 0) AS BIGINT) AS conversions
    FROM (SELECT *, ROW_NUMBER() OVER (
              PARTITION BY campaign_id
              ORDER BY metric_date DESC NULLS LAST, inserted_at DESC NULLS LAST,
                       spend DESC NULLS LAST, attributed_revenue DESC NULLS LAST,
                       conversions DESC NULLS LAST) AS rn
          FROM fact_campaign_metrics {where})
    WHERE rn = 1
  )"""


@register("campaign_leaderboard", with_facts("fact_campaign_metrics",
                                             extra=_LATEST_CTE.format(where="")) + """
SELECT * FROM latest ORDER BY attributed_revenue DESC, campaign_id""")
def _leaderboard(w: Warehouse):
    """Q1 list: W3 + P16 + O1."""
    return metrics.latest_per_campaign(w.fact_campaign_metrics)


@register("metrics_summary", with_facts("fact_campaign_metrics",
                                        extra=_LATEST_CTE.format(where="")) + """
SELECT COALESCE(""" + money_sum("spend") + """, 0) AS spend,
       COALESCE(""" + money_sum("attributed_revenue") + """, 0) AS attributed_revenue,
       CASE WHEN COALESCE(""" + money_sum("spend") + """, 0) = 0 THEN 0
            ELSE """ + money_sum("attributed_revenue") + " / " + money_sum("spend") + """ END AS roas,
       CASE WHEN COALESCE(SUM(conversions), 0) = 0 THEN 0
            ELSE """ + money_sum("spend") + """ / SUM(conversions) END AS cac,
       CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS conversions,
       COUNT(*) AS campaign_count
FROM latest""")
def _summary(w: Warehouse):
    """Q1 totals: A7."""
    return metrics.portfolio_summary(metrics.latest_per_campaign(w.fact_campaign_metrics))


@register("campaign_latest", with_facts(
    "fact_campaign_metrics", extra=_LATEST_CTE.format(where=f"WHERE campaign_id = '{CAMPAIGN}'"))
    + "SELECT * FROM latest")
def _campaign_latest(w: Warehouse):
    """Q2: one campaign's newest metrics."""
    return metrics.latest_per_campaign(w.fact_campaign_metrics, CAMPAIGN)


def _latest_writes(where: str = "") -> str:
    """Latest write per campaign-day, by arg_max on (write time, spend)."""
    return f"""
  latest_writes AS (
    SELECT campaign_id, metric_date, w.spend AS spend, w.revenue AS attributed_revenue,
           w.conversions AS conversions
    FROM (SELECT campaign_id, metric_date,
                 arg_max(struct_pack(spend := spend, revenue := attributed_revenue,
                                     conversions := conversions), epoch_us(inserted_at)) AS w
          FROM fact_campaign_metrics {where} GROUP BY campaign_id, metric_date)
  )"""


def _trend_sql(where: str) -> str:
    return with_facts("fact_campaign_metrics", extra=_latest_writes(where) + """,
  days AS (
    SELECT metric_date, """ + money_sum("spend") + """ AS spend,
           """ + money_sum("attributed_revenue") + """ AS attributed_revenue,
           CAST(SUM(conversions) AS BIGINT) AS conversions
    FROM latest_writes GROUP BY metric_date
  )""") + """
SELECT CAST(metric_date AS VARCHAR) AS date, spend, attributed_revenue, conversions,
       attributed_revenue / NULLIF(spend, 0) AS roas, spend / NULLIF(conversions, 0) AS cac
FROM days ORDER BY metric_date"""


@register("trend_all", _trend_sql(""))
def _trend_all(w: Warehouse):
    """Q3-Q6: cross-campaign daily trend."""
    return metrics.trend(w.fact_campaign_metrics)


@register("trend_campaign", _trend_sql(f"WHERE campaign_id = '{CAMPAIGN}'"))
def _trend_campaign(w: Warehouse):
    """Q3-Q6 for one campaign."""
    return metrics.trend(w.fact_campaign_metrics, campaign_id=CAMPAIGN)


@register("trend_date_range", _trend_sql(
    f"WHERE metric_date >= DATE '{DATE_FROM}' AND metric_date <= DATE '{DATE_TO}'"))
def _trend_range(w: Warehouse):
    """Q3-Q6 within an inclusive date range."""
    return metrics.trend(w.fact_campaign_metrics, date_from=DATE_FROM, date_to=DATE_TO)


def _moving_sql(measure: str, days: int) -> str:
    """The engine's own regression over a self-join on calendar days.

    Rounded at 9 digits: means of values of 6 digits end in a 5 at the seventh too often.
    """
    return with_facts("fact_campaign_metrics", extra=f"""
  fitted AS (
    SELECT c.campaign_id, c.metric_date, COUNT(p.y) AS points, AVG(p.y) AS level,
           CASE WHEN COUNT(p.y) > 1 THEN regr_slope(p.y, date_diff('day', c.metric_date, p.metric_date)) END AS slope
    FROM fact_campaign_metrics c
    JOIN (SELECT campaign_id, metric_date, CAST(CAST({measure} AS DECIMAL(18,6)) AS DOUBLE) AS y
          FROM fact_campaign_metrics) p
      ON p.campaign_id IS NOT DISTINCT FROM c.campaign_id
         AND date_diff('day', p.metric_date, c.metric_date) BETWEEN 0 AND {days - 1}
    GROUP BY c.campaign_id, c.metric_date
  )""") + f"""
SELECT campaign_id, metric_date, points, round(level, 9) + 0.0 AS level, round(slope, 9) + 0.0 AS slope,
       CASE WHEN points < 3 THEN NULL WHEN slope * {days - 1} > abs(level) * 0.1 THEN 'rising'
            WHEN slope * {days - 1} < -abs(level) * 0.1 THEN 'falling' ELSE 'stable' END AS label
FROM fitted ORDER BY campaign_id, metric_date"""


@register("moving_trend_roas", _moving_sql("roas", 14))
def _moving_trend_roas(w: Warehouse):
    """Slope and label of each campaign's ROAS over 14 calendar days."""
    return round_doubles(trends.moving_trend(w.fact_campaign_metrics, "roas", 14), 9,
                         only=("level", "slope")) \
        .orderBy("campaign_id", "metric_date")


@register("moving_trend_spend", _moving_sql("spend", 30))
def _moving_trend_spend(w: Warehouse):
    """Slope and label of each campaign's spend over 30 calendar days."""
    return round_doubles(trends.moving_trend(w.fact_campaign_metrics, "spend", 30), 9,
                         only=("level", "slope")) \
        .orderBy("campaign_id", "metric_date")


def _rows_sql(measures: str, where: str = "") -> str:
    return with_facts("fact_campaign_metrics") + f"""
SELECT CAST(metric_date AS VARCHAR) AS date, {measures}
FROM fact_campaign_metrics {where} ORDER BY metric_date"""


@register("trend_rows_roas", _rows_sql("roas"))
def _rows_roas(w: Warehouse):
    """Q7 roas template."""
    return metrics.trend_rows(w.fact_campaign_metrics, ["roas"])


@register("trend_rows_cac", _rows_sql("cac", f"WHERE campaign_id = '{CAMPAIGN}'"))
def _rows_cac(w: Warehouse):
    """Q7 cac template, one campaign."""
    return metrics.trend_rows(w.fact_campaign_metrics, ["cac"], campaign_id=CAMPAIGN)


@register("trend_rows_conversions", _rows_sql(
    "conversions", f"WHERE metric_date >= DATE '{DATE_FROM}' AND metric_date <= DATE '{DATE_TO}'"))
def _rows_conv(w: Warehouse):
    """Q7 conversions template, date range."""
    return metrics.trend_rows(w.fact_campaign_metrics, ["conversions"], date_from=DATE_FROM,
                              date_to=DATE_TO)


@register("trend_rows_spend_revenue", _rows_sql("spend, attributed_revenue"))
def _rows_spend_rev(w: Warehouse):
    """Q7 spend + revenue template."""
    return metrics.trend_rows(w.fact_campaign_metrics, ["spend", "attributed_revenue"])


# --------------------------------------------------------------------------
# Features and training frames
# --------------------------------------------------------------------------

_ROLL = ("rolling_7d_roas", "rolling_7d_spend", "rolling_7d_conversions", "rolling_7d_volatility")


def _week_sql(source: str, date: str) -> str:
    """Averages over a row and the six rows before it, by a self-join on row numbers."""
    return f"""
  numbered AS (
    SELECT *, (SELECT COUNT(*) FROM {source} p
               WHERE p.campaign_id = c.campaign_id AND p.{date} < c.{date}) AS place
    FROM {source} c
  ),
  week AS (
    SELECT c.campaign_id, c.{date},
           round(AVG(p.roas), 6) + 0.0 AS rolling_7d_roas,
           round(AVG(p.spend), 6) + 0.0 AS rolling_7d_spend,
           round(AVG(p.conversions), 6) + 0.0 AS rolling_7d_conversions,
           round(STDDEV_SAMP(p.roas), 6) + 0.0 AS rolling_7d_volatility
    FROM numbered c, numbered p
    WHERE p.campaign_id = c.campaign_id AND c.place - p.place BETWEEN 0 AND 6
    GROUP BY c.campaign_id, c.{date}
  )"""


_FEATURES_CTE = _week_sql("fact_campaign_metrics", "metric_date") + """,
  features AS (
    SELECT m.campaign_id, m.metric_date, m.spend, m.attributed_revenue, m.conversions, m.cac,
           m.roas, week.* EXCLUDE (campaign_id, metric_date),
           (SELECT MAX(t.roas) FROM fact_campaign_metrics t
            WHERE t.campaign_id = m.campaign_id AND t.metric_date = m.metric_date + 1)
           AS next_day_roas
    FROM fact_campaign_metrics m, week
    WHERE week.campaign_id = m.campaign_id AND week.metric_date = m.metric_date
  )"""


def _features_sql(select: str) -> str:
    return with_facts("fact_campaign_metrics", extra=_FEATURES_CTE) + select


@register("features_target", _features_sql("""
SELECT campaign_id, metric_date, spend, attributed_revenue, conversions, cac, roas,
       rolling_7d_roas, rolling_7d_spend, rolling_7d_conversions, rolling_7d_volatility,
       next_day_roas
FROM features ORDER BY campaign_id, metric_date"""))
def _features_target(w: Warehouse):
    """W10 (+ J3, J4, W5-W8)."""
    return _r(features.features_with_target(w.fact_campaign_metrics), *_ROLL) \
        .orderBy("campaign_id", "metric_date")


@register("features_events", with_facts("fact_campaign_metrics", "fact_events", extra="""
  per_day AS (
    SELECT event_date, map_from_entries(list((campaign_id, n))) AS by_campaign
    FROM (SELECT event_date, campaign_id, COUNT(*) AS n FROM fact_events
          WHERE campaign_id IS NOT NULL GROUP BY ALL) GROUP BY event_date
  ),
  counted AS (
    SELECT m.metric_date AS date, m.campaign_id, m.spend, m.attributed_revenue, m.conversions,
           m.cac, m.roas,
           CAST(COALESCE((SELECT by_campaign[m.campaign_id] FROM per_day
                          WHERE event_date = m.metric_date), 0) AS BIGINT) AS events_count
    FROM fact_campaign_metrics m
  ),""" + _week_sql("counted", "date")) + """
SELECT counted.*, week.* EXCLUDE (campaign_id, date)
FROM counted, week WHERE week.campaign_id = counted.campaign_id AND week.date = counted.date
ORDER BY counted.date, counted.campaign_id""")
def _features_events(w: Warehouse):
    """W11 (+ A3, J5, W5-W8)."""
    return _r(features.features_with_events(w.fact_campaign_metrics, w.fact_events), *_ROLL) \
        .orderBy("date", "campaign_id")


_TRAIN_COLS = ["spend", "attributed_revenue", "conversions", "cac", "roas", "rolling_7d_roas",
               "rolling_7d_spend", "rolling_7d_conversions", "rolling_7d_volatility"]


@register("training_frame", _features_sql("""
SELECT metric_date, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _TRAIN_COLS) + """,
       next_day_roas AS target_next_day_roas
FROM features WHERE next_day_roas IS NOT NULL"""))
def _training_frame(w: Warehouse):
    """M1: extract with NULL features kept, target known, renamed."""
    return _r(features.training_frame(features.features_with_target(w.fact_campaign_metrics),
                                      fill=None), *_ROLL)


@register("training_frame_filled", _features_sql("""
SELECT metric_date, """ + ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}"
                                   for c in _TRAIN_COLS) + """,
       next_day_roas AS target_next_day_roas
FROM features WHERE next_day_roas IS NOT NULL ORDER BY metric_date"""))
def _training_frame_filled(w: Warehouse):
    """M2: IFNULL(x, 0) features, target known."""
    return _r(features.training_frame(features.features_with_target(w.fact_campaign_metrics),
                                      fill=0.0), *_ROLL).orderBy("metric_date")


_PROFILE = {"mean": "CAST(SUM(CAST(v AS DECIMAL(38,8))) AS DOUBLE) / COUNT(v)",
            "stddev": "round(STDDEV_SAMP(v), 5) + 0.0", "min": "MIN(v)",
            "p25": "round(quantile_cont(v, 0.25), 9) + 0.0",
            "p50": "round(quantile_cont(v, 0.5), 9) + 0.0",
            "p75": "round(quantile_cont(v, 0.75), 9) + 0.0", "max": "MAX(v)"}


@register("training_profile", _features_sql("""
SELECT feature, CAST(COUNT(v) AS BIGINT) AS count, """ + ", ".join(
    f"{e} AS {c}" for c, e in _PROFILE.items()) + """
FROM (""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM features "
    f"WHERE next_day_roas IS NOT NULL" for c in _TRAIN_COLS + ["next_day_roas"]) + """)
GROUP BY feature"""))
def _training_profile(w: Warehouse):
    """M9 / A10: describe() of the training frame, one row per column, with exact
    quartiles (linear between the two nearest values)."""
    t = _r(features.training_frame(features.features_with_target(w.fact_campaign_metrics),
                                   fill=None), *_ROLL) \
        .withColumnRenamed("target_next_day_roas", "next_day_roas")
    p = features.profile(t, _TRAIN_COLS + ["next_day_roas"])
    return round_doubles(round_doubles(p, 5, only=("stddev",)), 9, only=("p25", "p50", "p75"))


@register("training_preview", _features_sql("""
SELECT metric_date, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _TRAIN_COLS) + """,
       next_day_roas AS target_next_day_roas
FROM features WHERE next_day_roas IS NOT NULL
ORDER BY metric_date, """ + ", ".join(f"{c} NULLS FIRST" for c in _TRAIN_COLS) + """ LIMIT 5"""))
def _training_preview(w: Warehouse):
    """Head preview of the training extract (first five by date)."""
    t = features.training_frame(features.features_with_target(w.fact_campaign_metrics), fill=None)
    return _r(t.orderBy("metric_date", *_TRAIN_COLS).limit(5), *_ROLL)


_LATEST_ROW_SEL = ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in _TRAIN_COLS)
# (rolling columns arrive rounded from the features CTE; COALESCE keeps the value)


@register("latest_labelled_row", _features_sql(f"""
SELECT campaign_id, metric_date, {_LATEST_ROW_SEL}, next_day_roas AS target_next_day_roas
FROM features WHERE next_day_roas IS NOT NULL
ORDER BY metric_date DESC, campaign_id ASC LIMIT 1"""))
def _latest_labelled(w: Warehouse):
    """Newest row with a known target."""
    return _r(features.latest_feature_row(
        features.features_with_target(w.fact_campaign_metrics), require_target=True), *_ROLL)


@register("latest_serving_row", _features_sql(f"""
SELECT campaign_id, metric_date, {_LATEST_ROW_SEL}
FROM features ORDER BY metric_date DESC, campaign_id ASC LIMIT 1"""))
def _latest_serving(w: Warehouse):
    """Newest row for serving, target not required."""
    return _r(features.latest_feature_row(
        features.features_with_target(w.fact_campaign_metrics)), *_ROLL)


@register("latest_serving_per_campaign", _features_sql(f"""
SELECT campaign_id, metric_date, {_LATEST_ROW_SEL} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id ORDER BY metric_date DESC) AS rn
  FROM features) WHERE rn = 1"""))
def _latest_serving_pc(w: Warehouse):
    """O6 per campaign."""
    return _r(features.latest_feature_row(
        features.features_with_target(w.fact_campaign_metrics), per_campaign=True), *_ROLL)


# --------------------------------------------------------------------------
# Anomalies
# --------------------------------------------------------------------------

def _series_sql(metric: str, by_campaign: bool = False, where: str = "") -> str:
    num, den = metrics.METRIC_AGGREGATES[metric]
    writes = _latest_writes(where).strip("\n")
    key = "campaign_id, " if by_campaign else ""

    def total(c):
        return "CAST(SUM(conversions) AS DOUBLE)" if c == "conversions" else money_sum(c)
    return f"""
{writes},
  series AS (
    SELECT {key}CAST(metric_date AS VARCHAR) AS date, {total(num)} / NULLIF({total(den)}, 0) AS v
    FROM latest_writes GROUP BY {key}metric_date
  ),
  pts AS (
    SELECT {key}date, v,
           COUNT(*) OVER s AS n,
           ROW_NUMBER() OVER (PARTITION BY {key or "NULL"} ORDER BY v) - 1 AS idx,
           AVG(v) OVER s AS mean, STDDEV_POP(v) OVER s AS sd
    FROM series WHERE v IS NOT NULL
    WINDOW s AS (PARTITION BY {key or "NULL"})
  ),
  st1 AS (
    SELECT *,
      MAX(CASE WHEN idx = n // 2 THEN v END) OVER (PARTITION BY {key or "NULL"}) AS median,
      MAX(CASE WHEN idx = n // 4 THEN v END) OVER (PARTITION BY {key or "NULL"}) AS q1,
      MAX(CASE WHEN idx = LEAST(n - 1, (3 * n) // 4) THEN v END)
          OVER (PARTITION BY {key or "NULL"}) AS q3
    FROM pts WHERE n >= 2
  ),
  st AS (
    SELECT *, AVG(ABS(v - median)) OVER (PARTITION BY {key or "NULL"}) AS mad,
           LAG(v) OVER (PARTITION BY {key or "NULL"} ORDER BY date) AS prev
    FROM st1
  ),
  scored AS (
    SELECT {key}date, '{metric}' AS metric, v AS value,
           CASE WHEN sd <> 0 THEN (v - mean) / sd ELSE 0.0 END AS z_raw,
           CASE WHEN mad = 0 THEN 0.0 ELSE 0.6745 * (v - median) / mad END AS mz_raw,
           (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS iqr_outlier,
           CASE WHEN prev IS NOT NULL AND prev <> 0 THEN (v - prev) / prev ELSE 0.0 END
               AS pct_raw
    FROM st
  ),
  alerts AS (
    SELECT {key}date, metric, value, (round(z_raw, 6) + 0.0) AS z_score,
           (round(mz_raw, 6) + 0.0) AS modified_z_score, iqr_outlier, (round(pct_raw, 6) + 0.0) AS percent_change,
      CASE
      WHEN ABS(z_raw) >= 3 OR ABS(mz_raw) >= 3 OR iqr_outlier OR ABS(pct_raw) >= 0.25 THEN 'high'
      WHEN ABS(z_raw) >= 2 OR ABS(mz_raw) >= 2 OR ABS(pct_raw) >= 0.15 THEN 'medium'
      ELSE 'low' END AS severity
    FROM scored
  )"""


@register("anomalies_roas", with_facts("fact_campaign_metrics", extra=_series_sql("roas"))
          + "SELECT * FROM alerts ORDER BY date")
def _anomalies_roas(w: Warehouse):
    """Q8: ROAS anomalies over the cross-campaign daily series."""
    s = metrics.metric_series(w.fact_campaign_metrics, "roas")
    return _r(anomaly.detect_anomalies(s, "roas", daily=True), "z_score", "modified_z_score", "percent_change")


@register("anomalies_cac", with_facts("fact_campaign_metrics", extra=_series_sql("cac"))
          + "SELECT * FROM alerts ORDER BY date")
def _anomalies_cac(w: Warehouse):
    """Q9: CAC anomalies."""
    s = metrics.metric_series(w.fact_campaign_metrics, "cac")
    return _r(anomaly.detect_anomalies(s, "cac", daily=True), "z_score", "modified_z_score", "percent_change")


_FILTER = (f"WHERE campaign_id = '{CAMPAIGN}' AND metric_date >= DATE '{DATE_FROM}' "
           f"AND metric_date <= DATE '{DATE_TO}'")


@register("anomalies_roas_filtered", with_facts(
    "fact_campaign_metrics", extra=_series_sql("roas", where=_FILTER))
    + "SELECT * FROM alerts ORDER BY date")
def _anomalies_roas_filtered(w: Warehouse):
    """Q8 with its filters: one campaign, a date range."""
    s = metrics.metric_series(w.fact_campaign_metrics, "roas", CAMPAIGN, DATE_FROM, DATE_TO)
    return _r(anomaly.detect_anomalies(s, "roas", daily=True), "z_score", "modified_z_score", "percent_change")


@register("anomalies_cac_filtered", with_facts(
    "fact_campaign_metrics", extra=_series_sql("cac", where=_FILTER))
    + "SELECT * FROM alerts ORDER BY date")
def _anomalies_cac_filtered(w: Warehouse):
    """Q9 with its filters."""
    s = metrics.metric_series(w.fact_campaign_metrics, "cac", CAMPAIGN, DATE_FROM, DATE_TO)
    return _r(anomaly.detect_anomalies(s, "cac", daily=True), "z_score", "modified_z_score", "percent_change")


@register("anomalies_by_campaign", with_facts(
    "fact_campaign_metrics", extra=_series_sql("roas", by_campaign=True))
    + "SELECT * FROM alerts ORDER BY campaign_id, date")
def _anomalies_by_campaign(w: Warehouse):
    """N6 per series key: one ROAS series per campaign."""
    s = metrics.metric_series(w.fact_campaign_metrics, "roas", by_campaign=True)
    return _r(anomaly.detect_anomalies(s, "roas", series_cols=("campaign_id",), daily=True), "z_score", "modified_z_score", "percent_change")


@register("series_stats", with_facts(
    "fact_campaign_metrics", extra=_series_sql("roas", by_campaign=True)) + """
SELECT campaign_id, CAST(MAX(n) AS BIGINT) AS n, (round(MAX(mean), 6) + 0.0) AS mean,
       (round(MAX(sd), 6) + 0.0) AS stddev, MAX(median) AS median, (round(MAX(mad), 6) + 0.0) AS mad,
       MAX(q1) AS q1, MAX(q3) AS q3
FROM st GROUP BY campaign_id""")
def _series_stats(w: Warehouse):
    """A8 per campaign series."""
    s = metrics.metric_series(w.fact_campaign_metrics, "roas", by_campaign=True)
    return _r(anomaly.series_stats(s, "roas", series_cols=("campaign_id",), daily=True), "mean", "stddev",
              "mad")


def _order_values_sql(key: str) -> str:
    keyed = f"{key}, " if key else ""
    return with_facts("fact_orders", extra=f"""
  sorted AS (
    SELECT {keyed}list_sort(list(revenue)) AS s FROM fact_orders WHERE revenue IS NOT NULL
    {"GROUP BY " + key if key else ""}),
  picked AS (
    SELECT *, len(s) AS n, s[len(s) // 2 + 1] AS median, s[len(s) // 4 + 1] AS q1,
           s[least(len(s) - 1, 3 * len(s) // 4) + 1] AS q3 FROM sorted)""") + f"""
SELECT {keyed}CAST(n AS BIGINT) AS n, round(list_avg(s), 6) + 0.0 AS mean,
       round(list_stddev_pop(s), 6) + 0.0 AS stddev, median,
       round(list_avg(list_transform(s, lambda x: abs(x - median))), 6) + 0.0 AS mad, q1, q3
FROM picked WHERE n >= 2"""


@register("order_value_stats", _order_values_sql(""))
def _order_value_stats(w: Warehouse):
    """Statistics of one series as long as the table, all order amounts."""
    return _r(anomaly.series_stats(w.fact_orders, "revenue", "order_ts"), "mean", "stddev", "mad")


@register("order_value_stats_by_customer", _order_values_sql("customer_id"))
def _order_value_stats_by_customer(w: Warehouse):
    """A8 for a series per customer, whatever number of orders a customer has."""
    return _r(anomaly.series_stats(w.fact_orders, "revenue", "order_ts", ("customer_id",)),
              "mean", "stddev", "mad")


@register("recent_alerts", with_facts("fact_campaign_metrics", extra=_series_sql("roas")) + """
SELECT * FROM (SELECT * FROM alerts ORDER BY date DESC LIMIT 5) ORDER BY date""")
def _recent_alerts(w: Warehouse):
    """The five newest ROAS alerts."""
    s = metrics.metric_series(w.fact_campaign_metrics, "roas")
    return _r(anomaly.recent_alerts(anomaly.detect_anomalies(s, "roas", daily=True), 5), "z_score", "modified_z_score", "percent_change")


# --------------------------------------------------------------------------
# Drill-down pages
# --------------------------------------------------------------------------

def _page_sql(fact: str, cols: str, where: str, order: str, limit: int, offset: int) -> str:
    return with_facts(fact) + f"""
SELECT {cols} FROM {fact} {where}
ORDER BY {order} LIMIT {limit} OFFSET {offset}"""


@register("raw_ad_spend_page", _page_sql(
    "fact_ad_spend", "campaign_id, date, spend, impressions, clicks, source, inserted_at",
    f"WHERE campaign_id = '{CAMPAIGN}'", "spend DESC NULLS LAST, campaign_id DESC, date DESC",
    25, 5))
def _page_ads(w: Warehouse):
    """Q10: ad spend page for one campaign, by spend."""
    rows, _ = drilldown.page(w.fact_ad_spend, "fact_ad_spend", {"campaign_id": CAMPAIGN},
                             order_by="spend", limit=25, offset=5)
    return rows


@register("raw_orders_page", _page_sql(
    "fact_orders", "order_id, customer_id, order_ts, order_date, revenue, currency, inserted_at",
    f"WHERE order_date >= DATE '{DATE_FROM}' AND order_date <= DATE '{DATE_TO}'",
    "revenue DESC NULLS LAST, order_id DESC", 200, 40))
def _page_orders(w: Warehouse):
    """Q11: orders page in a date range, by revenue, third page of 200 rows... offset 40."""
    rows, _ = drilldown.page(w.fact_orders, "fact_orders", None, DATE_FROM, DATE_TO,
                             order_by="revenue", limit=200, offset=40)
    return rows


@register("raw_events_page", _page_sql(
    "fact_events", "event_id, customer_id, event_ts, event_date, event_type, campaign_id, "
                   "source, inserted_at",
    f"WHERE customer_id = '{CUSTOMER}'", "event_ts DESC NULLS LAST, event_id DESC", 25, 0))
def _page_events(w: Warehouse):
    """Q12: one customer's events, newest first."""
    rows, _ = drilldown.page(w.fact_events, "fact_events", {"customer_id": CUSTOMER})
    return rows


@register("raw_attribution_page", _page_sql(
    "fact_attribution", "order_id, customer_id, campaign_id, touch_ts, revenue, inserted_at",
    f"WHERE touch_date >= DATE '{DATE_FROM}' AND touch_date <= DATE '{DATE_TO}'",
    "touch_ts DESC NULLS LAST, order_id DESC", 50, 10))
def _page_attr(w: Warehouse):
    """Q13: attribution rows by touch date range (P11 on the stored touch_date)."""
    rows, _ = drilldown.page(w.fact_attribution, "fact_attribution", None, DATE_FROM, DATE_TO,
                             order_by="touch_ts", limit=50, offset=10)
    return rows


@register("raw_orders_keyset_page", with_facts("fact_orders", extra="""
  first_page AS (
    SELECT revenue, order_id FROM fact_orders
    ORDER BY revenue DESC NULLS LAST, order_id DESC LIMIT 50
  ),
  bound AS (
    SELECT revenue, order_id FROM first_page ORDER BY revenue ASC, order_id ASC LIMIT 1
  )""") + """
SELECT o.order_id, o.customer_id, o.order_ts, o.order_date, o.revenue, o.currency, o.inserted_at
FROM fact_orders o, bound b
WHERE o.revenue < b.revenue OR (o.revenue = b.revenue AND o.order_id < b.order_id)
ORDER BY o.revenue DESC, o.order_id DESC LIMIT 50""")
def _keyset_orders(w: Warehouse):
    """O4 keyset form: the page after the first 50 orders by revenue, found by
    a (revenue, order_id) bound instead of an offset."""
    first = drilldown.keyset_page(w.fact_orders, "fact_orders", None, order_by="revenue",
                                  limit=50)
    last = first.orderBy(F.col("revenue").asc(), F.col("order_id").asc()) \
        .select("revenue", "order_id").first()          # one row: the page bound
    cols = drilldown.PAGES["fact_orders"].columns
    after = (last.revenue, last.order_id) if last is not None else None   # no orders: no bound
    return drilldown.keyset_page(w.fact_orders, "fact_orders", after, order_by="revenue",
                                 limit=50).select(*cols)


@register("page_count", with_facts("fact_events") + f"""
SELECT COUNT(*) AS total_count, CAST(50 AS BIGINT) AS "offset",
       COUNT(*) > 75 AS has_next
FROM fact_events WHERE campaign_id = '{CAMPAIGN}'""")
def _page_count(w: Warehouse):
    """A6 + O8: filtered count, page 2 of 25 rows and whether a next page exists."""
    _, count = drilldown.page(w.fact_events, "fact_events", {"campaign_id": CAMPAIGN})
    return drilldown.page_info(count, 2, 25)


# --------------------------------------------------------------------------
# Freshness
# --------------------------------------------------------------------------

_HEALTH_CTE = """
  data_health AS (
    SELECT event_type AS source, t.latest_timestamp, 'healthy' AS status,
           t.latest_timestamp AS inserted_at
    FROM (SELECT event_type, MAX(ts) AS newest, MIN(ts) AS oldest FROM tagged2
          GROUP BY event_type) g,
         LATERAL (SELECT newest AS latest_timestamp UNION ALL SELECT oldest) t
  )"""


def _iso_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN microsecond({c}) % 1000000 = 0 THEN '' "
            f"ELSE '.' || lpad(CAST(microsecond({c}) % 1000000 AS VARCHAR), 6, '0') END "
            f"|| '+00:00' END")


@register("health_latest", with_facts("tagged", extra=_HEALTH_CTE) + f"""
SELECT source, {_iso_sql('latest_timestamp')} AS latest_timestamp, status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY source
                               ORDER BY latest_timestamp DESC NULLS LAST, status DESC) AS rn
  FROM data_health) WHERE rn = 1 ORDER BY source""")
def _health_latest(w: Warehouse):
    """Q14: newest status per source."""
    return health.latest_health(w.data_health)


@register("freshness_upsert", with_facts("tagged", "fact_attribution", "fact_orders",
                                         extra=_HEALTH_CTE + """,
  incoming AS (
    SELECT 'attribution' AS source, MAX(touch_ts) AS latest_timestamp FROM fact_attribution
    UNION ALL
    SELECT 'purchase', MAX(order_ts) + INTERVAL 1 HOUR FROM fact_orders
  )""") + f"""
SELECT COALESCE(h.source, i.source) AS source,
       CASE WHEN i.source IS NOT NULL THEN i.latest_timestamp ELSE h.latest_timestamp END
           AS latest_timestamp,
       CASE WHEN i.source IS NOT NULL THEN 'healthy' ELSE h.status END AS status,
       CASE WHEN i.source IS NOT NULL AND h.source IS NOT NULL THEN {AS_OF_SQL}
            WHEN i.source IS NOT NULL THEN NULL ELSE h.inserted_at END AS inserted_at
FROM data_health h FULL OUTER JOIN incoming i ON h.source = i.source""")
def _freshness_upsert(w: Warehouse):
    """MERGE-style upsert of two derived freshness rows."""
    inc = (w.fact_attribution.agg(F.max("touch_ts").alias("latest_timestamp"))
           .select(F.lit("attribution").alias("source"), "latest_timestamp")
           .unionByName(w.fact_orders.agg(
               (F.max("order_ts") + F.expr("INTERVAL 1 HOUR")).alias("latest_timestamp"))
               .select(F.lit("purchase").alias("source"), "latest_timestamp")))
    return health.upsert_freshness(w.data_health, inc, as_of=w.as_of)


# --------------------------------------------------------------------------
# Normalisers
# --------------------------------------------------------------------------

_RAW_ADS_CTE = """
  raw_ads AS (
    SELECT campaign_id, CAST(date AS VARCHAR) AS date,
           CASE WHEN clicks = 0 THEN 'n/a' ELSE CAST(spend AS VARCHAR) END AS spend,
           CAST(impressions AS VARCHAR) AS impressions, CAST(clicks AS VARCHAR) AS clicks,
           CASE WHEN clicks = 1 THEN NULL ELSE source END AS source, seq AS ingest_seq
    FROM ad_runs
  )"""


@register("normalize_ads", with_facts("ad_runs", extra=_RAW_ADS_CTE) + """
SELECT CAST(campaign_id AS VARCHAR) AS campaign_id, TRY_CAST(date AS DATE) AS date,
       TRY_CAST(spend AS DOUBLE) AS spend, TRY_CAST(impressions AS BIGINT) AS impressions,
       TRY_CAST(clicks AS BIGINT) AS clicks, source
FROM raw_ads""")
def _normalize_ads(w: Warehouse):
    """P1 tolerant: unparseable spend becomes NULL, source NULL kept."""
    return normalize.normalize_ads(w.raw_ads, "tolerant", as_of=w.as_of).drop("inserted_at")


@register("quarantine_ads", with_facts("ad_runs", extra=_RAW_ADS_CTE) + """
SELECT campaign_id, TRY_CAST(date AS DATE) AS date, 'spend is null' AS violations
FROM raw_ads WHERE TRY_CAST(spend AS DOUBLE) IS NULL""")
def _quarantine_ads(w: Warehouse):
    """Rows failing NOT NULL / non-negative rules after tolerant parsing."""
    from adcredit.schemas import FACT_AD_SPEND
    _, bad = normalize.quarantine(normalize.normalize_ads(w.raw_ads, "tolerant", as_of=w.as_of),
                                  FACT_AD_SPEND)
    return bad.select("campaign_id", "date", F.array_join("violations", "; ").alias("violations"))


@register("normalize_ads_strict", with_facts("ad_runs", extra=_RAW_ADS_CTE) + """
SELECT campaign_id, CAST(date AS DATE) AS date, CAST(spend AS DOUBLE) AS spend,
       CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks,
       COALESCE(source, 'unknown') AS source
FROM raw_ads WHERE spend <> 'n/a'""")
def _normalize_ads_strict(w: Warehouse):
    """P2 strict on the rows that parse (a bad amount would raise): missing source -> unknown."""
    good = w.raw_ads.filter(F.col("spend") != "n/a")
    return normalize.normalize_ads(good, "strict", as_of=w.as_of).drop("inserted_at")


# Texts that a cast alone would take, and values that break a rule, by event number mod 16.
_BAD_REVENUE = ["12.5d", "Infinity", "NaN", "1f", "-3", "0.0000001", "abc", " 7.25 "]
_BAD_TS = ["12:30", "2024", "2024-13-01 00:00:00", "2024-01-05", "2024-01-05T10:00:00Z"]


def _bad_orders(w: Warehouse) -> DataFrame:
    """The raw orders, most with one bad field."""
    o = w.raw_orders.withColumn("n", F.substring("order_id", 5, 20).cast("bigint") % 16)
    revenue, ts = F.col("revenue"), F.col("order_ts")
    for i, v in enumerate(_BAD_REVENUE):
        revenue = F.when(F.col("n") == i, F.lit(v)).otherwise(revenue)
    for i, v in enumerate(_BAD_TS):
        ts = F.when(F.col("n") == 8 + i, F.lit(v)).otherwise(ts)
    customer = F.when(F.col("n") == 13, F.lit(None)).otherwise(F.col("customer_id"))
    return o.select("order_id", customer.alias("customer_id"), ts.alias("order_ts"),
                    revenue.alias("revenue"), "currency")


@register("normalize_bad_input", with_facts("fact_orders", extra="""
  numbered AS (SELECT *, CAST(substr(order_id, 5) AS BIGINT) % 16 AS n FROM fact_orders),
  judged AS (
    SELECT order_id, CASE n WHEN 4 THEN 'revenue is negative'
        WHEN 5 THEN 'revenue is finer than 6 decimals' WHEN 13 THEN 'customer_id is null'
        WHEN 8 THEN 'order_ts is null; order_date is null'
        WHEN 9 THEN 'order_ts is null; order_date is null'
        WHEN 10 THEN 'order_ts is null; order_date is null'
        ELSE CASE WHEN n IN (0, 1, 2, 3, 6) THEN 'revenue is null' END END AS violations,
      CASE WHEN n = 11 THEN TIMESTAMP '2024-01-05 00:00:00'
           WHEN n = 12 THEN TIMESTAMP '2024-01-05 10:00:00' ELSE order_ts END AS order_ts,
      CASE WHEN n = 7 THEN 7.25 ELSE revenue END AS revenue
    FROM numbered
  )""") + """
SELECT order_id, CASE WHEN violations IS NULL THEN order_ts END AS order_ts,
       CASE WHEN violations IS NULL THEN revenue END AS revenue, violations
FROM judged""")
def _normalize_bad_input(w: Warehouse):
    """P3 + P17 on input with a bad field in most rows: every row is accepted or rejected."""
    good, bad = normalize.accept(_bad_orders(w), "orders", as_of=w.as_of)
    return good.select("order_id", "order_ts", "revenue",
                       F.lit(None).cast("string").alias("violations")).unionByName(bad.select(
                           F.get_json_object("raw", "$.order_id").alias("order_id"),
                           F.lit(None).cast("timestamp").alias("order_ts"),
                           F.lit(None).cast("double").alias("revenue"),
                           F.array_join("violations", "; ").alias("violations")))


@register("normalize_orders", with_facts("fact_orders") + """
SELECT order_id, customer_id, TRY_CAST(CAST(order_ts AS VARCHAR) AS TIMESTAMP) AS order_ts,
       CAST(order_ts AS DATE) AS order_date, TRY_CAST(CAST(revenue AS VARCHAR) AS DOUBLE) AS revenue,
       'USD' AS currency
FROM fact_orders""")
def _normalize_orders(w: Warehouse):
    """Text orders back to fact_orders; NULL currency -> USD."""
    return normalize.normalize_orders(w.raw_orders, "tolerant", as_of=w.as_of).drop("inserted_at")


@register("normalize_events_distinct", with_facts("fact_events") + """
SELECT DISTINCT event_id, customer_id, event_ts, CAST(event_ts AS DATE) AS event_date,
       event_type, campaign_id, s AS source
FROM fact_events, (SELECT 'clickstream' AS s UNION ALL SELECT 'replay') AS r""")
def _normalize_events_distinct(w: Warehouse):
    """P5: SELECT DISTINCT over twice-delivered events."""
    return normalize.normalize_events(w.raw_events, "tolerant", as_of=w.as_of).drop("inserted_at")


@register("normalize_events_dedup", with_facts("fact_events") + """
SELECT event_id, customer_id, event_ts, CAST(event_ts AS DATE) AS event_date, event_type,
       campaign_id, 'replay' AS source
FROM fact_events""")
def _normalize_events_dedup(w: Warehouse):
    """One row per event_id, the later delivery wins."""
    return normalize.dedup_events(w.raw_events, as_of=w.as_of).drop("inserted_at")


# --------------------------------------------------------------------------
# Retention and serialisation
# --------------------------------------------------------------------------

@register("retention_180d", with_facts("fact_events") + f"""
SELECT event_id, event_date FROM fact_events
WHERE event_date IS NULL OR event_date >= DATE '{RETENTION_AS_OF}' - INTERVAL 180 DAY""")
def _retention(w: Warehouse):
    """S11 with a fixed as-of date: partitions older than 180 days drop out."""
    from adcredit.sources.sinks import apply_retention
    return apply_retention(w.fact_events, "event_date", RETENTION_AS_OF).select("event_id",
                                                                              "event_date")


@register("iso_rows", with_facts("fact_attribution") + f"""
SELECT order_id, {_iso_sql('touch_ts')} AS touch_ts_iso,
       strftime(touch_date, '%Y-%m-%d') AS touch_date_iso
FROM fact_attribution""")
def _iso_rows(w: Warehouse):
    """ISO-8601 text of instants and dates (None stays NULL)."""
    a = w.fact_attribution
    return a.select("order_id", iso_timestamp("touch_ts").alias("touch_ts_iso"),
                    iso_date("touch_date").alias("touch_date_iso"))
