"""Campaign-day metrics and the read queries over them.

All "latest row per key" steps are ``max(struct(order keys, payload))``
aggregations: they pre-aggregate before the shuffle, so a key holding a
large share of rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.functions.predicates import apply_filters, date_range, optional_eq
from adcredit.functions.scalar import (MONEY, finite, latest_struct, money_sum, ratio_or_zero,
                                       safe_divide)

_MEASURES = ["spend", "attributed_revenue", "roas", "cac", "conversions"]


def latest_spend(ad_spend: DataFrame, tie: tuple[str, ...] = ("spend",)) -> DataFrame:
    """W2 on spend: one row per (campaign_id, date), latest ``inserted_at``.

    Ties on ``inserted_at`` go to the highest ``tie`` columns (D4).
    """
    payload = ["spend", "impressions", "clicks", "source", "inserted_at"]
    order = ["inserted_at", *[t for t in tie if t != "inserted_at"]]
    picked = (ad_spend.groupBy("campaign_id", "date")
              .agg(latest_struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)],
                                 *[F.col(c).alias(c) for c in payload]).alias("m")))
    return picked.select("campaign_id", "date", *[F.col(f"m.{c}").alias(c) for c in payload])


def campaign_metrics(ad_spend: DataFrame, attribution: DataFrame, as_of=None,
                     unique_orders: bool = False) -> DataFrame:
    """A1 + J2 + A2 + F1.

    Spend rows left-joined to attribution on campaign and the touch's date,
    grouped by (campaign_id, date, spend): revenue sum (0 if none), distinct
    orders, ``roas = revenue / spend`` and ``cac = spend / conversions``,
    both NULL on a zero denominator.

    The attribution side is aggregated to one row per (campaign, day) first
    (order level, then day level: an exact distinct count that is safe for
    hot keys), so the join never meets a skewed key. A spend row repeated
    with the same value keeps the reference's arithmetic: revenue counts once
    per spend row, the distinct count does not (D4). A revenue that is NaN or
    infinite makes its day's revenue NaN.
    """
    attr = (attribution
            .filter(F.col("campaign_id").isNotNull() & F.col("touch_ts").isNotNull())
            .select("campaign_id", F.to_date("touch_ts").alias("touch_date"), "order_id",
                    F.when(finite("revenue"), F.col("revenue")).cast(MONEY).alias("revenue"),
                    F.coalesce(~finite("revenue"), F.lit(False)).alias("odd")))
    if not unique_orders:
        # order level first: the day-level count of order ids is then distinct
        attr = (attr.groupBy("campaign_id", "touch_date", "order_id")
                .agg(F.sum("revenue").alias("revenue"), F.max("odd").alias("odd")))
    per_day = (attr.groupBy("campaign_id", "touch_date")
               .agg(F.sum("revenue").alias("day_revenue"), F.max("odd").alias("odd"),
                    F.count("order_id").alias("day_orders")))
    ad = ad_spend.select("campaign_id", "date", "spend")
    joined = ad.join(per_day, (ad.campaign_id == per_day.campaign_id)
                     & (ad.date == per_day.touch_date), "left")
    grouped = (joined.groupBy(ad.campaign_id, ad.date, ad.spend)
               .agg(F.when(F.max("odd"), F.lit(float("nan")))
                    .otherwise(F.coalesce(F.sum("day_revenue").cast("double"), F.lit(0.0)))
                    .alias("attributed_revenue"),
                    F.coalesce(F.max("day_orders"), F.lit(0)).cast("bigint").alias("conversions")))
    inserted = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return grouped.select(
        F.col("campaign_id"), F.col("date").alias("metric_date"), F.col("spend"),
        F.col("attributed_revenue"),
        safe_divide("attributed_revenue", "spend").alias("roas"),
        safe_divide("spend", "conversions").alias("cac"),
        F.col("conversions"), inserted.alias("inserted_at"))


def daily_event_counts(events: DataFrame) -> DataFrame:
    """A3: events per (UTC date, campaign_id); NULL campaign is its own group."""
    return (events.groupBy(F.to_date("event_ts").alias("date"), F.col("campaign_id"))
            .agg(F.count(F.lit(1)).alias("events_count")))


def dedup_metrics(metrics: DataFrame) -> DataFrame:
    """W2 on metrics: latest write per (campaign_id, metric_date)."""
    order = ["inserted_at", "spend", "attributed_revenue", "conversions"]
    payload = ["spend", "attributed_revenue", "conversions", "roas", "cac", "inserted_at"]
    return (metrics.groupBy("campaign_id", "metric_date")
            .agg(latest_struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)],
                               *[F.col(c).alias(c) for c in payload]).alias("m"))
            .select("campaign_id", "metric_date", *[F.col(f"m.{c}").alias(c) for c in payload]))


def latest_per_campaign(metrics: DataFrame, campaign_id: str | None = None) -> DataFrame:
    """W3 + P16 (+ P7): each campaign's newest row, NULL measures shown as 0.

    Ordered as the leaderboard (O1): attributed revenue descending.
    """
    df = apply_filters(metrics, [p for p in [optional_eq("campaign_id", campaign_id)] if p is not None])
    order = ["metric_date", "inserted_at", "spend", "attributed_revenue", "conversions"]
    latest = (df.groupBy("campaign_id")
              .agg(latest_struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)],
                                 "metric_date", *_MEASURES).alias("m")))
    return (latest.select(
        F.col("campaign_id"), F.col("m.metric_date").alias("metric_date"),
        *[F.coalesce(F.col(f"m.{c}"), F.lit(0.0)).cast("double").alias(c)
          for c in ("spend", "attributed_revenue", "roas", "cac")],
        F.coalesce(F.col("m.conversions"), F.lit(0)).cast("bigint").alias("conversions"))
        .orderBy(F.col("attributed_revenue").desc(), F.col("campaign_id").asc()))


def campaign_detail(metrics: DataFrame, campaign_id: str) -> DataFrame:
    """Q2: the campaign's newest metrics; an unknown campaign raises
    ``LookupError`` (the reference answers 404). One bounded action."""
    row = latest_per_campaign(metrics, campaign_id)
    if row.isEmpty():
        raise LookupError(f"Campaign not found: {campaign_id}")
    return row


def portfolio_summary(latest: DataFrame) -> DataFrame:
    """Totals over the campaigns' latest rows; ratios 0 when undefined.

    A global aggregate (partial per task, one tiny final merge); no rows
    gives a row of zeros.
    """
    agg = latest.agg(F.coalesce(money_sum("spend"), F.lit(0.0)).alias("spend"),
                     F.coalesce(money_sum("attributed_revenue"), F.lit(0.0))
                     .alias("attributed_revenue"),
                     F.coalesce(F.sum("conversions"), F.lit(0)).cast("bigint").alias("conversions"),
                     F.count(F.lit(1)).alias("campaign_count"))
    return agg.select("spend", "attributed_revenue",
                      ratio_or_zero("attributed_revenue", "spend").alias("roas"),
                      ratio_or_zero("spend", "conversions").alias("cac"),
                      "conversions", "campaign_count")


def _filtered(metrics: DataFrame, campaign_id, date_from, date_to) -> DataFrame:
    preds = [p for p in [optional_eq("campaign_id", campaign_id)] if p is not None]
    preds += date_range("metric_date", date_from, date_to)
    return apply_filters(metrics, preds)


def trend(metrics: DataFrame, campaign_id: str | None = None, date_from=None,
          date_to=None) -> DataFrame:
    """A4 (Q3-Q6): dedup latest writes, then per date the sums and the
    ratios of sums. Filters are applied before the dedup."""
    d = dedup_metrics(_filtered(metrics, campaign_id, date_from, date_to))
    g = (d.groupBy("metric_date")
         .agg(money_sum("spend").alias("spend"),
              money_sum("attributed_revenue").alias("attributed_revenue"),
              F.sum("conversions").cast("bigint").alias("conversions")))
    return (g.select(F.col("metric_date").cast("string").alias("date"), "spend",
                     "attributed_revenue", "conversions",
                     safe_divide("attributed_revenue", "spend").alias("roas"),
                     safe_divide("spend", "conversions").alias("cac"))
            .orderBy("date"))


# The two series the anomaly endpoints aggregate.
METRIC_AGGREGATES = {
    "roas": ("attributed_revenue", "spend"),
    "cac": ("spend", "conversions"),
}


def metric_series(metrics: DataFrame, metric: str, campaign_id: str | None = None,
                  date_from=None, date_to=None, by_campaign: bool = False) -> DataFrame:
    """A5: one metric per date (optionally per campaign), ratio of sums."""
    if metric not in METRIC_AGGREGATES:
        raise ValueError(f"unsupported metric: {metric}")
    num, den = METRIC_AGGREGATES[metric]
    d = dedup_metrics(_filtered(metrics, campaign_id, date_from, date_to))
    keys = (["campaign_id"] if by_campaign else []) + ["metric_date"]
    sums = {c: (F.sum(c).cast("double") if c == "conversions" else money_sum(c))
            for c in (num, den)}
    g = d.groupBy(*keys).agg(sums[num].alias("num"), sums[den].alias("den"))
    return g.select(*[k for k in keys if k != "metric_date"],
                    F.col("metric_date").cast("string").alias("date"),
                    safe_divide("num", "den").cast("double").alias(metric))


def trend_rows(metrics: DataFrame, measures: list[str], campaign_id: str | None = None,
               date_from=None, date_to=None) -> DataFrame:
    """Q7: stored rows as they are (no dedup), date as text, date order."""
    df = _filtered(metrics, campaign_id, date_from, date_to)
    return (df.select(F.col("metric_date").cast("string").alias("date"), *measures)
            .orderBy("date"))
