"""Fixed schemas of the fact tables, their keys and physical layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, D, TS, DT, L = T.StringType(), T.DoubleType(), T.TimestampType(), T.DateType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


@dataclass(frozen=True)
class FactSpec:
    name: str
    schema: T.StructType
    partition_col: str | None
    cluster_cols: tuple[str, ...]
    key_cols: tuple[str, ...]
    retention_days: int | None = 180
    lookup_cols: tuple[str, ...] = ()       # columns that single values are looked up in

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.fieldNames())


FACT_AD_SPEND = FactSpec(
    "fact_ad_spend",
    _schema(("campaign_id", S, False), ("date", DT, False), ("spend", D, False),
            ("impressions", L, True), ("clicks", L, True), ("source", S, True),
            ("inserted_at", TS, True)),
    "date", ("campaign_id",), ("campaign_id", "date"))

FACT_ORDERS = FactSpec(
    "fact_orders",
    _schema(("order_id", S, False), ("customer_id", S, False), ("order_ts", TS, False),
            ("order_date", DT, False), ("revenue", D, False), ("currency", S, True),
            ("inserted_at", TS, True)),
    "order_date", ("customer_id",), ("order_id",), lookup_cols=("customer_id", "order_id"))

FACT_EVENTS = FactSpec(
    "fact_events",
    _schema(("event_id", S, False), ("customer_id", S, False), ("event_ts", TS, False),
            ("event_date", DT, False), ("event_type", S, True), ("campaign_id", S, True),
            ("source", S, True), ("inserted_at", TS, True)),
    "event_date", ("campaign_id", "customer_id"), ("event_id",), lookup_cols=("customer_id",))

# DATE(touch_ts) is stored as its own column so that date filters prune.
FACT_ATTRIBUTION = FactSpec(
    "fact_attribution",
    _schema(("order_id", S, False), ("customer_id", S, False), ("campaign_id", S, True),
            ("touch_ts", TS, True), ("revenue", D, False), ("inserted_at", TS, True),
            ("touch_date", DT, True)),
    "touch_date", ("campaign_id", "customer_id"), ("order_id",), lookup_cols=("customer_id", "order_id"))

FACT_CAMPAIGN_METRICS = FactSpec(
    "fact_campaign_metrics",
    _schema(("campaign_id", S, False), ("metric_date", DT, False), ("spend", D, False),
            ("attributed_revenue", D, False), ("roas", D, True), ("cac", D, True),
            ("conversions", L, True), ("inserted_at", TS, True)),
    "metric_date", ("campaign_id",), ("campaign_id", "metric_date"))

DATA_HEALTH = FactSpec(
    "data_health",
    _schema(("source", S, False), ("latest_timestamp", TS, True), ("status", S, True),
            ("inserted_at", TS, True)),
    None, ("source",), ("source",), retention_days=None)

# Rows that ingest rejects: the raw row as JSON and the rules it breaks.
QUARANTINE = FactSpec(
    "quarantine",
    _schema(("table", S, False), ("raw", S, True), ("violations", T.ArrayType(S), False),
            ("inserted_at", TS, True)),
    None, ("table",), (), retention_days=None)

# Feature tables written by the features job.
_FEATURE_VALUES = [("spend", D, True), ("attributed_revenue", D, True), ("conversions", L, True),
                   ("cac", D, True), ("roas", D, True)]
_ROLLING_VALUES = [("rolling_7d_roas", D, True), ("rolling_7d_spend", D, True),
                   ("rolling_7d_conversions", D, True), ("rolling_7d_volatility", D, True)]

CAMPAIGN_FEATURES = FactSpec(
    "fact_campaign_metrics_features",
    _schema(("campaign_id", S, False), ("metric_date", DT, False), *_FEATURE_VALUES,
            *_ROLLING_VALUES, ("next_day_roas", D, True)),
    "metric_date", ("campaign_id",), ("campaign_id", "metric_date"), retention_days=None)

DAILY_FEATURES = FactSpec(
    "daily_features",
    _schema(("date", DT, False), ("campaign_id", S, False), *_FEATURE_VALUES,
            ("events_count", L, True), *_ROLLING_VALUES),
    "date", ("campaign_id",), ("date", "campaign_id"), retention_days=None)

FACTS = {s.name: s for s in (FACT_AD_SPEND, FACT_ORDERS, FACT_EVENTS, FACT_ATTRIBUTION,
                             FACT_CAMPAIGN_METRICS, DATA_HEALTH, QUARANTINE, CAMPAIGN_FEATURES,
                             DAILY_FEATURES)}

# Holds the text of a raw line that could not be read as a row.
CORRUPT = "_corrupt_record"

# Raw landing tables: every column arrives as text.
RAW_ADS = _schema(*[(c, S, True) for c in
                    ("campaign_id", "date", "spend", "impressions", "clicks", "source")])
RAW_ORDERS = _schema(*[(c, S, True) for c in
                       ("order_id", "customer_id", "order_ts", "revenue", "currency")])
RAW_EVENTS = _schema(*[(c, S, True) for c in
                       ("event_id", "customer_id", "event_ts", "event_type", "campaign_id",
                        "source")])

# The model's feature order (must equal the serving contract).
FEATURE_ORDER = [
    "spend",
    "attributed_revenue",
    "conversions",
    "cac",
    "roas",
    "rolling_7d_roas",
    "rolling_7d_spend",
    "rolling_7d_conversions",
    "rolling_7d_volatility",
]
TARGET = "next_day_roas"
