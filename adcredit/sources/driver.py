"""Adapter views: the reference's fact tables derived from the given tables.

The supplied ``orders`` (1995-2001) and ``events`` (January 2024) never
overlap in time, so every fact table is derived from ``events`` alone
(purchases become orders, view/click/signup become touches, error rows
become repeated ad-spend writes). Each view is a lazy DataFrame over the
Parquet scan, so filters and column pruning reach the file.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.operators.attribution import last_touch
from adcredit.operators.metrics import campaign_metrics, latest_spend
from adcredit.session import ensure_utc

# The adapter rules (shared with the SQL oracle).
AS_OF = _dt.datetime(2024, 2, 1, 0, 0, 0)
CAMPAIGN_BUCKETS = 20          # campaign = props.k mod 20 ...
NO_CAMPAIGN_BUCKET = 19        # ... and this remainder means "no campaign"
TOUCH_TYPES = ("view", "click", "signup")
ORDER_TYPE = "purchase"
AD_TYPE = "error"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet relation of one table, listed anew: files added since are read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.expr("try_cast(get_json_object(props, '$.k') AS INT)")


def tag_events(events: DataFrame) -> DataFrame:
    """Common derived columns: UTC instant, customer and campaign ids."""
    k = _k()
    campaign = F.when(k.isNull() | (k % CAMPAIGN_BUCKETS == NO_CAMPAIGN_BUCKET),
                      F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("camp_"), F.format_string("%02d", k % CAMPAIGN_BUCKETS)))
    customer = F.when(F.col("user_id").isNotNull(),
                      F.concat(F.lit("customer_"), F.format_string("%05d", F.col("user_id"))))
    return events.select(
        F.col("event_id").alias("seq"), F.col("event_type"), F.col("value"),
        F.col("ts").cast("timestamp").alias("ts"),
        customer.alias("customer_id"),
        k.alias("k"), campaign.alias("campaign_id"))


class Warehouse:
    """The fact tables of one scale directory, as lazy DataFrames.

    Only plan definitions are kept: every action recomputes from the files.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.datetime = AS_OF):
        ensure_utc(spark)
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, as_of: _dt.datetime = AS_OF) -> "Warehouse":
        return cls(spark, sf_dir, as_of)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def tagged(self) -> DataFrame:
        return tag_events(self.table("events"))

    @property
    def as_of_col(self) -> Column:
        return F.lit(self.as_of).cast("timestamp")

    @cached_property
    def fact_orders(self) -> DataFrame:
        t = self.tagged.filter(F.col("event_type") == ORDER_TYPE)
        return t.select(
            F.concat(F.lit("ord_"), F.col("seq").cast("string")).alias("order_id"),
            "customer_id", F.col("ts").alias("order_ts"), F.to_date("ts").alias("order_date"),
            F.col("value").alias("revenue"), F.lit("USD").alias("currency"),
            self.as_of_col.alias("inserted_at"))

    @cached_property
    def fact_events(self) -> DataFrame:
        t = self.tagged.filter(F.col("event_type").isin(*TOUCH_TYPES))
        return t.select(
            F.concat(F.lit("evt_"), F.col("seq").cast("string")).alias("event_id"), "seq",
            "customer_id", F.col("ts").alias("event_ts"), F.to_date("ts").alias("event_date"),
            "event_type", "campaign_id", F.lit("clickstream").alias("source"),
            self.as_of_col.alias("inserted_at"))

    @cached_property
    def ad_runs(self) -> DataFrame:
        """Repeated hourly spend writes: several rows per campaign-day."""
        t = self.tagged.filter((F.col("event_type") == AD_TYPE) & F.col("campaign_id").isNotNull())
        return t.select(
            "campaign_id", F.to_date("ts").alias("date"), F.col("value").alias("spend"),
            (F.col("k") * 100).cast("bigint").alias("impressions"),
            F.col("k").cast("bigint").alias("clicks"), F.lit("ads").alias("source"),
            F.col("ts").alias("inserted_at"), "seq")

    @cached_property
    def fact_ad_spend(self) -> DataFrame:
        return latest_spend(self.ad_runs, tie=("seq",))

    @cached_property
    def fact_attribution(self) -> DataFrame:
        return last_touch(self.fact_orders, self.fact_events, as_of=self.as_of)

    @cached_property
    def fact_campaign_metrics(self) -> DataFrame:
        # last_touch emits one row per order_id
        return campaign_metrics(self.fact_ad_spend, self.fact_attribution, as_of=self.as_of,
                                unique_orders=True)

    @cached_property
    def data_health(self) -> DataFrame:
        """Two status rows per source (event type): the newest and an older one."""
        g = self.tagged.groupBy("event_type").agg(F.max("ts").alias("newest"),
                                                  F.min("ts").alias("oldest"))
        return g.select(
            F.col("event_type").alias("source"),
            F.explode(F.array(F.col("newest"), F.col("oldest"))).alias("latest_timestamp"),
        ).select("source", "latest_timestamp", F.lit("healthy").alias("status"),
                 F.col("latest_timestamp").alias("inserted_at"))

    # Raw landing views: the same rows as text, for the normalisers.
    @cached_property
    def raw_ads(self) -> DataFrame:
        a = self.ad_runs
        return a.select(
            "campaign_id", F.col("date").cast("string").alias("date"),
            # k = 0 rows arrive with an unparseable amount (tolerant -> NULL)
            F.when(F.col("clicks") == 0, F.lit("n/a"))
            .otherwise(F.col("spend").cast("string")).alias("spend"),
            F.col("impressions").cast("string").alias("impressions"),
            F.col("clicks").cast("string").alias("clicks"),
            F.when(F.col("clicks") == 1, F.lit(None).cast("string")).otherwise(F.col("source"))
            .alias("source"),
            F.col("seq").alias("ingest_seq"))

    @cached_property
    def raw_orders(self) -> DataFrame:
        o = self.fact_orders
        return o.select(
            "order_id", "customer_id", F.col("order_ts").cast("string").alias("order_ts"),
            F.col("revenue").cast("string").alias("revenue"),
            F.lit(None).cast("string").alias("currency"))

    @cached_property
    def raw_events(self) -> DataFrame:
        """Every touch delivered twice; the replay arrives later (higher seq)."""
        e = self.fact_events

        def cols(source: Column, seq: Column):
            return [F.col("event_id"), F.col("customer_id"),
                    F.col("event_ts").cast("string").alias("event_ts"), F.col("event_type"),
                    F.col("campaign_id"), source.alias("source"), seq.alias("ingest_seq")]

        first = e.select(*cols(F.col("source"), F.col("seq") * 2))
        replay = e.select(*cols(F.lit("replay"), F.col("seq") * 2 + 1))
        return first.unionByName(replay)
