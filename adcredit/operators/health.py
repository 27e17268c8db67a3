"""Source freshness: keyed upsert and the latest status per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.functions.scalar import iso_timestamp

HEALTHY = "healthy"


def upsert_freshness(existing: DataFrame, incoming: DataFrame, as_of=None) -> DataFrame:
    """S8 (MERGE on ``source``) without a transactional table format.

    Matched target rows get the incoming timestamp, status 'healthy' and a
    new ``inserted_at``; unmatched incoming sources are inserted (their
    ``inserted_at`` stays NULL, as the MERGE's INSERT omits it); other rows
    are unchanged. Several incoming rows for one source are reduced to the
    newest first (a MERGE would reject them). One full outer join on the
    small, pre-aggregated incoming side.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    inc = (incoming.groupBy("source")
           .agg(F.max("latest_timestamp").alias("in_ts"))
           .withColumnRenamed("source", "in_source"))
    j = existing.join(inc, existing.source == inc.in_source, "full_outer")
    matched = F.col("in_source").isNotNull()
    return j.select(
        F.coalesce(F.col("source"), F.col("in_source")).alias("source"),
        F.when(matched, F.col("in_ts")).otherwise(F.col("latest_timestamp"))
        .alias("latest_timestamp"),
        F.when(matched, F.lit(HEALTHY)).otherwise(F.col("status")).alias("status"),
        F.when(matched & F.col("source").isNotNull(), now)
        .when(matched, F.lit(None).cast("timestamp"))
        .otherwise(F.col("inserted_at")).alias("inserted_at"))


def latest_health(data_health: DataFrame) -> DataFrame:
    """W4 + O11 (Q14): newest status row per source, ordered by source."""
    best = (data_health.groupBy("source")
            .agg(F.max(F.struct("latest_timestamp", "status")).alias("m")))
    return (best.select("source", iso_timestamp("m.latest_timestamp").alias("latest_timestamp"),
                        F.col("m.status").alias("status"))
            .orderBy("source"))
