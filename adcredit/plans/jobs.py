"""Batch jobs B1-B6: the scheduled tasks, as Spark jobs over fact tables.

A warehouse is a root folder (on the shared file system) holding one
folder per fact table (layout: ``sources/sinks.py``). Ingest jobs quarantine what breaks a rule
and append the rest; derived tables (attribution, metrics, features) are replaced, whole or, in
incremental mode, all their changed dates in one commit.
"""

from __future__ import annotations

import datetime as _dt
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.operators import features as feat
from adcredit.operators import forecast
from adcredit.operators.attribution import last_touch
from adcredit.operators.health import upsert_freshness
from adcredit.operators.metrics import campaign_metrics, latest_spend
from adcredit.operators.normalize import accept, last_arrivals
from adcredit.schemas import FACTS
from adcredit.session import shared_dir
from adcredit.sources import files, index, manifest
from adcredit.sources.sinks import (TARGET_BYTES, compact, expire_partitions, read_fact,
                                    replace_partitions, write_fact)

SOURCE_PREFIX = "source-"


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


# -- freshness ---------------------------------------------------------------

def merge_freshness(spark: SparkSession, root: str, incoming: DataFrame, source: str,
                    as_of=None) -> None:
    """MERGE one source's rows of ``incoming`` into ``data_health``.

    Every source has its own folder, so jobs of different sources never meet,
    and a job that dies leaves the version before. Of two runs for one
    source at once, the second merges again, on top of the first.
    """
    path = f"{_path(root, 'data_health')}/{SOURCE_PREFIX}{quote(source, safe='')}"
    mine = incoming.filter(F.col("source") == source)
    while True:
        base = manifest.latest(spark, path)
        existing = read_fact(spark, "data_health", path, missing="empty", snapshot=base)
        try:
            write_fact(upsert_freshness(existing, mine, as_of=as_of), "data_health", path, "overwrite",
                       base=base)
            return
        except manifest.Conflict:
            continue


def update_freshness(spark: SparkSession, root: str, source: str, ts, as_of=None) -> None:
    """S8 as a job step: one source's timestamp."""
    incoming = spark.createDataFrame([(source, ts)], "source string, latest_timestamp timestamp")
    merge_freshness(spark, root, incoming, source, as_of)


def read_health(spark: SparkSession, root: str) -> DataFrame:
    """``data_health``: the current rows of all sources."""
    base = _path(root, "data_health")
    out = spark.createDataFrame([], FACTS["data_health"].schema)
    for name in files.folders(spark, base):
        if name.startswith(SOURCE_PREFIX):
            out = out.unionByName(read_fact(spark, "data_health", f"{base}/{name}",
                                            missing="empty"))
    return out


# -- ingest ------------------------------------------------------------------

def _ingest(spark: SparkSession, raw: DataFrame, kind: str, table: str, root: str, as_of,
            mode: str, arrival: str | None = None) -> bool:
    """Accepted rows are appended to the fact table, rejected ones to ``quarantine``.

    ``mode="strict"`` fails on the first bad value instead. The emptiness test reads the raw
    input, not the (shuffled) result.
    """
    good, bad = accept(raw, kind, mode, as_of, keep=(arrival,) if arrival else ())
    if arrival:
        good = last_arrivals(good, arrival=arrival)
    wrote = write_fact(good, table, _path(root, table), "append", probe=raw)
    write_fact(bad, "quarantine", _path(root, "quarantine"), "append")
    update_freshness(spark, root, kind, as_of, as_of)
    return wrote


def ingest_ads(spark: SparkSession, raw: DataFrame, root: str, as_of: _dt.datetime,
               mode: str = "tolerant") -> bool:
    """B1: raw ads -> normalise -> quarantine / append fact_ad_spend -> freshness."""
    return _ingest(spark, raw, "ads", "fact_ad_spend", root, as_of, mode)


def ingest_orders(spark: SparkSession, raw: DataFrame, root: str, as_of: _dt.datetime,
                  mode: str = "tolerant") -> bool:
    """B2: raw orders -> normalise -> quarantine / append fact_orders -> freshness."""
    return _ingest(spark, raw, "orders", "fact_orders", root, as_of, mode)


def compact_events(spark: SparkSession, raw: DataFrame, root: str, as_of: _dt.datetime,
                   arrival: str = "ingest_seq", mode: str = "tolerant") -> bool:
    """Raw events -> quarantine -> dedup by event_id (last arrival) -> append -> freshness."""
    return _ingest(spark, raw, "events", "fact_events", root, as_of, mode, arrival)


# -- attribution ---------------------------------------------------------------

def attribution_job(spark: SparkSession, root: str, as_of: _dt.datetime,
                    since: _dt.datetime | None = None, lookback_days: int = 7) -> None:
    """J1 -> fact_attribution -> A1 -> fact_campaign_metrics -> freshness.

    Metrics read the attribution table just written (not a recomputation),
    and spend goes through ``latest_spend`` so keys are unique (D4).

    ``since``: incremental mode, see :func:`_refresh`.
    """
    attr_path, metrics_path = (_path(root, t) for t in ("fact_attribution",
                                                        "fact_campaign_metrics"))
    if since is not None:
        _refresh(spark, root, as_of, since, lookback_days)
    else:
        orders = read_fact(spark, "fact_orders", _path(root, "fact_orders"))
        events = read_fact(spark, "fact_events", _path(root, "fact_events"))
        write_fact(last_touch(orders, events, lookback_days=lookback_days, as_of=as_of),
                   "fact_attribution", attr_path, "overwrite")
        spend = latest_spend(read_fact(spark, "fact_ad_spend", _path(root, "fact_ad_spend")))
        attribution = read_fact(spark, "fact_attribution", attr_path)
        write_fact(campaign_metrics(spend, attribution, as_of=as_of), "fact_campaign_metrics",
                   metrics_path, "overwrite")
    update_freshness(spark, root, "attribution", as_of, as_of)


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def affected_orders(orders: DataFrame, events: DataFrame, since: _dt.datetime,
                    lookback_days: int) -> DataFrame:
    """All rows of the orders whose answer rows inserted since ``since`` can change.

    These are the ids among the new orders (with their older rows), and the
    orders of a customer from that customer's first new event to ``lookback_days`` after
    the last one, whenever the events happened. New events are one range a customer, so
    the join makes at most one row an order.
    """
    new_ids = orders.filter(F.col("inserted_at") >= F.lit(since)).select("order_id")
    late = events.filter(F.col("inserted_at") >= F.lit(since)).groupBy("customer_id").agg(
        F.min("event_ts").alias("first"), F.max("event_ts").alias("last"))
    reach = F.col("last") + F.make_dt_interval(F.lit(lookback_days))
    touched = orders.join(late, "customer_id").filter(
        F.col("order_ts").between(F.col("first"), reach)).select("order_id")
    return orders.join(new_ids.unionByName(touched).distinct(), "order_id", "left_semi")


def _refresh(spark: SparkSession, root: str, as_of, since: _dt.datetime,
             lookback_days: int) -> None:
    """Re-attribute what rows inserted since ``since`` can change, and nothing else.

    Only the touch-date partitions that lose or gain such an order are replaced, and only
    the metric days of those, plus days with new spend, each table's in one commit. Events are read from the
    dates that the affected orders can look back to. Equal to a full recompute. Two runs at
    once: one of them raises ``Conflict`` and changes nothing in the table it lost.
    """
    attr_path, metrics_path = (_path(root, t) for t in ("fact_attribution",
                                                        "fact_campaign_metrics"))
    attr_base, metrics_base = (manifest.latest(spark, p) for p in (attr_path, metrics_path))
    orders = read_fact(spark, "fact_orders", _path(root, "fact_orders"))
    events = read_fact(spark, "fact_events", _path(root, "fact_events"))
    todo, todo_path = _staged(affected_orders(orders, events, since, lookback_days), "b4-orders")
    span = todo.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b")).first()
    days: set = set()
    staged = [todo_path]
    if span["a"] is not None:
        near = events.filter(F.col("event_date").between(
            F.lit(span["a"] - _dt.timedelta(days=lookback_days)), F.lit(span["b"])))
        fresh, path = _staged(last_touch(todo, near, lookback_days=lookback_days, as_of=as_of),
                              "b4-fresh")
        staged.append(path)
        old = read_fact(spark, "fact_attribution", attr_path, snapshot=attr_base)
        before = old.join(todo.select("order_id").distinct(), "order_id", "left_semi")
        days = {r[0] for r in before.select("touch_date").unionByName(fresh.select("touch_date"))
                .distinct().collect()}                       # at most one value a day
        kept = old.filter(_in_days("touch_date", days)) \
            .join(todo.select("order_id").distinct(), "order_id", "left_anti")
        rows, path = _staged(kept.select(*fresh.columns).unionByName(fresh), "b4-rows")
        staged.append(path)
        replace_partitions(rows, "fact_attribution", attr_path, sorted(days, key=str), attr_base)
    spend = read_fact(spark, "fact_ad_spend", _path(root, "fact_ad_spend"))
    days |= {r[0] for r in spend.filter(F.col("inserted_at") >= F.lit(since)).select("date")
             .distinct().collect()}
    days.discard(None)
    if days:
        attribution = read_fact(spark, "fact_attribution", attr_path)
        rows, path = _staged(campaign_metrics(
            latest_spend(spend.filter(_in_days("date", days))),
            attribution.filter(_in_days("touch_date", days)), as_of=as_of), "b4-metrics")
        staged.append(path)
        replace_partitions(rows, "fact_campaign_metrics", metrics_path, sorted(days), metrics_base)
    for path in staged:
        files.delete(spark, path)


def _in_days(col: str, days: set):
    """A literal list on the partition column, so the scan prunes."""
    known = sorted(d for d in days if d is not None)
    cond = F.col(col).isin(known) if known else F.lit(False)
    return cond | F.col(col).isNull() if None in days else cond


# -- features, training, retention -----------------------------------------------

def features_job(spark: SparkSession, root: str, since: _dt.datetime | None = None) -> None:
    """B5 + S10: write both feature tables (D18) with their fixed schemas.

    ``since``: incremental mode, see :func:`_refresh_features`; the first run is a full one.
    """
    paths = [_path(root, t) for t in ("fact_campaign_metrics_features", "daily_features")]
    if since is not None and all(manifest.latest(spark, p).version for p in paths):
        _refresh_features(spark, root, since)
        return
    metrics = read_fact(spark, "fact_campaign_metrics", _path(root, "fact_campaign_metrics"))
    events = read_fact(spark, "fact_events", _path(root, "fact_events"))
    write_fact(feat.features_with_target(metrics), "fact_campaign_metrics_features", paths[0], "overwrite")
    write_fact(feat.features_with_events(metrics, events), "daily_features", paths[1], "overwrite")


def _dates(snapshot: manifest.Snapshot) -> set[_dt.date]:
    return {_dt.date.fromisoformat(p.partition.split("=", 1)[1]) for p in snapshot.parts}


def _days_of(df: DataFrame, col: str) -> set:
    return {r[0] for r in df.select(col).distinct().collect()}          # a value a day


def _refresh_features(spark: SparkSession, root: str, since: _dt.datetime) -> None:
    """Recompute the features that metrics and events inserted since ``since`` change; equal to the full job.

    Days with such metrics, and days that lost all theirs, are compared with the stored features; each campaign that
    differs is recomputed from its first changed day on, and only the dates with a different result are
    replaced, each table's in one commit. An event that a correction moved to another date shows where a later
    insertion touches the date it left; after corrections that move events, run the full job.
    """
    name, daily = "fact_campaign_metrics_features", "daily_features"
    f_base, d_base = (manifest.latest(spark, _path(root, t)) for t in (name, daily))
    m_path = _path(root, "fact_campaign_metrics")
    m_base = manifest.latest(spark, m_path)
    metrics = read_fact(spark, "fact_campaign_metrics", m_path, snapshot=m_base)
    stored = read_fact(spark, name, _path(root, name), snapshot=f_base)
    stored_daily = read_fact(spark, daily, _path(root, daily), snapshot=d_base)
    recent = F.col("inserted_at") >= F.lit(since)
    days = _days_of(metrics.filter(recent), "metric_date") | (_dates(f_base) - _dates(m_base))
    cols = ["campaign_id", "metric_date", "spend", "attributed_revenue", "conversions", "cac", "roas"]
    here = _in_days("metric_date", days)
    changed = feat.differing(metrics.filter(here).select(*cols), stored.filter(here).select(*cols))
    firsts, firsts_path = _staged(changed.groupBy("campaign_id").agg(F.min("metric_date").alias("first")),
                                  "b5-campaigns")
    fresh, fresh_path = _staged(feat.features_since(metrics, firsts), "b5-fresh")
    staged = [firsts_path, fresh_path]

    def replaced(old: DataFrame, new: DataFrame, date: str, more: set = frozenset()) -> tuple[DataFrame, set]:
        """All rows of the dates that differ (and of ``more``), and those dates."""
        known = old.join(firsts, "campaign_id", "left")
        stale = F.coalesce(F.col(date) >= F.date_sub(F.col("first"), 1), F.lit(False))
        touched = _days_of(feat.differing(new, known.filter(stale).select(*new.columns)), date) | more
        rows = known.filter(~stale).select(*new.columns).unionByName(new).filter(_in_days(date, touched))
        return rows, touched

    rows, touched = replaced(stored, fresh, "metric_date")
    if touched:
        rows, path = _staged(rows, "b5-rows")
        staged.append(path)
        replace_partitions(rows, name, _path(root, name), sorted(touched), f_base)
    events = read_fact(spark, "fact_events", _path(root, "fact_events"))
    counted = _days_of(events.filter(recent), "event_date") & (_dates(d_base) | _dates(m_base))
    values = fresh.drop(feat.TARGET).withColumnRenamed("metric_date", "date")
    rows, touched = replaced(stored_daily.drop("events_count"), values, "date", counted)
    if touched:
        rows, path = _staged(feat.with_event_counts(rows, events.filter(_in_days("event_date", touched))),
                             "b5-daily")
        staged.append(path)
        before = stored_daily.filter(_in_days("date", touched)).select(*rows.columns)
        touched = _days_of(feat.differing(rows, before), "date")
        if touched:
            replace_partitions(rows.filter(_in_days("date", touched)), daily, _path(root, daily),
                               sorted(touched), d_base)
    for path in staged:
        files.delete(spark, path)


def training_job(spark: SparkSession, root: str, model_path: str,
                 num_trees: int = forecast.NUM_TREES, max_depth: int = forecast.MAX_DEPTH):
    """Training frame -> split -> fit -> evaluate -> save. Returns
    ``(model, evaluation DataFrame)``; an empty training frame raises."""
    features = read_fact(spark, "fact_campaign_metrics_features",
                         _path(root, "fact_campaign_metrics_features"))
    frame = feat.training_frame(features, fill=0.0, keys=("campaign_id",))
    if frame.isEmpty():
        raise RuntimeError("no training data")
    train, test = forecast.split(frame)
    model = forecast.fit_forecast(train, num_trees, max_depth)
    forecast.save_model(model, model_path)
    return model, forecast.evaluate(model, test)


def retention_job(spark: SparkSession, root: str, as_of) -> dict[str, list[str]]:
    """Drop expired partition folders of every stored fact table."""
    gone = {t: expire_partitions(spark, t, _path(root, t), as_of) for t in FACTS}
    return {t: names for t, names in gone.items() if names}


def compaction_job(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Merge the small files of every fact table that appends leave; files saved by table.

    Appends go on meanwhile. A table that another compaction or a replacement changed at the same
    time is left for the next run.
    """
    saved = {}
    for t in FACTS:
        try:
            saved[t] = compact(spark, t, _path(root, t), target_bytes)
        except manifest.Conflict:
            saved[t] = 0
    return {t: n for t, n in saved.items() if n}


def index_job(spark: SparkSession, root: str) -> dict[str, int]:
    """Index the parts of every stored fact table that are not indexed yet; parts by table.

    Best run after :func:`compaction_job`: an index goes with the parts that a compaction merges.
    """
    built = {t: index.build(spark, t, _path(root, t)) for t in FACTS if t != "data_health"}
    return {t: n for t, n in built.items() if n}


def warehouse_counts(spark: SparkSession, root: str) -> DataFrame:
    """Row count per fact table (a small health report of a warehouse)."""
    out = read_health(spark, root).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("data_health").alias("table"), "rows")
    for t in ("fact_ad_spend", "fact_orders", "fact_events", "fact_attribution",
              "fact_campaign_metrics", "quarantine"):
        c = read_fact(spark, t, _path(root, t), missing="empty").agg(
            F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows")
        out = out.unionByName(c)
    return out
