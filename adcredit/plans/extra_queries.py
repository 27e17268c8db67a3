"""Registered queries that write tables, train models or run streams.

Each one works in a fresh folder under the shared ``spark.checkpoint.dir``
and returns a DataFrame read back from what it wrote, so the check covers
the full write / read path.
"""

from __future__ import annotations

import datetime as _dt
from itertools import zip_longest

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.operators import drilldown
from adcredit.operators import features as feat
from adcredit.operators import forecast
from adcredit.plans import jobs
from adcredit.functions.scalar import finite
from adcredit.operators.normalize import accept, normalize_events
from adcredit.plans.catalog import (CAMPAIGN, CUSTOMER, DATE_FROM, DATE_TO, RETENTION_AS_OF, SQL,
                                    _FEATURES_CTE, _ROLL, _features_sql, _r, register)
from adcredit.plans.oracle import with_facts
from adcredit.schemas import FACT_AD_SPEND
from adcredit.session import shared_dir, state_partitions
from adcredit.sources import files, index, manifest
from adcredit.sources.driver import Warehouse
from adcredit.sources.raw import RAW_SCHEMAS, read_raw, stream_raw
from adcredit.sources.sinks import read_fact, replace_partitions, write_fact
from adcredit.streaming import corrections
from adcredit.streaming import jobs as sj

_ATTR_COLS = "order_id, customer_id, campaign_id, touch_ts, revenue"


# --------------------------------------------------------------------------
# Sinks and layout
# --------------------------------------------------------------------------

@register("append_replace_roundtrip", with_facts("fact_attribution") + f"""
SELECT {_ATTR_COLS}, touch_date FROM fact_attribution""")
def _append_replace(w: Warehouse):
    """Replace, append (doubles), replace again (back to one copy),
    then an empty append, which must be a no-op."""
    # attribution is computed once into a written table; the round trip
    # then works from that copy (no cache, lineage cut at the files)
    first = shared_dir(w.spark, "fact_attribution")
    write_fact(w.fact_attribution, "fact_attribution", first, "overwrite")
    attr = read_fact(w.spark, "fact_attribution", first)
    path = shared_dir(w.spark, "fact_attribution")
    write_fact(attr, "fact_attribution", path, "overwrite")
    write_fact(attr, "fact_attribution", path, "append")
    doubled = read_fact(w.spark, "fact_attribution", path).count()
    write_fact(attr, "fact_attribution", path, "overwrite")
    if write_fact(attr.limit(0), "fact_attribution", path, "append"):
        raise AssertionError("empty append wrote files")
    back = read_fact(w.spark, "fact_attribution", path)
    if doubled != 2 * attr.count():
        raise AssertionError("append did not add a full copy")
    return back.select("order_id", "customer_id", "campaign_id", "touch_ts", "revenue",
                       "touch_date")


@register("partitioned_write_scan", with_facts("fact_events") + f"""
SELECT event_id, customer_id, event_ts, event_date, event_type, campaign_id, source
FROM fact_events
WHERE event_date >= DATE '{DATE_FROM}' AND event_date <= DATE '{DATE_TO}'
  AND campaign_id = '{CAMPAIGN}'""")
def _partitioned_scan(w: Warehouse):
    """S9 + P10: date-partitioned, cluster-sorted write; the read prunes
    date directories and pushes the campaign filter into the Parquet scan."""
    path = shared_dir(w.spark, "fact_events")
    write_fact(w.fact_events, "fact_events", path, "overwrite")
    ev = read_fact(w.spark, "fact_events", path)
    return (ev.filter(F.col("event_date").between(F.lit(DATE_FROM), F.lit(DATE_TO))
                      & (F.col("campaign_id") == CAMPAIGN))
            .drop("inserted_at"))


@register("events_compacted", with_facts("fact_events") + """
SELECT event_id, customer_id, event_ts, event_date, event_type, campaign_id, 'replay' AS source
FROM fact_events""")
def _events_compacted(w: Warehouse):
    """B3 + S5: all raw events land in three appends, then compaction merges each date's small
    files into one while the rows stay the same."""
    spark, root = w.spark, shared_dir(w.spark, "warehouse")
    path = f"{root}/fact_events"
    for n in range(3):                                  # all deliveries of an event are in one batch
        batch = w.raw_events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == n)
        jobs.compact_events(spark, batch, root, w.as_of)
    before = manifest.latest(spark, path)
    saved = jobs.compaction_job(spark, root)["fact_events"]
    after = manifest.latest(spark, path)
    if saved <= 0 or sum(p.files for p in after.parts) != len({p.partition for p in before.parts}):
        raise AssertionError(f"compaction left {after.parts}")
    return read_fact(spark, "fact_events", path).drop("inserted_at")


_EVENT_COLS = "event_id, customer_id, event_ts, event_date, event_type, campaign_id, source"


def _indexed_events(w: Warehouse) -> str:
    """A written ``fact_events`` in two appends, of which the first is indexed."""
    path = shared_dir(w.spark, "fact_events")
    late = F.pmod(F.xxhash64("event_id"), F.lit(8)) == 0
    write_fact(w.fact_events.filter(~late), "fact_events", path)
    index.build(w.spark, "fact_events", path)
    write_fact(w.fact_events.filter(late), "fact_events", path)
    return path


@register("customer_lookup", with_facts("fact_events") + f"""
SELECT {_EVENT_COLS} FROM fact_events WHERE customer_id = '{CUSTOMER}'""")
def _customer_lookup(w: Warehouse):
    """One customer's events through the key index; rows appended since are found too."""
    return index.lookup(w.spark, "fact_events", _indexed_events(w), "customer_id", [CUSTOMER]).drop("inserted_at")


@register("deep_events_page", with_facts("fact_events") + f"""
SELECT {_EVENT_COLS}, (SELECT COUNT(*) FROM fact_events) AS total_count
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY event_ts DESC NULLS LAST, event_id DESC) AS place
      FROM fact_events)
WHERE place > (SELECT COUNT(*) FROM fact_events) // 2
ORDER BY place LIMIT 200""")
def _deep_page(w: Warehouse):
    """O4 + A6: the page in the middle of all events reads only the dates it lies in."""
    path = _indexed_events(w)
    total = sum(index.row_counts(w.spark, "fact_events", path).values())
    rows, _ = drilldown.stored_page(w.spark, "fact_events", path, limit=200, offset=total // 2)
    return rows.drop("inserted_at").withColumn("total_count", F.lit(total).cast("bigint"))


@register("dates_replaced", with_facts("fact_ad_spend") + f"""
SELECT campaign_id, date, CASE WHEN date BETWEEN DATE '{DATE_FROM}' AND DATE '{DATE_TO}'
                               THEN CAST(2 * spend AS DOUBLE) ELSE spend END AS spend
FROM fact_ad_spend""")
def _dates_replaced(w: Warehouse):
    """Every date of a range gets new rows in one commit; all other dates keep their files, and
    the version before is still readable."""
    path = shared_dir(w.spark, "fact_ad_spend")
    write_fact(w.fact_ad_spend, "fact_ad_spend", path, "overwrite")
    base = manifest.latest(w.spark, path)
    old = read_fact(w.spark, "fact_ad_spend", path, snapshot=base)
    inside = F.col("date").between(F.lit(DATE_FROM).cast("date"), F.lit(DATE_TO).cast("date"))
    days = [r[0] for r in old.filter(inside).select("date").distinct().collect()]       # days
    replace_partitions(old.filter(inside).withColumn("spend", 2 * F.col("spend")), "fact_ad_spend", path,
                       days, base)
    if manifest.latest(w.spark, path).version != base.version + 1:
        raise AssertionError("more than one commit")
    cols = ["campaign_id", "date", "spend"]
    if old.select(cols).exceptAll(w.fact_ad_spend.select(cols)).count():
        raise AssertionError("the version before has changed")
    return read_fact(w.spark, "fact_ad_spend", path).select(cols)


# --------------------------------------------------------------------------
# Batch jobs end to end
# --------------------------------------------------------------------------

@register("jobs_end_to_end", with_facts("ad_runs", "day_totals", extra="""
  spend AS (
    SELECT campaign_id, date, MAX(spend) AS spend FROM ad_runs WHERE clicks <> 0 GROUP BY ALL
  )""") + """
SELECT s.campaign_id, s.date AS metric_date, s.spend,
       COALESCE(CAST(d.day_revenue AS DOUBLE), 0) AS attributed_revenue,
       CAST(COALESCE(d.day_orders, 0) AS BIGINT) AS conversions
FROM spend s LEFT JOIN day_totals d ON d.campaign_id = s.campaign_id AND d.touch_date = s.date""")
def _jobs_end_to_end(w: Warehouse):
    """Ingest all raw ads / orders / events (unreadable amounts and replays included),
    run attribution and metrics into a fresh warehouse folder and read the metrics back.
    Ads with an unreadable amount must be in quarantine, no row may be lost."""
    spark, root, as_of = w.spark, _ingested(w), w.as_of
    counts = {r["table"]: r["rows"] for r in jobs.warehouse_counts(spark, root).collect()}
    if (counts["fact_ad_spend"] + counts["quarantine"], counts["fact_orders"],
            2 * counts["fact_events"]) != (w.raw_ads.count(), w.raw_orders.count(),
                                           w.raw_events.count()):
        raise AssertionError(f"rows are unaccounted for: {counts}")
    jobs.attribution_job(spark, root, as_of)
    m = read_fact(spark, "fact_campaign_metrics", f"{root}/fact_campaign_metrics")
    return m.select("campaign_id", "metric_date", "spend", "attributed_revenue", "conversions")


def _ingested(w: Warehouse) -> str:
    """A fresh warehouse folder with all raw rows ingested."""
    root = shared_dir(w.spark, "warehouse")
    jobs.ingest_ads(w.spark, w.raw_ads, root, w.as_of)
    jobs.ingest_orders(w.spark, w.raw_orders, root, w.as_of)
    jobs.compact_events(w.spark, w.raw_events, root, w.as_of)
    return root


def _featured(w: Warehouse) -> str:
    """A fresh warehouse folder with metrics, events and the feature tables."""
    root = shared_dir(w.spark, "warehouse")
    write_fact(w.fact_campaign_metrics, "fact_campaign_metrics",
               f"{root}/fact_campaign_metrics", "overwrite")
    write_fact(w.fact_events, "fact_events", f"{root}/fact_events", "append")
    jobs.features_job(w.spark, root)
    return root


@register("features_job_table", _features_sql("""
SELECT campaign_id, metric_date, spend, attributed_revenue, conversions, cac, roas,
       rolling_7d_roas, rolling_7d_spend, rolling_7d_conversions, rolling_7d_volatility,
       next_day_roas
FROM features"""))
def _features_job_table(w: Warehouse):
    """B5 + S10: the feature table, written and read back with its fixed schema."""
    name = "fact_campaign_metrics_features"
    return _r(read_fact(w.spark, name, f"{_featured(w)}/{name}"), *_ROLL)


@register("features_incremental", SQL["features_job_table"])
def _features_incremental(w: Warehouse):
    """Features of metrics that were incomplete, then brought up to date by the late dates alone."""
    spark, root = w.spark, shared_dir(w.spark, "warehouse")
    name, path = "fact_campaign_metrics_features", f"{root}/fact_campaign_metrics"
    early = w.as_of - _dt.timedelta(days=1)
    inside = F.col("metric_date").between(F.lit(DATE_FROM).cast("date"), F.lit(DATE_TO).cast("date"))
    metrics = w.fact_campaign_metrics.withColumn("inserted_at", F.lit(early))
    # the range's dates first come with half the spend, and without the rows of one campaign
    write_fact(metrics.filter(~inside | (F.col("campaign_id") != CAMPAIGN))
               .withColumn("spend", F.when(inside, F.col("spend") / 2).otherwise(F.col("spend"))),
               "fact_campaign_metrics", path, "overwrite")
    write_fact(w.fact_events.withColumn("inserted_at", F.lit(early)), "fact_events", f"{root}/fact_events")
    jobs.features_job(spark, root)
    late = metrics.filter(inside).withColumn("inserted_at", F.lit(w.as_of))
    days = [r[0] for r in late.select("metric_date").distinct().collect()]              # days
    replace_partitions(late, "fact_campaign_metrics", path, days)
    jobs.features_job(spark, root, since=w.as_of)
    return _r(read_fact(spark, name, f"{root}/{name}"), *_ROLL)


@register("daily_features_table", SQL["features_events"])
def _daily_features_table(w: Warehouse):
    """The daily features with event counts, written and read back."""
    return _r(read_fact(w.spark, "daily_features", f"{_featured(w)}/daily_features"), *_ROLL)


@register("retention_job", with_facts("fact_events") + f"""
SELECT event_id, event_date, 'healthy' AS health FROM fact_events
WHERE event_date >= DATE '{RETENTION_AS_OF}' - INTERVAL 180 DAY""")
def _retention_job(w: Warehouse):
    """Expired partition folders of a written table are gone; ``data_health`` stays."""
    spark, root = w.spark, shared_dir(w.spark, "warehouse")
    path = f"{root}/fact_events"
    write_fact(w.fact_events, "fact_events", path, "append")
    jobs.update_freshness(spark, root, "events", w.as_of, w.as_of)
    jobs.retention_job(spark, root, RETENTION_AS_OF)
    health = jobs.read_health(spark, root).filter(F.col("source") == "events").first()  # one row
    return read_fact(spark, "fact_events", path).select(
        "event_id", "event_date", F.lit(health["status"]).alias("health"))


# --------------------------------------------------------------------------
# Raw landing files
# --------------------------------------------------------------------------

def _landed_ads(w: Warehouse, path: str) -> None:
    """Raw ads as JSON lines; those of two clicks are cut off in the middle."""
    line = F.to_json(F.struct(*[F.col(c) for c in RAW_SCHEMAS["ads"].fieldNames()]))
    broken = F.when(F.col("clicks") == "2", F.substring(line, 1, 25)).otherwise(line)
    w.raw_ads.select(broken.alias("value")).write.text(path)


_ADS_SQL = with_facts("ad_runs") + """
SELECT campaign_id, date, CASE WHEN clicks = 0 THEN NULL ELSE spend END AS spend, impressions,
       clicks, CAST(NULL AS VARCHAR) AS violations
FROM ad_runs WHERE clicks NOT IN (0, 2)
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, CASE clicks WHEN 0 THEN 'spend is null'
    ELSE 'campaign_id is null; date is null; spend is null; row is unreadable' END
FROM ad_runs WHERE clicks IN (0, 2)"""


def _told(good: DataFrame, violations: DataFrame) -> DataFrame:
    """Accepted rows, and the violations of each rejected one."""
    cols = ["campaign_id", "date", "spend", "impressions", "clicks"]
    none = [F.lit(None).cast(FACT_AD_SPEND.schema[c].dataType).alias(c) for c in cols]
    return good.select(*cols, F.lit(None).cast("string").alias("violations")).unionByName(
        violations.select(*none, F.array_join("violations", "; ").alias("violations")))


@register("raw_json_ads", _ADS_SQL)
def _raw_json_ads(w: Warehouse):
    """JSON lines; a line that cannot be read is rejected with its text, not lost."""
    path = shared_dir(w.spark, "raw-ads")
    _landed_ads(w, path)
    return _told(*accept(read_raw(w.spark, "ads", path), "ads", as_of=w.as_of))


@register("raw_csv_orders", with_facts("fact_orders") + """
SELECT order_id, customer_id, order_ts, order_date, revenue, currency FROM fact_orders""")
def _raw_csv_orders(w: Warehouse):
    """CSV with a header, every column as text."""
    path = shared_dir(w.spark, "raw-orders")
    w.raw_orders.write.option("header", "true").csv(path)
    good, _ = accept(read_raw(w.spark, "orders", path, "csv"), "orders", as_of=w.as_of)
    return good.drop("inserted_at")


@register("raw_json_events", SQL["normalize_events_distinct"])
def _raw_json_events(w: Warehouse):
    """S3: JSON lines of twice-delivered events, normalised, exact copies removed."""
    path = shared_dir(w.spark, "raw-events")
    w.raw_events.drop("ingest_seq").write.json(path)
    raw = read_raw(w.spark, "events", path)
    return normalize_events(raw, as_of=w.as_of).drop("inserted_at")


# --------------------------------------------------------------------------
# Forecast (random forest): a forest cannot be matched value for value (D19), so split,
# evaluation rule, keys and properties are checked against SQL
# --------------------------------------------------------------------------

_MODELS: dict[tuple[str, str], tuple] = {}


def reset_models() -> None:
    """Forget trained models and release their persisted training frames."""
    for entry in _MODELS.values():
        entry[2].unpersist()
    _MODELS.clear()


def _frame(w: Warehouse) -> DataFrame:
    return feat.training_frame(feat.features_with_target(w.fact_campaign_metrics), fill=0.0,
                               keys=("campaign_id",))


def _model(w: Warehouse):
    """(model, test rows, whole frame) of this application and folder, trained once."""
    key = (w.spark.sparkContext.applicationId, w.sf_dir)
    if key not in _MODELS:
        # one row per campaign-day; train and test splits both read it
        frame = _frame(w).persist(StorageLevel.MEMORY_AND_DISK)
        train, test = forecast.split(frame)
        model = forecast.fit_forecast(train)
        path = forecast.save_model(model, shared_dir(w.spark, "roas_model"))
        _MODELS[key] = (forecast.load_model(path), test, frame)
    return _MODELS[key]


_SPLIT_CTE = """,
  parted AS (
    SELECT campaign_id, metric_date, COALESCE(roas, 0) AS roas, next_day_roas,
           CAST('0x' || substr(md5('42|' || campaign_id || '|' || CAST(metric_date AS VARCHAR)), 1, 8)
                AS BIGINT) % 10000 >= 8000 AS test
    FROM features WHERE next_day_roas IS NOT NULL
  )"""


def _split_sql(select: str) -> str:
    return with_facts("fact_campaign_metrics", extra=_FEATURES_CTE + _SPLIT_CTE) + select


@register("forecast_split", _split_sql("""
SELECT campaign_id, metric_date, CASE WHEN test THEN 'test' ELSE 'train' END AS part FROM parted"""))
def _forecast_split(w: Warehouse):
    """M3: which rows train and which test."""
    train, test = forecast.split(_frame(w))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))).select("campaign_id", "metric_date", "part")


@register("forecast_rule_eval", _split_sql("""
SELECT round(AVG((roas - next_day_roas) ** 2), 6) + 0.0 AS mse,
       round(1 - SUM((roas - next_day_roas) ** 2) / (VAR_POP(next_day_roas) * COUNT(*)), 6) + 0.0 AS r2,
       COUNT(*) AS rows
FROM parted WHERE test"""))
def _forecast_rule_eval(w: Warehouse):
    """M5 / A11 on a fixed rule: today's ROAS as tomorrow's, on the test rows."""
    _, test = forecast.split(_frame(w))
    return _r(forecast.evaluate_predictions(test.withColumn("prediction", F.col("roas"))),
              "mse", "r2")


@register("forecast_train_eval", _split_sql("""
SELECT COUNT(*) FILTER (NOT test) AS train_rows, COUNT(*) FILTER (test) AS rows,
       TRUE AS mse_valid, TRUE AS r2_valid
FROM parted"""))
def _train_eval(w: Warehouse):
    """M3-M5 + S15: hash split, 200-tree forest, saved and reloaded, MSE / R2 on the test rows.

    The errors depend on the forest, so they are reported as valid: MSE finite and not negative, R2 at
    most 1.
    """
    model, test, frame = _model(w)
    train, _ = forecast.split(frame)
    return forecast.evaluate(model, test).select(
        F.lit(train.count()).cast("bigint").alias("train_rows"), "rows", (finite("mse") & (F.col("mse") >= 0)).alias("mse_valid"),
        (finite("r2") & (F.col("r2") <= 1)).alias("r2_valid"))


@register("feature_importance", """
SELECT unnest(['""" + "', '".join(sorted(forecast.FEATURE_ORDER)) + """']) AS feature,
       TRUE AS in_unit, CAST(1 AS DOUBLE) AS total""")
def _importance(w: Warehouse):
    """Nine importances within 0..1 that sum to 1 (the report sorts them
    descending)."""
    rows = forecast.feature_importance(w.spark, _model(w)[0])
    total = rows.agg(F.round(F.sum("importance"), 9).alias("total")).first()["total"]
    return rows.select("feature", F.col("importance").between(0, 1).alias("in_unit"),
                       F.lit(total).alias("total"))


def _scored(w: Warehouse, rows: DataFrame) -> DataFrame:
    """Keys, today's ROAS, and whether the prediction lies within the training targets."""
    model, _, frame = _model(w)
    train, _ = forecast.split(frame)
    span = train.agg(F.min(forecast.LABEL).alias("low"), F.max(forecast.LABEL).alias("high")).first()
    predicted = F.col("predicted_next_day_roas")
    return forecast.score(model, rows).select(
        "campaign_id", "metric_date", "roas",
        predicted.between(span["low"], span["high"]).alias("in_range"))


@register("forecast_next_day", _features_sql("""
SELECT campaign_id, metric_date, COALESCE(roas, 0) AS roas, TRUE AS in_range
FROM features ORDER BY metric_date DESC, campaign_id ASC LIMIT 1"""))
def _next_day(w: Warehouse):
    """M7 / Q15: prediction for the newest feature row, within the training targets (a
    forest averages them)."""
    return _scored(w, feat.latest_feature_row(feat.features_with_target(w.fact_campaign_metrics)))


@register("score_features", _features_sql("""
SELECT campaign_id, metric_date, roas, TRUE AS in_range FROM features"""))
def _score(w: Warehouse):
    """M8: batch scoring of every feature row."""
    rows = feat.features_with_target(w.fact_campaign_metrics)
    return _scored(w, rows.select("campaign_id", "metric_date", *forecast.FEATURE_ORDER))


# --------------------------------------------------------------------------
# Streams, fed by the derived facts landing as files in arrival order
# --------------------------------------------------------------------------

_DELAY_S = 3600
_CHUNK_DAYS = 6


def _arrivals(df: DataFrame, ts_col: str) -> list[DataFrame]:
    """Successive spans of days: the order in which rows arrive. The rows are written once,
    partitioned by span, and each arrival is one partition."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "arrivals")
    day = F.datediff(F.to_date(ts_col), F.lit(_dt.date(2000, 1, 1)))
    df.withColumn("_span", F.floor(day / _CHUNK_DAYS)).write.partitionBy("_span").parquet(path)
    return [spark.read.schema(df.schema).parquet(f"{path}/{name}")
            for name in files.folders(spark, path)]                 # a few spans


def _run_available(spark, start) -> None:
    with state_partitions(spark):
        started = start()
    for query in started if isinstance(started, list) else [started]:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()


def _land_and_stream(parts: list[DataFrame], src: str, start) -> None:
    """Land each arrival (a parallel write) and run the stream over what is
    available, restarting from the same checkpoint every time: state and
    progress survive the restart, as after a driver or executor loss.
    The checkpoint keeps the number of state partitions from the first start.
    """
    for part in parts:
        part.write.mode("append").parquet(src)
        _run_available(part.sparkSession, start)


def _streamed_touches(w: Warehouse, orders: DataFrame) -> DataFrame:
    """T3 over ``orders`` and all touches, restarted after every arrival."""
    spark = w.spark
    src, out, ck = (shared_dir(spark, n) for n in ("touch-src", "touch-out", "touch-ck"))
    touches = sj.touch_stream(orders, w.fact_events)
    max_ts = touches.agg(F.max("ts")).first()[0]
    parts = _arrivals(touches, "ts") + [sj.end_of_input_marker(spark, max_ts, _DELAY_S)]

    def start():
        stream = spark.readStream.schema(sj.TOUCH_INPUT).parquet(src)
        return (sj.stream_last_touch(stream, f"{_DELAY_S} seconds").writeStream
                .format("parquet").option("path", out).option("checkpointLocation", ck)
                .outputMode("append").trigger(availableNow=True).start())

    _land_and_stream(parts, src, start)
    answers = spark.read.schema(sj.TOUCH_OUTPUT).parquet(out)
    late = sj.repair(orders, w.fact_events, answers)
    return answers.withColumn("late", F.lit(False)).unionByName(
        late.withColumn("late", F.lit(True)))


@register("stream_last_touch", with_facts("fact_attribution") + f"""
SELECT {_ATTR_COLS}, false AS late FROM fact_attribution""")
def _stream_last_touch(w: Warehouse):
    """Streaming last touch equals the batch attribution; none is left to the repair."""
    return _streamed_touches(w, w.fact_orders)


@register("stream_interval_last_touch", with_facts("fact_attribution") + f"""
SELECT {_ATTR_COLS} FROM fact_attribution""")
def _stream_interval_last_touch(w: Warehouse):
    """The interval join of the order and event streams equals the batch attribution."""
    spark = w.spark
    root = shared_dir(spark, "stream-interval")
    out, ck = f"{root}/out", f"{root}/ck"
    event, order = f"{root}/events", f"{root}/orders"
    e = w.fact_events.select("event_id", "customer_id", "event_ts", "campaign_id")
    o = w.fact_orders.select("order_id", "customer_id", "order_ts", "revenue")
    last = max(x for df, c in ((e, "event_ts"), (o, "order_ts")) for x in df.agg(F.max(c)).first())

    def start():
        streams = [spark.readStream.schema(df.schema).parquet(at) for df, at in ((o, order), (e, event))]
        return sj.stream_interval_last_touch(*streams, f"{_DELAY_S} seconds").writeStream.format("parquet") \
            .option("path", out).option("checkpointLocation", ck).outputMode("append") \
            .trigger(availableNow=True).start()

    for es, os_ in zip_longest(_arrivals(e, "event_ts"), _arrivals(o, "order_ts")):
        for df, at in ((es, event), (os_, order)):
            if df is not None:
                df.write.mode("append").parquet(at)
        _run_available(spark, start)                    # restarted after every arrival
    for n in (1, 2):    # closing rows on both sides move the watermarks of join and sum past all input
        ts = last + _dt.timedelta(days=30 * n)
        for df, at in ((e, event), (o, order)):
            spark.createDataFrame([("~end", "~end", ts, None)], df.schema).coalesce(1) \
                .write.mode("append").parquet(at)
        _run_available(spark, start)
    return spark.read.schema(sj.TOUCH_OUTPUT).parquet(out).filter("order_id <> '~end'")


@register("stream_last_touch_dirty", with_facts("fact_attribution") + """
SELECT order_id, CASE WHEN n % 13 = 0 THEN NULL ELSE customer_id END AS customer_id,
       CASE WHEN n % 13 <> 0 THEN campaign_id END AS campaign_id,
       CASE WHEN n % 13 <> 0 THEN touch_ts END AS touch_ts, revenue / 3 AS revenue, false AS late
FROM (SELECT *, CAST(substr(order_id, 5) AS BIGINT) AS n FROM fact_attribution)""")
def _stream_last_touch_dirty(w: Warehouse):
    """T3 on orders without a customer, orders delivered twice, and amounts of full precision."""
    o = w.fact_orders.withColumn("n", F.substring("order_id", 5, 20).cast("bigint"))
    o = o.withColumn("revenue", F.col("revenue") / 3).withColumn(
        "customer_id", F.when(F.col("n") % 13 != 0, F.col("customer_id"))).drop("n")
    return _streamed_touches(w, o.unionByName(o))


@register("stream_events_dedup", with_facts("fact_events") + """
SELECT event_id, customer_id, event_ts, event_date, event_type, campaign_id, source
FROM fact_events""")
def _stream_events(w: Warehouse):
    """Twice-delivered events, one row per event_id after the stream.

    The delay exceeds the input's span, so every replay arrives inside the watermark and is
    removed as a duplicate, not dropped as late.
    """
    from adcredit.schemas import RAW_EVENTS
    spark = w.spark
    src, out, ck = (shared_dir(spark, n) for n in ("events-src", "events-out", "events-ck"))
    raw = w.raw_events.drop("ingest_seq")
    # the first deliveries arrive before the replays
    parts = [raw.filter(F.col("source") != "replay"), raw.filter(F.col("source") == "replay")]
    late = []

    def start():
        stream = spark.readStream.schema(RAW_EVENTS).parquet(src)
        q = (sj.stream_events(stream, "60 days", as_of=w.as_of)
             .drop("inserted_at").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).outputMode("append")
             .trigger(availableNow=True).start())
        late.append(q)
        return q

    _land_and_stream(parts, src, start)
    if sum(sj.dropped_by_watermark(q) for q in late):
        raise AssertionError("replays were dropped as late")
    return spark.read.parquet(out)


@register("stream_events_last_arrival", SQL["normalize_events_dedup"])
def _stream_last_arrival(w: Warehouse):
    """P6 as a stream: every event twice, the last arrival is left in the table, whatever the order.

    By a hash of the event, a third each: both deliveries in the first landing, the replay in the second
    (a correction of a stored row), the replay before the first delivery (which then changes nothing).
    """
    spark, raw = w.spark, w.raw_events
    src, table, ck, rejected = (shared_dir(spark, n) for n in ("last-src", "last-events", "last-ck", "last-bad"))
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    replay = F.col("source") == "replay"
    now = F.when(third == 0, True).when(third == 1, ~replay).otherwise(replay)
    started = []

    def start():
        stream = spark.readStream.schema(raw.schema).parquet(src)
        started.extend(corrections.start_last_arrivals(stream, table, ck, rejected, "events", as_of=w.as_of,
                                                       delay="60 days", groups=1024))
        return started[-2:]

    _land_and_stream([raw.filter(now), raw.filter(~now)], src, start)
    if sum(sj.dropped_by_watermark(q) for q in started):
        raise AssertionError("deliveries were dropped as late")
    return read_fact(spark, "fact_events", table).drop("inserted_at")


def _streamed_ingest(w: Warehouse, kind: str, table: str, src: str, fmt: str, arrivals) -> str:
    """T2 into a fresh warehouse folder, restarted after each of ``arrivals`` (functions that land
    files in ``src``)."""
    root, ck = shared_dir(w.spark, "warehouse"), shared_dir(w.spark, "ingest-ck")
    for land in arrivals:
        land()
        _run_available(w.spark, lambda: sj.stream_ingest(stream_raw(w.spark, kind, src, fmt), kind,
                                                         f"{root}/{table}", ck, f"{root}/quarantine",
                                                         as_of=w.as_of))
    return root


@register("stream_ingest_orders", with_facts("fact_orders") + """
SELECT order_id, customer_id, order_ts, order_date, revenue, currency FROM fact_orders""")
def _stream_ingest(w: Warehouse):
    """Raw text orders streamed into the date-partitioned fact table; the last arrival is a batch
    job beside the stream, whose rows the reader must see as well."""
    spark, raw, src = w.spark, w.raw_orders, shared_dir(w.spark, "orders-src")
    timed = raw.withColumn("_ts", F.col("order_ts").cast("timestamp"))
    parts = [p.drop("_ts") for p in _arrivals(timed, "_ts")]
    lands = [lambda p=p: p.write.mode("append").parquet(src) for p in parts[:-1]]
    root = _streamed_ingest(w, "orders", "fact_orders", src, "parquet", lands)
    for part in parts[-1:]:
        jobs.ingest_orders(spark, part, root, w.as_of)
    return read_fact(spark, "fact_orders", f"{root}/fact_orders",
                     missing="empty").drop("inserted_at")


@register("stream_ingest_ads", _ADS_SQL)
def _stream_ingest_ads(w: Warehouse):
    """JSON ads streamed; unreadable lines and amounts land in quarantine."""
    src = shared_dir(w.spark, "ads-src")
    root = _streamed_ingest(w, "ads", "fact_ad_spend", src, "json", [lambda: _landed_ads(w, src)])
    return _told(read_fact(w.spark, "fact_ad_spend", f"{root}/fact_ad_spend"),
                 read_fact(w.spark, "quarantine", f"{root}/quarantine"))


@register("stream_daily_counts", with_facts("fact_events") + """
SELECT CAST(event_ts AS DATE) AS date, campaign_id, COUNT(*) AS events_count
FROM fact_events GROUP BY 1, 2""")
def _stream_counts(w: Warehouse):
    """T5: one-day tumbling windows per campaign, emitted as days close."""
    spark = w.spark
    src, out, ck = (shared_dir(spark, n) for n in ("counts-src", "counts-out", "counts-ck"))
    ev = w.fact_events.select("event_id", "event_ts", "campaign_id")
    max_ts = ev.agg(F.max("event_ts")).first()[0]
    marker = spark.createDataFrame(
        [("~end-of-input", max_ts + _dt.timedelta(days=1, seconds=_DELAY_S + 1), "~end-of-input")],
        ev.schema)
    parts = _arrivals(ev, "event_ts") + [marker]

    def start():
        stream = spark.readStream.schema(ev.schema).parquet(src)
        return (sj.stream_daily_counts(stream, f"{_DELAY_S} seconds").writeStream
                .format("parquet").option("path", out).option("checkpointLocation", ck)
                .outputMode("append").trigger(availableNow=True).start())

    _land_and_stream(parts, src, start)
    return spark.read.parquet(out)


@register("stream_freshness", with_facts("fact_orders") + """
SELECT 'orders' AS source, MAX(order_ts) AS latest_timestamp, 'healthy' AS status
FROM fact_orders""")
def _stream_freshness(w: Warehouse):
    """T4: per-micro-batch MERGE of the orders source's freshness."""
    spark = w.spark
    src, root, ck = (shared_dir(spark, n) for n in ("fresh-src", "warehouse", "fresh-ck"))
    o = w.fact_orders.select("order_id", "order_ts")

    def start():
        stream = spark.readStream.schema(o.schema).parquet(src)
        return (stream.writeStream
                .foreachBatch(sj.freshness_sink(root, "orders", "order_ts", as_of=w.as_of))
                .option("checkpointLocation", ck).trigger(availableNow=True).start())

    _land_and_stream(_arrivals(o, "order_ts"), src, start)
    return jobs.read_health(spark, root).select("source", "latest_timestamp", "status")
