"""Structured Streaming forms of the scheduled ingest and attribution jobs.

The reference runs these as cron micro-batches; here they are streams:

* ``stream_events``       T1  normalise, watermark, de-duplicate by event_id
* ``stream_ingest``       T2  quarantine, normalise and append to the fact table's stream folder
* ``stream_interval_last_touch``  T3  last-touch attribution as a stream-stream interval join (JVM state)
* ``stream_last_touch``   T3  the same keyed by customer, for hot customers and re-delivered orders
* ``freshness_sink``      T4  per micro-batch upsert of the source's freshness
* ``stream_daily_counts`` T5  tumbling one-day event counts per campaign

All inputs must carry real ``TIMESTAMP`` columns (watermarks refuse NTZ). Rows older than the
watermark are dropped by Spark's stateful operators; :func:`dropped_by_watermark` counts them, and
:func:`unanswered_orders` finds the orders that a batch run must repair.
"""

from __future__ import annotations

import datetime as _dt
import sys
from collections import defaultdict

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

import numpy as np
import pandas as pd

from adcredit.operators.attribution import last_touch
from adcredit.operators.normalize import KINDS, accept, normalize_events
from adcredit.plans.jobs import merge_freshness
from adcredit.schemas import FACTS
from adcredit.sources.sinks import conform, stream_folder


def _deduplicated(events: DataFrame, delay: str) -> DataFrame:
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def stream_events(raw_stream: DataFrame, delay: str = "1 hour", mode: str = "tolerant",
                  as_of=None) -> DataFrame:
    """Normalised events, one per event_id while it is within the watermark.

    The first arrival is kept (a stream cannot wait for "the last" one); the
    state of an id is dropped once the watermark passes its event time.
    """
    ev = normalize_events(raw_stream, mode, as_of=as_of, distinct=False) \
        if "event_date" not in raw_stream.columns else raw_stream
    return _deduplicated(ev, delay)


def stream_ingest(raw_stream: DataFrame, kind: str, path: str, checkpoint: str,
                  quarantine_path: str, mode: str = "tolerant", as_of=None,
                  delay: str = "1 hour") -> list:
    """Accepted rows to the fact table's stream folder, rejected ones to quarantine.

    ``kind``: ads, orders or events (events are de-duplicated as in T1). Two queries,
    each with a file sink and a checkpoint, so both are exactly-once: a restarted query
    (after executor or driver loss) resumes from its last committed batch.
    Returns the started queries.
    """
    good, bad = accept(raw_stream, kind, mode, as_of)
    spec = KINDS[kind][1]
    if kind == "events":
        good = _deduplicated(good, delay)

    def start(df: DataFrame, to: str, name: str, partition: str | None):
        writer = df.writeStream.format("parquet").outputMode("append") \
            .option("checkpointLocation", f"{checkpoint}/{name}").option("path", stream_folder(to))
        writer = writer.partitionBy(partition) if partition else writer
        return writer.trigger(availableNow=True).start()

    return [start(conform(good, spec), path, "accepted", spec.partition_col),
            start(conform(bad, FACTS["quarantine"]), quarantine_path, "rejected", None)]


def dropped_by_watermark(query) -> int:
    """Rows that the query's stateful operators dropped as too late, so far as it reports."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
               for op in p["stateOperators"])


def freshness_sink(root: str, source: str, ts_col: str, as_of=None):
    """T4: ``foreachBatch`` function upserting ``source``'s freshness in ``data_health``.

    Each batch's newest instant is MERGEd into the source's own versioned folder.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        incoming = batch.agg(F.max(ts_col).alias("latest_timestamp")) \
            .filter(F.col("latest_timestamp").isNotNull()) \
            .select(F.lit(source).alias("source"), "latest_timestamp")
        merge_freshness(batch.sparkSession, root, incoming, source, as_of)
    return run


def stream_daily_counts(events_stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """T5: events per (UTC day, campaign) emitted once the day is closed."""
    g = (events_stream.withWatermark("event_ts", delay)
         .groupBy(F.window("event_ts", "1 day"), F.col("campaign_id"))
         .agg(F.count(F.lit(1)).alias("events_count")))
    return g.select(F.to_date(F.col("window.start")).alias("date"), "campaign_id",
                    "events_count")


# --------------------------------------------------------------------------
# Last touch with bounded state per customer, in groups of customers
# --------------------------------------------------------------------------

TOUCH_INPUT = T.StructType([
    T.StructField("kind", T.IntegerType()),          # 0 event, 1 order
    T.StructField("customer_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
])

TOUCH_OUTPUT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("touch_ts", T.TimestampType()),
    T.StructField("revenue", T.DoubleType()),
])

def _owned(*fields: T.StructField) -> T.ArrayType:
    """Rows of one customer (or of one order without a customer) in the state of a group."""
    return T.ArrayType(T.StructType([T.StructField("alone", T.StringType()),
                                     T.StructField("customer_id", T.StringType()), *fields]))


_TS = T.StructField("ts", T.LongType())
_EVENT = (_TS, T.StructField("event_id", T.StringType()), T.StructField("campaign_id", T.StringType()))
_ORDER_ID = T.StructField("order_id", T.StringType())

# per customer: folded = newest event at or before the watermark; events and orders hold newer rows;
# done = orders answered within the look-back. All values are typed: none passes through text.
TOUCH_STATE = T.StructType([
    T.StructField("folded", _owned(*_EVENT)),                # none or one a customer
    T.StructField("events", _owned(*_EVENT)),
    T.StructField("orders", _owned(_TS, _ORDER_ID, T.StructField("revenue", T.DoubleType()))),
    T.StructField("done", _owned(_TS, _ORDER_ID)),
])


def _rank(event: tuple) -> tuple:
    """Batch order of touches: instant, then id (longer ids after shorter ones)."""
    ts, event_id, _ = event
    return ts, event_id is not None, len(event_id or ""), event_id or ""


_NAT = np.iinfo("int64").min                                 # numpy's instant that is none


def _text(v) -> str | None:
    return None if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)) else str(v)


def _attribute_customer(customer: str | None, held: tuple, wm: int, lookback_us: int) -> tuple:
    """One customer (or one order without a customer) at the watermark ``wm``: what stays held,
    and {order id: (touch, revenue)} of the orders answered now."""
    folded, events, orders, done = held
    answered = {oid for _, oid in done}
    # copies collapse: one row an event, one row an (order, instant)
    events = sorted(set(events), key=_rank)
    newest: dict = {}
    for ts, oid, rev in orders:
        if oid not in answered:
            had = newest.get((ts, oid))
            newest[ts, oid] = rev if had is None else had if rev is None else max(had, rev)
    orders = sorted(((ts, oid, rev) for (ts, oid), rev in newest.items()),
                    key=lambda o: (o[0], o[1] is not None, o[1] or ""))

    # 1) answer the orders the watermark has passed: every event at or
    #    before them has arrived (the folded row + the buffered events)
    best: dict = {}
    at, last = 0, folded[0] if folded else None
    for ts, oid, rev in orders:
        if ts > wm:
            break
        while at < len(events) and events[at][0] <= ts:
            if last is None or _rank(events[at]) > _rank(last):
                last = events[at]
            at += 1
        touch = last if customer is not None and last is not None \
            and ts - lookback_us <= last[0] <= ts else None
        # rows of one order id: the latest touch wins, as in the batch
        order = (touch is not None, _rank(touch) if touch else (), ts, rev is not None, rev or 0)
        if oid not in best or order > best[oid][0]:
            best[oid] = (order, touch, rev)
            answered.add(oid)
    latest = {oid: ts for ts, oid, _ in orders if ts <= wm}         # in order of time: the last stays
    done = done + [(latest[oid], oid) for oid in best]
    # a second instant of an answered id that comes later is the same order
    orders = [o for o in orders if o[0] > wm and o[1] not in answered]

    # 2) events at or before the watermark fold into one row (newest
    #    wins): every pending order is later than the watermark
    past = folded + [e for e in events if e[0] <= wm]
    folded = [max(past, key=_rank)] if past else []
    events = [e for e in events if e[0] > wm]

    # 3) nothing older than the look-back can be picked or re-delivered any more
    folded = [e for e in folded if e[0] + lookback_us >= wm]
    done = [d for d in done if d[0] + lookback_us >= wm]
    return (folded, events, orders, done), {oid: (touch, rev) for oid, (_, touch, rev) in best.items()}


def _attribute_group(lookback_us: int):
    """State function for a group of customers: Arrow batches in, one frame of answers out."""

    def fn(key, pdfs, state):
        wm = int(state.getCurrentWatermarkMs()) * 1000
        held: dict = defaultdict(lambda: ([], [], [], []))          # by (alone, customer)
        for n, part in enumerate(state.get if state.exists else ()):
            for alone, customer, *row in part or ():
                held[alone, customer][n].append(tuple(row))
        if not state.hasTimedOut:
            for pdf in pdfs:
                us = pd.to_datetime(pdf["ts"]).astype("datetime64[us]").astype("int64")
                columns = ("kind", "alone", "customer_id", "event_id", "campaign_id", "order_id", "revenue")
                for ts, kind, alone, customer, ev, camp, oid, rev in zip(
                        us.tolist(), *(pdf[c].tolist() for c in columns)):
                    if kind == 0:
                        held[_text(alone), _text(customer)][1].append((ts, _text(ev), _text(camp)))
                    elif kind == 1:
                        held[_text(alone), _text(customer)][2].append(
                            (ts, _text(oid), None if pd.isna(rev) else float(rev)))
        keep: tuple = ([], [], [], [])
        answers, due = [], None
        for (alone, customer), had in held.items():
            parts, best = _attribute_customer(customer, had, wm, lookback_us)
            folded, events, orders, done = parts
            for to, part in zip(keep, parts):
                to.extend((alone, customer, *row) for row in part)
            answers += [(oid, customer, touch, rev) for oid, (touch, rev) in best.items()]
            times = [o[0] for o in orders[:1]] + [e[0] for e in events[-1:]] \
                + [x[0] + lookback_us for x in folded + done]
            if times:
                due = min(times) if due is None else min(due, *times)
        if due is not None:
            state.update(keep)
            state.setTimeoutTimestamp(max(due // 1000, wm // 1000) + 1)
        elif state.exists:
            state.remove()
        if answers:
            yield pd.DataFrame({
                "order_id": pd.Series([a[0] for a in answers], dtype=object),
                "customer_id": pd.Series([a[1] for a in answers], dtype=object),
                "campaign_id": pd.Series([a[2] and a[2][2] for a in answers], dtype=object),
                "touch_ts": pd.Series(np.array([a[2][0] if a[2] else _NAT for a in answers], "int64")
                                      .view("datetime64[us]")),
                "revenue": pd.Series([a[3] for a in answers], dtype="float64"),
            })

    return fn


def touch_stream(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Union orders and events into the single keyed input of T3."""
    e = events.select(F.lit(0).alias("kind"), "customer_id", F.col("event_ts").alias("ts"),
                      "event_id", "campaign_id", F.lit(None).cast("string").alias("order_id"),
                      F.lit(None).cast("double").alias("revenue"))
    o = orders.select(F.lit(1).alias("kind"), "customer_id", F.col("order_ts").alias("ts"),
                      F.lit(None).cast("string").alias("event_id"),
                      F.lit(None).cast("string").alias("campaign_id"), "order_id", "revenue")
    return e.unionByName(o)


def stream_last_touch(touches: DataFrame, delay: str = "1 hour",
                      lookback_days: int = 7, groups: int = 1024) -> DataFrame:
    """Continuous last-touch attribution.

    The rows of the batch J1 for all input that is not older than the watermark when it
    arrives: one row an order id, orders without a customer included (they are keyed by their order
    id). An order is emitted once the watermark passes it, so every event at or before it has
    arrived. State per customer: the newest event at or before the watermark, the rows newer than
    it (at most ``delay`` of them), and the ids answered within the look-back; the last two and
    the folded event expire with the look-back, and then the state is removed. Two rows of one
    order id more than ``delay`` apart are answered by the first (a stream cannot take an answer back);
    the batch job answers them by the latest touch.

    Customers are dealt to ``groups`` groups by a hash, and a group's customers share a state row and a call:
    a call of the Python worker costs some milliseconds, whether for one customer's rows or for thousands. A task
    holds one group's rows of a micro-batch at a time, so ``groups`` should grow with the customers (some hundred to
    some thousand each); it is fixed by the checkpoint, as the number of shuffle partitions is.

    This operator is Python per group (Arrow batches, a small helper over lists); all
    others of the package are JVM-side, :func:`stream_interval_last_touch` too. A customer's state is in one task, as with any
    keyed state; for a hot customer it is bounded by the delay and the look-back's orders.
    """
    if groups < 1:
        raise ValueError("groups must be positive")
    lookback_us = int(lookback_days) * 86_400 * 1_000_000
    # ship the state function by value: executors need not install this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    alone = F.when(F.col("customer_id").isNull(), F.col("order_id"))
    keyed = touches.filter(F.col("customer_id").isNotNull() | (F.col("kind") != 0)) \
        .withColumn("alone", alone) \
        .withColumn("group", F.pmod(F.xxhash64("alone", "customer_id"), F.lit(groups))).withWatermark("ts", delay)
    return keyed.groupBy("group").applyInPandasWithState(
        _attribute_group(lookback_us), TOUCH_OUTPUT, TOUCH_STATE, "append",
        GroupStateTimeout.EventTimeTimeout)


def stream_interval_last_touch(orders: DataFrame, events: DataFrame, delay: str = "1 hour",
                               lookback_days: int = 7) -> DataFrame:
    """Last touch as an interval join of two streams, then the greatest touch per order.

    Equal to the batch J1 for input not older than the watermark, with JVM state only: events are kept for
    the look-back, orders until the watermark passes them, when an order without a touch is given out
    as such; a row per order id and instant. Join and aggregation share one watermark chain.

    :func:`stream_last_touch` stays beside it, since two results differ: an order id that comes again later
    with another instant is a second row here (a stream cannot take the first back, and no id is
    remembered); and a customer's events of a look-back meet each of that customer's orders, so for a customer
    with a large share of all rows the join's work grows with their product, while the
    keyed form keeps one folded event a customer.
    """
    o = orders.select("order_id", F.col("customer_id").alias("o_customer"), "order_ts", "revenue") \
        .withWatermark("order_ts", delay)
    e = events.select(
        F.col("customer_id").alias("e_customer"), "event_ts",
        F.struct(F.col("event_ts").alias("ts"), F.length(F.col("event_id").cast("string")).alias("tie"),
                 F.col("event_id").cast("string").alias("event_id"), "campaign_id").alias("touch")) \
        .withWatermark("event_ts", delay)
    reach = F.make_dt_interval(F.lit(int(lookback_days)))
    pairs = o.join(e, (F.col("o_customer") == F.col("e_customer"))
                   & (F.col("event_ts") <= F.col("order_ts"))
                   & (F.col("event_ts") >= F.col("order_ts") - reach), "left_outer")
    best = pairs.select("order_id", "o_customer", "order_ts", "revenue", "touch") \
        .groupBy("order_ts", "order_id", "o_customer") \
        .agg(F.max("touch").alias("touch"), F.max("revenue").alias("revenue"))
    return best.select("order_id", F.col("o_customer").alias("customer_id"),
                       F.col("touch.campaign_id").alias("campaign_id"),
                       F.col("touch.ts").alias("touch_ts"), "revenue")


def unanswered_orders(orders: DataFrame, answered: DataFrame) -> DataFrame:
    """Side table for batch repair: orders that the stream has not answered (too late for it)."""
    return orders.join(answered.select("order_id"), "order_id", "left_anti")


def repair(orders: DataFrame, events: DataFrame, answered: DataFrame,
           lookback_days: int = 7) -> DataFrame:
    """Batch answers (J1) for :func:`unanswered_orders`, in the stream's columns."""
    return last_touch(unanswered_orders(orders, answered), events, lookback_days) \
        .select(*TOUCH_OUTPUT.fieldNames())


def end_of_input_marker(spark, max_ts: _dt.datetime, delay_seconds: int) -> DataFrame:
    """One row past ``max_ts + delay``: closing the input advances the
    watermark so the last windows / pending orders are emitted."""
    ts = max_ts + _dt.timedelta(seconds=delay_seconds + 1)
    return spark.createDataFrame([(2, "~end-of-input", ts, None, None, None, None)], TOUCH_INPUT)
