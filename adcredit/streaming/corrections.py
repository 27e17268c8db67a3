"""The last arrival of every event wins, in a stream.

``stream_events`` keeps an event's first arrival. Here a keyed state remembers, for each event id, the
number of its last arrival and the date that its row is stored under. A newer arrival comes out at once,
with that date; ``upsert_batch`` replaces the stored row in the commit that adds the new one. An older or repeated
arrival is dropped. A timer ends an id's state once the watermark is ``keep`` past its event time.

The state function is Python per event id (the state API for timers has no DataFrame form) and needs the
RocksDB state store, which :func:`start_last_arrivals` sets for its own query only. State is a few numbers an id,
spread by event id: a hot customer or campaign is no hot key, and copies of one event are streamed through, not held.

A call per id costs some eight requests to the JVM and a record batch. With ``groups`` the ids are dealt to that many
groups by a hash; a group's ids share a call, a state row and a time-out, and the answers are the same. Without, state
can be read by event id.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import pandas as pd
from pyspark.sql.streaming.state import GroupStateTimeout

from adcredit.operators.normalize import accept
from adcredit.schemas import FACT_EVENTS, FACTS
from adcredit.session import shared_dir, state_partitions
from adcredit.sources import files
from adcredit.sources.sinks import conform, stream_folder, upsert_batch

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "arrival long, event_date date, until long"
# instants pass Python as numbers: no time zone of a worker can touch them
_OUT = "event_id string, customer_id string, event_us long, event_date date, event_type string, " \
    "campaign_id string, source string, inserted_us long, replaces date"

_GROUP_ROW = ("event_id", "arrival", "event_us", "customer_id", "event_day", "event_type", "campaign_id", "source",
              "inserted_us")
_GROUP_STATE = "ids array<string>, arrivals array<long>, days array<int>, untils array<long>"
_GROUP_OUT = "event_id string, customer_id string, event_us long, event_day int, event_type string, " \
    "campaign_id string, source string, inserted_us long, replaces_day int"


class LastArrival(StatefulProcessor):
    """State of one event id."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # equal arrival numbers: the greatest row, so that the order of rows in a batch decides nothing
        row = max(rows, key=lambda r: (r["arrival"], r["event_us"], str(r)))
        known = self.last.get()
        if known is not None and row["arrival"] <= known[0]:
            return
        until = row["event_us"] // 1000 + self.keep_ms
        if known is not None:
            until = max(until, known[2])
        if known is None or until != known[2]:
            if known is not None:
                self.handle.deleteTimer(known[2])
            self.handle.registerTimer(until)
        self.last.update((row["arrival"], row["event_date"], until))
        yield Row(event_id=key[0], customer_id=row["customer_id"], event_us=row["event_us"],
                  event_date=row["event_date"], event_type=row["event_type"],
                  campaign_id=row["campaign_id"], source=row["source"], inserted_us=row["inserted_us"],
                  replaces=None if known is None else known[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def _text(value) -> str | None:
    return value if isinstance(value, str) else None        # pandas: a missing string may be NaN


def _last_of_group(keep_ms: int):
    """:class:`LastArrival` for a group of ids: lists of ids, arrivals, days and times to forget them."""

    def fn(key, pdfs, state):
        known = {}
        if state.exists:
            ids, *held = state.get
            known = dict(zip(ids, zip(*held)))
        newest: dict = {}
        for pdf in () if state.hasTimedOut else pdfs:
            for event, *row in zip(*(pdf[c].tolist() for c in _GROUP_ROW)):
                old = known.get(event)
                if old is not None and row[0] <= old[0]:
                    continue
                best = newest.get(event)
                if best is None or row[:2] > best[:2] \
                        or row[:2] == best[:2] and _as_told(row) > _as_told(best):
                    newest[event] = row
        answers = []
        for event, row in newest.items():
            arrival, event_us, customer, day, kind, campaign, source, inserted_us = row
            old, until = known.get(event), event_us // 1000 + keep_ms
            known[event] = arrival, day, until if old is None else max(until, old[2])
            answers.append((event, _text(customer), event_us, day, _text(kind), _text(campaign), _text(source),
                            None if pd.isna(inserted_us) else int(inserted_us), None if old is None else old[1]))
        # as with timers: a batch's rows still meet what its watermark ends
        wm = state.getCurrentWatermarkMs()
        live = [(event, *had) for event, had in known.items() if had[2] >= wm]
        if live:
            state.update(tuple(map(list, zip(*live))))
            state.setTimeoutTimestamp(max(min(had[3] for had in live), wm + 1))
        elif state.exists:
            state.remove()
        if answers:
            names = [f.split()[0] for f in _GROUP_OUT.split(", ")]
            yield pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(names, zip(*answers))})

    return fn


def _as_told(row: list) -> list[str]:
    """The order of rows with equal arrival numbers and instants, as in :class:`LastArrival`."""
    return [repr(_text(value)) for value in (row[2], *row[4:7])] + [repr(row[7])]


def last_arrival_changes(events: DataFrame, arrival: str = "ingest_seq", delay: str = "1 hour",
                         keep_days: int = 30, groups: int | None = None) -> DataFrame:
    """Fact rows of a stream of normalised events whenever an id's newest arrival changes.

    ``replaces`` is the date that the id's row had before, NULL for a new id. Rows without an arrival number
    come before all others. Corrections are recognised for ``keep_days`` after the event's time (watermark time);
    rows older than the watermark are dropped by Spark (``dropped_by_watermark``).

    ``groups``: ids share calls and state rows in so many hash groups; a task holds the state of one group and the
    newest row of each of its ids in the micro-batch, so the number should grow with the ids (the checkpoint fixes it).
    """
    if keep_days < 0:
        raise ValueError("keep_days must not be negative")
    if groups is not None and groups < 1:
        raise ValueError("groups must be positive")
    # ship the state class by value: executors need not install this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = events.withWatermark("event_ts", delay).select(
        "event_ts", "event_id", "customer_id", F.unix_micros("event_ts").alias("event_us"), "event_date",
        "event_type", "campaign_id", "source", F.unix_micros("inserted_at").alias("inserted_us"),
        F.coalesce(F.col(arrival).cast("long"), F.lit(-2 ** 63)).alias("arrival"))
    if groups is None:
        out = rows.groupBy("event_id").transformWithState(
            LastArrival(keep_days * 86_400_000), _OUT, "update", "EventTime")
    else:
        out = rows.withColumn("event_day", F.unix_date("event_date")).drop("event_date") \
            .withColumn("group", F.pmod(F.xxhash64("event_id"), F.lit(groups))) \
            .groupBy("group").applyInPandasWithState(
                _last_of_group(keep_days * 86_400_000), _GROUP_OUT, _GROUP_STATE, "update",
                GroupStateTimeout.EventTimeTimeout) \
            .withColumn("event_date", F.date_from_unix_date("event_day")) \
            .withColumn("replaces", F.date_from_unix_date("replaces_day"))
    return out.withColumn("event_ts", F.timestamp_micros("event_us")) \
        .withColumn("inserted_at", F.timestamp_micros("inserted_us")) \
        .select(*FACT_EVENTS.columns, "replaces")


def upsert_sink(path: str, name: str):
    """``foreachBatch`` function that commits each batch of changes to the event table, exactly once.

    ``name`` stands for the stream's checkpoint in the table's log; another checkpoint needs another name.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = shared_dir(spark, "changes")       # the state runs once, its output is read several times
        batch.write.parquet(staged)
        changes = spark.read.schema(batch.schema).parquet(staged)
        if not changes.isEmpty():
            upsert_batch(changes, "fact_events", path, "replaces", (name, batch_id))
        files.delete(spark, staged)
    return run


@contextmanager
def _rocksdb(spark: SparkSession):
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def start_last_arrivals(raw_stream: DataFrame, path: str, checkpoint: str, quarantine_path: str, name: str,
                        arrival: str = "ingest_seq", mode: str = "tolerant", as_of=None,
                        delay: str = "1 hour", keep_days: int = 30, groups: int | None = None) -> list:
    """P6 as a stream: raw events to the event table, the last arrival of each id, rejected ones to quarantine.

    The table's result equals the batch ``dedup_events`` over all accepted input that is neither older than the
    watermark nor later than ``keep_days``. ``groups`` as in :func:`last_arrival_changes`. Returns the started queries; both are exactly-once over a restart.
    """
    good, bad = accept(raw_stream, "events", mode, as_of, keep=(arrival,))
    changes = last_arrival_changes(good, arrival, delay, keep_days, groups)
    spark = raw_stream.sparkSession
    with _rocksdb(spark), state_partitions(spark):
        kept = changes.writeStream.outputMode("update").foreachBatch(upsert_sink(path, name)) \
            .option("checkpointLocation", f"{checkpoint}/changes").trigger(availableNow=True).start()
    rejected = conform(bad, FACTS["quarantine"]).writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", f"{checkpoint}/rejected").option("path", stream_folder(quarantine_path)) \
        .trigger(availableNow=True).start()
    return [kept, rejected]
