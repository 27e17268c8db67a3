"""Stateful streaming last touch: out-of-order arrival within the delay gives the batch answer,
values pass unchanged, state expires, and what comes too late is found for repair."""

import datetime as dt

from pyspark.sql import functions as F

from adcredit.operators.attribution import last_touch
from adcredit.session import state_partitions
from adcredit.streaming import jobs as sj

T0 = dt.datetime(2026, 3, 1)


def h(x):
    return T0 + dt.timedelta(hours=x)


EV = "kind int, customer_id string, ts timestamp, event_id string, campaign_id string, " \
     "order_id string, revenue double"
END = (2, "~end", h(400), None, None, None, None)


def ev(cust, hour, tie, camp):
    return (0, cust, h(hour), f"e{tie}", camp, None, None)


def od(cust, hour, oid, rev=1.0):
    return (1, cust, h(hour), None, None, oid, rev)


def _run(spark, tmp_path, files, delay="2 hours", restart=False):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))

    def go():
        stream = spark.readStream.schema(sj.TOUCH_INPUT).option("maxFilesPerTrigger", 1) \
            .parquet(src)
        q = (sj.stream_last_touch(stream, delay).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ck).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        return q

    for rows in files:
        spark.createDataFrame(rows, EV).coalesce(1).write.mode("append").parquet(src)
        if restart:
            q = go()
    q = q if restart else go()
    return spark.read.schema(sj.TOUCH_OUTPUT).parquet(out), q


def _split(spark, files):
    df = spark.createDataFrame([r for f in files for r in f if r[0] in (0, 1)], EV)
    orders = df.filter("kind = 1").select("order_id", "customer_id", F.col("ts").alias("order_ts"),
                                          "revenue")
    events = df.filter("kind = 0").select("event_id", "customer_id", F.col("ts").alias("event_ts"),
                                          "campaign_id")
    return orders, events


def _rows(df):
    return sorted((r.order_id, r.customer_id, r.campaign_id, r.touch_ts, r.revenue)
                  for r in df.collect())


FILES = [
    [ev("a", 0, 1, "A0"), ev("a", 5, 2, "A5"), od("a", 3, "o1"), ev("b", 1, 3, "B1"),
     od(None, 2, "n1", 1 / 3), od("a", 3, "o1")],
    # the event at 4h and the order at 4h30 arrive after data up to 5h; o1 comes again
    [ev("a", 4, 4, "A4"), od("a", 4.5, "o2", 1e-12), od("b", 4, "o3", 2 / 3), od("a", 6, "o4"),
     od("a", 3, "o1"), od(None, 5, "n2"), od(None, 5, "n2")],
    [ev("a", 8, 5, None), od("a", 9, "o5", 0.1 + 0.2), od("c", 9, "o6"),
     od("b", 1 + 24 * 7 + 1, "o7"), ev("c", 9, 9, "C9"), ev("c", 9, 10, "C10")],
    [END],
]


def test_stream_equals_batch_whether_restarted_or_not(spark, tmp_path):
    orders, events = _split(spark, FILES)
    want = _rows(last_touch(orders, events))
    for restart in (False, True):
        got, _ = _run(spark, tmp_path / str(restart), FILES, restart=restart)
        assert _rows(got) == want
    by_id = {r[0]: r for r in want}
    assert by_id["o2"][2] == "A4" and by_id["o5"][2:4] == (None, h(8))
    assert by_id["o6"][2] == "C10"                        # e10 beats e9
    assert by_id["o7"][2:4] == (None, None)               # last touch older than 7 days
    assert by_id["n1"][1:4] == (None, None, None) and by_id["n1"][4] == 1 / 3
    assert by_id["o2"][4] == 1e-12 and by_id["o5"][4] == 0.1 + 0.2


def test_state_is_removed_after_the_look_back(spark, tmp_path):
    _, q = _run(spark, tmp_path, [*FILES, [(2, "~end", h(1200), None, None, None, None)],
                                  [(2, "~end", h(1201), None, None, None, None)]])
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 0


def test_late_orders_are_counted_and_repaired(spark, tmp_path):
    files = [
        [ev("a", 1, 1, "A1"), ev("a", 10, 2, "A10"), od("a", 11, "o1")],
        [ev("z", 20, 3, "Z")],                    # moves the watermark to 18h
        [od("a", 2, "late")],                     # arrives long after its time
        [END],
    ]
    got, q = _run(spark, tmp_path, files)
    assert {r.order_id for r in got.collect()} == {"o1"}
    assert sj.dropped_by_watermark(q) == 1
    orders, events = _split(spark, files)
    assert [r.order_id for r in sj.unanswered_orders(orders, got).collect()] == ["late"]
    assert _rows(got.unionByName(sj.repair(orders, events, got))) == _rows(
        last_touch(orders, events))


def test_customers_share_calls_and_state_rows(spark, tmp_path):
    """A call of the Python worker is paid for a group of customers, not for each one."""
    files = [[row for c in range(40) for row in (ev(f"c{c}", c / 40, 2 * c, f"A{c}"), od(f"c{c}", 1 + c / 40, f"o{c}"),
                                                 od(f"c{c}", 30 + c / 40, f"p{c}"), od(None, 3, f"n{c}"))]
             + [od(None, 3, f"m{n}") for n in range(300)],
             [ev(f"c{c}", 29, 2 * c + 1, f"B{c}") for c in range(0, 40, 3)], [END]]
    orders, events = _split(spark, files)
    want, src = _rows(last_touch(orders, events)), str(tmp_path / "src")
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, EV).coalesce(1).write.mode("append").parquet(src)
    for groups in (1, 3):
        out, ck = (str(tmp_path / f"{n}{groups}") for n in ("out", "ck"))
        stream = spark.readStream.schema(sj.TOUCH_INPUT).option("maxFilesPerTrigger", 1).parquet(src)
        q = sj.stream_last_touch(stream, "2 hours", groups=groups).writeStream.format("parquet") \
            .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
        assert _rows(spark.read.schema(sj.TOUCH_OUTPUT).parquet(out)) == want
        assert 0 < max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]) <= groups


# -- T3 as an interval join --------------------------------------------------

def _run_join(spark, tmp_path, files, delay="2 hours"):
    """The files of :func:`_run`, one micro-batch each; END rows close both sides."""
    out, ck = (str(tmp_path / n) for n in ("out", "ck"))
    at = {k: str(tmp_path / k) for k in ("orders", "events")}
    q = None
    for rows in files:
        df = spark.createDataFrame(rows, EV).coalesce(1)
        df.filter("kind <> 0").select(F.coalesce("order_id", F.lit("~end")).alias("order_id"), "customer_id",
                                      F.col("ts").alias("order_ts"), "revenue") \
            .write.mode("append").parquet(at["orders"])
        df.filter("kind <> 1").select("event_id", "customer_id", F.col("ts").alias("event_ts"), "campaign_id") \
            .write.mode("append").parquet(at["events"])
        streams = [spark.readStream.schema(spark.read.parquet(p).schema).parquet(p) for p in at.values()]
        q = sj.stream_interval_last_touch(*streams, delay).writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    return spark.read.schema(sj.TOUCH_OUTPUT).parquet(out).filter("order_id <> '~end'"), q


def test_interval_join_equals_batch_with_jvm_state_only(spark, tmp_path):
    orders, events = _split(spark, FILES)
    closing = [[(2, "~end", h(400 + n), None, None, None, None)] for n in (0, 300, 600)]
    got, q = _run_join(spark, tmp_path, [*FILES[:-1], *closing])
    assert _rows(got) == _rows(last_touch(orders, events))
    plan = q._jsq.explainInternal(False)
    assert "StreamingSymmetricHashJoin" in plan and "Python" not in plan and "InPandas" not in plan
    # events leave with the look-back, orders with the watermark: only closing rows are left
    assert sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]) <= 4


def test_state_partitions_follow_the_cores_not_the_batch_shuffles(spark, tmp_path):
    files = [[od("a", 3, "o1"), ev("a", 1, 1, "A1")]]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        with state_partitions(spark, per_core=1):
            _run_join(spark, tmp_path, files)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = spark.read.format("state-metadata").load(str(tmp_path / "ck"))
    assert {r[0] for r in stores.select("numPartitions").collect()} == {spark.sparkContext.defaultParallelism}
