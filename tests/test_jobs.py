"""Batch jobs B1-B6 on a fresh warehouse folder, raw sources and keyset paging."""

import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from adcredit.functions.scalar import fixed_decimals, money_sum
from adcredit.operators import drilldown
from adcredit.operators.normalize import accept, normalize_orders, quarantine
from adcredit.plans import jobs
from adcredit.schemas import FACTS, RAW_ORDERS
from adcredit.session import shared_dir
from adcredit.sources import files
from adcredit.sources.driver import Warehouse
from adcredit.sources.raw import read_raw, stream_raw
from adcredit.sources.sinks import current, read_fact, write_fact
from adcredit.streaming import jobs as sj
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def warehouse(spark):
    w = Warehouse(spark, SF_SMALL)
    root = shared_dir(spark, "wh-test")
    jobs.ingest_ads(spark, w.raw_ads, root, w.as_of)
    jobs.ingest_orders(spark, w.raw_orders, root, w.as_of)
    jobs.compact_events(spark, w.raw_events, root, w.as_of)
    jobs.attribution_job(spark, root, w.as_of)
    jobs.features_job(spark, root)
    return w, root


def test_ingest_and_attribution_tables(spark, warehouse):
    w, root = warehouse
    counts = {r.table: r.rows for r in jobs.warehouse_counts(spark, root).collect()}
    assert counts["fact_orders"] == w.fact_orders.count()
    # every raw ad is accepted or quarantined with its text
    assert counts["quarantine"] == w.raw_ads.filter("spend = 'n/a'").count() > 0
    assert counts["fact_ad_spend"] + counts["quarantine"] == w.raw_ads.count()
    rejected = read_fact(spark, "quarantine", f"{root}/quarantine").collect()
    assert {json.loads(r.raw)["spend"] for r in rejected} == {"n/a"}
    assert {tuple(r.violations) for r in rejected} == {("spend is null",)}
    # twice-delivered events compact to one row each, the later delivery
    assert counts["fact_events"] == w.fact_events.count()
    ev = read_fact(spark, "fact_events", f"{root}/fact_events")
    assert {r.source for r in ev.select("source").distinct().collect()} == {"replay"}
    assert counts["fact_attribution"] == counts["fact_orders"]
    health = {r.source: r.status for r in jobs.read_health(spark, root).collect()}
    assert health == {"ads": "healthy", "orders": "healthy", "events": "healthy",
                      "attribution": "healthy"}
    with pytest.raises(Exception, match="spend"):
        jobs.ingest_ads(spark, w.raw_ads, shared_dir(spark, "wh-strict"), w.as_of, mode="strict")


def test_features_and_training_job(spark, warehouse, tmp_path):
    _, root = warehouse
    for name in ("fact_campaign_metrics_features", "daily_features"):
        table = read_fact(spark, name, f"{root}/{name}")
        assert table.columns == list(FACTS[name].columns) and table.count() > 0
    model, ev = jobs.training_job(spark, root, shared_dir(spark, "model"), num_trees=5,
                                  max_depth=4)
    r = ev.collect()[0]
    assert r.rows > 0 and r.mse >= 0
    from adcredit.operators import forecast
    imp = forecast.feature_importance(spark, model).collect()
    assert len(imp) == 9 and abs(sum(x.importance for x in imp) - 1.0) < 1e-6


def test_raw_sources(spark, tmp_path):
    p = tmp_path / "ads.json"
    p.write_text("\n".join(json.dumps(r) for r in [
        {"campaign_id": "A", "date": "2026-08-01", "spend": "12.5", "impressions": "10",
         "clicks": "2", "source": "api"},
        {"campaign_id": 7, "date": "2026-08-02", "spend": 3, "clicks": "x"}]))
    df = read_raw(spark, "ads", str(p))
    assert df.schema.simpleString().count("string") == 7      # and the text of broken lines
    rows = {r.campaign_id: r for r in df.collect()}
    assert rows["7"].spend == "3" and rows["A"].source == "api"


def test_keyset_page_walks_all_rows(spark):
    w = Warehouse(spark, SF_SMALL)
    df = w.fact_orders
    seen, after = [], None
    while True:
        page = drilldown.keyset_page(df, "fact_orders", after, order_by="revenue", limit=50) \
            .collect()
        if not page:
            break
        seen += [r.order_id for r in page]
        last = page[-1]
        after = (last.revenue, last.order_id)
    assert len(seen) == len(set(seen)) == df.count()


def test_corrupt_lines_keep_their_text(spark, tmp_path):
    p = tmp_path / "orders.json"
    p.write_text('{"order_id": "o1", "customer_id": "c", "order_ts": "2026-08-01 10:00:00", '
                 '"revenue": "5"}\n{"order_id": "o2", "cust\n')
    good, bad = accept(read_raw(spark, "orders", str(p)), "orders")
    assert [r.order_id for r in good.collect()] == ["o1"]
    row = bad.collect()[0]
    assert "row is unreadable" in row.violations and '"o2' in json.loads(row.raw)["_corrupt_record"]


BAD = ["12.5d", "1f", "7d", "Infinity", "-Infinity", "NaN", "1e400", "1,5", "", "0x1F"]


@pytest.mark.parametrize("value", BAD)
def test_bad_amounts_are_rejected(spark, value):
    raw = spark.createDataFrame([("o", "c", "2026-08-01 10:00:00", value, None)], RAW_ORDERS)
    good, bad = accept(raw, "orders")
    assert good.count() == 0 and bad.count() == 1
    if value != "1e400":
        with pytest.raises(Exception, match="revenue"):
            normalize_orders(raw, "strict").collect()


@pytest.mark.parametrize("value", ["12:30", "2024", "2024-01", "T10:00", "now", "2024-02-30"])
def test_bad_instants_are_rejected(spark, value):
    raw = spark.createDataFrame([("o", "c", value, "5", None)], RAW_ORDERS)
    good, bad = accept(raw, "orders")
    assert good.count() == 0 and bad.collect()[0].violations[0] == "order_ts is null"
    with pytest.raises(Exception):
        normalize_orders(raw, "strict").collect()


def test_not_finite_or_too_fine_amounts(spark):
    rows = [("A", dt.date(2026, 8, 1), v) for v in (float("nan"), float("inf"), 1e-7, 0.1 + 0.2, 2.5)]
    df = spark.createDataFrame(rows, "campaign_id string, date date, spend double")
    good, bad = quarantine(df, FACTS["fact_ad_spend"])
    assert [r.spend for r in good.collect()] == [2.5]
    assert sorted(r.violations[0] for r in bad.collect()) == [
        "spend is finer than 6 decimals"] * 2 + ["spend is not finite"] * 2
    total = df.agg(money_sum("spend")).first()[0]
    assert total != total                                  # NaN shows in a sum


def test_required_columns_are_enforced(spark, tmp_path):
    df = spark.createDataFrame([("o", None, dt.datetime(2026, 8, 1), dt.date(2026, 8, 1), 1.0)],
                               "order_id string, customer_id string, order_ts timestamp, "
                               "order_date date, revenue double")
    with pytest.raises(Exception, match="fact_orders.customer_id is NULL"):
        write_fact(df, "fact_orders", str(tmp_path / "t"), "append")


def test_absent_tables_raise_unless_allowed(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_fact(spark, "fact_orders", str(tmp_path / "nowhere"))
    assert read_fact(spark, "fact_orders", str(tmp_path / "nowhere"), missing="empty").count() == 0


def test_concurrent_upserts_of_different_sources_lose_nothing(spark):
    from concurrent.futures import ThreadPoolExecutor
    root, now = shared_dir(spark, "health"), dt.datetime(2026, 8, 1)
    names = ["ads", "orders", "events", "attribution", "a/b c"]
    for day in range(2):
        with ThreadPoolExecutor(5) as pool:
            list(pool.map(lambda n: jobs.update_freshness(
                spark, root, n, now + dt.timedelta(days=day), now), names))
    got = {r.source: r.latest_timestamp for r in jobs.read_health(spark, root).collect()}
    assert got == dict.fromkeys(names, now + dt.timedelta(days=1))


def test_a_replacement_that_dies_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "ads")
    good = spark.createDataFrame([("A", dt.date(2026, 8, 1), 1.0), ("B", dt.date(2026, 8, 2), 2.0)],
                                 "campaign_id string, date date, spend double")
    write_fact(good, "fact_ad_spend", path, "overwrite")
    with pytest.raises(Exception):
        write_fact(good.withColumn("spend", F.when(F.col("campaign_id") == "A", 9.0)),
                   "fact_ad_spend", path, "overwrite")           # NULL spend: fails while writing
    assert sorted(r.spend for r in read_fact(spark, "fact_ad_spend", path).collect()) == [1.0, 2.0]
    write_fact(good.limit(1), "fact_ad_spend", path, "append")
    assert read_fact(spark, "fact_ad_spend", path).count() == 3


def test_stream_and_batch_rows_of_one_table_are_both_read(spark, tmp_path):
    w = Warehouse(spark, SF_SMALL)
    src, root = str(tmp_path / "src"), str(tmp_path / "wh")
    raw = w.raw_orders
    first = raw.filter("order_id < 'ord_5'")
    first.write.parquet(src)
    for q in sj.stream_ingest(stream_raw(spark, "orders", src, "parquet"), "orders",
                              f"{root}/fact_orders", str(tmp_path / "ck"), f"{root}/quarantine",
                              as_of=w.as_of):
        q.awaitTermination()
    jobs.ingest_orders(spark, raw.filter("order_id >= 'ord_5'"), root, w.as_of)
    assert 0 < first.count() < raw.count()
    assert read_fact(spark, "fact_orders", f"{root}/fact_orders").count() == raw.count()
    with pytest.raises(ValueError):
        write_fact(w.fact_orders, "fact_orders", f"{root}/fact_orders", "overwrite")


def test_retention_drops_old_folders_only(spark):
    w, root = Warehouse(spark, SF_SMALL), shared_dir(spark, "wh-retention")
    write_fact(w.fact_events, "fact_events", f"{root}/fact_events", "append")
    jobs.update_freshness(spark, root, "events", dt.datetime(2020, 1, 1), w.as_of)
    gone = jobs.retention_job(spark, root, dt.date(2024, 7, 10))      # cutoff 2024-01-12
    assert gone == {"fact_events": [f"event_date=2024-01-{d:02d}" for d in range(1, 12)]}
    left = [n for n in files.folders(spark, current(spark, f"{root}/fact_events")) if "=" in n]
    assert min(left) == "event_date=2024-01-12"
    assert jobs.read_health(spark, root).count() == 1


def test_no_shared_folder_raises_off_local_mode(monkeypatch):
    from adcredit import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def _frames(spark):
    """Orders and events in two deliveries; the second has late events and ids on both sides."""
    t0 = dt.datetime(2026, 3, 1)
    one, two = dt.datetime(2026, 4, 1), dt.datetime(2026, 4, 2)

    def order(i, c, day, at):
        ts = t0 + dt.timedelta(days=day)
        return (f"o{i}", c, ts, ts.date(), float(i + 1), "USD", at)

    def event(i, c, day, camp, at):
        ts = t0 + dt.timedelta(days=day)
        return (f"e{i}", c, ts, ts.date(), "click", camp, "x", at)
    orders = [order(i, f"c{i % 4}", i % 20, one) for i in range(40)] \
        + [order(3, "c3", 15, two), order(50, "c1", 21, two), order(51, "new", 3, two)]
    events = [event(i, f"c{i % 4}", (i * 7) % 20, f"k{i % 3}", one) for i in range(30)] \
        + [event(90, "c2", 2.5, "late", two), event(91, "c0", 5, None, two)]
    spend = [(f"k{k}", (t0 + dt.timedelta(days=d)).date(), 10.0 + d, 1, 1, "ads", one)
             for k in range(3) for d in range(22)] + [("late", dt.date(2026, 3, 3), 5.0, 1, 1, "ads", two)]
    return (spark.createDataFrame(orders, FACTS["fact_orders"].schema),
            spark.createDataFrame(events, FACTS["fact_events"].schema),
            spark.createDataFrame(spend, FACTS["fact_ad_spend"].schema), one, two)


def _tables(spark, root):
    return {t: sorted((tuple(r) for r in read_fact(spark, t, f"{root}/{t}").drop("inserted_at")
                       .collect()), key=str) for t in ("fact_attribution", "fact_campaign_metrics")}


def test_incremental_attribution_equals_full(spark):
    orders, events, spend, one, two = _frames(spark)
    roots = [shared_dir(spark, "wh-inc"), shared_dir(spark, "wh-full")]
    for root, cut in zip(roots, (one, two)):
        for df, t in ((orders, "fact_orders"), (events, "fact_events"), (spend, "fact_ad_spend")):
            write_fact(df.filter(F.col("inserted_at") <= F.lit(cut)), t, f"{root}/{t}", "append")
        jobs.attribution_job(spark, root, cut)
    inc, full = roots
    before = _tables(spark, inc)
    assert before != _tables(spark, full)
    for df, t in ((orders, "fact_orders"), (events, "fact_events"), (spend, "fact_ad_spend")):
        write_fact(df.filter(F.col("inserted_at") == F.lit(two)), t, f"{inc}/{t}", "append")
    base = current(spark, f"{inc}/fact_attribution")

    def parts():
        return {n: tuple(sorted(p.name for p in pathlib.Path(base.removeprefix("file:"), n).iterdir()))
                for n in files.folders(spark, base) if "=" in n}
    old = parts()
    jobs.attribution_job(spark, inc, two, since=two)
    assert _tables(spark, inc) == _tables(spark, full)
    assert current(spark, f"{inc}/fact_attribution") == base
    same = [n for n, names in parts().items() if old.get(n) == names]
    assert len(same) >= 5                                  # untouched days keep their files
    jobs.attribution_job(spark, inc, two, since=two + dt.timedelta(days=1))     # nothing new
    assert _tables(spark, inc) == _tables(spark, full)


def test_fixed_decimals(spark):
    df = spark.createDataFrame([(1234.5,), (0.125,), (-2.0,), (None,)], "v double")
    assert [r[0] for r in df.select(fixed_decimals("v")).collect()] == ["1234.50", "0.13", "-2.00", None]
