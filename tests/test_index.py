"""Key index and row counts: look-ups open only files that hold the value, deep pages only their dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adcredit.operators import drilldown
from adcredit.plans import jobs
from adcredit.sources import files, index, manifest
from adcredit.sources.sinks import compact, read_fact, replace_partitions, write_fact

T = "fact_events"
DAYS = [dt.date(2026, 8, d) for d in range(1, 11)]
SCHEMA = "event_id string, customer_id string, event_ts timestamp, event_date date, campaign_id string"


def events(spark, first, last, days=DAYS):
    """A hot customer has a third of the rows, ``rare`` two rows on two dates."""
    rows = []
    for i in range(first, last):
        day = days[i % len(days)]
        who = "hot" if i % 3 == 0 else f"c{i % 50}"
        rows.append((f"e{i:05d}", who, dt.datetime(day.year, day.month, day.day, i % 24), day, f"k{i % 4}"))
    return spark.createDataFrame(rows, SCHEMA)


def rare(spark, *days):
    return spark.createDataFrame([(f"r{d}", "rare", dt.datetime(d.year, d.month, d.day), d, None) for d in days],
                                 SCHEMA)


@pytest.fixture()
def path(spark, tmp_path):
    path = str(tmp_path / "t")
    write_fact(events(spark, 0, 600).unionByName(rare(spark, DAYS[2], DAYS[7])), T, path)
    assert index.build(spark, T, path) == len(DAYS)
    return path


def got(df):
    return sorted(r["event_id"] for r in df.collect())


def test_lookup_opens_only_files_that_hold_the_key(spark, path):
    df = index.lookup(spark, T, path, "customer_id", ["rare"])
    opened = [f for f in df.inputFiles()]
    assert len(opened) == 2 and {f.split("event_date=")[1][:10] for f in opened} == {"2026-08-03", "2026-08-08"}
    assert got(df) == ["r2026-08-03", "r2026-08-08"]
    all_rows = read_fact(spark, T, path)
    for who in ("hot", "c7", "nobody"):
        want = got(all_rows.filter(F.col("customer_id") == who))
        assert got(index.lookup(spark, T, path, "customer_id", [who])) == want
        assert (who == "nobody") == (want == [])
    assert got(index.lookup(spark, T, path, "customer_id", ["rare", "c7", None])) == got(
        all_rows.filter(F.col("customer_id").isin("rare", "c7")))
    assert index.lookup(spark, T, path, "customer_id", ["nobody"]).inputFiles() == []
    assert index.lookup(spark, T, path, "customer_id", [None]).count() == 0
    near = index.lookup(spark, T, path, "customer_id", ["rare"], DAYS[5], "2026-08-09")
    assert got(near) == ["r2026-08-08"] and len(near.inputFiles()) == 1
    with pytest.raises(ValueError, match="no look-up"):
        index.lookup(spark, T, path, "campaign_id", ["k1"])
    with pytest.raises(FileNotFoundError):
        index.lookup(spark, T, path + "-none", "customer_id", ["x"])


def test_index_follows_appends_replacements_and_compaction(spark, path):
    write_fact(rare(spark, DAYS[4]).unionByName(events(spark, 600, 640)), T, path)     # not indexed yet

    def check(rows):
        assert got(index.lookup(spark, T, path, "customer_id", ["rare"])) == rows
        counts = index.row_counts(spark, T, path)
        want = {f"event_date={r[0]}": r[1] for r in read_fact(spark, T, path).groupBy("event_date").count().collect()}
        assert {k: n for k, n in counts.items() if n} == want
    three = ["r2026-08-03", "r2026-08-05", "r2026-08-08"]
    check(three)
    new = len([p for p in manifest.latest(spark, path).parts if p.path not in manifest.latest(spark, path).facts])
    assert index.build(spark, T, path) == new > 0 and index.build(spark, T, path) == 0
    check(three)
    old = {f.keys for f in manifest.latest(spark, path).facts.values()}
    assert compact(spark, T, path) > 0
    check(three)
    index.build(spark, T, path)
    check(three)
    replace_partitions(rare(spark, DAYS[2]).withColumn("event_id", F.lit("new")), T, path, DAYS[2:8])
    check(["new"])
    replace_partitions(events(spark, 0, 9, DAYS[:1]), T, path, DAYS[:1])
    live = {f.keys for f in manifest.latest(spark, path).facts.values()}
    assert not live & old
    assert not any(files.exists(spark, f"{path}/{k}") for k in old)         # dead indexes are deleted
    assert all(files.exists(spark, f"{path}/{k}") for k in live)
    manifest.sweep(spark, path, 0)
    assert all(files.exists(spark, f"{path}/{k}") for k in live)
    check(["new"])


def test_a_lost_build_leaves_a_readable_table(spark, path, monkeypatch):
    write_fact(rare(spark, DAYS[4]), T, path)
    real = manifest.commit
    monkeypatch.setattr(manifest, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        index.build(spark, T, path)
    monkeypatch.setattr(manifest, "commit", real)
    assert got(index.lookup(spark, T, path, "customer_id", ["rare"])) == ["r2026-08-03", "r2026-08-05", "r2026-08-08"]
    assert any("_index/" in p for p in manifest.sweep(spark, path, 0))
    assert index.build(spark, T, path) == 1


@pytest.mark.parametrize("offset", [0, 1, 59, 60, 137, 400, 590, 602, 5000])
def test_deep_pages_equal_plain_pages(spark, path, offset):
    plain = read_fact(spark, T, path)
    for order in ("event_ts", "event_date"):
        rows, count = drilldown.stored_page(spark, T, path, order_by=order, limit=25, offset=offset)
        want, total = drilldown.page(plain, T, order_by=order, limit=25, offset=offset)
        assert rows.collect() == want.collect() and count.collect() == total.collect()
        assert len({f.split("event_date=")[1][:10] for f in rows.inputFiles()}) <= 2
    rows, count = drilldown.stored_page(spark, T, path, None, DAYS[2], DAYS[6], limit=7, offset=offset)
    want, total = drilldown.page(plain, T, None, DAYS[2], DAYS[6], limit=7, offset=offset)
    assert rows.collect() == want.collect() and count.collect() == total.collect()


def test_filtered_pages_and_pages_by_value(spark, path, tmp_path):
    plain = read_fact(spark, T, path)
    for filters in ({"customer_id": "rare"}, {"campaign_id": "k1"}, {"customer_id": "hot", "campaign_id": "k1"}):
        rows, count = drilldown.stored_page(spark, T, path, filters, offset=1)
        want, total = drilldown.page(plain, T, filters, offset=1)
        assert rows.collect() == want.collect() and count.collect() == total.collect()
    # NULL dates come last; a value's order is not the dates' order
    t, root = "fact_attribution", str(tmp_path / "w")
    day = [dt.date(2026, 8, 1 + i % 3) if i % 4 else None for i in range(40)]
    write_fact(spark.createDataFrame(
        [(f"o{i:02d}", "c", "k", dt.datetime(d.year, d.month, d.day, i % 20) if d else None, float(i % 7), d)
         for i, d in enumerate(day)], "order_id string, customer_id string, campaign_id string, touch_ts timestamp, "
                                      "revenue double, touch_date date"), t, f"{root}/{t}")
    assert jobs.index_job(spark, root) == {t: 4}
    plain = read_fact(spark, t, f"{root}/{t}")
    for order in ("touch_ts", "revenue"):
        for offset in (0, 12, 28, 33):
            rows, _ = drilldown.stored_page(spark, t, f"{root}/{t}", order_by=order, limit=9, offset=offset)
            want, _ = drilldown.page(plain, t, order_by=order, limit=9, offset=offset)
            assert rows.collect() == want.collect()
    assert got_orders(index.lookup(spark, t, f"{root}/{t}", "order_id", ["o00", "o01"])) == ["o00", "o01"]


def got_orders(df):
    return sorted(r["order_id"] for r in df.collect())
