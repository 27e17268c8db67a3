"""Commit log: atomic replacement of several dates, readers and writers at once, killed writers, compaction."""

import datetime as dt
import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from adcredit.plans import jobs
from adcredit.session import shared_dir
from adcredit.sources import files, manifest, sinks
from adcredit.sources.driver import Warehouse
from adcredit.sources.sinks import compact, read_fact, replace_partitions, write_fact
from conftest import SF_SMALL

T = "fact_ad_spend"
DAYS = [dt.date(2026, 8, d) for d in range(1, 11)]


def spend(spark, value, days=DAYS, campaigns=("A", "B")):
    return spark.createDataFrame([(c, d, float(value)) for c in campaigns for d in days],
                                 "campaign_id string, date date, spend double")


def values(spark, path, snapshot=None):
    return sorted((r.date, r.campaign_id, r.spend) for r in read_fact(spark, T, path, snapshot=snapshot).collect())


def expected(value, days=DAYS, campaigns=("A", "B")):
    return sorted((d, c, float(value)) for c in campaigns for d in days)


def test_any_number_of_dates_is_one_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    write_fact(spend(spark, 1), T, path)
    before = manifest.latest(spark, path)
    # one new date, seven replaced, one emptied, the last left alone
    new = [*DAYS[:7], dt.date(2026, 9, 1)]
    replace_partitions(spend(spark, 2, new), T, path, [*new, DAYS[7]])
    after = manifest.latest(spark, path)
    assert after.version == before.version + 1
    assert values(spark, path) == sorted(expected(2, new) + expected(1, DAYS[8:]))
    assert values(spark, path, before) == expected(1)              # a reader at work keeps its version
    kept = {p.path for p in before.of(f"date={d}" for d in DAYS[8:])}
    assert kept and kept <= {p.path for p in after.parts}           # other dates keep their files
    with pytest.raises(ValueError, match="not replaced"):
        replace_partitions(spend(spark, 3), T, path, DAYS[:2])
    assert manifest.latest(spark, path) == after


def test_null_and_reappearing_partitions(spark, tmp_path):
    path, t = str(tmp_path / "t"), "fact_attribution"

    def rows(revenue, *touched):
        return spark.createDataFrame(
            [(f"o{i}", "c", "k" if d else None, dt.datetime(d.year, d.month, d.day) if d else None, revenue, d)
             for i, d in enumerate(touched)],
            "order_id string, customer_id string, campaign_id string, touch_ts timestamp, "
            "revenue double, touch_date date")
    write_fact(rows(1.0, None, DAYS[0], DAYS[1]), t, path)
    replace_partitions(rows(2.0, None), t, path, [None, DAYS[0]])

    def now():
        return sorted(((r.touch_date, r.revenue) for r in read_fact(spark, t, path).collect()), key=str)
    assert now() == [(None, 2.0), (DAYS[1], 1.0)]
    replace_partitions(rows(3.0, DAYS[0]), t, path, [DAYS[0]])
    assert now() == [(None, 2.0), (DAYS[0], 3.0), (DAYS[1], 1.0)]


def test_readers_during_replacements_see_one_version(spark, tmp_path):
    path, stop, seen, odd = str(tmp_path / "t"), threading.Event(), set(), []
    write_fact(spend(spark, 0), T, path)

    def reader():
        while not stop.is_set():
            got = values(spark, path)
            seen.add(got[0][2])
            if got != expected(got[0][2]):
                odd.append(got)
    threads = [threading.Thread(target=reader) for _ in range(2)]
    for t in threads:
        t.start()
    for n in range(1, 6):
        replace_partitions(spend(spark, n), T, path, DAYS)
    stop.set()
    for t in threads:
        t.join()
    assert not odd and len(seen) > 1 and values(spark, path) == expected(5)


@pytest.mark.parametrize("dies_in", ["place", "claim"])
def test_a_writer_killed_in_the_middle_changes_nothing(spark, tmp_path, monkeypatch, dies_in):
    path = str(tmp_path / "t")
    write_fact(spend(spark, 1), T, path)
    before, calls = manifest.latest(spark, path), []

    class Killed(BaseException):
        pass

    def die(*args):
        if dies_in == "place" and len(calls) < 3:           # some folders are in place already
            calls.append(args)
            return move(*args)
        raise Killed
    move = files.move
    with monkeypatch.context() as m:
        m.setattr(files, "move" if dies_in == "place" else "claim", die)
        with pytest.raises(Killed):
            replace_partitions(spend(spark, 2), T, path, DAYS)
    assert manifest.latest(spark, path) == before and values(spark, path) == expected(1)
    assert manifest.sweep(spark, path) == []                # a writer may still be at work
    gone = manifest.sweep(spark, path, seconds=0)
    assert gone and values(spark, path) == expected(1)
    assert not {p.path for p in before.parts} & set(gone)
    replace_partitions(spend(spark, 2), T, path, DAYS)
    assert values(spark, path) == expected(2)


def test_two_replacements_of_a_date_cannot_both_win(spark, tmp_path):
    path = str(tmp_path / "t")
    write_fact(spend(spark, 1), T, path)
    base = manifest.latest(spark, path)

    def attempt(job):
        value, days = job
        try:
            replace_partitions(spend(spark, value, days), T, path, days, base)
            return value
        except manifest.Conflict:
            return None
    with ThreadPoolExecutor(4) as pool:                     # all of them read the same version
        won = [v for v in pool.map(attempt, [(n, DAYS[:5]) for n in (2, 3, 4, 5)]) if v]
    assert len(won) == 1
    assert values(spark, path) == sorted(expected(won[0], DAYS[:5]) + expected(1, DAYS[5:]))
    assert attempt((9, DAYS[5:])) == 9                      # other dates do not conflict
    with pytest.raises(manifest.Conflict):
        write_fact(spend(spark, 7), T, path, "overwrite", base=base)


def test_a_version_is_claimed_once(spark, tmp_path):
    target = str(tmp_path / "log" / "1.json")

    def attempt(n):
        source = str(tmp_path / f"try-{n}")
        files.write_text(spark, source, str(n))
        return files.claim(spark, source, target)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(attempt, range(40)))
    assert sum(won) == 1 and files.read_text(spark, target) == str(won.index(True))


def test_concurrent_appends_all_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: write_fact(spend(spark, n, DAYS[:2]), T, path), range(8)))
    assert manifest.latest(spark, path).version == 8
    assert values(spark, path) == sorted(x for n in range(8) for x in expected(n, DAYS[:2]))


def test_concurrent_freshness_of_one_source_merges(spark):
    root, now = shared_dir(spark, "health"), dt.datetime(2026, 8, 10)
    days = [now - dt.timedelta(days=d) for d in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda ts: jobs.update_freshness(spark, root, "ads", ts, now), days))
    assert [r.source for r in jobs.read_health(spark, root).collect()] == ["ads"]


def test_compaction_bounds_files_and_keeps_rows(spark, tmp_path):
    w, path, t = Warehouse(spark, SF_SMALL), str(tmp_path / "e"), "fact_events"
    events = w.fact_events
    for n in range(5):
        write_fact(events.filter(F.pmod(F.xxhash64("event_id"), F.lit(5)) == n), t, path)
    rows = sorted(map(tuple, read_fact(spark, t, path).collect()))
    before = manifest.latest(spark, path)
    dates = {p.partition for p in before.parts}
    saved = compact(spark, t, path)     # five small files a date to one
    after = manifest.latest(spark, path)
    assert sum(p.files for p in after.parts) == len(dates) == sum(p.files for p in before.parts) - saved
    assert sorted(map(tuple, read_fact(spark, t, path).collect())) == rows
    assert sorted(map(tuple, read_fact(spark, t, path, snapshot=before).collect())) == rows
    assert compact(spark, t, path) == 0 and manifest.latest(spark, path) == after      # nothing left to do
    # a date of more than the target size gets several files of about that size
    most = max(p.bytes for p in after.parts)
    write_fact(events.filter("event_date = '2024-01-05'"), t, path)
    assert compact(spark, t, path, target_bytes=2 * most // 3) > -1
    for p in manifest.latest(spark, path).of({"event_date=2024-01-05"}):
        folder = os.path.join(path, p.path)
        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == p.files
    assert read_fact(spark, t, path).count() == len(rows) + events.filter("event_date = '2024-01-05'").count()


def test_compaction_while_appends_go_on(spark, tmp_path, monkeypatch):
    """Rows appended between a compaction's read and its commit stay; a second compaction conflicts."""
    path, place, extra = str(tmp_path / "t"), manifest.place, []
    for n in range(3):
        write_fact(spend(spark, n), T, path)

    def then_append(*args):
        out = place(*args)
        if not extra:
            extra.append(1)
            write_fact(spend(spark, 9), T, path)
        return out
    with monkeypatch.context() as m:
        m.setattr(manifest, "place", then_append)
        assert compact(spark, T, path) == 20                        # ten dates, three files to one
    assert values(spark, path) == sorted(x for n in (0, 1, 2, 9) for x in expected(n))
    assert {len(manifest.latest(spark, path).of({f"date={d}"})) for d in DAYS} == {2}

    extra.clear()

    def then_compact(*args):
        out = place(*args)
        if not extra:
            extra.append(1)
            assert compact(spark, T, path) > 0
        return out
    with monkeypatch.context() as m:
        m.setattr(manifest, "place", then_compact)
        with pytest.raises(manifest.Conflict):
            compact(spark, T, path)
    assert values(spark, path) == sorted(x for n in (0, 1, 2, 9) for x in expected(n))
    assert manifest.sweep(spark, path, seconds=0)


def test_dead_parts_go_with_the_next_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        write_fact(spend(spark, n, DAYS[:1]), T, path, "overwrite")
    folder = os.path.join(path, "data", f"date={DAYS[0]}")
    assert len(os.listdir(folder)) == 2                             # this version's and the one's before
    write_fact(spend(spark, 9, DAYS[:1]), T, path, "append")
    assert len(os.listdir(folder)) == 3


def test_old_versions_leave_the_log(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(manifest, "KEEP_VERSIONS", 2)
    monkeypatch.setattr(manifest, "KEEP_SECONDS", -60)
    for n in range(5):
        write_fact(spend(spark, n, DAYS[:1]), T, path)
    assert len(files.names(spark, f"{path}/_log")) == 2
    assert len(values(spark, path)) == 10


def test_compaction_job_leaves_no_small_files(spark):
    w, root = Warehouse(spark, SF_SMALL), shared_dir(spark, "wh-compact")
    for n in range(3):
        part = w.raw_orders.filter(F.pmod(F.xxhash64("order_id"), F.lit(3)) == n)
        jobs.ingest_orders(spark, part, root, w.as_of)
    before = read_fact(spark, "fact_orders", f"{root}/fact_orders").count()
    saved = jobs.compaction_job(spark, root)
    assert saved["fact_orders"] > 0 and before == w.raw_orders.count()
    assert read_fact(spark, "fact_orders", f"{root}/fact_orders").count() == before
    assert jobs.compaction_job(spark, root) == {}
    assert sinks.current(spark, f"{root}/fact_orders").endswith("/data")
