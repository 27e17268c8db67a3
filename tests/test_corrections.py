"""The last arrival wins in a stream: corrections before and after the first emission, moved dates, expiry,
repeated batches, and compaction meanwhile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adcredit.operators.normalize import accept, last_arrivals
from adcredit.schemas import FACT_EVENTS
from adcredit.sources import manifest, sinks
from adcredit.sources.sinks import read_fact, upsert_batch
from adcredit.streaming import corrections
from adcredit.streaming.jobs import dropped_by_watermark

RAW = "event_id string, customer_id string, event_ts string, event_type string, campaign_id string, " \
    "source string, ingest_seq long"
AS_OF = dt.datetime(2026, 4, 1)


def raw(event, day, seq, source="first", customer="c1"):
    return event, customer, f"2026-03-{day:02d} 10:00:00", "click", "k", source, seq


def run(spark, tmp_path, batches, **options):
    src, table, ck = (str(tmp_path / n) for n in ("src", "fact_events", "ck"))
    queries = []
    for rows in batches:
        if callable(rows):
            rows(table)
            continue
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(RAW).parquet(src)
        queries = corrections.start_last_arrivals(stream, table, ck, str(tmp_path / "quarantine"), "s",
                                                  as_of=AS_OF, **options)
        for q in queries:
            q.awaitTermination()
            assert q.exception() is None
    return read_fact(spark, "fact_events", table), queries, table


def rows_of(df):
    return sorted(tuple(r) for r in df.select("event_id", "event_date", "event_ts", "source").collect())


BATCHES = [
    [raw("a", 1, 1), raw("a", 1, 4, "same batch"), raw("b", 1, 2), raw("c", 2, 9, "newest first"),
     raw("d", 2, 3), raw("bad", 2, 3, customer=None), raw("n", 1, None, "no number")],
    # b is corrected and moves to another day, c's older arrival comes late, d comes again unchanged
    [raw("b", 3, 7, "moved"), raw("c", 2, 5, "older"), raw("d", 2, 3), raw("e", 3, 8), raw("n", 1, 1, "numbered")],
    [raw("b", 2, 11, "moved back"), raw("a", 1, 12, "again")],
]


@pytest.mark.parametrize("compacted", [False, True])
def test_stream_equals_batch(spark, tmp_path, compacted):
    batches = list(BATCHES)
    if compacted:
        batches.insert(2, lambda table: sinks.compact(spark, "fact_events", table))
    out, _, _ = run(spark, tmp_path, batches, delay="60 days")
    good, bad = accept(spark.createDataFrame(sum(BATCHES, []), RAW), "events", "tolerant", AS_OF,
                       keep=("ingest_seq",))
    want = last_arrivals(good.withColumn("ingest_seq", F.coalesce("ingest_seq", F.lit(-1))),
                         arrival="ingest_seq")
    assert rows_of(out) == rows_of(want) and out.count() == 6
    assert out.filter("inserted_at IS NULL").isEmpty()
    assert read_fact(spark, "quarantine", str(tmp_path / "quarantine")).count() == bad.count() == 1


def test_state_expires_and_late_rows_are_counted(spark, tmp_path):
    batches = [[raw("a", 1, 1), raw("b", 9, 2)], [raw("b", 9, 3, "kept"), raw("z", 28, 4)],
               [raw("a", 1, 5, "late"), raw("z", 28, 6, "newest")], [raw("y", 28, 7)]]
    out, (q, _), _ = run(spark, tmp_path, batches, delay="1 day", keep_days=2)
    assert [(e, s) for e, _, _, s in rows_of(out)] == [("a", "first"), ("b", "kept"), ("y", "first"),
                                                      ("z", "newest")]
    state = spark.read.format("statestore").option("stateVarName", "last") \
        .load(str(tmp_path / "ck" / "changes"))
    assert sorted(r[0] for r in state.select("key.event_id").collect()) == ["y", "z"]


def test_late_rows_are_reported(spark, tmp_path):
    out, (q, _), _ = run(spark, tmp_path, [[raw("a", 1, 1), raw("z", 28, 2)], [raw("a", 1, 4, "late")]],
                         delay="1 hour", keep_days=1)
    assert [(e, s) for e, _, _, s in rows_of(out)] == [("a", "first"), ("z", "first")]
    assert dropped_by_watermark(q) == 1


def change(spark, rows):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT_EVENTS.schema.fields)
    full = [(e, "c", dt.datetime(2026, 3, day, 10), dt.date(2026, 3, day), "click", "k", source, AS_OF,
             None if old is None else dt.date(2026, 3, old)) for e, day, source, old in rows]
    return spark.createDataFrame(full, schema + ", replaces date")


def test_a_repeated_batch_is_committed_once_and_only_touched_parts_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    one = change(spark, [("a", 1, "first", None), ("b", 1, "first", None)])
    assert upsert_batch(one, "fact_events", path, "replaces", ("s", 0))
    assert not upsert_batch(one, "fact_events", path, "replaces", ("s", 0))
    assert upsert_batch(change(spark, [("c", 1, "first", None)]), "fact_events", path, "replaces", ("s", 1))
    before = {p.path for p in manifest.latest(spark, path).parts}
    assert upsert_batch(change(spark, [("a", 1, "fixed", 1), ("x", 2, "first", None)]), "fact_events", path,
                        "replaces", ("s", 2))
    after = manifest.latest(spark, path)
    assert len(before & {p.path for p in after.parts}) == 1 and after.applied == {"s": 2}
    assert [(e, s) for e, _, _, s in rows_of(read_fact(spark, "fact_events", path))] == [
        ("a", "fixed"), ("b", "first"), ("c", "first"), ("x", "first")]


def test_a_compaction_in_between_makes_the_batch_start_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n, e in enumerate("ab"):
        upsert_batch(change(spark, [(e, 1, "first", None)]), "fact_events", path, "replaces", ("s", n))
    real, calls = manifest.commit, []

    def commit(spark_, path_, *a, **k):
        if k.get("batch") and not calls:
            calls.append(1)
            sinks.compact(spark, "fact_events", path)
        return real(spark_, path_, *a, **k)
    monkeypatch.setattr(manifest, "commit", commit)
    assert upsert_batch(change(spark, [("a", 2, "fixed", 1)]), "fact_events", path, "replaces", ("s", 2))
    assert [(e, s) for e, _, _, s in rows_of(read_fact(spark, "fact_events", path))] == [
        ("a", "fixed"), ("b", "first")]


def test_groups_of_ids_answer_as_single_ids_do(spark, tmp_path, groups=3):
    """Calls and state rows are paid for groups of ids; corrections, ties, expiry and late rows stay the same."""
    many = [raw(f"m{n}", 1 + n % 5, n) for n in range(60)]
    batches = [
        [*many, *BATCHES[0], raw("x", 2, 1), raw("tie", 4, 3, "one"), raw("tie", 4, 3, "two"), raw("tie", 4, 3, None)],
        [*[raw(f"m{n}", 2, 100 + n, "moved") for n in range(0, 60, 4)], *BATCHES[1], raw("tie", 4, 3, "zz")],
        [*BATCHES[2], raw("m1", 28, 500, "far")],
        [raw("m2", 1, 501, "late"), raw("m1", 28, 400, "older")],
        [raw("m1", 27, 502, "later number"), raw("new", 28, None)],
    ]
    got = {}
    for n in (None, groups):
        out, queries, table = run(spark, tmp_path / str(n), batches, delay="5 days", keep_days=3, groups=n)
        got[n] = (sorted(map(str, out.drop("inserted_at").collect())), dropped_by_watermark(queries[0]),
                  read_fact(spark, "quarantine", str(tmp_path / str(n) / "quarantine")).count())
        assert out.filter("inserted_at IS NULL").isEmpty()
    assert got[groups] == got[None] and got[groups][1] == 0 and len(got[groups][0]) == 69
    assert 0 < queries[0].lastProgress["stateOperators"][0]["numRowsTotal"] <= groups
    state = spark.read.format("statestore").load(str(tmp_path / str(groups) / "ck" / "changes"))
    assert sorted(i for r in state.select("value.groupState.ids").collect() for i in r[0]) == ["m1", "new"]


def test_groups_count_late_rows_and_end_empty_state(spark, tmp_path):
    batches = [[raw("a", 1, 1), raw("z", 28, 2)], [raw("a", 1, 4, "late")]]
    out, (q, _), _ = run(spark, tmp_path, batches, delay="1 hour", keep_days=1, groups=50)
    assert [(e, s) for e, _, _, s in rows_of(out)] == [("a", "first"), ("z", "first")]
    assert dropped_by_watermark(q) == 1 and q.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    with pytest.raises(ValueError):
        corrections.last_arrival_changes(spark.createDataFrame([], RAW), groups=0)
