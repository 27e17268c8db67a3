"""Incremental features equal the full job and rewrite only the dates that change."""

import datetime as dt

from adcredit.plans import jobs
from adcredit.sources import manifest
from adcredit.sources.sinks import read_fact, replace_partitions, write_fact

M, E, T, D = "fact_campaign_metrics", "fact_events", "fact_campaign_metrics_features", "daily_features"
DAY = [dt.date(2026, 8, 1) + dt.timedelta(days=i) for i in range(30)]
OLD, NEW = dt.datetime(2026, 9, 1), dt.datetime(2026, 9, 2)


def metrics(spark, rows, at):
    return spark.createDataFrame([(c, d, float(s), float(r), r / s if s else None, None, n, at)
                                  for c, d, s, r, n in rows],
                                 "campaign_id string, metric_date date, spend double, attributed_revenue double, "
                                 "roas double, cac double, conversions long, inserted_at timestamp")


def events(spark, rows, at):
    return spark.createDataFrame([(f"e{c}{d}{i}", "u", dt.datetime(d.year, d.month, d.day), d, c, at)
                                  for i, (c, d) in enumerate(rows)],
                                 "event_id string, customer_id string, event_ts timestamp, event_date date, "
                                 "campaign_id string, inserted_at timestamp")


def tables(spark, root):
    return [sorted(map(str, read_fact(spark, t, f"{root}/{t}").collect())) for t in (T, D)]


def parts(spark, root, t):
    return {p.partition: p.path for p in manifest.latest(spark, f"{root}/{t}").parts}


def moved(before, after):
    return {k.split("=")[1] for k in before.keys() | after.keys() if before.get(k) != after.get(k)}


def test_incremental_features_equal_the_full_job(spark, tmp_path):
    root, full = str(tmp_path / "w"), str(tmp_path / "f")
    # A every day, B with gaps, C one early day, Z without spend
    base = [("A", d, 10 + i, 7 * i % 23, i) for i, d in enumerate(DAY)] + \
        [("B", d, 5, i % 7, 1) for i, d in enumerate(DAY) if i % 3 == 0] + [("C", DAY[1], 4, 2, 1)] + \
        [("Z", DAY[12], 0, 0, 0)]
    write_fact(metrics(spark, base, OLD), M, f"{root}/{M}")
    write_fact(events(spark, [("A", d) for d in DAY], OLD), E, f"{root}/{E}")
    jobs.features_job(spark, root, since=NEW)                   # nothing stored yet: a full run
    first = tables(spark, root)
    before = [parts(spark, root, t) for t in (T, D)]
    jobs.features_job(spark, root, since=NEW)                   # nothing new: nothing is written
    assert [parts(spark, root, t) for t in (T, D)] == before and tables(spark, root) == first

    # late: a changed and a new row on day 20, day 12 of A and Z lost, day 3 emptied; one late event on day 5
    later = [r for r in base if r[1] not in (DAY[3], DAY[12], DAY[20])]
    day20 = [("A", DAY[20], 99, 50, 2), ("C", DAY[20], 3, 9, 1)]
    day12 = [r for r in base if r[1] == DAY[12] and r[0] == "B"]
    replace_partitions(metrics(spark, day20 + day12, NEW), M, f"{root}/{M}", [DAY[3], DAY[12], DAY[20]])
    write_fact(events(spark, [("A", DAY[5]), ("nobody", DAY[6])], NEW), E, f"{root}/{E}")
    jobs.features_job(spark, root, since=NEW)
    write_fact(metrics(spark, later + day20 + day12, NEW), M, f"{full}/{M}")
    write_fact(read_fact(spark, E, f"{root}/{E}"), E, f"{full}/{E}")
    jobs.features_job(spark, full)
    assert tables(spark, root) == tables(spark, full)
    changed = [moved(b, parts(spark, root, t)) for b, t in zip(before, (T, D))]
    days = {str(d): i for i, d in enumerate(DAY)}
    f, d = ({days[x] for x in c} for c in changed)
    # frames of A and B: six rows after the change; targets: the day before it
    assert {2, 3, 4, 11, 12, 19, 20, 21} <= f and 28 not in f and not f & {0, 1}
    assert 5 in d and 2 not in d and not d & {0, 1, 28}


def test_only_the_frames_of_a_late_row_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "w")
    write_fact(metrics(spark, [(c, d, 10 + i, i, 1) for c in "AB" for i, d in enumerate(DAY)], OLD), M, f"{root}/{M}")
    write_fact(events(spark, [("A", DAY[0])], OLD), E, f"{root}/{E}")
    jobs.features_job(spark, root)
    before = [parts(spark, root, t) for t in (T, D)]
    replace_partitions(metrics(spark, [("A", DAY[10], 77, 5, 1), ("B", DAY[10], 20, 10, 1)], NEW), M, f"{root}/{M}",
                       [DAY[10]])
    jobs.features_job(spark, root, since=NEW)
    got = [{DAY.index(dt.date.fromisoformat(x)) for x in moved(b, parts(spark, root, t))}
           for b, t in zip(before, (T, D))]
    assert got == [set(range(9, 17)), set(range(10, 17))]
