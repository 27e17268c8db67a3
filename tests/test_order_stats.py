"""Distributed order statistics: brute force, ties, extreme doubles, a series of 10^6 points."""

import datetime as dt
import math
import statistics
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from adcredit.operators import anomaly, features
from adcredit.operators.order_stats import at_ranks, code, counted, previous

EXTREMES = [0.0, -0.0, 1.0, -1.0, math.nextafter(1, 2), math.nextafter(1, 0), 5e-324, -5e-324, 1e-310, 2.0 ** -1022,
            math.nextafter(2.0 ** -1022, 0), 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf,
            0.1, 1 / 3, 2.0 ** 52, 2.0 ** 53 + 2, 1e-300, 123456.789, 8.0, 7.999999999999999]


def test_code_is_the_double_in_order(spark):
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2 ** 63, 4000, dtype=np.uint64).view(np.float64)
    values = EXTREMES + [float(v) for v in bits if math.isfinite(v)] + (2.0 ** np.arange(-1074, 1024)).tolist()
    values += [-v for v in values]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", code(F.col("v")).alias("c")).collect()

    def ieee(v):
        n = struct.unpack(">q", struct.pack(">d", abs(v)))[0]
        return -n if v < 0 else n
    assert [r["c"] for r in got] == [ieee(v) for v in values]
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(code(F.col("v"))).first()[0]
    assert nan > ieee(math.inf)


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
def test_ranks_equal_sorting(spark, keys):
    rng = np.random.default_rng(len(keys))
    rows = [(k, j, float(v)) for k in ("a", "b", None) for j in (1, 2)
            for v in np.concatenate([rng.normal(100, 1e-9, 40), rng.normal(0, 1e6, 30), [7.0] * 35])]
    rows += [("one", 1, 3.0), ("none", 1, None), ("odd", 2, float("nan")), ("odd", 2, -math.inf), ("odd", 2, 0.0)]
    df = spark.createDataFrame(rows, "k string, j int, v double")
    ranks = {"first": lambda n: n * 0, "mid": lambda n: F.floor(n / 2), "next": lambda n: F.floor(n / 2) + 1,
             "last": lambda n: n - 1, "beyond": lambda n: n}
    got = at_ranks(counted(df, keys, "v"), keys, ranks).collect()
    groups = {}
    for k, j, v in rows:
        if v is not None:
            groups.setdefault(tuple({"k": k, "j": j}[x] for x in keys), []).append(v)
    assert len(got) == len(groups)
    for r in got:
        s = sorted(groups[tuple(r[x] for x in keys)], key=lambda x: (math.isnan(x), x))
        want = [len(s), s[0], s[len(s) // 2], s[len(s) // 2 + 1] if len(s) // 2 + 1 < len(s) else None, s[-1], None]
        assert str([r[c] for c in ("n", *ranks)]) == str(want)


def test_previous_crosses_months(spark):
    days = [dt.date(2025, 11, 3), dt.date(2025, 11, 30), dt.date(2026, 1, 1), dt.date(2026, 1, 2), dt.date(2026, 7, 9)]
    rows = [(k, d, float(i)) for k in ("a", None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "k string, d date, v double").repartition(3)
    for order in ("d", "text"):
        got = previous(df.withColumn("text", F.col("d").cast("string")), ["k"], order, "v", "p").collect()
        assert sorted(((r["k"] or "", r["v"], r["p"]) for r in got), key=str) == sorted(
            ((k, float(i), float(i - 1) if i else None) for k in ("", "a") for i in range(5)), key=str)


def brute(values):
    """The literal rules: upper median, mean deviation from it, index quartiles, population deviation."""
    s, n = sorted(values), len(values)
    median = s[n // 2]
    return (n, statistics.fmean(s), statistics.pstdev(s), median, sum(abs(x - median) for x in s) / n, s[n // 4],
            s[min(n - 1, 3 * n // 4)])


def test_series_of_a_million_points(spark):
    """One series, a third of it one value; every statistic and alert against plain Python."""
    n, third = 1_000_000, 333_333
    t0 = dt.datetime(2020, 1, 1)
    df = spark.range(n, numPartitions=8).select(
        (F.lit(t0) + F.make_dt_interval(mins=F.col("id"))).alias("date"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_003)) / 7.0).alias("v"))
    r = anomaly.series_stats(df, "v").first()
    values = [x[0] for x in df.select("v").toPandas().to_numpy()]
    want = brute(values)
    assert sum(v == 5.0 for v in values) >= third
    assert r["n"] == n and (r["median"], r["q1"], r["q3"]) == (want[3], want[5], want[6])
    assert all(math.isclose(r[c], w, rel_tol=1e-9) for c, w in zip(("mean", "stddev", "mad"),
                                                                  (want[1], want[2], want[4])))
    alerts = anomaly.detect_anomalies(df, "v")
    changes = sum(1 for a, b in zip(values, values[1:]) if a and abs((b - a) / a) >= 0.25)
    got = alerts.agg(F.count(F.lit(1)).alias("n"),
                     F.count_if(F.abs("percent_change") >= 0.25).alias("changes")).first()
    assert (got["n"], got["changes"]) == (n, changes)


def test_stats_of_short_and_flat_series(spark):
    rows = [("flat", dt.date(2026, 1, d), 0.1) for d in range(1, 8)] + [("one", dt.date(2026, 1, 1), 1.0)] \
        + [("two", dt.date(2026, 1, d), float(d)) for d in (1, 2)] + [("null", dt.date(2026, 1, 1), None)] * 3
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = {r["k"]: r for r in anomaly.series_stats(df, "v", series_cols=("k",)).collect()}
    assert set(got) == {"flat", "two"}
    assert got["flat"]["stddev"] == 0.0 and got["flat"]["mad"] == 0.0 and got["flat"]["mean"] == 0.1
    assert tuple(got["two"])[1:] == brute([1.0, 2.0])
    for daily in (True, False):                 # both ways agree, also on the values before
        both = anomaly.detect_anomalies(df, "v", series_cols=("k",), daily=daily).orderBy("k", "date").collect()
        assert [(r["k"], r["value"], r["percent_change"]) for r in both if r["k"] == "two"] == [
            ("two", 1.0, 0.0), ("two", 2.0, 1.0)]
    assert {r["severity"] for r in anomaly.detect_anomalies(df, "v", series_cols=("k",)).filter("k = 'flat'").collect()} \
        == {"low"}


def test_profile_quartiles_equal_percentile(spark):
    rng = np.random.default_rng(9)
    rows = [(float(a), float(b) if b > 0 else None, None) for a, b in zip(rng.integers(0, 9, 501), rng.normal(0, 1, 501))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {r["feature"]: r for r in features.profile(df, ["a", "b", "c"]).collect()}
    for c in ("a", "b"):
        want = df.select(*(F.percentile(c, F.lit(p / 100)) for p in (25, 50, 75))).first()
        assert [got[c][f"p{p}"] for p in (25, 50, 75)] == pytest.approx(list(want), rel=1e-15)
    assert got["c"]["count"] == 0 and got["c"]["p50"] is None


def test_no_window_over_a_whole_series(spark):
    """Windows run over digits of a level or over a month, never over a series' rows."""
    df = spark.createDataFrame([("a", dt.date(2026, 1, 1), 1.0)], "k string, date date, v double")
    plan = anomaly.detect_anomalies(df, "v", series_cols=("k",))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows
    for line in windows:
        assert "_month" in line or "sum(c#" in line or "_last" in line, line
    assert "percentile" not in plan


def test_a_series_declared_daily_is_checked(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "MAX_DAYS", 5)
    df = spark.createDataFrame([(dt.date(2026, 1, d), float(d)) for d in range(1, 8)], "date date, v double")
    with pytest.raises(Exception, match="more than 5 points"):
        anomaly.series_stats(df, "v", daily=True).collect()
    assert anomaly.series_stats(df, "v").first()["n"] == 7
