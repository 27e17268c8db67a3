"""Hand-worked golden rows (edge cases the generated tables do not reach)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from adcredit.operators import anomaly, features, health, metrics, normalize
from adcredit.operators.attribution import last_touch
from adcredit.schemas import FACT_AD_SPEND
from adcredit.sources import sinks

T = dt.datetime(2026, 8, 8, 12, 0, 0)
US = dt.timedelta(microseconds=1)


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_ts timestamp, "
                                       "revenue double")


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, customer_id string, event_ts timestamp, "
                                       "campaign_id string")


def _touch(spark, orders, events, **kw):
    out = last_touch(_orders(spark, orders), _events(spark, events), **kw)
    return {r.order_id: (r.campaign_id, r.touch_ts) for r in out.collect()}


def test_look_back_is_inclusive_at_both_ends(spark):
    got = _touch(spark,
                 [("o1", "c1", T, 10.0), ("o2", "c2", T, 10.0), ("o3", "c3", T, 10.0),
                  ("o4", "c4", T, 10.0)],
                 [("e1", "c1", T - dt.timedelta(days=7), "A"),
                  ("e2", "c2", T - dt.timedelta(days=7) - US, "B"),
                  ("e3", "c3", T, "C"),
                  ("e4", "c4", T + US, "D")])
    assert got["o1"] == ("A", T - dt.timedelta(days=7))
    assert got["o2"] == (None, None)
    assert got["o3"] == ("C", T)
    assert got["o4"] == (None, None)


def test_ties_latest_null_campaign_missing_touch_and_duplicate_orders(spark):
    got = _touch(spark,
                 [("o1", "c1", T, 10.0), ("o2", "c2", T, 10.0), ("o3", "c3", T, 10.0),
                  ("o4", "c4", T, 10.0), ("o4", "c4", T, 10.0)],
                 [("e1", "c1", T - dt.timedelta(hours=1), "LOW"),
                  ("e2", "c1", T - dt.timedelta(hours=1), "HIGH"),
                  ("e3", "c2", T - dt.timedelta(days=2), "OLDER"),
                  ("e4", "c2", T - dt.timedelta(days=1), None),
                  ("e5", "c4", T - dt.timedelta(days=3), "X")])
    assert got["o1"][0] == "HIGH"          # equal instants: higher event_id wins
    assert got["o2"] == (None, T - dt.timedelta(days=1))  # latest touch has no campaign
    assert got["o3"] == (None, None)       # no touch: kept with NULLs
    assert got["o4"][0] == "X"
    assert len(got) == 4


def test_touch_in_an_earlier_bucket_is_carried(spark):
    # one-minute buckets: the only touch is 3 days and many buckets earlier
    got = _touch(spark, [("o1", "c1", T, 1.0)],
                 [("e1", "c1", T - dt.timedelta(days=3), "A")], bucket_seconds=60)
    assert got["o1"] == ("A", T - dt.timedelta(days=3))


def test_null_customer_matches_nothing(spark):
    got = _touch(spark, [("o1", None, T, 1.0)], [("e1", None, T, "A")])
    assert got == {"o1": (None, None)}


def _spend(spark, rows):
    return spark.createDataFrame(rows, "campaign_id string, date date, spend double")


def _attr(spark, rows):
    return spark.createDataFrame(rows, "order_id string, campaign_id string, touch_ts timestamp, "
                                       "revenue double")


def test_campaign_metrics_golden(spark):
    d = dt.date(2026, 8, 1)
    ts = dt.datetime(2026, 8, 1, 10)
    spend = _spend(spark, [("A", d, 500.0), ("B", d, 300.0), ("C", d, 0.0),
                           ("D", d, 500.0), ("D", d, 500.0)])
    attr = _attr(spark, [("o1", "A", ts, 100.0), ("o2", "A", ts, 150.0), ("o3", "C", ts, 40.0),
                         ("o4", "D", ts, 250.0), ("o5", "D", ts, 250.0)])
    got = {r.campaign_id: r for r in metrics.campaign_metrics(spend, attr).collect()}
    a, b, c, d_ = got["A"], got["B"], got["C"], got["D"]
    assert (a.attributed_revenue, a.conversions, a.roas, a.cac) == (250.0, 2, 0.5, 250.0)
    assert (b.attributed_revenue, b.conversions, b.roas, b.cac) == (0.0, 0, 0.0, None)
    assert (c.attributed_revenue, c.roas, c.cac) == (40.0, None, 0.0)
    # repeated equal spend rows: one row, revenue doubled, distinct count not
    assert (d_.attributed_revenue, d_.conversions) == (1000.0, 2)
    assert len(got) == 4


def test_trend_is_ratio_of_sums(spark):
    d = dt.date(2026, 8, 1)
    m = spark.createDataFrame(
        [("A", d, 100.0, 300.0, 3, None, None, dt.datetime(2026, 8, 2)),
         ("B", d, 300.0, 100.0, 1, None, None, dt.datetime(2026, 8, 2))],
        "campaign_id string, metric_date date, spend double, attributed_revenue double, "
        "conversions bigint, roas double, cac double, inserted_at timestamp")
    r = metrics.trend(m).collect()[0]
    assert (r.spend, r.attributed_revenue, r.roas, r.cac) == (400.0, 400.0, 1.0, 100.0)


def test_rolling_and_calendar_target(spark):
    m = spark.createDataFrame(
        [("A", dt.date(2026, 8, 1), 1.0), ("A", dt.date(2026, 8, 2), 3.0),
         ("A", dt.date(2026, 8, 4), 5.0)],
        "campaign_id string, metric_date date, roas double") \
        .withColumn("spend", F.lit(1.0)).withColumn("attributed_revenue", F.lit(1.0)) \
        .withColumn("conversions", F.lit(1).cast("bigint")).withColumn("cac", F.lit(1.0))
    rows = features.features_with_target(m).orderBy("metric_date").collect()
    assert [r.rolling_7d_roas for r in rows] == [1.0, 2.0, 3.0]
    assert rows[0].rolling_7d_volatility is None
    assert math.isclose(rows[1].rolling_7d_volatility, 1.41421356, rel_tol=1e-8)
    assert math.isclose(rows[2].rolling_7d_volatility, 2.0)
    assert [r.next_day_roas for r in rows] == [3.0, None, None]


def _alerts(spark, values):
    s = spark.createDataFrame([(f"2026-08-{i + 1:02d}", v) for i, v in enumerate(values)],
                              "date string, roas double")
    return anomaly.detect_anomalies(s, "roas").orderBy("date").collect()


def test_anomalies_two_points(spark):
    a, b = _alerts(spark, [4.5, 3.2])
    assert (round(a.z_score, 6), a.modified_z_score, a.iqr_outlier, a.percent_change,
            a.severity) == (1.0, 0.0, False, 0.0, "low")
    assert round(b.z_score, 6) == -1.0 and round(b.modified_z_score, 3) == -1.349
    assert round(b.percent_change, 5) == -0.28889 and b.severity == "high"


def test_anomalies_outlier_and_flat_and_short(spark):
    rows = _alerts(spark, [1.0, 1.0, 1.0, 1.0, 10.0])
    assert [r.severity for r in rows] == ["low"] * 4 + ["high"]
    last = rows[-1]
    assert (round(last.z_score, 6), round(last.modified_z_score, 4), last.iqr_outlier,
            last.percent_change) == (2.0, 3.3725, True, 9.0)
    assert all(r.z_score == 0 and r.severity == "low" for r in _alerts(spark, [0.0, 0.0, 0.0]))
    assert _alerts(spark, [7.0]) == []
    assert _alerts(spark, [None, None]) == []


def test_normalise_tolerant_and_strict(spark):
    raw = spark.createDataFrame([("A", "2026-08-01", "abc", "10", "12.5", None)],
                                "campaign_id string, date string, spend string, "
                                "impressions string, clicks string, source string")
    r = normalize.normalize_ads(raw, "tolerant").collect()[0]
    assert (r.spend, r.clicks, r.source) == (None, None, None)
    good, bad = normalize.quarantine(normalize.normalize_ads(raw, "tolerant"), FACT_AD_SPEND)
    assert good.count() == 0 and bad.collect()[0].violations == ["spend is null"]
    with pytest.raises(Exception):
        normalize.normalize_ads(raw, "strict").collect()
    ok = raw.withColumn("spend", F.lit("5")).withColumn("clicks", F.lit(" 3 "))
    r = normalize.normalize_ads(ok, "strict").collect()[0]
    assert (r.spend, r.clicks, r.source) == (5.0, 3, "unknown")
    orders = spark.createDataFrame([("o", "c", "2026-08-01T10:00:00Z", "9.5", None)],
                                   "order_id string, customer_id string, order_ts string, "
                                   "revenue string, currency string")
    assert normalize.normalize_orders(orders).collect()[0].currency == "USD"


def test_dedup_keeps_last_arrival(spark):
    raw = spark.createDataFrame(
        [("e1", "c", "2026-08-01 10:00:00", "click", "A", "first", 1),
         ("e1", "c", "2026-08-01 10:00:00", "click", "A", "second", 2)],
        "event_id string, customer_id string, event_ts string, event_type string, "
        "campaign_id string, source string, ingest_seq int")
    assert [r.source for r in normalize.dedup_events(raw).collect()] == ["second"]
    assert normalize.normalize_events(raw).count() == 2


def test_sinks_empty_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "ads")
    rows = _spend(spark, [("A", dt.date(2026, 8, 1), 1.0)])
    assert sinks.write_fact(rows, "fact_ad_spend", path, "append")
    assert not sinks.write_fact(rows.limit(0), "fact_ad_spend", path, "append")
    assert sinks.read_fact(spark, "fact_ad_spend", path).count() == 1
    sinks.write_fact(rows.limit(0), "fact_ad_spend", path, "overwrite")
    assert sinks.read_fact(spark, "fact_ad_spend", path).count() == 0


def test_freshness_upsert(spark):
    old = dt.datetime(2026, 8, 1)
    new = dt.datetime(2026, 8, 2)
    existing = spark.createDataFrame([("ads", old, "stale", old)],
                                     "source string, latest_timestamp timestamp, status string, "
                                     "inserted_at timestamp")
    incoming = spark.createDataFrame([("ads", new), ("orders", new)],
                                     "source string, latest_timestamp timestamp")
    got = {r.source: r for r in health.upsert_freshness(existing, incoming, as_of=new).collect()}
    assert (got["ads"].latest_timestamp, got["ads"].status, got["ads"].inserted_at) == \
        (new, "healthy", new)
    assert (got["orders"].status, got["orders"].inserted_at) == ("healthy", None)
    assert len(got) == 2


def test_page_validation(spark):
    from adcredit.operators import drilldown
    df = _spend(spark, [("A", dt.date(2026, 8, 1), 1.0)])
    with pytest.raises(ValueError):
        drilldown.page(df, "fact_ad_spend", order_by="revenue")
    with pytest.raises(ValueError):
        drilldown.page(df, "fact_ad_spend", limit=201)
    with pytest.raises(ValueError):
        drilldown.page(df, "fact_ad_spend", offset=-1)


def test_portfolio_summary_of_nothing_is_zeros(spark):
    empty = spark.createDataFrame([], "spend double, attributed_revenue double, conversions bigint")
    r = metrics.portfolio_summary(empty).collect()[0]
    assert (r.spend, r.attributed_revenue, r.roas, r.cac, r.conversions) == (0.0, 0.0, 0.0, 0.0, 0)


def test_row_count_properties(spark):
    from adcredit.sources.driver import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.01")
    a = w.fact_attribution
    assert a.count() == a.select("order_id").distinct().count() == w.fact_orders.count()
    joined = a.join(w.fact_orders.select("order_id", "order_ts"), "order_id")
    bad = joined.filter(F.col("touch_ts").isNotNull() & (
        (F.col("touch_ts") > F.col("order_ts"))
        | (F.col("touch_ts") < F.col("order_ts") - F.expr("INTERVAL 7 DAYS"))))
    assert bad.count() == 0


def test_campaign_detail_unknown_raises(spark):
    d = dt.date(2026, 8, 1)
    m = spark.createDataFrame(
        [("A", d, 100.0, 300.0, 3, 3.0, 33.3, dt.datetime(2026, 8, 2))],
        "campaign_id string, metric_date date, spend double, attributed_revenue double, "
        "conversions bigint, roas double, cac double, inserted_at timestamp")
    assert metrics.campaign_detail(m, "A").collect()[0].roas == 3.0
    with pytest.raises(LookupError):
        metrics.campaign_detail(m, "missing")


def test_feature_inputs_have_unique_keys(spark):
    from adcredit.sources.driver import Warehouse
    w = Warehouse.of(spark, "/root/testdata/sf0.001")
    assert features.unique_key_violations(w.fact_campaign_metrics,
                                          ["campaign_id", "metric_date"]).count() == 0
    dup = w.fact_campaign_metrics.unionByName(w.fact_campaign_metrics.limit(1))
    assert features.unique_key_violations(dup, ["campaign_id", "metric_date"]).count() == 1
