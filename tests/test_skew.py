"""Last touch on a skewed fixture against a brute-force reference.

One customer holds a third of all rows, one event is re-delivered many
times and one order is copied many times. The Spark operator must return
exactly the brute-force answer (every order, pair enumeration in pandas on
this small fixture), for every bucket width.
"""

import datetime as dt
import random

import pandas as pd
import pytest

from adcredit.operators.attribution import last_touch

BASE = dt.datetime(2026, 1, 1)


def _fixture(n_events=3000, n_orders=600, seed=7):
    rnd = random.Random(seed)
    ev, od = [], []
    for i in range(n_events):
        hot = i % 3 == 0
        cust = "hot" if hot else f"c{rnd.randint(1, 60)}"
        ts = BASE + dt.timedelta(seconds=rnd.randint(0, 40 * 86400))
        camp = None if rnd.random() < 0.1 else f"k{rnd.randint(0, 9)}"
        ev.append((f"e{i:05d}", cust, ts, camp))
    copy = ev[0]
    ev += [copy] * 400                               # re-delivered event
    for i in range(n_orders):
        hot = i % 3 == 0
        cust = "hot" if hot else f"c{rnd.randint(1, 60)}"
        ts = BASE + dt.timedelta(seconds=rnd.randint(0, 40 * 86400))
        od.append((f"o{i:05d}", cust, ts, float(rnd.randint(1, 500))))
    od += [od[1]] * 300                              # copied order
    od.append(("o_null", None, BASE, 1.0))
    return od, ev


def _brute(od, ev, days=7):
    o = pd.DataFrame(od, columns=["order_id", "customer_id", "order_ts", "revenue"])
    e = pd.DataFrame(ev, columns=["event_id", "customer_id", "event_ts", "campaign_id"])
    j = o.merge(e, on="customer_id", how="left")
    inside = (j["event_ts"] <= j["order_ts"]) & \
        (j["event_ts"] >= j["order_ts"] - pd.Timedelta(days=days))
    j = j[inside]
    j = j.sort_values(["order_id", "event_ts", "event_id"]).groupby("order_id").tail(1)
    best = {r.order_id: (r.campaign_id if isinstance(r.campaign_id, str) else None,
                         r.event_ts.to_pydatetime()) for r in j.itertuples()}
    return {oid: best.get(oid, (None, None)) for oid in o["order_id"].unique()}


@pytest.fixture(scope="module")
def data():
    od, ev = _fixture()
    return od, ev, _brute(od, ev)


@pytest.mark.parametrize("bucket_seconds", [60, 3600, 86400, 30 * 86400])
def test_matches_brute_force(spark, data, bucket_seconds):
    od, ev, want = data
    orders = spark.createDataFrame(od, "order_id string, customer_id string, order_ts timestamp, "
                                       "revenue double")
    events = spark.createDataFrame(ev, "event_id string, customer_id string, "
                                       "event_ts timestamp, campaign_id string")
    got = {r.order_id: (r.campaign_id, r.touch_ts)
           for r in last_touch(orders, events, bucket_seconds=bucket_seconds).collect()}
    assert got == want


def test_plan_has_no_pair_join(spark, data):
    od, ev, _ = data
    orders = spark.createDataFrame(od, "order_id string, customer_id string, order_ts timestamp, "
                                       "revenue double")
    events = spark.createDataFrame(ev, "event_id string, customer_id string, "
                                       "event_ts timestamp, campaign_id string")
    plan = last_touch(orders, events)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
