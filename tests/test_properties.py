"""Property test: last touch equals brute force on random small inputs.

Times sit on a coarse grid (half days) so that exact look-back boundaries,
equal instants and duplicate order ids are frequent.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adcredit.operators.attribution import last_touch
from test_skew import _brute

BASE = dt.datetime(2026, 5, 1)
CUSTOMERS = st.sampled_from(["a", "b", "c"])
WHEN = st.integers(min_value=0, max_value=40).map(lambda h: BASE + dt.timedelta(hours=12 * h))

events_st = st.lists(st.tuples(CUSTOMERS, WHEN, st.sampled_from(["x", "y", None])),
                     min_size=0, max_size=25)
orders_st = st.lists(st.tuples(st.integers(0, 12), CUSTOMERS, WHEN,
                               st.floats(1, 100, allow_nan=False)), min_size=1, max_size=15)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=events_st, orders=orders_st, bucket=st.sampled_from([3600, 86400, 5 * 86400]))
def test_last_touch_equals_brute_force(spark, events, orders, bucket):
    ev = [(f"e{i:03d}", c, t, k) for i, (c, t, k) in enumerate(events)]
    # one (customer, time, revenue) per order id: duplicates of an id are copies
    seen = {}
    for oid, c, t, r in orders:
        seen.setdefault(f"o{oid}", (c, t, r))
    od = [(oid, c, t, r) for oid, (c, t, r) in seen.items()]
    want = _brute(od, ev) if ev else {o[0]: (None, None) for o in od}
    o_df = spark.createDataFrame(od, "order_id string, customer_id string, order_ts timestamp, "
                                     "revenue double")
    e_df = spark.createDataFrame(ev, "event_id string, customer_id string, event_ts timestamp, "
                                     "campaign_id string")
    got = {r.order_id: (r.campaign_id, r.touch_ts)
           for r in last_touch(o_df, e_df, bucket_seconds=bucket).collect()}
    assert got == want
