"""Plan guards for the registered read queries (the batch path stays JVM-side).

No pair-producing joins, no Python evaluation operators, and the scans of
the events table get the event-type filter pushed into Parquet.
"""

import pytest

from adcredit.plans import catalog, extra_queries  # noqa: F401  (registers queries)
from conftest import SF_SMALL

SIDE_EFFECTS = ("stream_", "forecast_", "feature_importance", "score_features",
                "append_replace_roundtrip", "partitioned_write_scan", "events_compacted", "dates_replaced", "customer_lookup",
                "deep_events_page", "jobs_end_to_end", "raw_json_",
                "raw_csv_", "features_job_table", "features_incremental", "daily_features_table", "retention_job")
READS = sorted(k for k in catalog.QUERIES if not k.startswith(SIDE_EFFECTS))
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", READS)
def test_plan_is_jvm_side_without_pair_joins(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line
             and "event_type" in line]
    assert scans, f"{name}: no events scan found"
    for line in scans:
        assert "PushedFilters: [" in line and "event_type" in line.split("PushedFilters")[1], \
            f"{name}: event_type filter not pushed: {line[:200]}"


def test_written_fact_prunes_partitions_and_sorts_by_cluster_keys(spark, tmp_path):
    import datetime as dt
    import os

    from pyspark.sql import functions as F

    from adcredit.sources.driver import Warehouse
    from adcredit.sources.sinks import apply_retention, current, read_fact, write_fact

    w = Warehouse.of(spark, SF_SMALL)
    path = str(tmp_path / "fact_events")
    write_fact(w.fact_events, "fact_events", path, "overwrite")
    table, path = path, current(spark, path)
    days = [d for d in os.listdir(path) if d.startswith("event_date=")]
    assert len(days) == 30
    import pyarrow.parquet as pq
    read = 0
    for d in days[:5]:
        for folder, _, names in os.walk(os.path.join(path, d)):
            for f in (n for n in names if n.endswith(".parquet")):
                read += 1
                t = pq.ParquetFile(os.path.join(folder, f)).read(columns=["campaign_id", "customer_id"])
                keys = [(c is not None, c or "", u or "") for c, u in
                        zip(t["campaign_id"].to_pylist(), t["customer_id"].to_pylist())]
                assert keys == sorted(keys)   # nulls first, then cluster-key order
    assert read >= 5
    ev = read_fact(spark, "fact_events", table)
    kept = apply_retention(ev, "event_date", dt.date(2024, 7, 10))   # cutoff 2024-01-12
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters")[1]
    assert kept.count() == w.fact_events.filter(F.col("event_date") >= dt.date(2024, 1, 12)).count()
    one = ev.filter((F.col("event_date") == dt.date(2024, 1, 5)) & (F.col("campaign_id") == "camp_03"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "campaign_id" in plan.split("PushedFilters")[1].split("]")[0]


def test_keyset_bound_is_pushed_and_prunes(spark, tmp_path):
    import datetime as dt

    from adcredit.operators import drilldown
    from adcredit.sources.driver import Warehouse
    from adcredit.sources.sinks import read_fact, write_fact

    path = str(tmp_path / "fact_orders")
    write_fact(Warehouse.of(spark, SF_SMALL).fact_orders, "fact_orders", path, "overwrite")
    orders = read_fact(spark, "fact_orders", path)
    by_value = drilldown.keyset_page(orders, "fact_orders", (50.0, "ord_5"), order_by="revenue")
    plan = by_value._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(revenue,50.0)" in plan
    by_day = drilldown.keyset_page(orders, "fact_orders", (dt.date(2024, 1, 9), "ord_5"),
                                   order_by="order_date")
    plan = by_day._jdf.queryExecution().executedPlan().toString()
    assert any("order_date" in part.split("]")[0] and "<= 2024-01-09" in part.split("]")[0]
               for part in plan.split("PartitionFilters: [")[1:])
    page = drilldown.keyset_page(orders.limit(0), "fact_orders", None, order_by="revenue")
    assert page.count() == 0
