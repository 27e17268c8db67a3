"""Every registered query against its DuckDB oracle (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from adcredit.plans import catalog
from conftest import SF_SMALL
from oracle_compare import compare, duck

SQL = dict(catalog.SQL)             # the optional text operators have their own tests
QUERIES = dict(catalog.QUERIES)
SLOW = {k for k in QUERIES if k.startswith("stream_") or k in ("jobs_end_to_end",)}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_sql_key_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["campaign_id", "metric_date", "spend"]
    assert df.count() > 0
    assert entry.entry(spark).schema == df.schema      # stable across calls


@pytest.mark.parametrize("name", sorted(k for k in SQL if k not in SLOW))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL) == []


@pytest.mark.parametrize("name", sorted(k for k in SQL if k in SLOW))
def test_write_and_stream_queries_match_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL) == []
