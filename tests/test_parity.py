"""Every registered query against its DuckDB oracle (row count, column
names, order-free multiset of values) on the smallest dataset."""

import pytest

import __spark_entry__ as E
from signalmart.plans import registry
from tests.conftest import SF_SMALL
from tools.parity import compare, duck

QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_SMALL, con)
    assert r.get("cols_match"), r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r.get("exact"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 21


@pytest.mark.parametrize("name", ["local_time", "daily_signals", "backfill_windows",
                                  "time_slice", "stream_tumbling", "csv_roundtrip"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    from signalmart.session import session_conf
    with session_conf(spark, spark__sql__session__timeZone="America/New_York"):
        r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert r.get("exact") and r["spark_rows"] == r["oracle_rows"], r
