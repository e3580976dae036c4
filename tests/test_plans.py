"""Physical-plan assertions: the plan shapes the design relies on."""

import re

import pytest

from signalmart.plans import registry
from tests.conftest import SF_SMALL, plan_text

PY_UDF = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.fixture(scope="module")
def q():
    return registry.QUERIES


def test_flagship_plan(spark, q):
    p = plan_text(q["daily_signals"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and ", Partial" in p      # top-1 per key before the shuffle
    assert "BroadcastHashJoin" in p                           # calendars / markets broadcast
    assert not any(u in p for u in PY_UDF)                    # no Python on the hot path
    # trailing avg + count share one window over market-days
    assert len(re.findall(r"avg\(arrivals", p)) >= 1
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_column_pruning_reaches_scan(spark, q):
    p = plan_text(q["daily_count"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    assert schemas and all("value" not in s and "props" not in s for s in schemas)


def test_scalar_subquery_and_top_k(spark, q):
    assert "Subquery" in plan_text(q["latest_snapshot"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan_text(q["top_recent"](spark, SF_SMALL))


def test_partition_filters(spark, q):
    from signalmart.plans.registry import PRUNE_FROM, PRUNE_TO
    files = q["partition_prune"](spark, SF_SMALL).inputFiles()
    days = {re.search(r"dt=([0-9-]+)", f)[1] for f in files}
    assert days and all(PRUNE_FROM <= d <= PRUNE_TO for d in days)
    # both bounds of the pull window and of the backfill week reach the scan
    for name in ("time_slice", "backfill_windows"):
        pushed = max(re.findall(r"PushedFilters: \[([^\n]*)\]", plan_text(q[name](spark, SF_SMALL))), key=len)
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed, (name, pushed)


def test_partial_aggregation(spark, q):
    p = plan_text(q["hourly_curve"](spark, SF_SMALL))
    assert p.count("HashAggregate") >= 2        # partial before the exchange, final after


def test_no_python_anywhere(spark, q):
    for name, fn in q.items():
        if name.startswith("stream_"):
            continue
        p = plan_text(fn(spark, SF_SMALL), "simple")
        assert not any(u in p for u in PY_UDF), name


def test_hot_key_holding_a_third_of_rows(spark):
    """One natural key landed ~10k times (a third of the input) next to 20k
    ordinary rows: the partial top-1 runs before the exchange, and the
    result keeps exactly one row per key with the freshest extraction."""
    from pyspark.sql import functions as F
    from signalmart.operators.dedupe import latest_per_key
    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("extracted")).repartition(8)
    out = latest_per_key(base, ["k"], ["extracted"])
    p = plan_text(out)
    assert "row_number(), 1, Partial" in p
    hot = out.filter("k = -1").collect()
    assert len(hot) == 1 and hot[0].extracted == 29997
    assert out.count() == 20001


def test_appended_files_are_seen_in_the_same_session(spark, tmp_dir):
    from signalmart.plans import landing
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.filter("event_id % 2 = 0").write.parquet(f"{tmp_dir}/events.parquet")
    n = registry.QUERIES["csv_roundtrip"](spark, tmp_dir).count()
    first = registry.gold(spark, tmp_dir).count()
    assert landing.landed_flights(spark, tmp_dir) == landing.landed_flights(spark, tmp_dir)
    events.filter("event_id % 2 = 1").write.mode("append").parquet(f"{tmp_dir}/events.parquet")
    assert n < registry.QUERIES["csv_roundtrip"](spark, tmp_dir).count() == events.count()
    assert registry.QUERIES["daily_count"](spark, tmp_dir).count() == registry.gold(spark, tmp_dir).count() >= first


def test_unknown_markets_stay_and_are_counted(spark, tmp_dir):
    from pyspark.sql import functions as F
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.withColumn("event_type", F.when(F.col("event_id") == 3, "other").otherwise(F.col("event_type"))) \
        .write.parquet(f"{tmp_dir}/events.parquet")
    assert registry.QUERIES["daily_count"](spark, tmp_dir).filter("market = 'other'").first().arrivals == 1
    bad = registry.QUERIES["dq_known_market"](spark, tmp_dir).first()
    assert (bad.bad_rows, bad.passed) == (1, False)
