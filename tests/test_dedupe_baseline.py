"""Freshest-wins dedupe and the trailing baseline (FIXTURES §2, cases 1-2, 8-12)."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalmart.operators.baseline import pct_vs_baseline, trailing_baseline
from signalmart.operators.dedupe import key_copy_counts, latest_per_key
from tests.conftest import rows

T = dt.datetime


def test_freshest_extraction_wins(spark):
    df = spark.createDataFrame([
        ("LAS", "a1", T(2026, 8, 13, 9), T(2026, 8, 13, 10), 1, "old"),
        ("LAS", "a1", T(2026, 8, 13, 9), T(2026, 8, 13, 11), 2, "new"),
        ("LAS", "b2", T(2026, 8, 13, 9), T(2026, 8, 13, 10), 3, "only"),
    ], "market string, icao24 string, ts timestamp_ntz, extracted timestamp_ntz, id int, v string")
    out = latest_per_key(df, ["market", "icao24", "ts"], ["extracted", "id"])
    assert rows(out, "icao24", "v") == [("a1", "new"), ("b2", "only")]


def test_tie_break_is_stable_under_shuffle(spark):
    base = [("K", T(2026, 1, 1, 5), i, f"v{i}") for i in range(20)]
    results = set()
    for seed in range(3):
        data = base[:]
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, extracted timestamp_ntz, id int, v string") \
            .repartition(5)
        results.add(tuple(rows(latest_per_key(df, ["k"], ["extracted", "id"]), "v")))
    assert results == {(("v19",),)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 10**6)),
                min_size=1, max_size=40, unique_by=lambda t: t[2]))
def test_dedupe_properties(spark, data):
    df = spark.createDataFrame(data, "k int, ts int, id int")
    once = latest_per_key(df, ["k"], ["ts", "id"])
    twice = latest_per_key(once, ["k"], ["ts", "id"])
    assert rows(once) == rows(twice)  # idempotent
    expect = {}
    for k, ts, i in data:
        if k not in expect or (ts, i) > expect[k][1:]:
            expect[k] = (k, ts, i)
    assert rows(once) == sorted(expect.values())
    c = key_copy_counts(df, ["k"]).first()
    assert (c.bronze_rows, c.silver_rows) == (len(data), len(expect))


def _daily(spark, counts, start=dt.date(2026, 8, 1), skip=()):
    data, d = [], start
    for n in counts:
        while d in skip:
            d += dt.timedelta(days=1)
        data.append(("LAS", d, n))
        d += dt.timedelta(days=1)
    return spark.createDataFrame(data, "market string, day date, arrivals long")


def test_first_day_has_no_baseline(spark):
    out = trailing_baseline(_daily(spark, [10, 12]), ["market"], "day", "arrivals") \
        .withColumn("pct", pct_vs_baseline("arrivals", "trailing_7day_avg")).orderBy("day")
    first, second = out.collect()
    assert first.trailing_7day_avg is None and first.pct is None and first.days_in_window == 0
    assert second.trailing_7day_avg == 10.0 and second.pct == 20.0


def test_window_excludes_current_row_and_counts_rows(spark):
    out = trailing_baseline(_daily(spark, list(range(1, 10))), ["market"], "day", "arrivals")
    r = {x.arrivals: x for x in out.collect()}
    assert r[8].days_in_window == 7 and r[8].trailing_7day_avg == sum(range(1, 8)) / 7
    assert r[9].trailing_7day_avg == sum(range(2, 9)) / 7  # current row never included


def test_missing_day_stretches_window(spark):
    skip = {dt.date(2026, 8, 4)}
    out = trailing_baseline(_daily(spark, list(range(1, 10)), skip=skip),
                            ["market"], "day", "arrivals")
    r = {x.arrivals: x for x in out.collect()}
    # 8 observed days before the 9th value; the frame spans 8 calendar days
    assert r[9].days_in_window == 7
    assert r[9].trailing_7day_avg == sum(range(2, 9)) / 7


def test_pct_rounding_on_decimal_form(spark):
    df = spark.createDataFrame([(11995, 10000.0), (10994, 10000.0), (10995, 10000.0),
                                (5, 0.0)], "n long, avg double")
    out = [r.p for r in df.select(pct_vs_baseline("n", "avg").alias("p")).collect()]
    assert out == [20.0, 9.9, 10.0, None]
    assert [r.v for r in spark.createDataFrame([(19.95,), (9.95,)], "x double")
            .select(F.round("x", 1).alias("v")).collect()] == [20.0, 10.0]
