"""Payload records, landing by pull, the catalog table, bucketed silver, the
model graph and the digest outbox."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.__main__ import main
from signalmart.operators import alerts as A
from signalmart.operators import quality as Q
from signalmart.operators.dedupe import latest_per_key
from signalmart.plans import landing, models, registry
from signalmart.sources import bucketed, pulls
from signalmart.sources import payloads as P
from signalmart.sources.raw import read_raw
from tests.conftest import SF_SMALL, plan_text, rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


# ---- payload records -------------------------------------------------------
def _reasons(df):
    return sorted((r.reason or "row") for r in df.collect())


def test_every_arrival_record_is_a_row_or_has_a_reason(spark):
    docs = [
        ([{"lastSeen": "17x", "icao24": "a"}, {"lastSeen": 1700000000, "icao24": "b"}], ["lastSeen is no number", "row"]),
        ([{"lastSeen": 1700000000.9, "icao24": 7}, {"lastSeen": 0}, {"lastSeen": None}, {}], ["no time"] * 3 + ["row"]),
        ([None, 5, "x", [1]], ["record is no object"] * 4),
        ([{"lastSeen": True}, {"lastSeen": {"a": 1}}, {"lastSeen": [1]}, {"lastSeen": "1700000000"}], ["lastSeen is no number"] * 4),
        ([{"lastSeen": 1e30}, {"lastSeen": -1e30}, {"lastSeen": 9e15}], ["lastSeen is out of range"] * 3),
        ([{"lastSeen": 1700000000, "callsign": {"q": 1}}, {"lastSeen": 1700000000, "icao24": [1]}],
         ["callsign is no text", "icao24 is no text"]),
        ([], []),
        ({"states": []}, ["malformed document: not an array of records"]),
    ]
    texts = [json.dumps(d) for d, _ in docs] + ["[{", "null", "[] []", "[{\"lastSeen\": 1}] x", "", "  "]
    want = [r for _, r in docs] + [["malformed document"], ["malformed document: not an array of records"],
                                   ["malformed document: text behind its end"], ["malformed document: text behind its end"], [], []]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "extraction_id int, payload string")
    got = P.arrival_records(df, "payload", F.lit("LAS"), F.lit("UTC"), F.lit("t"))
    for k, reasons in enumerate(want):
        assert _reasons(got.filter(F.col("extraction_id") == k)) == sorted(reasons), texts[k]
    assert rows(P.arrival_rows(df, "payload", F.lit("LAS"), F.lit("UTC"), F.lit("t")), "icao24") == [("7",), ("b",)]
    kept = got.filter("reason = 'lastSeen is no number' AND extraction_id = 0").first()
    assert json.loads(kept.record) == {"icao24": "a", "lastSeen": "17x"}


def test_every_weather_hour_is_a_row_or_has_a_reason(spark):
    hourly = {"time": ["2026-08-06T14:00", None, "x", "2026-08-06T15:00", "2026-13-45T99:00", "2026-08-06T16:00", 5],
              "temperature_2m": [90.5, 1, 1, "hot", 1, None], "precipitation": None}
    bad_array = {"time": ["2026-08-06T14:00"], "wind_speed_10m": {"a": 1}}
    texts = [json.dumps({"hourly": hourly}), json.dumps({"hourly": bad_array}), json.dumps({"hourly": {"time": []}}),
             json.dumps({"hourly": 5}), "{}", "{\"hourly\""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "extraction_id int, payload string")
    got = P.weather_records(df, "payload", F.lit("LAS"), F.lit("t"))
    time = "time is no ISO time"
    no_array = "malformed document: no array hourly.time"
    want = [["row", "row", "no time", time, time, time, "temperature_2m is no number"],
            ["malformed document: wind_speed_10m is no array"], [], [no_array], [no_array], ["malformed document"]]
    for k, reasons in enumerate(want):
        assert _reasons(got.filter(F.col("extraction_id") == k)) == sorted(reasons), texts[k]
    assert rows(P.weather_rows(df, "payload", F.lit("LAS"), F.lit("t")), "hour_local", "temp_f", "precip_mm") == [
        ("14", "90.5", None), ("16", None, None)]


def _pull(root, market, name, records):
    _write(f"{root}/{market}/{name}.json", json.dumps(records) + "\n")


def _record(day, who="a"):
    return {"lastSeen": 1786000000 + day * 86400, "icao24": who}


@pytest.fixture
def feed(tmp_dir):
    _write(f"{tmp_dir}/markets.csv", "market,icao,name,lat,lon,tz\nLAS,KLAS,Las Vegas,36.08,-115.15,UTC\n")
    return tmp_dir


def _normalize(spark, root, payloads):
    return main(["normalize", "--kind", "arrivals", "--payloads", f"{root}/{payloads}", "--markets", f"{root}/markets.csv",
                 "--out", f"{root}/raw"], spark)


def test_rejects_belong_to_their_pull(spark, feed, capsys):
    one, two = "pull_20260806T150000", "pull_20260807T150000"
    _pull(f"{feed}/p1", "LAS", one, [_record(0), {"lastSeen": "17x"}, {}])
    _pull(f"{feed}/p1", "XXX", one, [_record(0)])
    assert _normalize(spark, feed, "p1") == 0
    said = capsys.readouterr().out
    assert "1 records left out: lastSeen is no number" in said and "1 documents left out: unknown market" in said
    assert "1 rows landed, 1 records have no time, 2 left out" in said
    _pull(f"{feed}/p2", "LAS", two, [_record(1), {"lastSeen": "18x"}])
    assert _normalize(spark, feed, "p2") == 0
    rejects = lambda: sorted(r.pull for r in spark.read.parquet(f"{feed}/raw_rejects").collect())
    assert rejects() == [f"LAS-{one}_json", f"LAS-{two}_json", f"XXX-{one}_json"]       # the first run's stay
    _pull(f"{feed}/p1", "LAS", one, [_record(0)])                                        # mended at the source
    assert _normalize(spark, feed, "p1") == 0
    assert rejects() == [f"LAS-{two}_json", f"XXX-{one}_json"]


def test_a_repeated_pull_with_a_day_less_leaves_none_of_its_rows(spark, feed):
    name = "pull_20260806T150000"
    _pull(f"{feed}/p", "LAS", name, [_record(d, f"a{d}") for d in range(4)])
    _pull(f"{feed}/p", "LAS", "pull_20260806T160000", [_record(1, "other")])
    _normalize(spark, feed, "p")
    who = lambda df: [r[0] for r in rows(df, "icao24")]
    assert who(pulls.read_pulls(spark, f"{feed}/raw", S.RAW_FLIGHTS_SCHEMA)) == ["a0", "a1", "a2", "a3", "other"]
    _pull(f"{feed}/p", "LAS", name, [_record(0, "a0"), _record(2, "a2")])
    _normalize(spark, feed, "p")
    assert who(pulls.read_pulls(spark, f"{feed}/raw", S.RAW_FLIGHTS_SCHEMA)) == ["a0", "a2", "other"]
    assert who(read_raw(spark, f"{feed}/raw", S.RAW_FLIGHTS_SCHEMA)) == ["a0", "a2", "other"]
    _pull(f"{feed}/p", "LAS", name, [])                                                  # nothing at all is left
    _normalize(spark, feed, "p")
    assert who(pulls.read_pulls(spark, f"{feed}/raw", S.RAW_FLIGHTS_SCHEMA)) == ["other"]


def test_a_landing_that_dies_leaves_the_earlier_one(spark, tmp_dir, monkeypatch):
    cols = S.FLIGHTS_COLUMNS
    row = lambda who: spark.createDataFrame([("LAS", who, "", "", "", "2026-08-01", "1", "t", "2026-08-01", "p1")],
                                            [*cols, "dt", "pull"])
    pulls.land_pulls(row("old"), f"{tmp_dir}/raw", cols)
    with monkeypatch.context() as m:
        m.setattr(pulls, "_manifest_path", lambda root: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            pulls.land_pulls(row("new"), f"{tmp_dir}/raw", cols)
    assert rows(pulls.read_pulls(spark, f"{tmp_dir}/raw", S.PLAIN_FLIGHTS_SCHEMA), "icao24") == [("old",)]
    pulls.land_pulls(row("newer"), f"{tmp_dir}/raw", cols)
    assert rows(pulls.read_pulls(spark, f"{tmp_dir}/raw", S.PLAIN_FLIGHTS_SCHEMA), "icao24") == [("newer",)]
    assert pulls.read_pulls(spark, f"{tmp_dir}/none", S.PLAIN_FLIGHTS_SCHEMA).count() == 0


def test_the_manifest_is_compacted(spark, tmp_dir, monkeypatch):
    cols = S.FLIGHTS_COLUMNS
    monkeypatch.setattr(pulls, "MANIFEST_FILES", 3)
    for k in range(6):
        df = spark.createDataFrame([("LAS", f"a{k}", "", "", "", "d", "1", "t", f"2026-08-0{1 + k % 2}", f"p{k % 3}")],
                                   [*cols, "dt", "pull"])
        pulls.land_pulls(df, f"{tmp_dir}/raw", cols)
    assert len(glob.glob(f"{tmp_dir}/raw/_manifest/*.parquet")) <= 3
    assert rows(pulls.read_pulls(spark, f"{tmp_dir}/raw", S.PLAIN_FLIGHTS_SCHEMA), "icao24") == [("a3",), ("a4",), ("a5",)]


# ---- catalog table ---------------------------------------------------------
def test_partitions_come_from_the_catalog(spark, tmp_dir):
    cols = S.FLIGHTS_COLUMNS
    def land(days, pull):
        pulls.land_pulls(spark.createDataFrame(
            [("LAS", "a", "", "", "", d, "1", "t", d, pull) for d in days], [*cols, "dt", "pull"]), f"{tmp_dir}/raw", cols)
    land([f"2026-08-{d:02}" for d in range(1, 11)], "p1")
    table = pulls.catalog_table(spark, "raw_by_catalog", f"{tmp_dir}/raw", S.PLAIN_FLIGHTS_SCHEMA)
    days = table.filter("dt BETWEEN '2026-08-03' AND '2026-08-04'")
    assert rows(days, "dt") == [("2026-08-03",), ("2026-08-04",)]
    plan = plan_text(days)
    assert "CatalogFileIndex" in plan or "PrunedInMemoryFileIndex" in plan or "PartitionFilters" in plan
    # a folder that no manifest row names is not there for the table
    _write(f"{tmp_dir}/raw/dt=2026-08-03/pull=p9/landing=x/f.csv", "LAS,stray,,,,,,\n")
    assert rows(spark.table("raw_by_catalog").filter("dt = '2026-08-03'"), "icao24") == [("a",)]
    assert spark.table("raw_by_catalog").filter("dt = '2026-08-03'").inputFiles()[0].count("landing=") == 1
    land(["2026-08-03"], "p2")
    land(["2026-08-01"], "p1")                                                           # the pull again, nine days less
    table = pulls.catalog_table(spark, "raw_by_catalog", f"{tmp_dir}/raw", S.PLAIN_FLIGHTS_SCHEMA)
    assert rows(table, "dt", "pull") == [("2026-08-01", "p1"), ("2026-08-03", "p2")]
    spark.sql("DROP TABLE raw_by_catalog")


# ---- bucketed silver -------------------------------------------------------
def _below(plan, node):
    """The part of a plan that stands below a node's line."""
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if node in line)
    return "\n".join(lines[at + 1:])


def test_work_on_the_natural_key_needs_no_exchange(spark, tmp_dir):
    path, keys = f"{tmp_dir}/silver", ["market", "icao24"]
    df = spark.range(5000).selectExpr("concat('m', id % 3) AS market", "cast(id AS string) AS icao24", "id AS x")
    bucketed.write(latest_per_key(df, keys, ["x"]), "silver_bucketed", path, keys, 4)
    assert len(glob.glob(f"{path}/*.parquet")) == 4                                     # one file per bucket
    spark.sql("DROP TABLE silver_bucketed")
    table = bucketed.attach(spark, "silver_again", path, keys)                           # another session's catalog
    check = Q.unique(table, keys, "silver")
    assert check.first().passed
    plan = plan_text(check, "simple")
    assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan_text(check)
    fresh = table.unionByName(table.filter("x % 2 = 0").withColumn("x", F.col("x") + 100_000))
    merged = latest_per_key(fresh, keys, ["x"])
    assert "Exchange" not in plan_text(merged, "simple") and merged.count() == 5000
    assert merged.filter("x >= 100000").count() == 2500
    spark.sql("DROP TABLE silver_again")


def test_built_silver_is_checked_without_an_exchange(spark):
    plan = plan_text(registry.QUERIES["bucketed_unique"](spark, SF_SMALL), "simple")
    assert "Exchange hashpartitioning" not in plan
    plan = plan_text(registry.QUERIES["bucketed_merge"](spark, SF_SMALL), "simple")
    assert "Exchange" not in _below(plan, "Window ")
    assert landing.bucketed_flights(spark, SF_SMALL).count() > 0


def test_buckets_follow_the_input(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.csv", "x" * 1000)
    slots = spark.sparkContext.defaultParallelism
    assert bucketed.buckets_for(spark, f"{tmp_dir}/in") == slots
    assert bucketed.buckets_for(spark, f"{tmp_dir}/in", bucket_bytes=10) == 100


# ---- model graph -----------------------------------------------------------
def test_models_stand_behind_their_inputs():
    assert models.order(["mart_hourly_curve"]) == ["raw_flights", "stg_flights", "mart_hourly_curve"]
    every = models.order(["mart_alerts", "mart_hourly_curve"])
    assert set(every) == set(models.MODELS)
    for name in every:
        assert all(every.index(i) < every.index(name) for i in models.MODELS[name].inputs)
    loop = {"a": models.Model("a", "view", ("b",)), "b": models.Model("b", "view", ("a",))}
    with pytest.raises(ValueError, match="a -> b -> a"):
        models.order(["a"], loop)
    with pytest.raises(ValueError, match="nothing is no model"):
        models.order(["nothing"])


def test_one_mart_builds_what_it_needs_and_nothing_else(spark, tmp_dir):
    root, db = landing.landed_flights(spark, SF_SMALL), "models_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    with pytest.raises(ValueError, match="source models_test.raw_flights is not there"):
        models.build(spark, ["mart_hourly_curve"], db, f"{tmp_dir}/m")
    pulls.catalog_table(spark, f"{db}.raw_flights", root, S.RAW_FLIGHTS_SCHEMA)
    assert models.build(spark, ["mart_hourly_curve"], db, f"{tmp_dir}/m") == ["stg_flights", "mart_hourly_curve"]
    assert {t.name for t in spark.catalog.listTables(db) if not t.isTemporary} == {"raw_flights", "stg_flights", "mart_hourly_curve"}
    first = rows(spark.table(f"{db}.mart_hourly_curve"))
    assert models.build(spark, ["mart_hourly_curve"], db, f"{tmp_dir}/m") == ["stg_flights", "mart_hourly_curve"]
    assert rows(spark.table(f"{db}.mart_hourly_curve")) == first                        # replaced by an equal version
    pulls.catalog_table(spark, f"{db}.raw_weather", landing.landed_weather(spark, SF_SMALL), S.RAW_WEATHER_SCHEMA)
    for name, seed in (("seed_calendar_events", registry._calendar(spark)), ("seed_holidays", registry._holidays(spark))):
        seed.write.mode("overwrite").option("path", f"{tmp_dir}/{name}").saveAsTable(f"{db}.{name}")
    assert models.build(spark, ["mart_alerts"], db, f"{tmp_dir}/m") == [
        "stg_flights", "stg_weather", "mart_daily_signals", "mart_alerts"]
    want = registry.QUERIES["daily_signals"](spark, SF_SMALL)
    assert rows(spark.table(f"{db}.mart_daily_signals"), *S.DAILY_COLUMNS) == rows(want, *S.DAILY_COLUMNS)
    spark.sql(f"DROP DATABASE {db} CASCADE")


# ---- digest outbox ---------------------------------------------------------
def test_a_digest_is_told_once_until_it_changes(spark):
    import datetime as dt
    kind = "arrival_date_local date, markets long, high_markets long, subject string, digest string"
    day = lambda d, text: (dt.date(2026, 8, d), 1, 0, "s", text)
    first = spark.createDataFrame([day(1, "a"), day(2, "b")], kind)
    sent = A.sent_rows(first)
    assert A.unsent(first, sent).count() == 0 and A.unsent(first, sent.limit(0)).count() == 2
    later = spark.createDataFrame([day(1, "a"), day(2, "B"), day(3, "c")], kind)
    assert rows(A.unsent(later, sent), "digest") == [("B",), ("c",)]
