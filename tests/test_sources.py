"""Raw CSV landing/reading, seeds and payload parsing (FIXTURES §2, 3-7, 27-29)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.functions.columns import clean_code
from signalmart.sources import payloads as P
from signalmart.sources.raw import (land_raw, local_table, read_partitioned, read_raw,
                                    read_seed, reject_counts, typed_projection)
from tests.conftest import plan_text, rows

LINE = "LAS,a1b2c3,{cs},{dep},2026-08-13 16:05:00,2026-08-13,9,2026-08-13 17:00:00"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        fh.write(text)


def test_crlf_and_blank_fields(spark, tmp_dir):
    _write(f"{tmp_dir}/raw/dt=2026-08-13/a.csv",
           LINE.format(cs="  ", dep="") + "\r\n" + LINE.format(cs='" AB1 "', dep='""') + "\r\n")
    raw = read_raw(spark, f"{tmp_dir}/raw/dt=*/*.csv", S.RAW_FLIGHTS_SCHEMA)
    typed = typed_projection(raw, S.FLIGHTS_TYPES, keep=("dt",))
    got = rows(typed, "callsign", "departure_airport", "arrival_hour_local", "dt")
    assert got == [(None, None, 9, "2026-08-13"), ("AB1", None, 9, "2026-08-13")]
    assert typed.schema["arrival_ts_utc"].dataType.simpleString() == "timestamp_ntz"


def test_malformed_number_raises_or_is_tolerated(spark, tmp_dir):
    _write(f"{tmp_dir}/w/dt=2026-08-13/a.csv",
           "LAS,2026-08-13 10:00:00,2026-08-13,10,abc,0.1,5,2026-08-13 11:00:00\n")
    raw = read_raw(spark, f"{tmp_dir}/w/dt=*/*.csv", S.RAW_WEATHER_SCHEMA)
    with pytest.raises(Exception):
        typed_projection(raw, S.WEATHER_TYPES).collect()
    r = typed_projection(raw, S.WEATHER_TYPES, tolerant=True).first()
    assert r.temp_f is None and r.precip_mm == 0.1
    rej = reject_counts(raw, S.WEATHER_TYPES).first()
    assert rej.temp_f == 1 and rej.precip_mm == 0 and rej.observed_at_local == 0


def test_landing_is_idempotent_and_prunes(spark, tmp_dir):
    df = spark.createDataFrame(
        [("LAS", "a", "", "", "2026-08-1%d 10:00:00" % d, "2026-08-1%d" % d, "3",
          "2026-08-1%d 11:00:00" % d, "2026-08-1%d" % d) for d in (1, 2, 3)],
        S.FLIGHTS_COLUMNS + ["dt"])
    path = f"{tmp_dir}/landed"
    land_raw(df, path, S.FLIGHTS_COLUMNS)
    from signalmart.session import session_conf
    with session_conf(spark, spark__sql__sources__partitionOverwriteMode="static"):
        # re-land one day; the other days survive whatever the session default
        land_raw(df.filter(F.col("dt") == "2026-08-12"), path, S.FLIGHTS_COLUMNS)
    full = read_partitioned(spark, path, S.PLAIN_FLIGHTS_SCHEMA)
    assert rows(full, "dt") == [("2026-08-11",), ("2026-08-12",), ("2026-08-13",)]
    pruned = read_partitioned(spark, path, S.PLAIN_FLIGHTS_SCHEMA, "2026-08-12", "2026-08-12")
    assert all("dt=2026-08-12" in f for f in pruned.inputFiles())
    assert pruned.count() == 1
    late = read_partitioned(spark, path, S.PLAIN_FLIGHTS_SCHEMA, "2026-08-12")
    assert "PartitionFilters: [isnotnull(dt" in plan_text(late) and late.count() == 2
    disc = read_raw(spark, path, S.PLAIN_FLIGHTS_SCHEMA, dt_from="discovery")
    assert rows(disc, "dt") == rows(full, "dt")


def test_seed_and_local_table(spark, tmp_dir):
    _write(f"{tmp_dir}/holidays.csv", "holiday_date,holiday_name\n2026-01-01,New Year's Day\n")
    seed = read_seed(spark, f"{tmp_dir}/holidays.csv", S.HOLIDAYS_DDL)
    lit = local_table(spark, [(__import__("datetime").date(2026, 1, 1), "New Year's Day")],
                      S.HOLIDAYS_DDL)
    assert rows(seed) == rows(lit)


def test_arrival_payload_rows(spark):
    doc = json.dumps([
        {"lastSeen": 1783987500, "icao24": "a1", "callsign": " AB,1 ", "estDepartureAirport": "KSFO"},
        {"lastSeen": None, "icao24": "a2"},
        {"lastSeen": 0, "icao24": "a3"},
        {"icao24": "a4"},
        {"lastSeen": 1783920600, "icao24": "a5"},   # 2026-07-13 05:30Z -> previous local day
    ])
    docs = spark.createDataFrame([(doc, "LAS", "America/Los_Angeles", "2026-07-13 06:00:00")],
                                 "payload string, market string, tz string, ex string")
    out = {r.icao24: r for r in P.arrival_rows(docs, "payload", "market", "tz", "ex").collect()}
    assert set(out) == {"a1", "a5"}
    assert out["a1"].callsign == "AB1" and out["a1"].departure_airport == "KSFO"
    assert out["a5"].arrival_date_local == "2026-07-12" and out["a5"].arrival_hour_local == "22"
    assert out["a5"].callsign == "" and out["a5"].arrival_ts_utc == "2026-07-13 05:30:00"


def test_autumn_dst_keeps_both_arrivals(spark):
    # 2026-11-01 08:30Z and 09:30Z are both 01:30 in Los Angeles
    doc = json.dumps([{"lastSeen": 1793521800, "icao24": "x"},
                      {"lastSeen": 1793525400, "icao24": "x"}])
    docs = spark.createDataFrame([(doc, "LAX", "America/Los_Angeles", "t")],
                                 "payload string, market string, tz string, ex string")
    out = P.arrival_rows(docs, "payload", "market", "tz", "ex")
    got = rows(out, "arrival_ts_utc", "arrival_hour_local")
    assert got == [("2026-11-01 08:30:00", "1"), ("2026-11-01 09:30:00", "1")]


def test_weather_payload_parallel_arrays(spark):
    doc = json.dumps({"hourly": {"time": ["2026-07-17T13:00", "2026-07-17T14:00"],
                                 "temperature_2m": [101.2, 103.0],
                                 "precipitation": [0.0, None],
                                 "wind_speed_10m": [12.5, 14.0]}})
    docs = spark.createDataFrame([(doc, "LAS", "2026-07-17 21:00:00")],
                                 "payload string, market string, ex string")
    types = {c: t for c, t in S.WEATHER_TYPES.items() if c != "extraction_id"}
    out = typed_projection(P.weather_rows(docs, "payload", "market", "ex"), types)
    got = rows(out, "observed_date_local", "hour_local", "temp_f", "precip_mm")
    import datetime as dt
    assert got == [(dt.date(2026, 7, 17), 13, 101.2, 0.0), (dt.date(2026, 7, 17), 14, 103.0, None)]


def test_payload_files_read_as_json_lines(spark, tmp_dir):
    docs = [json.dumps([{"lastSeen": 1783987500 + i, "icao24": f"a{i}"}]) for i in range(3)]
    _write(f"{tmp_dir}/landing/LAS/pull_1.json", "\n".join(docs) + "\n")
    lines = P.read_json_lines(spark, f"{tmp_dir}/landing")
    lines = lines.withColumn("market", F.regexp_extract("source_file", r"/landing/(\w+)/", 1))
    out = P.arrival_rows(lines, "payload", "market", F.lit("America/Los_Angeles"),
                         F.lit("2026-07-13 06:00:00"))
    assert rows(out, "market", "icao24") == [("LAS", "a0"), ("LAS", "a1"), ("LAS", "a2")]


def test_work_dirs_share_one_checkpoint_root(spark):
    from signalmart.session import checkpoint_root, work_dir
    root = checkpoint_root(spark)
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0] == root.rstrip("/")
    assert checkpoint_root(spark) == root


def test_landing_bounds_files_per_day(spark, tmp_dir):
    """Sixteen writing tasks, three quarters of the rows on one day: files per
    day follow the target size, not the number of tasks."""
    import glob
    from signalmart.session import session_conf
    df = spark.range(40000, numPartitions=16).select(
        *[F.sha2(F.concat(F.lit(c), F.col("id")), 256).alias(c) for c in S.FLIGHTS_COLUMNS[:-1]],
        F.col("id").cast("string").alias("extracted_at_utc"),
        F.when(F.col("id") < 30000, "2026-08-01").otherwise("2026-08-02").alias("dt"))
    land_raw(df, f"{tmp_dir}/plain", S.FLIGHTS_COLUMNS)
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="4m"):
        land_raw(df.repartition(16), f"{tmp_dir}/small", S.FLIGHTS_COLUMNS)
    per_day = lambda p: [len(glob.glob(f"{p}/dt={d}/*.csv")) for d in ("2026-08-01", "2026-08-02")]
    assert per_day(f"{tmp_dir}/plain") == [1, 1]
    assert 2 <= per_day(f"{tmp_dir}/small")[0] <= 8 and per_day(f"{tmp_dir}/small")[1] <= 4
    back = read_partitioned(spark, f"{tmp_dir}/small", S.PLAIN_FLIGHTS_SCHEMA)
    assert back.count() == 40000                       # nothing dropped


def test_named_days_alone_are_indexed(spark, tmp_dir):
    for day in range(1, 10):
        _write(f"{tmp_dir}/raw/dt=2026-08-0{day}/a.csv", "LAS,x,,,,,,,\n")
    week = read_partitioned(spark, f"{tmp_dir}/raw", S.RAW_FLIGHTS_SCHEMA, "2026-08-03", "2026-08-05")
    assert [f.rsplit("/", 2)[1] for f in sorted(week.inputFiles())] == [f"dt=2026-08-0{d}" for d in (3, 4, 5)]
    assert rows(week, "dt") == [(f"2026-08-0{d}",) for d in (3, 4, 5)]
    assert read_partitioned(spark, f"{tmp_dir}/raw", S.RAW_FLIGHTS_SCHEMA, "2025-01-01", "2025-01-02").count() == 0


def test_malformed_documents_are_set_aside(spark):
    good = json.dumps([{"lastSeen": 1700000000.5, "icao24": "a"}])
    docs = spark.createDataFrame([(good,), ("[{\"lastSeen\": 17",), ("nonsense",), ("",), (None,)], "payload string")
    assert P.rejects(docs, "payload", P.ARRIVALS_PAYLOAD).count() == 2
    rows_ = P.arrival_rows(docs, "payload", F.lit("LAS"), F.lit("UTC"), F.lit("t"))
    assert rows(rows_, "icao24", "arrival_ts_utc") == [("a", "2023-11-14 22:13:20")]  # a fraction is kept
    wx = spark.createDataFrame([("{\"hourly\": {\"time\": []}}",), ("{",), ("{}",)], "payload string")
    assert P.rejects(wx, "payload", P.WEATHER_PAYLOAD).count() == 2


def test_codes_lose_any_white_space(spark):
    df = spark.createDataFrame([("AB1\t",), ("\n C,D\u00a0",), (None,)], "c string")
    assert [r[0] for r in df.select(clean_code("c")).collect()] == ["AB1", "CD", ""]


def test_local_table_literals_round_trip(spark):
    import datetime as dt
    data = [(dt.date(2026, 1, 1), "New Year's Day"), (dt.date(2026, 2, 2), "a\\b 'c' \"d\""),
            (dt.date(2026, 3, 3), None)]
    got = rows(local_table(spark, data, S.HOLIDAYS_DDL))
    assert got == rows(spark.createDataFrame(data, S.HOLIDAYS_DDL))
