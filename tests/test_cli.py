"""The command line on a small landed fixture: normalize -> build -> check -> alert."""

import json
import os

from signalmart import schemas as S
from signalmart.__main__ import main
from signalmart.operators.dedupe import latest_per_key
from signalmart.plans import incremental
from signalmart.sources.raw import read_raw, typed_projection
from tests.conftest import rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_cli_daily_run(spark, tmp_dir, capsys):
    base = 1786000000  # 2026-08-06 UTC
    for day in range(9):
        recs = [{"lastSeen": base + day * 86400 + i * 60, "icao24": f"a{i}",
                 "callsign": f" CS{i} ", "estDepartureAirport": "KSFO"}
                for i in range(10 + (8 if day == 8 else 0))]
        _write(f"{tmp_dir}/payloads/flights/LAS/pull_{day}.json", json.dumps(recs) + "\n")
        wx = {"hourly": {"time": [f"2026-08-{6 + day:02d}T{h:02d}:00" for h in range(24)],
                         "temperature_2m": [90.0 + h for h in range(24)],
                         "precipitation": [0.1] * 24, "wind_speed_10m": [10.0] * 24}}
        _write(f"{tmp_dir}/payloads/weather/LAS/pull_{day}.json", json.dumps(wx) + "\n")
    _write(f"{tmp_dir}/seeds/markets.csv",
           "market,icao,name,lat,lon,tz\nLAS,KLAS,Las Vegas,36.08,-115.15,America/Los_Angeles\n")
    _write(f"{tmp_dir}/seeds/events.csv", "market,event_date,event_name,weight\n"
                                          "LAS,2026-08-13,Expo,1\n")
    _write(f"{tmp_dir}/seeds/holidays.csv", "holiday_date,holiday_name\n")
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/warehouse"
    assert main(["normalize", "--kind", "arrivals", "--payloads", f"{tmp_dir}/payloads/flights",
                 "--markets", f"{tmp_dir}/seeds/markets.csv", "--out", f"{raw}/flights"],
                spark) == 0
    assert main(["normalize", "--kind", "weather", "--payloads", f"{tmp_dir}/payloads/weather",
                 "--out", f"{raw}/weather"], spark) == 0
    assert main(["build", "--flights", f"{raw}/flights", "--weather", f"{raw}/weather",
                 "--events", f"{tmp_dir}/seeds/events.csv",
                 "--holidays", f"{tmp_dir}/seeds/holidays.csv", "--out", out], spark) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["bronze_flights"] == 98 and counts["flights_duplicates_removed"] == 0
    assert main(["check", "--out", out], spark) == 0
    capsys.readouterr()
    assert main(["alert", "--out", out], spark) == 0
    text = capsys.readouterr().out
    assert "Demand signals for" in text and "LAS:" in text and "HIGH" in text
    # landing the same pulls again adds nothing
    assert main(["normalize", "--kind", "arrivals", "--payloads", f"{tmp_dir}/payloads/flights",
                 "--markets", f"{tmp_dir}/seeds/markets.csv", "--out", f"{raw}/flights"],
                spark) == 0
    assert read_raw(spark, f"{raw}/flights", S.RAW_FLIGHTS_SCHEMA).count() == 98


def _pulls(tmp_dir, name, temp):
    wx = {"hourly": {"time": ["2026-08-06T14:00"], "temperature_2m": [temp],
                     "precipitation": [0.0], "wind_speed_10m": [10.0]}}
    _write(f"{tmp_dir}/payloads/weather/LAS/{name}", json.dumps(wx) + "\n")


def test_the_later_pull_wins_and_bad_documents_are_counted(spark, tmp_dir, capsys):
    _pulls(tmp_dir, "pull_20260805T140000.json", 112.0)     # a day-old forecast
    _pulls(tmp_dir, "pull_20260806T150000.json", 90.0)      # the observation
    _write(f"{tmp_dir}/payloads/weather/LAS/pull_20260806T160000.json", "{not json\n")
    run = ["normalize", "--kind", "weather", "--payloads", f"{tmp_dir}/payloads/weather",
           "--out", f"{tmp_dir}/raw"]
    assert main(run, spark) == 0 and main(run, spark) == 0
    assert "1 documents left out: malformed document" in capsys.readouterr().out
    raw = typed_projection(read_raw(spark, f"{tmp_dir}/raw", S.RAW_WEATHER_SCHEMA), S.WEATHER_TYPES)
    assert raw.count() == 2
    best = latest_per_key(raw, S.WEATHER_KEY, S.FRESHEST).first()
    assert best.temp_f == 90.0 and str(best.extracted_at_utc) == "2026-08-06 15:00:00"
    assert best.extraction_id == "LAS/pull_20260806T150000.json"


def test_payloads_of_unknown_markets_are_counted(spark, tmp_dir, capsys):
    _write(f"{tmp_dir}/markets.csv", "market,icao,name,lat,lon,tz\nLAS,KLAS,Las Vegas,36.08,-115.15,America/Los_Angeles\n")
    for m in ("LAS", "XXX"):
        _write(f"{tmp_dir}/p/{m}/pull_20260806T150000.json", json.dumps([{"lastSeen": 1786000000, "icao24": "a"}]) + "\n")
    assert main(["normalize", "--kind", "arrivals", "--payloads", f"{tmp_dir}/p", "--markets",
                 f"{tmp_dir}/markets.csv", "--out", f"{tmp_dir}/raw"], spark) == 0
    assert "1 documents left out: unknown market" in capsys.readouterr().out
    assert read_raw(spark, f"{tmp_dir}/raw", S.RAW_FLIGHTS_SCHEMA).count() == 1


def test_update_takes_new_files_only_and_equals_a_rebuild(spark, tmp_dir, capsys):
    import glob
    _write(f"{tmp_dir}/events.csv", "market,event_date,event_name,weight\n")
    _write(f"{tmp_dir}/holidays.csv", "holiday_date,holiday_name\n")
    raw = f"{tmp_dir}/raw"

    def land(day, name, n, stamp):
        lines = [f"LAS,k{i},CS,KSFO,2026-08-{day:02d} 20:0{i}:00,2026-08-{day:02d},13,2026-08-{day:02d} {stamp},"
                 for i in range(n)]
        _write(f"{raw}/flights/dt=2026-08-{day:02d}/{name}.csv", "\n".join(lines) + "\n")

    for day in range(1, 10):
        land(day, "a", 3, "21:00:00")
    _write(f"{raw}/weather/dt=2026-08-01/a.csv",
           "LAS,2026-08-01 13:00:00,2026-08-01,13,109.5,0.0,12.0,2026-08-01 21:00:00,\n")
    args = ["--flights", f"{raw}/flights", "--weather", f"{raw}/weather", "--events", f"{tmp_dir}/events.csv",
            "--holidays", f"{tmp_dir}/holidays.csv"]
    assert main(["update", *args, "--out", f"{tmp_dir}/inc"], spark) == 0
    before = set(glob.glob(f"{tmp_dir}/inc/silver_flights/data/dt=*/*/*"))
    land(9, "late", 5, "23:00:00")
    assert main(["update", *args, "--out", f"{tmp_dir}/inc"], spark) == 0
    new = set(glob.glob(f"{tmp_dir}/inc/silver_flights/data/dt=*/*/*")) - before
    assert len(new) == 1 and "dt=2026-08-09" in new.pop()      # one partition got a new version
    assert main(["build", *args, "--out", f"{tmp_dir}/full"], spark) == 0
    inc, full = (incremental.gold(spark, f"{tmp_dir}/{o}") for o in ("inc", "full"))
    assert rows(inc, *S.DAILY_COLUMNS) == rows(full, *S.DAILY_COLUMNS) and inc.count() == 9
    assert main(["check", "--out", f"{tmp_dir}/inc"], spark) == 0
