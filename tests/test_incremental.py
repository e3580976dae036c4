"""The incremental gold tables: equal to a rebuild, and only what a change
reaches is opened or written."""

import os
import random

import pytest
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.__main__ import main
from signalmart.plans import incremental, marts
from signalmart.streaming import versioned as V
from tests.conftest import rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


class Feed:
    """A raw zone on disk that grows file by file, and its seeds."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        self.seeds("market,event_date,event_name,weight\n", "holiday_date,holiday_name\n")
        self.weather("LAS", "2026-08-01", 70.0)

    def seeds(self, events, holidays):
        _write(f"{self.root}/events.csv", events)
        _write(f"{self.root}/holidays.csv", holidays)

    def flights(self, market, day, count, tag="k", stamp="21:00:00"):
        self.n += 1
        _write(f"{self.root}/raw/flights/dt={day}/f{self.n}.csv", "".join(
            f"{market},{tag}{i},CS,KSFO,{day} 20:{i:02}:00,{day},{13 + i % 3},{day} {stamp},\n" for i in range(count)))

    def weather(self, market, day, temp):
        self.n += 1
        _write(f"{self.root}/raw/weather/dt={day}/w{self.n}.csv",
               f"{market},{day} 13:00:00,{day},13,{temp},0.0,12.0,{day} 2{self.n % 4}:00:00,{self.n:06}\n")

    @property
    def args(self):
        r = self.root
        return ["--flights", f"{r}/raw/flights", "--weather", f"{r}/raw/weather", "--events", f"{r}/events.csv",
                "--holidays", f"{r}/holidays.csv", "--out", f"{r}/out"]

    def update(self):
        """The days that this run wrote, of each gold table."""
        was = {name: V.last_version(self.spark, f"{self.root}/out/{name}") for name in (incremental.DAILY, incremental.CURVE)}
        assert main(["update", *self.args], self.spark) == 0
        kind = incremental.rollup_kind("hourly_arrivals")
        return [sorted(r[0] for r in V.changed(self.spark, f"{self.root}/out/{name}", ["dt"], kind, v))
                for name, v in was.items()]

    def matches_a_rebuild(self):
        out = f"{self.root}/out"
        from signalmart.__main__ import _seeds
        whole = incremental.signals(self.spark, out, *_seeds(self.spark, f"{self.root}/events.csv", f"{self.root}/holidays.csv"))
        cols = [*S.DAILY_COLUMNS, "driver_points"]
        got = incremental.gold(self.spark, out)
        assert sorted(map(str, rows(got, *cols))) == sorted(map(str, rows(whole, *cols)))
        curve = marts.hourly_curve(incremental.silver(self.spark, out, "flights"))
        assert rows(incremental.gold(self.spark, out, incremental.CURVE), *S.HOURLY_COLUMNS) == rows(curve, *S.HOURLY_COLUMNS)


def _day(k):
    return f"2026-{8 + (k - 1) // 31:02}-{(k - 1) % 31 + 1:02}" if k <= 31 else f"2026-09-{k - 31:02}"


@pytest.fixture
def feed(spark, tmp_dir):
    f = Feed(spark, tmp_dir)
    for k in range(1, 21):
        f.flights("LAS", _day(k), 3 + k % 4)
        if k % 6 == 1:                      # a market seen every sixth day
            f.flights("SPA", _day(k), 2)
    return f


def test_a_late_day_reaches_seven_observed_days(feed, monkeypatch):
    daily, curve = feed.update()
    assert len(daily) == len(curve) == 20
    feed.matches_a_rebuild()
    feed.flights("LAS", _day(20), 9, "late", "23:00:00")
    opened = []
    load = V._load
    with monkeypatch.context() as m:
        m.setattr(V, "_load", lambda spark, table, schema, folders: (
            opened.extend(folders), load(spark, table, schema, folders))[1])
        assert feed.update() == [[_day(20)], [_day(20)]]
    days = lambda name: {f.split("/dt=")[1][:10] for f in opened if f"/{name}/" in f}
    assert days("hourly_arrivals") == {_day(k) for k in range(13, 21)}   # the baseline's days
    assert days(incremental.DAILY) == {_day(20)}
    # late rows for an old day, of a market seen every day and of one whose next days lie far behind
    feed.flights("LAS", _day(5), 9, "late", "23:00:00")
    feed.flights("SPA", _day(1), 4, "late", "23:00:00")
    daily, curve = feed.update()
    assert curve == [_day(1), _day(5)] and daily == [_day(k) for k in (*range(1, 14), 19)]
    feed.matches_a_rebuild()


def test_weather_and_calendars_reach_their_own_days(feed):
    feed.update()
    feed.weather("LAS", _day(20), 111.0)
    feed.seeds(f"market,event_date,event_name,weight\nLAS,{_day(9)},Expo,1\n", f"holiday_date,holiday_name\n{_day(15)},Rest\n")
    assert feed.update() == [[_day(9), _day(15), _day(20)], []]
    feed.matches_a_rebuild()
    feed.seeds("market,event_date,event_name,weight\n", f"holiday_date,holiday_name\n{_day(15)},Rest\n")
    assert feed.update() == [[_day(9)], []]                              # an event taken back
    feed.matches_a_rebuild()


def test_random_updates_and_rows_without_a_date_equal_a_rebuild(feed, spark):
    r = random.Random(5)
    _write(f"{feed.root}/raw/flights/dt={_day(3)}/odd.csv", f"LAS,zz,CS,KSFO,{_day(3)} 20:00:00,,,{_day(3)} 21:00:00,\n")
    feed.update()
    assert incremental.gold(spark, f"{feed.root}/out").filter("arrival_date_local IS NULL").count() == 1
    for _ in range(4):
        feed.flights(r.choice(["LAS", "SPA", "NEW"]), _day(r.randint(1, 24)), r.randint(1, 5), "s", "23:00:00")
    feed.weather("LAS", _day(r.randint(1, 20)), 60.0)
    feed.update()
    feed.matches_a_rebuild()
    assert feed.update() == [[], []]                                     # nothing new, nothing written


def test_a_run_that_dies_in_gold_leaves_the_old_rows(feed, spark, monkeypatch, capsys):
    feed.update()
    out = f"{feed.root}/out"
    before = rows(incremental.gold(spark, out), *S.DAILY_COLUMNS)
    feed.flights("LAS", _day(20), 20, "late", "23:00:00")
    whole = V.write
    with monkeypatch.context() as m:
        def die(df, table, cols, version):
            if table.endswith(incremental.DAILY):
                whole(df.limit(1), table, cols, version)                 # half written
                raise RuntimeError("killed")
            whole(df, table, cols, version)
        m.setattr(V, "write", die)
        with pytest.raises(RuntimeError):
            main(["update", *feed.args], spark)
    assert rows(incremental.gold(spark, out), *S.DAILY_COLUMNS) == before
    assert main(["alert", "--out", out], spark) == 0 and "LAS:" in capsys.readouterr().out
    daily, curve = feed.update()                                         # no new file, but work left over
    assert daily == curve == [_day(20)]
    feed.matches_a_rebuild()


def test_tidy_removes_what_no_reader_needs(feed, spark, capsys):
    feed.update()
    feed.flights("LAS", _day(20), 8, "late", "23:00:00")
    feed.update()
    assert main(["tidy", "--out", f"{feed.root}/out"], spark) == 0
    import json
    went = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert went["silver_flights"] == {"folders": 1, "commits": 2} and went[incremental.DAILY] == {"folders": 1, "commits": 2}
    feed.flights("LAS", _day(20), 9, "later", "23:30:00")
    assert feed.update() == [[_day(20)], [_day(20)]]
    feed.matches_a_rebuild()


def test_alerts_are_said_once_and_unknown_markets_fail_the_check(feed, spark, capsys):
    feed.update()
    out = f"{feed.root}/out"
    run = ["alert", "--out", out]
    capsys.readouterr()
    assert main(run, spark) == 0 and "LAS:" in capsys.readouterr().out
    assert main(run, spark) == 0 and capsys.readouterr().out.startswith("Nothing new for")
    assert main([*run, "--again"], spark) == 0 and "LAS:" in capsys.readouterr().out
    assert main(["check", "--out", out], spark) == 0 and "known_market is not checked" in capsys.readouterr().out
    _write(f"{feed.root}/markets.csv", "market,icao,name,lat,lon,tz\nLAS,KLAS,Las Vegas,36.08,-115.15,America/Los_Angeles\n")
    feed.flights("LAS", _day(20), 20, "late", "23:00:00")
    assert main(["update", *feed.args, "--markets", f"{feed.root}/markets.csv"], spark) == 0
    capsys.readouterr()
    assert main(run, spark) == 0 and "LAS:" in capsys.readouterr().out     # the day's numbers have changed
    assert main(["check", "--out", out], spark) == 1                       # the seed was kept
    assert "known_market" in capsys.readouterr().out
    with open(f"{feed.root}/markets.csv", "a") as fh:
        fh.write("SPA,KSPA,Spa,0,0,UTC\n")
    assert main(["check", "--out", out, "--markets", f"{feed.root}/markets.csv"], spark) == 0
