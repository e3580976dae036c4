"""The shared test tables seen as the feeds of the signal.

The arrivals and weather feeds of a real deployment are landed CSV files.
Here they are derived by Spark from the `events` table, so every query's
work grows with the data:

* market      := events.event_type (each type gets a market row below)
* arrival     := an event; natural key (market, user, UTC hour of ts), so
                 several events of one user in one hour are repeated
                 extractions of one arrival; freshest = latest ts, then
                 highest event_id (a total tie-break)
* weather     := per market-local hour, the freshest event's value read as
                 temperature (F), value/1000 as precipitation (mm) and
                 value/10 as wind (km/h)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.functions.columns import trunc_hour, utc_to_local
from signalmart.operators.dedupe import latest_per_key
from signalmart.sources.raw import local_table, read_table

# ---------------------------------------------------------------------------
# FIXED VALUES: market dimension and calendars for the event-type markets
# ---------------------------------------------------------------------------
EVENT_MARKETS = [
    ("click", "KLAX", "Los Angeles International", 33.94, -118.41, "America/Los_Angeles"),
    ("view", "KJFK", "New York JFK International", 40.64, -73.78, "America/New_York"),
    ("purchase", "EGLL", "London Heathrow", 51.47, -0.45, "Europe/London"),
    ("signup", "RJTT", "Tokyo Haneda", 35.55, 139.78, "Asia/Tokyo"),
    ("error", "BIKF", "Keflavik International", 63.98, -22.61, "Atlantic/Reykjavik"),
]
EVENT_CALENDAR = [
    ("purchase", dt.date(2024, 1, 12), "Winter Sale", 2),
    ("purchase", dt.date(2024, 1, 12), "Clearance Weekend", 1),
    ("view", dt.date(2024, 1, 20), None, 1),
    ("click", dt.date(2024, 1, 25), "Product Launch", 2),
    ("signup", dt.date(2024, 1, 9), "Referral Week", 2),
    ("error", dt.date(2024, 1, 27), "Platform Migration", 2),
]
HOLIDAYS = [
    (dt.date(2024, 1, 1), "New Year's Day"),
    (dt.date(2024, 1, 15), "Martin Luther King Jr. Day"),
]
# Pull-window parameters of the hourly extractor (hours).
LOOKBACK_HOURS = 3
LAG_HOURS = 1
BACKFILL_DAYS = 7


def markets(spark: SparkSession) -> DataFrame:
    return local_table(spark, EVENT_MARKETS, S.MARKETS_DDL)


def event_calendar(spark: SparkSession) -> DataFrame:
    return local_table(spark, EVENT_CALENDAR, S.CALENDAR_EVENTS_DDL)


def holidays(spark: SparkSession) -> DataFrame:
    return local_table(spark, HOLIDAYS, S.HOLIDAYS_DDL)


def _with_zone(df: DataFrame, spark: SparkSession, on: str = "event_type") -> DataFrame:
    """Attach the market's zone and airport. The market dimension is an
    inline table of known size, so the planner broadcasts it; the fact side
    is not moved. Rows of a market that the dimension lacks stay, without an
    airport and with UTC as their local time; the quality suite counts them."""
    dim = markets(spark).select(F.col("market").alias("_m"), "icao", "tz")
    out = df.join(dim, df[on] == dim["_m"], "left").drop("_m")
    return out.withColumn("tz", F.coalesce("tz", F.lit("UTC")))


def _arrival_core(events: DataFrame) -> DataFrame:
    """What the natural key and the freshness order need, nothing more."""
    return events.select(
        F.col("event_type").alias("market"),
        F.col("user_id").cast("string").alias("icao24"),
        trunc_hour(F.col("ts")).alias("arrival_ts_utc"),
        F.col("ts").alias("extracted_at_utc"),
        F.col("event_id").alias("extraction_id"),
        F.col("props"),
    )


def _arrival_derive(spark: SparkSession, core: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Derived columns: market-local date/hour, callsign, airport."""
    e = _with_zone(core, spark, on="market")
    local = utc_to_local(F.col("arrival_ts_utc"), F.col("tz"))
    return e.select(
        F.col("market"),
        F.col("icao24"),
        F.concat(F.upper("market"), F.get_json_object("props", "$.k")).alias("callsign"),
        F.col("icao").alias("departure_airport"),
        F.col("arrival_ts_utc"),
        F.to_date(local).alias("arrival_date_local"),
        F.hour(local).alias("arrival_hour_local"),
        *keep,
    )


def arrivals_feed(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Typed raw arrivals (bronze after typing): one row per extraction."""
    return _arrival_derive(spark, _arrival_core(events), keep=("extracted_at_utc", "extraction_id"))


def weather_feed(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Typed raw hourly weather: one row per extraction."""
    e = _with_zone(events.select("event_id", "ts", "event_type", "value"), spark)
    e = e.withColumnRenamed("event_type", "market")
    local = utc_to_local(F.col("ts"), F.col("tz"))
    return e.select(
        F.col("market"),
        trunc_hour(local).alias("observed_at_local"),
        F.to_date(local).alias("observed_date_local"),
        F.hour(local).alias("hour_local"),
        F.col("value").alias("temp_f"),
        (F.col("value") / 1000).alias("precip_mm"),
        (F.col("value") / 10).alias("wind_kmh"),
        F.col("ts").alias("extracted_at_utc"),
        F.col("event_id").alias("extraction_id"),
    )


FRESHEST = S.FRESHEST


def silver_flights(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Freshest extraction per arrival. The dedupe runs on the narrow core
    columns; the zone lookup, local date/hour and callsign are derived after
    it, once per surviving arrival instead of once per extraction, and the
    shuffle does not carry them."""
    core = latest_per_key(_arrival_core(events), S.FLIGHTS_KEY, FRESHEST, drop=FRESHEST)
    return _arrival_derive(spark, core)


def silver_weather(spark: SparkSession, events: DataFrame) -> DataFrame:
    return latest_per_key(weather_feed(spark, events), S.WEATHER_KEY, FRESHEST, drop=FRESHEST)


def load_events(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "events")
