"""Tables derived once from a dataset: the raw-zone landing of the feeds
(headerless CSV under dt=, pull= and landing= folders) and the gold mart.

A derived table is written to the shared checkpoint folder and read by every
query that needs it. It belongs to the listing of the files it came from
(paths, sizes, times): if files are added or changed, it is written anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.operators.dedupe import latest_per_key
from signalmart.plans import feeds
from signalmart.session import work_dir
from signalmart.sources import bucketed
from signalmart.sources.pulls import land_pulls
from signalmart.sources.raw import rebalanced

EXTRACTED_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_WRITTEN: dict[tuple, str] = {}


def listing(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a folder's files from another: their number
    and a sum over their paths, sizes and times. No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.xxhash64("path", "length", "modificationTime")
    return tuple(files.agg(F.count(F.lit(1)), F.sum(name % 1_000_000_007)).first())


def written_once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a table that `write(path)` derives from the events table."""
    key = (spark.sparkContext.applicationId, sf_dir, name,
           listing(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _WRITTEN:
        path = work_dir(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _raw_text(feed: DataFrame, columns: list[str], date_column: str) -> DataFrame:
    """Typed feed -> raw text columns, extraction id, dt (local date), pull."""
    def text(c: str):
        kind = dict(feed.dtypes)[c]
        if c == "extracted_at_utc":
            return F.date_format(c, EXTRACTED_FORMAT)
        return F.date_format(c, S.RAW_TS_FORMAT) if kind.startswith("timestamp") else F.col(c).cast("string")

    # the feed landed in two hourly pulls: the first half hour's and the rest
    pull = F.when(F.minute("extracted_at_utc") < 30, "early").otherwise("late")
    return feed.select(
        *[text(c).alias(c) for c in columns],
        F.lpad(F.col("extraction_id").cast("string"), 20, "0").alias(S.EXTRACTION_COLUMN),
        F.col(date_column).cast("string").alias(S.PARTITION_COLUMN), pull.alias(S.PULL_COLUMN))


def _land(feed: DataFrame, columns: list[str], date_column: str, path: str) -> None:
    land_pulls(_raw_text(feed, columns, date_column), path, [*columns, S.EXTRACTION_COLUMN])


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrivals feed as raw text, with dt and pull."""
    return _raw_text(feeds.arrivals_feed(spark, feeds.load_events(spark, sf_dir)), S.FLIGHTS_COLUMNS, "arrival_date_local")


def landed_flights(spark: SparkSession, sf_dir: str) -> str:
    """Path of the landed raw flights table of `sf_dir`."""
    return written_once(spark, sf_dir, "raw-flights", lambda path: _land(
        feeds.arrivals_feed(spark, feeds.load_events(spark, sf_dir)), S.FLIGHTS_COLUMNS,
        "arrival_date_local", path))


def landed_weather(spark: SparkSession, sf_dir: str) -> str:
    """Path of the landed raw weather table of `sf_dir`."""
    return written_once(spark, sf_dir, "raw-weather", lambda path: _land(
        feeds.weather_feed(spark, feeds.load_events(spark, sf_dir)), S.WEATHER_COLUMNS,
        "observed_date_local", path))


def stored_gold(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    """The daily mart as a written table (what alerts and checks read)."""
    path = written_once(spark, sf_dir, "gold", lambda to: rebalanced(build()).write.parquet(to))
    return spark.read.parquet(path)


def bucketed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deduplicated arrivals, with what tells a fresher extraction, as a
    table bucketed by their natural key."""
    def write(path: str) -> None:
        feed = feeds.arrivals_feed(spark, feeds.load_events(spark, sf_dir))
        flights = latest_per_key(feed, S.FLIGHTS_KEY, S.FRESHEST)
        n = bucketed.buckets_for(spark, f"{sf_dir.rstrip('/')}/events.parquet")
        bucketed.write(flights, _table_name(path), path, S.FLIGHTS_KEY, n)

    path = written_once(spark, sf_dir, "silver-flights", write)
    return bucketed.attach(spark, _table_name(path), path, S.FLIGHTS_KEY)


def _table_name(path: str) -> str:
    return "silver_flights_" + path.rsplit("-", 1)[-1]
