"""The incremental daily run: new raw files -> silver and rollups -> gold.

`refresh` streams the files that landed since its last run through the
freshest-wins upsert; each micro-batch touches only the (day, key bucket)
partitions it has rows for, and their partial rollups. `refresh_gold` then
brings the gold tables up to what the rollups hold: the hourly curve of the
days that changed, and the daily signals of just the rows a change reaches (a
market's changed day and its seven observed days behind it). Both gold tables
are versioned by day, so a run that dies leaves the old rows, and their commits
name the rollup versions they were made from, so the next run goes on there.
`signals` scores the whole mart from the rollups (a rebuild).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalmart import schemas as S
from signalmart.operators import alerts as A
from signalmart.operators.rollups import (
    counts_from_partials, rollup_counts, weather_from_partials, weather_partials)
from signalmart.plans import marts
from signalmart.sources import bucketed
from signalmart.streaming import ingest as K
from signalmart.streaming import versioned

_PART = [S.PARTITION_COLUMN, K.BUCKET_COLUMN]
_DAY = [S.PARTITION_COLUMN]
_HOUR = ["market", "arrival_date_local", "arrival_hour_local"]


def _arrivals_rollup(merged: DataFrame) -> DataFrame:
    return rollup_counts(merged, [*_HOUR, *_PART], "arrivals")


def _weather_rollup(merged: DataFrame) -> DataFrame:
    return weather_partials(merged, ["market", "observed_date_local", *_PART])


def _buckets(spark: SparkSession, src: str, out: str, kind: str, wanted: int | None = None) -> int:
    """A table keeps the number of key buckets it was begun with: the one
    wanted, or what the largest day landed so far needs."""
    path = f"{out}/buckets_{kind}"
    if not _folder_exists(spark, path):
        spark.createDataFrame([(wanted or K.buckets_for(spark, src),)], "buckets int").write.parquet(path)
    return spark.read.schema("buckets int").parquet(path).first()[0]


_ROLLUPS = {
    "hourly_arrivals": "market string, arrival_date_local date, arrival_hour_local int, dt string, key_bucket long, "
                       "arrivals long",
    "daily_weather": "market string, observed_date_local date, dt string, key_bucket long, "
                     "temp_max_f double, temp_min_f double, precip_sum decimal(28,6), wind_max double",
}
DAILY, CURVE, OUTBOX = "gold_daily_signals", "gold_hourly_arrival_curve", "sent_digests"
_GOLD = {
    DAILY: "daily_key string, market string, arrival_date_local date, arrivals long, trailing_7day_avg double, "
           "arrivals_vs_7day_avg_pct double, temp_max_f double, temp_min_f double, precip_total_mm double, "
           "wind_max_kmh double, is_weekend int, is_holiday int, is_major_event int, event_name string, "
           "is_extreme_heat int, is_pool_weather int, is_rain int, pressure_score int, demand_pressure string, "
           "score_drivers string, interpretation string, driver_points array<int>",
    CURVE: "market string, arrival_date_local date, arrival_hour_local int, arrivals long",
}


def rollup_kind(name: str) -> StructType:
    return StructType.fromDDL(_ROLLUPS[name])


def refresh(spark: SparkSession, flights: str, weather: str, out: str,
            flights_schema: StructType = S.RAW_FLIGHTS_SCHEMA,
            weather_schema: StructType = S.RAW_WEATHER_SCHEMA, buckets: int | None = None, **stream) -> None:
    """Take in the raw files that are new since the last call. `buckets`: key
    buckets of a day, for tables that are begun with a small part of one."""
    K.upsert(spark, flights, f"{out}/silver_flights", f"{out}/_ck_flights", day="arrival_date_local",
             schema=flights_schema, rollups=[(_arrivals_rollup, f"{out}/hourly_arrivals")],
             buckets=_buckets(spark, flights, out, "flights", buckets), **stream)
    K.upsert(spark, weather, f"{out}/silver_weather", f"{out}/_ck_weather", keys=S.WEATHER_KEY,
             types=S.WEATHER_TYPES, schema=weather_schema, day="observed_date_local",
             rollups=[(_weather_rollup, f"{out}/daily_weather")],
             buckets=_buckets(spark, weather, out, "weather", buckets), **stream)


def _daily(partials: DataFrame, *more: str) -> DataFrame:
    return counts_from_partials(partials, [*marts.DAY, *more])


def _weather(partials: DataFrame) -> DataFrame:
    return (weather_from_partials(partials, ["market", "observed_date_local"])
            .withColumnRenamed("observed_date_local", "arrival_date_local"))


def signals(spark: SparkSession, out: str, calendar: DataFrame, holidays: DataFrame) -> DataFrame:
    """The whole mart (with `driver_points`) from the current rollups."""
    arrivals, weather = (versioned.read(spark, f"{out}/{name}", _PART, rollup_kind(name)) for name in _ROLLUPS)
    return marts.signals_from_rollups(_daily(arrivals), _weather(weather), calendar, holidays,
                                      points_name="driver_points")


# ---- gold, as far as something changed -------------------------------------
def _consumed(spark: SparkSession, gold: str, source: str) -> int:
    """The version of a rollup table that a gold table has taken in."""
    rows = versioned.commits(spark, gold, [], StructType()).filter(F.col(versioned.STREAM) == source)
    top = rows.agg(F.max(versioned.BATCH)).first()[0]
    return -1 if top is None else top


def _pending(spark: SparkSession, out: str, gold: str, source: str) -> tuple[set, int]:
    """The days of a rollup table that changed since, and its version now."""
    table = f"{out}/{source}"
    days = versioned.changed(spark, table, _DAY, rollup_kind(source), _consumed(spark, gold, source))
    return {r[0] for r in days}, versioned.last_version(spark, table)


def _rollup_days(spark: SparkSession, out: str, source: str, days: list) -> DataFrame:
    return versioned.read_partitions(spark, f"{out}/{source}", _PART, rollup_kind(source),
                                     [{S.PARTITION_COLUMN: d} for d in days], on=_DAY)


def _store(spark: SparkSession, rows: DataFrame, table: str, days: set, marks: dict[str, int]) -> None:
    """Rows as the new version of their days; the commit names the versions
    of the sources they were made from."""
    version = versioned.last_version(spark, table) + 1
    versioned.write(rows, table, _DAY, version)
    touched = [(d,) for d in sorted(days)]
    names = [dict(zip(_DAY, t)) for t in touched]
    versioned.commit(spark, table, _DAY, names, version, marks=marks)


def refresh_curve(spark: SparkSession, out: str) -> set:
    """The hourly curve of the days whose arrivals changed; returns them."""
    table = f"{out}/{CURVE}"
    days, top = _pending(spark, out, table, "hourly_arrivals")
    if days:
        partials = _rollup_days(spark, out, "hourly_arrivals", sorted(days))
        _store(spark, counts_from_partials(partials, [*_HOUR, *_DAY]), table, days, {"hourly_arrivals": top})
    return days


def _spans(touched: list[int], gap: int) -> list[tuple[int, int]]:
    """Places in ascending order to (first, last) of those that lie close."""
    out: list[tuple[int, int]] = []
    for k in touched:
        if out and k - out[-1][1] <= gap:
            out[-1] = out[-1][0], k
        else:
            out.append((k, k))
    return out


def _around(spark: SparkSession, out: str, days: list, first: int, last: int) -> DataFrame:
    """Daily counts (market, day, dt) of the days from `first` to `last` (places
    in `days`) and of as many on either side that every market seen there has
    its seven observed days before and behind, if it has so many at all."""
    n = S.TRAILING_DAYS
    lo, hi = max(0, first - n), min(len(days) - 1, last + n)
    while True:
        counts = _daily(_rollup_days(spark, out, "hourly_arrivals", days[lo:hi + 1]), S.PARTITION_COLUMN)
        dt = F.col(S.PARTITION_COLUMN)
        seen = counts.groupBy("market").agg(
            F.count_if(dt < days[first]).alias("before"), F.count_if(dt > days[last]).alias("behind"),
            F.count_if(dt.between(days[first], days[last])).alias("inside")).filter("inside > 0")
        before, behind = seen.agg(F.min("before"), F.min("behind")).first()
        if before is None or ((before >= n or lo == 0) and (behind >= n or hi == len(days) - 1)):
            return counts
        if before < n:
            lo = max(0, first - 2 * (first - lo))
        if behind < n:
            hi = min(len(days) - 1, last + 2 * (hi - last))


def rescored(spark: SparkSession, out: str, calendar: DataFrame, holidays: DataFrame, counted: set, other: set,
             days: list) -> DataFrame:
    """The rows of the mart (with dt) that a change reaches. `counted`: days
    whose arrivals changed, which the next seven observed days of their markets
    see too; `other`: days whose weather or calendar changed."""
    place = {d: k for k, d in enumerate(days)}
    parts = []
    for first, last in _spans(sorted(place[d] for d in counted | other if d in place), 2 * S.TRAILING_DAYS):
        counts = _around(spark, out, days, first, last)
        weather = _weather(_rollup_days(spark, out, "daily_weather", days[first:last + 1 + S.TRAILING_DAYS]))
        inside = days[first:last + 1]
        moved, own = ([d for d in inside if d in s] for s in (counted, other))
        dt = F.col(S.PARTITION_COLUMN)
        reach = Window.partitionBy("market").orderBy("arrival_date_local").rowsBetween(-S.TRAILING_DAYS, 0)
        hit = (F.max(dt.isin(moved).cast("int")).over(reach) == 1) | dt.isin(own)
        reached = counts.withColumn("hit", hit).filter("hit").select(F.col("market").alias("m"),
                                                                     F.col("arrival_date_local").alias("d"), dt)
        # a reached day far behind the span (a sparse market) needs its weather too
        far = [r[0] for r in reached.filter(~dt.isin(days[first:last + 1 + S.TRAILING_DAYS])).select(dt).distinct().collect()]
        if far:
            weather = weather.unionByName(_weather(_rollup_days(spark, out, "daily_weather", far)))
        scored = marts.signals_from_rollups(counts, weather, calendar, holidays, points_name="driver_points")
        same = scored["market"].eqNullSafe(F.col("m")) & scored["arrival_date_local"].eqNullSafe(F.col("d"))
        parts.append(scored.join(reached, same).drop("m", "d"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def _seed_changes(spark: SparkSession, out: str, calendar: DataFrame, holidays: DataFrame) -> tuple[set, list]:
    """Days on which the calendars differ from those of the last run, and the
    tables to keep them in."""
    days, keep = set(), []
    for name, seed, day in (("events", calendar, "event_date"), ("holidays", holidays, "holiday_date")):
        table = f"{out}/seed_{name}"
        old = versioned.read(spark, table, [], seed.schema)
        both = seed.exceptAll(old).unionByName(old.exceptAll(seed)).select(F.date_format(day, "yyyy-MM-dd"))
        found = {r[0] for r in both.distinct().collect()}  # days of a calendar
        if found:
            days |= found
            keep.append((seed, table))
    return days, keep


def refresh_daily(spark: SparkSession, out: str, calendar: DataFrame, holidays: DataFrame) -> set:
    """The daily signals that a change of arrivals, weather or calendars
    reaches, merged into the gold table; returns the days that were written."""
    table = f"{out}/{DAILY}"
    counted, top = _pending(spark, out, table, "hourly_arrivals")
    windy, weather_top = _pending(spark, out, table, "daily_weather")
    marked, seeds = _seed_changes(spark, out, calendar, holidays)
    now = versioned.current(spark, f"{out}/hourly_arrivals", _PART, rollup_kind("hourly_arrivals"))
    days = sorted(r[0] for r in now.select(S.PARTITION_COLUMN).distinct().collect())
    written: set = set()
    if (counted | windy | marked) & set(days):
        fresh = rescored(spark, out, calendar, holidays, counted, windy | marked, days)
        kind = StructType.fromDDL(f"{_GOLD[DAILY]}, dt string")
        fresh = fresh.select(*[F.col(f.name).cast(f.dataType) for f in kind.fields])
        reached = fresh.select("market", "arrival_date_local", S.PARTITION_COLUMN)
        written = {r[0] for r in reached.select(S.PARTITION_COLUMN).distinct().collect()}
        old = versioned.read_partitions(spark, table, _DAY, kind, [{S.PARTITION_COLUMN: d} for d in written])
        keys = reached.select(F.col("market").alias("m"), F.col("arrival_date_local").alias("d"))
        stay = old.join(keys, old["market"].eqNullSafe(F.col("m")) & old["arrival_date_local"].eqNullSafe(F.col("d")),
                        "left_anti")
        _store(spark, stay.unionByName(fresh), table, written, {"hourly_arrivals": top, "daily_weather": weather_top})
    for seed, at in seeds:
        versioned.replace(seed, at)
    return written


def refresh_gold(spark: SparkSession, out: str, calendar: DataFrame, holidays: DataFrame) -> dict:
    """Bring both gold tables up to the rollups; days written in each."""
    return {"daily": refresh_daily(spark, out, calendar, holidays), "curve": refresh_curve(spark, out)}


def gold(spark: SparkSession, out: str, name: str = DAILY) -> DataFrame:
    """A gold table of `update` (versioned by day) or of `build` (as a whole)."""
    kind, table = StructType.fromDDL(_GOLD[name]), f"{out}/{name}"
    if not versioned.exists(spark, table):
        return spark.createDataFrame([], kind)
    by_day = S.PARTITION_COLUMN in spark.read.parquet(f"{table}/commits").columns
    if not by_day:
        return versioned.read(spark, table, [], kind)
    return versioned.read(spark, table, _DAY, StructType.fromDDL(f"{_GOLD[name]}, dt string")).drop(S.PARTITION_COLUMN)


def silver(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """A silver table of `update` (versioned) or of `build` (bucketed)."""
    path = f"{out}/silver_{kind}"
    if not versioned.exists(spark, path):
        keys = S.FLIGHTS_KEY if kind == "flights" else S.WEATHER_KEY
        if bucketed.is_bucketed(spark, path):
            name = f"silver_{kind}_{abs(hash(path)):x}"  # one name per folder in this session's catalog
            return bucketed.attach(spark, name, path, keys)
        return spark.read.parquet(path)
    types = S.FLIGHTS_TYPES if kind == "flights" else S.WEATHER_TYPES
    ddl = ", ".join(f"{c} {'string' if t is None or t.startswith('text') else t}" for c, t in types.items())
    return versioned.read(spark, path, _PART, StructType.fromDDL(f"{ddl}, dt string, key_bucket long"))


def keep_markets(markets: DataFrame, out: str) -> None:
    """Keep the markets' seed beside the tables, for the check of unknown ones."""
    versioned.replace(markets, f"{out}/seed_markets")


def markets(spark: SparkSession, out: str) -> DataFrame | None:
    table = f"{out}/seed_markets"
    if not versioned.exists(spark, table):
        return None
    return versioned.read(spark, table, [], StructType.fromDDL(S.MARKETS_DDL))


def unsent(spark: SparkSession, out: str, digests: DataFrame) -> DataFrame:
    """The digests that were not sent yet, or not with this content."""
    return A.unsent(digests, spark.read.schema(A.OUTBOX).parquet(f"{out}/{OUTBOX}")
                    if _folder_exists(spark, f"{out}/{OUTBOX}") else spark.createDataFrame([], A.OUTBOX))


def note_sent(digests: DataFrame, out: str) -> None:
    """Note digests as sent: a run that dies before this sends them again, one
    that ran through does not."""
    A.sent_rows(digests).coalesce(1).write.mode("append").parquet(f"{out}/{OUTBOX}")


def _folder_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def tidy(spark: SparkSession, out: str) -> dict:
    """Maintenance between runs: folders of replaced versions go, and each
    table's commit files become one. No reader or run may be under way.
    Returns per table how many of each went."""
    silver_kind = StructType.fromDDL("dt string, key_bucket long")
    tables = {**{f"silver_{k}": (_PART, silver_kind) for k in ("flights", "weather")},
              **{name: (_PART, rollup_kind(name)) for name in _ROLLUPS},
              **{f"seed_{k}": ([], StructType()) for k in ("events", "holidays", "markets")}}
    for name in _GOLD:
        at = f"{out}/{name}"
        by_day = versioned.exists(spark, at) and S.PARTITION_COLUMN in spark.read.parquet(f"{at}/commits").columns
        tables[name] = (_DAY, StructType.fromDDL("dt string")) if by_day else ([], StructType())
    return {name: {"folders": versioned.vacuum(spark, f"{out}/{name}", cols, kind),
                   "commits": versioned.compact(spark, f"{out}/{name}", cols, kind)}
            for name, (cols, kind) in tables.items() if versioned.exists(spark, f"{out}/{name}")}
