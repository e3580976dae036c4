"""The production path: raw files -> bronze -> silver -> gold tables.

    build(spark, raw_flights, raw_weather, calendar, holidays, root)

* bronze: the raw text, partitioned by dt, written as a table (A7/A8)
* silver: typed + freshest-wins, written once as tables bucketed and sorted
          by the natural key, so that later work on the key needs no exchange
          (or, with silver_as="view", views inlined into each mart, A11)
* gold:   daily signals and hourly curve written as tables (mart = table),
          each as a new version that the table is pointed to when it is whole

Every table lives under `root` in the shared folder and is registered in
the session catalog (CREATE DATABASE IF NOT EXISTS ..., A10), so later
jobs (alerts, quality suite) read the written gold table instead of
recomputing it: the write is also the lineage cut. Row counts of each layer
come from `Observation`s attached to the writes, so counting costs no extra
pass over the data (E7/E8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.operators.dedupe import latest_per_key
from signalmart.plans import marts
from signalmart.sources import bucketed
from signalmart.sources.raw import CORRUPT_COLUMN, read_raw, rebalanced, typed_projection
from signalmart.streaming import versioned

GOLD_COLUMNS = [*S.DAILY_COLUMNS, "driver_points"]


def _write_table(df: DataFrame, name: str, path: str, partition_by: list[str] = ()) -> None:
    if partition_by:
        df = rebalanced(df, *partition_by)
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def swap_table(df: DataFrame, name: str, path: str) -> None:
    """Write rows as a new version below `path`, commit it and point the
    table there: until then readers have the old rows, and a run that dies
    leaves them."""
    spark = df.sparkSession
    at = versioned.replace(df, path)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{at}'")
        spark.catalog.refreshTable(name)
    else:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet LOCATION '{at}'")


def _observed(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    obs = Observation(label)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def build(spark: SparkSession, raw_flights: str, raw_weather: str, calendar: DataFrame,
          holidays: DataFrame, root: str, database: str = "signalmart",
          silver_as: str = "table", flights_schema=S.RAW_FLIGHTS_SCHEMA,
          weather_schema=S.RAW_WEATHER_SCHEMA, buckets: int | None = None) -> dict:
    """Rebuild every layer; returns row counts per layer, and per raw feed
    the number of lines with too few or too many fields (they stay in bronze,
    cut or filled with NULLs). The seeds are written as tables too."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_db'")
    root = root.rstrip("/")

    # bronze: faithful string copy + dt recovered from the file path
    counts = {}
    for name, seed in (("calendar_events", calendar), ("holidays", holidays)):
        _write_table(seed, f"{database}.seed_{name}", f"{root}/seed_{name}")
    calendar, holidays = (spark.table(f"{database}.seed_{n}") for n in ("calendar_events", "holidays"))
    for kind, path, schema in (("flights", raw_flights, flights_schema),
                               ("weather", raw_weather, weather_schema)):
        obs = Observation(f"bronze_{kind}")
        bronze = read_raw(spark, path, schema, corrupt=True).observe(
            obs, F.count(F.lit(1)).alias("rows"), F.count(CORRUPT_COLUMN).alias("malformed")).drop(CORRUPT_COLUMN)
        _write_table(bronze, f"{database}.bronze_{kind}", f"{root}/bronze_{kind}",
                     [S.PARTITION_COLUMN])
        counts[f"bronze_{kind}"] = obs.get["rows"]
        counts[f"malformed_{kind}"] = obs.get["malformed"]

    # silver: typed + deduped. As tables (default) the dedupe, the largest
    # shuffle of the build, runs once and both marts read its output; as
    # views it is inlined into (and repeated by) every mart that uses it.
    bf = spark.table(f"{database}.bronze_flights")
    bw = spark.table(f"{database}.bronze_weather")
    silver = {
        "flights": latest_per_key(typed_projection(bf, S.FLIGHTS_TYPES, keep=(S.PARTITION_COLUMN,)),
                                  S.FLIGHTS_KEY, S.FRESHEST, drop=S.FRESHEST),
        "weather": latest_per_key(typed_projection(bw, S.WEATHER_TYPES, keep=(S.PARTITION_COLUMN,)),
                                  S.WEATHER_KEY, S.FRESHEST, drop=S.FRESHEST),
    }
    for kind, df in silver.items():
        if silver_as == "table":
            counted, obs = _observed(df, f"silver_{kind}")
            keys = S.FLIGHTS_KEY if kind == "flights" else S.WEATHER_KEY
            n = buckets or bucketed.buckets_for(spark, raw_flights if kind == "flights" else raw_weather)
            silver[kind] = bucketed.write(counted, f"{database}.silver_{kind}", f"{root}/silver_{kind}", keys, n)
            counts[f"silver_{kind}"] = obs.get["rows"]
        silver[kind] = silver[kind].drop(S.PARTITION_COLUMN)
        silver[kind].createOrReplaceTempView(f"silver_{kind}")

    # gold: tables
    sf, sw = silver["flights"], silver["weather"]
    if silver_as != "table":  # count silver on the gold write, no extra pass
        sf, obs_sf = _observed(sf, "silver_flights")
        sw, obs_sw = _observed(sw, "silver_weather")
    gold, obs_g = _observed(marts.daily_signals(sf, sw, calendar, holidays,
                                                points_name="driver_points"), "gold_daily")
    swap_table(gold, f"{database}.gold_daily_signals", f"{root}/gold_daily_signals")
    curve, obs_h = _observed(marts.hourly_curve(silver["flights"]), "gold_hourly")
    swap_table(curve, f"{database}.gold_hourly_arrival_curve", f"{root}/gold_hourly_arrival_curve")
    counts["gold_daily"] = obs_g.get["rows"]
    counts["gold_hourly"] = obs_h.get["rows"]
    if silver_as != "table":
        counts["silver_flights"] = obs_sf.get["rows"]
        counts["silver_weather"] = obs_sw.get["rows"]
    counts["flights_duplicates_removed"] = counts["bronze_flights"] - counts["silver_flights"]
    counts["weather_duplicates_removed"] = counts["bronze_weather"] - counts["silver_weather"]
    return counts


def gold(spark: SparkSession, database: str = "signalmart") -> DataFrame:
    """The written daily-signals table (for alerts and the quality suite),
    with the points of each fired rule as an array (`driver_points`)."""
    return spark.table(f"{database}.gold_daily_signals")
