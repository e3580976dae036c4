"""Command line: the daily run as Spark jobs.

  python -m signalmart normalize --kind arrivals --payloads DIR --markets CSV --out RAW
  python -m signalmart build  --flights RAW --weather RAW --events CSV --holidays CSV --out DIR
  python -m signalmart update --flights RAW --weather RAW --events CSV --holidays CSV --out DIR
  python -m signalmart check  --out DIR       # quality suite, exit 1 on any failure
  python -m signalmart alert  --out DIR       # latest-day digest, once; lists HIGH markets
  python -m signalmart tidy   --out DIR       # between runs: old versions and commit files go

`normalize` turns landed API payloads (JSON lines in <dir>/<market>/<pull>)
into headerless raw CSV under dt= and pull= folders. A payload's pull time is
the UTC stamp in its file's name (yyyyMMddTHHmmss) or else the file's time, and
its file names the pull, so a repeated run replaces what it landed before, by
the manifest of the raw zone. Documents and records it can't use (malformed,
unknown market, a value of the wrong kind) go to <out>_rejects with a reason,
by pull, and are counted: records = rows + records without a time + rejects. `build` rebuilds bronze, silver and gold tables under --out (a shared
folder on a cluster) and prints the layer row counts. `update` takes in only
the raw files that are new since its last run and rewrites the days of the gold
tables that they reach. `check` and `alert` read the written tables. With
--markets, `build` and `update` keep the markets' seed for the check of unknown
ones.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.operators import alerts as A
from signalmart.operators import quality as Q
from signalmart.plans import incremental, medallion
from signalmart.session import session_conf, work_dir
from signalmart.sources import payloads as P
from signalmart.sources.pulls import land_pulls
from signalmart.sources.raw import read_seed

DB = "signalmart"
UNKNOWN_MARKET = "unknown market"


def _session(spark: SparkSession | None) -> SparkSession:
    if spark is not None:
        return spark
    from signalmart.session import get_spark
    return get_spark()


#: FIXED VALUE: a UTC stamp in a payload's file name.
_STAMP = r"(\d{8})T?(\d{6})"


def _documents(spark: SparkSession, payloads: str):
    """Payload documents with market, pull time and extraction id."""
    docs = P.read_json_lines(spark, payloads.rstrip("/"))
    name = F.regexp_extract("source_file", r"([^/]+)$", 1)
    day, time = F.regexp_extract(name, _STAMP, 1), F.regexp_extract(name, _STAMP, 2)
    stamp = F.try_to_timestamp(F.concat(day, time), F.lit("yyyyMMddHHmmss"))
    pulled = F.coalesce(stamp.cast("timestamp_ntz"),
                        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("file_time").cast("timestamp_ntz")))
    market = F.regexp_extract(F.col("source_file"), r"/([^/]+)/[^/]+$", 1)
    return docs.select(
        "payload", "source_file", market.alias("market"),
        F.date_format(pulled, S.RAW_TS_FORMAT).alias("extracted_at"),
        F.concat_ws("/", market, name).alias(S.EXTRACTION_COLUMN),
        F.concat_ws("-", market, F.regexp_replace(name, r"[^A-Za-z0-9]+", "_")).alias(S.PULL_COLUMN))


def _keep_rejects(bad: DataFrame, pulls: DataFrame, path: str) -> None:
    """Rejects by pull: those of the pulls of this run replace theirs, others
    stay."""
    spark = bad.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at):  # pulls that had rejects and have none now
        had = spark.read.schema("pull string").parquet(path).select("pull").distinct()
        clean = had.join(pulls, "pull", "left_semi").join(bad.select("pull"), "pull", "left_anti").collect()
        for r in clean:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/pull={r['pull']}"), True)
    (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(S.PULL_COLUMN).parquet(path))


def normalize(spark: SparkSession, kind: str, payloads: str, markets_csv: str, out: str) -> int:
    out = out.rstrip("/")
    docs = _documents(spark, payloads)
    if kind == "arrivals":
        dim = read_seed(spark, markets_csv, S.MARKETS_DDL).select(F.col("market").alias("_m"), "tz")
        docs = docs.join(dim, docs["market"] == dim["_m"], "left").drop("_m")
        known = docs.filter("tz IS NOT NULL")
        records = P.arrival_records(known, "payload", "market", "tz", "extracted_at")
        strange = docs.filter("tz IS NULL").select(
            *[F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c)
              for c in records.columns if c not in ("extracted_at_utc", "record", "reason")],
            F.col("extracted_at").alias("extracted_at_utc"), F.col("payload").alias("record"),
            F.lit(UNKNOWN_MARKET).alias("reason"))
        records = records.unionByName(strange)
        cols, dt_col = S.FLIGHTS_COLUMNS, "arrival_date_local"
    else:
        records = P.weather_records(docs, "payload", "market", "extracted_at")
        cols, dt_col = S.WEATHER_COLUMNS, "observed_date_local"
    # the documents are parsed once: rows, rejects and counts come from here
    staged = work_dir(spark, "records")
    records.write.parquet(staged)
    records = spark.read.schema(records.schema).parquet(staged)
    pulls = docs.select(S.PULL_COLUMN).distinct()
    rows = records.filter("reason IS NULL").withColumn(S.PARTITION_COLUMN, F.col(dt_col))
    land_pulls(rows, out, [*cols, S.EXTRACTION_COLUMN], pulls)
    bad = records.filter(F.col("reason").isNotNull() & (F.col("reason") != P.NO_TIME)).select(
        "market", S.EXTRACTION_COLUMN, "extracted_at_utc", "record", "reason", S.PULL_COLUMN)
    _keep_rejects(bad, pulls, f"{out}_rejects")
    counts = {r["reason"]: r["count"] for r in records.groupBy("reason").count().collect()}  # a row per reason
    landed, timeless = counts.pop(None, 0), counts.pop(P.NO_TIME, 0)
    for reason, n in sorted(counts.items()):
        what = "documents" if reason.startswith(("malformed document", UNKNOWN_MARKET)) else "records"
        print(f"{n} {what} left out: {reason}")
    print(f"{landed} rows landed, {timeless} records have no time, {sum(counts.values())} left out")
    return 0


def _schemas(plain: bool) -> dict:
    return {"flights_schema": S.PLAIN_FLIGHTS_SCHEMA if plain else S.RAW_FLIGHTS_SCHEMA,
            "weather_schema": S.PLAIN_WEATHER_SCHEMA if plain else S.RAW_WEATHER_SCHEMA}


def _seeds(spark: SparkSession, events: str, holidays: str):
    return read_seed(spark, events, S.CALENDAR_EVENTS_DDL), read_seed(spark, holidays, S.HOLIDAYS_DDL)


def build(spark: SparkSession, flights: str, weather: str, events: str, holidays: str,
          out: str, plain: bool = False, buckets: int | None = None) -> dict:
    return medallion.build(spark, flights, weather, *_seeds(spark, events, holidays), out, database=DB,
                           buckets=buckets, **_schemas(plain))


def update(spark: SparkSession, flights: str, weather: str, events: str, holidays: str,
           out: str, plain: bool = False, buckets: int | None = None) -> dict:
    """New raw files only: silver and rollups by upsert, then the rows of the
    gold tables that they reach. Returns the days written in each."""
    out = out.rstrip("/")
    incremental.refresh(spark, flights, weather, out, buckets=buckets, **_schemas(plain))
    days = incremental.refresh_gold(spark, out, *_seeds(spark, events, holidays))
    return {f"{name}_days": len(d) for name, d in days.items()}


def check(spark: SparkSession, out: str, markets: str | None = None) -> list:
    """The quality suite over the written tables. The markets' seed is the one
    named here, or the one that `build` or `update` was given."""
    out = out.rstrip("/")
    fl, wx = (incremental.silver(spark, out, k) for k in ("flights", "weather"))
    gold, curve = incremental.gold(spark, out), incremental.gold(spark, out, incremental.CURVE)
    checks = [Q.unique(fl, S.FLIGHTS_KEY, "silver_flights"),
              Q.unique(wx, S.WEATHER_KEY, "silver_weather"),
              Q.unique(gold, ["daily_key"], "gold", ignore_nulls=True),
              Q.not_null(gold, ["daily_key", "arrivals", "demand_pressure", "score_drivers",
                                "interpretation"], "gold"),
              Q.not_null(fl, ["market", "arrival_ts_utc"], "silver_flights"),
              Q.not_null(wx, ["market", "observed_at_local"], "silver_weather"),
              Q.not_null(curve, ["market"], "hourly_curve"),
              Q.accepted_values(gold, "demand_pressure", S.ACCEPTED_LABELS, "gold"),
              Q.warmup_window(gold), Q.reconcile(gold)]
    dim = read_seed(spark, markets, S.MARKETS_DDL) if markets else incremental.markets(spark, out)
    if dim is None:
        print("known_market is not checked: no markets were named")
    else:
        checks.append(Q.known_markets(fl, dim, "silver_flights"))
    return Q.assert_passed(Q.suite(checks))


def alert(spark: SparkSession, out: str, again: bool = False) -> dict:
    """Say the latest day's digest, once: what was said is kept beside the
    tables, and a repeated run is silent unless something changed."""
    out = out.rstrip("/")
    snap = A.latest_snapshot(incremental.gold(spark, out))
    digests = A.alert_digest(snap)
    digest = digests.collect()          # one row per day: one row
    high = [r.market for r in A.alert_rows(snap).select("market").collect()]  # <= markets
    if not digest:
        print("No mart rows found.")
        return {"high": [], "digest": None}
    fresh = incremental.unsent(spark, out, digests)
    if not again and not fresh.take(1):
        print(f"Nothing new for {digest[0].arrival_date_local}: its digest was sent before.")
        return {"high": high, "digest": None}
    print(digest[0].subject)
    print(digest[0].digest)
    incremental.note_sent(digests, out)
    print(("HIGH: " + ", ".join(high)) if high else "No HIGH market today.")
    return {"high": high, "digest": digest[0].digest}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="signalmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    n = sub.add_parser("normalize")
    n.add_argument("--kind", choices=["arrivals", "weather"], required=True)
    n.add_argument("--payloads", required=True)
    n.add_argument("--markets")
    n.add_argument("--out", required=True)
    for name in ("build", "update"):
        b = sub.add_parser(name)
        for a in ("--flights", "--weather", "--events", "--holidays", "--out"):
            b.add_argument(a, required=True)
        b.add_argument("--markets", help="seed of the known markets, kept for `check`")
        b.add_argument("--plain-raw", action="store_true", help="raw files without an extraction id")
        b.add_argument("--file-bytes", help="target size of table files, e.g. 256m")
        b.add_argument("--buckets", type=int, help="key buckets of a day of silver (update, first run) or of the "
                                                   "whole table (build); by default from the bytes landed")
    for name in ("check", "alert", "tidy"):
        sub.add_parser(name).add_argument("--out", required=True)
    sub.choices["check"].add_argument("--markets")
    sub.choices["alert"].add_argument("--again", action="store_true", help="even if the digest was sent before")
    args = ap.parse_args(argv)
    spark = _session(spark)
    if args.cmd == "normalize":
        if args.kind == "arrivals" and not args.markets:
            ap.error("--markets is required for arrivals")
        return normalize(spark, args.kind, args.payloads, args.markets, args.out)
    if args.cmd in ("build", "update"):
        run = build if args.cmd == "build" else update
        size = {"spark__sql__adaptive__advisoryPartitionSizeInBytes": args.file_bytes} if args.file_bytes else {}
        with session_conf(spark, **size):
            if args.markets:
                incremental.keep_markets(read_seed(spark, args.markets, S.MARKETS_DDL), args.out.rstrip("/"))
            print(json.dumps(run(spark, args.flights, args.weather, args.events, args.holidays,
                                 args.out, args.plain_raw, args.buckets)))
        return 0
    if args.cmd == "tidy":
        print(json.dumps(incremental.tidy(spark, args.out.rstrip("/"))))
        return 0
    if args.cmd == "check":
        try:
            check(spark, args.out, args.markets)
        except AssertionError as e:
            print(str(e))
            return 1
        return 0
    alert(spark, args.out, args.again)
    return 0


if __name__ == "__main__":
    sys.exit(main())
