"""Query registry: name -> (spark callable, oracle SQL or None).

Every callable takes (spark, sf_dir) and returns a DataFrame built from the
tables in sf_dir (whole tables, no sampling). The oracle SQL is DuckDB over
the same tables (see plans/oracle.py).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.functions.columns import (
    blank_to_null, clean_code, epoch_to_utc, format_ts, utc_to_local, weekend_flag)
from signalmart.operators import alerts as A
from signalmart.operators import quality as Q
from signalmart.operators import rules as R
from signalmart.operators.baseline import pct_vs_baseline, trailing_baseline
from signalmart.operators.dedupe import key_copy_counts
from signalmart.operators.dedupe import latest_per_key as dedupe_latest
from signalmart.operators.rollups import daily_weather
from signalmart.plans import feeds, incremental, landing, marts, medallion, models
from signalmart.plans import oracle as O
from signalmart.session import work_dir
from signalmart.sources import payloads as P
from signalmart.sources import pulls
from signalmart.sources.raw import read_partitioned, read_raw, read_seed, read_table, typed_projection
from signalmart.streaming import ingest as K

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _events(spark, sf_dir):
    return feeds.load_events(spark, sf_dir)


def _flights(spark, sf_dir):
    return feeds.silver_flights(spark, _events(spark, sf_dir))


def _weather(spark, sf_dir):
    return feeds.silver_weather(spark, _events(spark, sf_dir))


def _calendar(spark):
    return feeds.event_calendar(spark)


def _holidays(spark):
    return feeds.holidays(spark)


def mart(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return marts.daily_signals(_flights(spark, sf_dir), _weather(spark, sf_dir),
                               _calendar(spark), _holidays(spark), **kw)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as a written table with `driver_points`: what alerts and
    checks read, as a deployment reads its stored gold table."""
    return landing.stored_gold(spark, sf_dir, lambda: mart(spark, sf_dir, points_name="driver_points"))


@register("daily_signals", O.mart_sql("SELECT * FROM mart"))
def daily_signals(spark, sf_dir):
    """The full daily demand-signals mart (21 columns)."""
    return mart(spark, sf_dir)


_M = O.mart_sql


# ---------------------------------------------------------------------------
# 2.1 scans, sources, sinks (landed CSV read back)
# ---------------------------------------------------------------------------
_RAW_TEXT_SQL = """
    SELECT market, icao24, callsign, departure_airport,
           strftime(arrival_ts_utc, '%Y-%m-%d %H:%M:%S') AS arrival_ts_utc,
           CAST(arrival_date_local AS VARCHAR) AS arrival_date_local,
           CAST(arrival_hour_local AS VARCHAR) AS arrival_hour_local,
           strftime(extracted_at_utc, '%Y-%m-%d %H:%M:%S.%f') AS extracted_at_utc,
           CAST(arrival_date_local AS VARCHAR) AS dt
    FROM arrivals_feed"""


def _raw(spark, sf_dir):
    return read_raw(spark, landing.landed_flights(spark, sf_dir), S.RAW_FLIGHTS_SCHEMA)


@register("csv_roundtrip", O.with_ctes(_RAW_TEXT_SQL, O.FEEDS))
def csv_roundtrip(spark, sf_dir):
    """Land the feed as headerless CSV per dt and pull, read it
    back with an explicit all-string schema and the dt recovered from the
    path."""
    return _raw(spark, sf_dir).select(*S.FLIGHTS_COLUMNS, S.PARTITION_COLUMN)


@register("typed_projection", O.with_ctes("""
    SELECT market, icao24, callsign, departure_airport, arrival_ts_utc,
           arrival_date_local, arrival_hour_local, extracted_at_utc
    FROM arrivals_feed""", O.FEEDS))
def typed_projection_q(spark, sf_dir):
    """Raw strings -> silver types (blank -> NULL first)."""
    return typed_projection(_raw(spark, sf_dir), S.FLIGHTS_TYPES).select(*S.FLIGHTS_COLUMNS)


@register("path_partition", O.with_ctes("""
    SELECT CAST(arrival_date_local AS VARCHAR) AS dt, count(*) AS rows,
           count(*) AS rows_matching_local_date
    FROM arrivals_feed GROUP BY arrival_date_local""", O.FEEDS))
def path_partition(spark, sf_dir):
    """A4/H7: dt cut from each file path by regex, checked against the
    column it was derived from."""
    return _raw(spark, sf_dir).groupBy("dt").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("dt") == F.col("arrival_date_local")).alias("rows_matching_local_date"))


PRUNE_FROM, PRUNE_TO = "2024-01-08", "2024-01-14"


@register("partition_prune", O.with_ctes(f"""
    SELECT CAST(arrival_date_local AS VARCHAR) AS dt, market, count(*) AS rows
    FROM arrivals_feed
    WHERE CAST(arrival_date_local AS VARCHAR) BETWEEN '{PRUNE_FROM}' AND '{PRUNE_TO}'
    GROUP BY ALL""", O.FEEDS))
def partition_prune(spark, sf_dir):
    """One week of a dt-partitioned table; only its folders are
    named in the path, listed and read."""
    df = read_partitioned(spark, landing.landed_flights(spark, sf_dir), S.RAW_FLIGHTS_SCHEMA,
                          PRUNE_FROM, PRUNE_TO)
    return df.groupBy("dt", "market").agg(F.count(F.lit(1)).alias("rows"))


@register("catalog_prune", O.with_ctes(f"""
    SELECT CAST(arrival_date_local AS VARCHAR) AS dt, market, count(*) AS rows
    FROM arrivals_feed
    WHERE CAST(arrival_date_local AS VARCHAR) BETWEEN '{PRUNE_FROM}' AND '{PRUNE_TO}'
    GROUP BY ALL""", O.FEEDS))
def catalog_prune(spark, sf_dir):
    """A3/A5: the raw zone as a catalog table; the week's partitions come from
    the catalog, which takes them from the manifest of the pulls."""
    root = landing.landed_flights(spark, sf_dir)
    name = "raw_flights_" + root.rsplit("-", 1)[-1]
    df = pulls.catalog_table(spark, name, root, S.RAW_FLIGHTS_SCHEMA)
    return df.filter(F.col("dt").between(PRUNE_FROM, PRUNE_TO)).groupBy("dt", "market").agg(
        F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------
# 2.2 payload normalisation
# ---------------------------------------------------------------------------
@register("json_extract", O.with_ctes(f"""
    SELECT e.event_type AS market, CAST(e.user_id AS VARCHAR) AS icao24,
           upper(e.event_type) || json_extract_string(e.props, '$.k') AS callsign,
           coalesce(m.icao, '') AS departure_airport,
           strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS arrival_ts_utc,
           strftime({O.local('e.ts', O.TZ)}, '%Y-%m-%d') AS arrival_date_local,
           CAST(hour({O.local('e.ts', O.TZ)}) AS VARCHAR) AS arrival_hour_local,
           strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS extracted_at_utc
    FROM events e LEFT JOIN markets m ON e.event_type = m.market"""))
def json_extract(spark, sf_dir):
    """Arrival payloads (JSON arrays of objects, as an API would
    return them) parsed into variants and exploded: records without an arrival
    time dropped, fractions of a second too, callsigns cleaned."""
    return P.arrival_rows(_arrival_documents(spark, sf_dir), "payload", "market", "tz", "extracted_at")


def _arrival_documents(spark, sf_dir):
    """A document per event with its arrival, a record without a time and one
    whose time is no number; beside each one that is cut short and an empty one.
    A market that the dimension lacks has UTC as its zone."""
    ev = _events(spark, sf_dir)
    dim = feeds.markets(spark).select("market", "icao", "tz")
    e = ev.join(dim, ev["event_type"] == dim["market"], "left").withColumns({
        "market": F.col("event_type"), "tz": F.coalesce("tz", F.lit("UTC"))})
    record = F.struct(
        F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                         F.col("ts")).cast("double").alias("lastSeen"),
        F.col("user_id").cast("string").alias("icao24"),
        F.concat(F.lit(" "), F.upper("market"), F.lit(","),
                 F.get_json_object("props", "$.k"), F.lit(" ")).alias("callsign"),
        F.col("icao").alias("estDepartureAirport"))
    no_time = record.withField("lastSeen", F.lit(None).cast("double"))
    record = record.withField("lastSeen", record["lastSeen"] + 0.25)
    wrong = F.to_json(record.withField("lastSeen", F.lit("17x")))
    docs = e.select("market", "tz", format_ts("ts").alias("extracted_at"),
                    F.concat(F.lit("["), F.to_json(record), F.lit(","), F.to_json(no_time), F.lit(","), wrong,
                             F.lit("]")).alias("payload"))
    cut_short = docs.withColumn("payload", F.expr("left(payload, 20)"))
    return docs.unionByName(cut_short).unionByName(docs.withColumn("payload", F.lit("")))


@register("payload_rejects", """
    SELECT market, outcome, count(*) AS records
    FROM (SELECT event_type AS market,
                 unnest(['row', 'no time', 'lastSeen is no number', 'malformed document']) AS outcome FROM events)
    GROUP BY ALL""")
def payload_rejects(spark, sf_dir):
    """What became of every record of the arrival payloads, by market:
    rows, records without a time, and rejects with their reason."""
    records = P.arrival_records(_arrival_documents(spark, sf_dir), "payload", "market", "tz", "extracted_at")
    return records.groupBy("market", F.coalesce("reason", F.lit("row")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("records"))


@register("array_zip", """
    SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS BIGINT) AS idx,
           CAST(unnest(embedding) AS DOUBLE) AS x
    FROM embeddings""")
def array_zip(spark, sf_dir):
    """B2: array -> rows, one per element with its position; an empty or
    missing vector gives none."""
    emb = read_table(spark, sf_dir, "embeddings")
    z = emb.select("vec_id", "label", F.posexplode("embedding").alias("idx", "x"))
    return z.select("vec_id", "label", F.col("idx").cast("long").alias("idx"),
                    F.col("x").cast("double").alias("x"))


@register("iso_slice", O.mart_sql("""
    SELECT market, observed_at_local, observed_date_local, hour_local,
           temp_f, precip_mm, wind_kmh FROM weather"""))
def iso_slice(spark, sf_dir):
    """Hourly weather as API-style documents (per market-day,
    parallel arrays of ISO 'yyyy-MM-ddTHH:mm' times and values), read back
    by zipping the arrays and slicing the ISO strings. A document holds one
    market-day, so at most 25 hours."""
    wx = _weather(spark, sf_dir)
    h = F.array_sort(F.collect_list(F.struct(
        F.date_format("observed_at_local", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("temp_f"), F.col("precip_mm"), F.col("wind_kmh"))))
    docs = (wx.groupBy("market", "observed_date_local").agg(h.alias("h"))
            .select("market", F.to_json(F.struct(F.struct(
                F.transform("h", lambda x: x["time"]).alias("time"),
                F.transform("h", lambda x: x["temp_f"]).alias("temperature_2m"),
                F.transform("h", lambda x: x["precip_mm"]).alias("precipitation"),
                F.transform("h", lambda x: x["wind_kmh"]).alias("wind_speed_10m"),
            ).alias("hourly"))).alias("payload")))
    rows = P.weather_rows(docs, "payload", "market", F.lit(None).cast("string"))
    return typed_projection(rows, {k: v for k, v in S.WEATHER_TYPES.items()
                                   if k not in S.FRESHEST})


@register("local_time", O.with_ctes(f"""
    SELECT e.event_id, e.event_type AS market,
           date_trunc('second', e.ts) AS arrival_ts_utc,
           strftime({O.local('e.ts', O.TZ)}, '%Y-%m-%d %H:%M:%S') AS local_time,
           CAST({O.local('e.ts', O.TZ)} AS DATE) AS arrival_date_local,
           CAST(hour({O.local('e.ts', O.TZ)}) AS INTEGER) AS arrival_hour_local
    FROM events e LEFT JOIN markets m ON e.event_type = m.market"""))
def local_time(spark, sf_dir):
    """Epoch seconds -> UTC timestamp -> market-local date,
    hour and text, with the zone taken per row from the market dimension (UTC
    for a market that it lacks)."""
    ev = _events(spark, sf_dir)
    dim = feeds.markets(spark).select("market", "tz")
    e = ev.join(dim, ev["event_type"] == dim["market"], "left").withColumns({
        "market": F.col("event_type"), "tz": F.coalesce("tz", F.lit("UTC"))})
    secs = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            F.col("ts"))
    utc = epoch_to_utc(secs)
    loc = utc_to_local(utc, "tz")
    return e.select("event_id", "market", utc.alias("arrival_ts_utc"),
                    format_ts(loc).alias("local_time"),
                    F.to_date(loc).alias("arrival_date_local"),
                    F.hour(loc).alias("arrival_hour_local"))


def _latest(ev: DataFrame, what) -> Column:
    """The greatest value as a literal. Two scalar subqueries over one table
    would be merged into a struct, whose fields no scan takes as a filter; a
    pull window is known before its job starts anyway."""
    row = ev.agg(F.max(what).alias("x"))
    # through its text: a Python datetime would be read in the session's zone
    value = row.select(F.col("x").cast("string")).first()[0]
    return F.lit(value).cast(row.schema["x"].dataType)


def _between(ev: DataFrame, begin: Column, end: Column) -> DataFrame:
    return ev.filter((F.col("ts") >= begin) & (F.col("ts") < end))


@register("time_slice", f"""
    SELECT event_id, event_type, ts FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {feeds.LAG_HOURS + feeds.LOOKBACK_HOURS} HOUR
      AND ts <  (SELECT max(ts) FROM events) - INTERVAL {feeds.LAG_HOURS} HOUR""")
def time_slice(spark, sf_dir):
    """The extractor's pull window [now - lag - lookback, now - lag),
    with `now` = the latest event time."""
    ev = _events(spark, sf_dir)
    now = _latest(ev, F.col("ts"))
    return _between(ev, now - F.make_dt_interval(hours=F.lit(feeds.LAG_HOURS + feeds.LOOKBACK_HOURS)),
                    now - F.make_dt_interval(hours=F.lit(feeds.LAG_HOURS))) \
        .select("event_id", "event_type", "ts")


@register("backfill_windows", f"""
    WITH days AS (
      SELECT CAST(d AS DATE) AS day FROM generate_series(
        (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL {feeds.BACKFILL_DAYS} DAY,
        (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 1 DAY, INTERVAL 1 DAY) AS g(d))
    SELECT CAST(d.day AS TIMESTAMP) AS window_begin,
           CAST(d.day AS TIMESTAMP) + INTERVAL 86400 SECOND AS window_end,
           e.event_type AS market, count(*) AS rows
    FROM days d JOIN events e ON CAST(e.ts AS DATE) = d.day
    GROUP BY ALL""")
def backfill_windows(spark, sf_dir):
    """The N days before the latest one as one-day UTC windows [00:00,
    +86400 s). The windows are whole days, so an event's window follows from
    its date."""
    ev = _events(spark, sf_dir)
    today = _latest(ev, F.to_date("ts"))
    week = _between(ev, F.date_sub(today, feeds.BACKFILL_DAYS).cast("timestamp_ntz"), today.cast("timestamp_ntz"))
    begin = F.to_date("ts").cast("timestamp_ntz")
    return week.groupBy(begin.alias("window_begin"),
                        F.timestamp_add("SECOND", F.lit(86400), begin).alias("window_end"),
                        F.col("event_type").alias("market")).agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------
# 2.3 projections, cleaning, flags
# ---------------------------------------------------------------------------
@register("string_clean", f"""
    SELECT p_partkey,
           nullif(trim(replace({O.strip("coalesce(p_name, '')")}, ',', '')), '') AS name_clean,
           nullif(trim(p_brand), '') AS brand,
           nullif(p_type, '') AS type
    FROM part""")
def string_clean(spark, sf_dir):
    """Strip + drop commas (NULL-safe), blank -> NULL."""
    part = read_table(spark, sf_dir, "part")
    return part.select("p_partkey",
                       blank_to_null(clean_code("p_name")).alias("name_clean"),
                       blank_to_null("p_brand").alias("brand"),
                       blank_to_null("p_type", trim=False).alias("type"))


@register("text_clean", f"""
    SELECT conv_id, turn, nullif(trim(role), '') AS role,
           nullif(trim(replace({O.strip("coalesce(text, '')")}, ',', '')), '') AS text_clean
    FROM conversations""")
def text_clean(spark, sf_dir):
    """B7/C3 on whole conversation texts: strip, drop commas, blank -> NULL."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", blank_to_null("role").alias("role"),
                       blank_to_null(clean_code("text")).alias("text_clean"))


@register("latest_per_key", O.with_ctes("SELECT * FROM flights", O.FEEDS))
def latest_per_key_q(spark, sf_dir):
    """Freshest extraction per (market, icao24, arrival)."""
    return _flights(spark, sf_dir)


@register("latest_weather", O.with_ctes("SELECT * FROM weather", O.FEEDS))
def latest_weather(spark, sf_dir):
    """freshest extraction per (market, local hour) of the weather feed."""
    return _weather(spark, sf_dir)


@register("layer_counts", O.with_ctes("""
    SELECT 'flights' AS feed, CAST(sum(n) AS BIGINT) AS bronze_rows, count(*) AS silver_rows,
           CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed
    FROM (SELECT count(*) AS n FROM arrivals_feed GROUP BY market, icao24, arrival_ts_utc)
    UNION ALL
    SELECT 'weather', CAST(sum(n) AS BIGINT), count(*), CAST(sum(n) - count(*) AS BIGINT)
    FROM (SELECT count(*) AS n FROM weather_feed GROUP BY market, observed_at_local)""",
    O.FEEDS))
def layer_counts(spark, sf_dir):
    """Bronze rows, silver rows and duplicates removed, per feed,
    each from a single grouped pass."""
    ev = _events(spark, sf_dir)
    fl = key_copy_counts(feeds.arrivals_feed(spark, ev), S.FLIGHTS_KEY)
    wx = key_copy_counts(feeds.weather_feed(spark, ev), S.WEATHER_KEY)
    cols = ["bronze_rows", "silver_rows", "duplicates_removed"]
    return (fl.select(F.lit("flights").alias("feed"), *cols)
            .unionByName(wx.select(F.lit("weather").alias("feed"), *cols)))


@register("weather_flags", O.mart_sql("""
    SELECT market, observed_date_local, temp_max_f, precip_total_mm,
      CASE WHEN temp_max_f >= 108 THEN 1 ELSE 0 END AS is_extreme_heat,
      CASE WHEN temp_max_f BETWEEN 85 AND 104 AND coalesce(precip_total_mm, 0) < 0.5
           THEN 1 ELSE 0 END AS is_pool_weather,
      CASE WHEN coalesce(precip_total_mm, 0) >= 2 THEN 1 ELSE 0 END AS is_rain
    FROM wx_day"""))
def weather_flags(spark, sf_dir):
    """Heat, pool and rain flags on daily weather."""
    wx = daily_weather(_weather(spark, sf_dir))
    return R.with_flags(wx, R.weather_flag_predicates()).select(
        "market", "observed_date_local", "temp_max_f", "precip_total_mm",
        "is_extreme_heat", "is_pool_weather", "is_rain")


@register("weekend_flag", """
    SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders,
           CASE WHEN dayofweek(CAST(o_orderdate AS DATE)) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
    FROM orders GROUP BY 1""")
def weekend_flag_q(spark, sf_dir):
    """Saturday/Sunday flag per order day."""
    o = read_table(spark, sf_dir, "orders")
    daily = o.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders"))
    return daily.withColumn("is_weekend", weekend_flag("order_date"))


# ---------------------------------------------------------------------------
# 2.4 joins
# ---------------------------------------------------------------------------
@register("fact_left_join", """
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders,
                      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_value
               FROM orders GROUP BY 1),
         l AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipped_lines,
                      CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS shipped_qty
               FROM lineitem GROUP BY 1)
    SELECT o.day, o.orders, o.order_value, l.shipped_lines, l.shipped_qty
    FROM o LEFT JOIN l ON o.day = l.day""")
def fact_left_join(spark, sf_dir):
    """Daily fact LEFT JOIN another daily fact on the day key; both
    sides are aggregated first (partial aggregates), so the join moves one
    row per day."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    od = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("order_value"))
    ld = li.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("shipped_lines"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("shipped_qty"))
    return od.join(ld, "day", "left")


def _daily(spark, sf_dir):
    return marts.daily_arrivals(_flights(spark, sf_dir))


@register("calendar_join", _M("""
    SELECT d.market, d.arrival_date_local, d.arrivals,
           CASE WHEN c.event_date IS NOT NULL THEN 1 ELSE 0 END AS is_major_event,
           c.event_name,
           CASE WHEN h.holiday_date IS NOT NULL THEN 1 ELSE 0 END AS is_holiday
    FROM daily d
    LEFT JOIN cal c ON d.market = c.market AND d.arrival_date_local = c.event_date
    LEFT JOIN hol h ON d.arrival_date_local = h.holiday_date"""))
def calendar_join(spark, sf_dir):
    """Plain left joins to the market-event calendar (two
    keys) and the holiday calendar (date only), with match flags. Without
    the guard, two events on one market-day give two rows."""
    d = marts.with_calendar(_daily(spark, sf_dir), _calendar(spark),
                            _holidays(spark), guard=False)
    return d.select("market", "arrival_date_local", "arrivals", "is_major_event",
                    "event_name", "is_holiday")


@register("calendar_guard", _M("""
    SELECT d.market, d.arrival_date_local, d.arrivals,
           CASE WHEN c.event_date IS NOT NULL THEN 1 ELSE 0 END AS is_major_event,
           c.event_name,
           CASE WHEN h.holiday_date IS NOT NULL THEN 1 ELSE 0 END AS is_holiday
    FROM daily d
    LEFT JOIN (SELECT market, day AS event_date, event_name FROM event_day) c
      ON d.market = c.market AND d.arrival_date_local = c.event_date
    LEFT JOIN (SELECT DISTINCT holiday_date FROM hol) h ON d.arrival_date_local = h.holiday_date"""))
def calendar_guard(spark, sf_dir):
    """The calendar collapsed to one row per key first, so the join
    keeps one row per market-day (names sorted and joined)."""
    d = marts.with_calendar(_daily(spark, sf_dir), _calendar(spark),
                            _holidays(spark), guard=True)
    return d.select("market", "arrival_date_local", "arrivals", "is_major_event",
                    "event_name", "is_holiday")


# ---------------------------------------------------------------------------
# 2.5 aggregations, 2.6 windows
# ---------------------------------------------------------------------------
@register("daily_count", _M("SELECT * FROM daily"))
def daily_count(spark, sf_dir):
    """Arrivals per market per local day."""
    return _daily(spark, sf_dir)


@register("daily_stats", _M("""
    SELECT market, observed_date_local, temp_max_f, temp_min_f,
           precip_total_mm, wind_max_kmh FROM wx_day"""))
def daily_stats(spark, sf_dir):
    """Daily max/min temperature, rounded precip total and wind."""
    return daily_weather(_weather(spark, sf_dir))


@register("hourly_curve", _M("""
    SELECT market, arrival_date_local, arrival_hour_local, count(*) AS arrivals
    FROM flights GROUP BY ALL"""))
def hourly_curve(spark, sf_dir):
    """Arrivals per market, local day and local hour."""
    return marts.hourly_curve(_flights(spark, sf_dir))


@register("trailing_baseline", f"""
    WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS order_date,
                      count(*) AS orders FROM orders GROUP BY 1, 2)
    SELECT *, avg(orders) OVER w AS trailing_7day_avg, count(orders) OVER w AS days_in_window
    FROM d WINDOW w AS (PARTITION BY o_orderpriority ORDER BY order_date
                        ROWS BETWEEN {S.TRAILING_DAYS} PRECEDING AND 1 PRECEDING)""")
def trailing_baseline_q(spark, sf_dir):
    """Trailing 7-observed-day average and count per priority over
    sparse order days (gaps stretch the frame: ROWS, not calendar days)."""
    o = read_table(spark, sf_dir, "orders")
    d = o.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders"))
    return trailing_baseline(d, ["o_orderpriority"], "order_date", "orders")


@register("pct_vs_baseline", _M(f"""
    SELECT market, arrival_date_local, arrivals,
           {O.rnd('trailing_7day_avg')} AS trailing_7day_avg, days_in_window,
           CASE WHEN trailing_7day_avg > 0 THEN
             {O.rnd('(arrivals - trailing_7day_avg) / trailing_7day_avg * 100')} END
             AS arrivals_vs_7day_avg_pct
    FROM base"""))
def pct_vs_baseline_q(spark, sf_dir):
    """Deviation from the trailing average, guarded and rounded."""
    t = trailing_baseline(_daily(spark, sf_dir), ["market"], "arrival_date_local", "arrivals")
    return t.select("market", "arrival_date_local", "arrivals",
                    F.round("trailing_7day_avg", 1).alias("trailing_7day_avg"),
                    "days_in_window",
                    pct_vs_baseline("arrivals", "trailing_7day_avg")
                    .alias("arrivals_vs_7day_avg_pct"))


# ---------------------------------------------------------------------------
# 2.9 rules, labels, drivers, interpretation (projections of the mart)
# ---------------------------------------------------------------------------
_SCORE_COLS = ["daily_key", "arrivals_vs_7day_avg_pct", "is_weekend", "is_holiday",
               "is_major_event", "is_extreme_heat", "is_rain", "pressure_score"]


@register("rule_score", _M(f"SELECT {', '.join(_SCORE_COLS)} FROM mart"))
def rule_score(spark, sf_dir):
    """The rules score (sum over ladders, first match wins)."""
    return mart(spark, sf_dir).select(*_SCORE_COLS)


@register("band_label", _M("""
    SELECT daily_key, days_in_window, pressure_score, demand_pressure FROM mart_full"""))
def band_label(spark, sf_dir):
    """Bands by score with the warm-up override."""
    return mart(spark, sf_dir, keep_window=True).select(
        "daily_key", "days_in_window", "pressure_score", "demand_pressure")


@register("driver_text", _M("SELECT daily_key, pressure_score, event_name, score_drivers FROM mart"))
def driver_text(spark, sf_dir):
    """Every fired rule with its points, '; '-joined."""
    return mart(spark, sf_dir).select("daily_key", "pressure_score", "event_name",
                                      "score_drivers")


@register("interpretation", _M("SELECT daily_key, demand_pressure, interpretation FROM mart"))
def interpretation(spark, sf_dir):
    """Label -> plain-language reading."""
    return mart(spark, sf_dir).select("daily_key", "demand_pressure", "interpretation")


# ---------------------------------------------------------------------------
# 2.7 / 2.9 alerts
# ---------------------------------------------------------------------------
_ALERT_SQL = f"""
    SELECT {', '.join(S.ALERT_COLUMNS)} FROM mart
    WHERE arrival_date_local = (SELECT max(arrival_date_local) FROM mart)"""


@register("latest_snapshot", _M(_ALERT_SQL))
def latest_snapshot(spark, sf_dir):
    """Every market's row on the global latest date."""
    return A.latest_snapshot(gold(spark, sf_dir))


@register("alert_rows", _M(f"SELECT * FROM ({_ALERT_SQL}) WHERE demand_pressure = 'HIGH'"))
def alert_rows(spark, sf_dir):
    """HIGH rows of the snapshot (none = no alert)."""
    return A.alert_rows(A.latest_snapshot(gold(spark, sf_dir)))


_DIGEST_LINE = ("market || ': ' || demand_pressure || ' | ' || CAST(arrivals AS VARCHAR) "
                "|| ' arrivals, ' || coalesce(CAST(arrivals_vs_7day_avg_pct AS VARCHAR), 'n/a') "
                "|| '% vs trailing avg | why: ' || score_drivers || chr(10) || '  ' || interpretation")


def _digest_sql(rows: str) -> str:
    return f"""
    SELECT arrival_date_local, count(*) AS markets,
           count(*) FILTER (WHERE demand_pressure = 'HIGH') AS high_markets,
           'Demand signals ' || CAST(arrival_date_local AS VARCHAR) || ': ' || coalesce('HIGH in '
             || string_agg(market, ', ' ORDER BY market) FILTER (WHERE demand_pressure = 'HIGH'), 'no HIGH market')
             AS subject,
           'Demand signals for ' || CAST(arrival_date_local AS VARCHAR) || chr(10)
             || string_agg({_DIGEST_LINE}, chr(10) ORDER BY market) || chr(10)
             || {O.q(S.DIGEST_FOOTER)} AS digest
    FROM ({rows}) GROUP BY arrival_date_local"""


@register("alert_digest", _M(_digest_sql(_ALERT_SQL)))
def alert_digest(spark, sf_dir):
    """The latest day's message, with its subject."""
    return A.alert_digest(A.latest_snapshot(gold(spark, sf_dir)))


@register("alert_history", _M(f"SELECT {', '.join(S.ALERT_COLUMNS)} FROM mart WHERE demand_pressure = 'HIGH'"))
def alert_history(spark, sf_dir):
    """I13 over every day: the rows that raised an alert."""
    return A.alert_rows(gold(spark, sf_dir).select(*S.ALERT_COLUMNS))


@register("digest_history", _M(_digest_sql("SELECT * FROM mart")))
def digest_history(spark, sf_dir):
    """I14 over every day: one message per day, all markets of the day."""
    return A.alert_digest(gold(spark, sf_dir))


@register("digest_outbox", _M(_digest_sql("SELECT * FROM mart WHERE demand_pressure IS DISTINCT FROM 'WARMUP'")
                              .replace("GROUP BY arrival_date_local", "GROUP BY arrival_date_local HAVING "
                                       "arrival_date_local > (SELECT min(arrival_date_local) + 14 FROM mart)")))
def digest_outbox(spark, sf_dir):
    """I14 with its outbox: of every day's digest (rated markets), those of the
    first fortnight and of the first day behind it were sent; the latter with
    another content, so it is told again."""
    rated = gold(spark, sf_dir).filter(~F.col("demand_pressure").eqNullSafe(S.WARMUP_LABEL))
    digests = A.alert_digest(rated)
    begin = gold(spark, sf_dir).select(F.min("arrival_date_local")).scalar()
    sent = A.sent_rows(digests.filter(F.col("arrival_date_local") <= F.date_add(begin, 14)))
    stale = A.sent_rows(digests.filter(F.col("arrival_date_local") == F.date_add(begin, 15))
                        .withColumn("digest", F.concat("digest", F.lit("!"))))
    return A.unsent(digests, sent.unionByName(stale))


@register("top_recent", _M("""
    SELECT market, arrival_date_local, arrivals, pressure_score, demand_pressure, score_drivers
    FROM mart ORDER BY arrival_date_local DESC, market LIMIT 10"""))
def top_recent(spark, sf_dir):
    """Ten most recent market-days (a top-k report)."""
    return A.top_recent(gold(spark, sf_dir))


# ---------------------------------------------------------------------------
# 2.10 data quality
# ---------------------------------------------------------------------------
def _chk(name: str, bad_sql: str, src: str) -> str:
    return (f"SELECT '{name}' AS \"check\", CAST(({bad_sql}) AS BIGINT) AS bad_rows, "
            f"({bad_sql}) = 0 AS passed FROM {src}")


def _dup_sql(name, keys, src, ignore_nulls=False):
    where = (" WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in keys)) if ignore_nulls else ""
    inner = f"(SELECT 1 FROM {src}{where} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
    return _chk(name, "count(*)", inner)


def _unique_checks(spark, sf_dir):
    fl, wx, m = _flights(spark, sf_dir), _weather(spark, sf_dir), gold(spark, sf_dir)
    return [Q.unique(fl, S.FLIGHTS_KEY, "silver_flights"),
            Q.unique(wx, S.WEATHER_KEY, "silver_weather"),
            Q.unique(m, ["daily_key"], "gold", ignore_nulls=True)]


_UNIQUE_SQL = [
    _dup_sql("silver_flights.unique.market+icao24+arrival_ts_utc", S.FLIGHTS_KEY, "flights"),
    _dup_sql("silver_weather.unique.market+observed_at_local", S.WEATHER_KEY, "weather"),
    _dup_sql("gold.unique.daily_key", ["daily_key"], "mart", ignore_nulls=True),
]


@register("dq_unique", _M(" UNION ALL ".join(_UNIQUE_SQL)))
def dq_unique(spark, sf_dir):
    """Natural keys and the mart grain are unique."""
    return Q.suite(_unique_checks(spark, sf_dir))


@register("bucketed_unique", _M(_UNIQUE_SQL[0]))
def bucketed_unique(spark, sf_dir):
    """J2/J3 on silver that is bucketed by its natural key: the grouping takes
    the table's own distribution, without an exchange below it."""
    return Q.unique(landing.bucketed_flights(spark, sf_dir), S.FLIGHTS_KEY, "silver_flights")


@register("bucketed_merge", O.with_ctes("""
    SELECT market, count(*) AS arrivals, count(*) FILTER (WHERE arrival_hour_local % 2 = 0) AS renewed
    FROM flights GROUP BY market""", O.FEEDS))
def bucketed_merge(spark, sf_dir):
    """F1 on bucketed silver: a second extraction of some of its keys, in as
    many buckets, is merged into it, freshest first, without an exchange of
    either."""
    silver = landing.bucketed_flights(spark, sf_dir)
    later = F.timestamp_add("DAY", F.lit(36_500), F.col("extracted_at_utc"))
    new = silver.filter(F.col("arrival_hour_local") % 2 == 0).withColumn("extracted_at_utc", later)
    merged = dedupe_latest(silver.unionByName(new), S.FLIGHTS_KEY, S.FRESHEST)
    renewed = F.col("extracted_at_utc") > F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    return merged.groupBy("market").agg(F.count(F.lit(1)).alias("arrivals"), F.count_if(renewed).alias("renewed"))


_NOT_NULL = {
    "gold": ("mart", ["daily_key", "arrivals", "demand_pressure", "score_drivers",
                      "interpretation"]),
    "silver_flights": ("flights", ["market", "arrival_ts_utc"]),
    "silver_weather": ("weather", ["market", "observed_at_local"]),
    "hourly_curve": ("hourly", ["market"]),
}


def _not_null_checks(spark, sf_dir):
    fl, wx, m = _flights(spark, sf_dir), _weather(spark, sf_dir), gold(spark, sf_dir)
    tables = {"gold": m, "silver_flights": fl, "silver_weather": wx,
              "hourly_curve": marts.hourly_curve(fl)}
    return [Q.not_null(tables[t], cols, t) for t, (_, cols) in _NOT_NULL.items()]


_NOT_NULL_SQL = [
    _chk(f"{t}.not_null.{c}", f"count(*) FILTER (WHERE {c} IS NULL)", src)
    for t, (src, cols) in _NOT_NULL.items() for c in cols]
_HOURLY_CTE = {"hourly": "SELECT market, arrival_date_local, arrival_hour_local, count(*) AS arrivals "
                         "FROM flights GROUP BY ALL"}


@register("dq_not_null", O.with_ctes(" UNION ALL ".join(_NOT_NULL_SQL), O.FEEDS, O.MART, _HOURLY_CTE))
def dq_not_null(spark, sf_dir):
    """Required columns are never NULL (one aggregate pass per table)."""
    return Q.suite(_not_null_checks(spark, sf_dir))


_ACCEPTED_SQL = _chk("gold.accepted.demand_pressure",
                     "count(*) FILTER (WHERE demand_pressure IS NULL OR demand_pressure NOT IN ("
                     + ", ".join(O.q(v) for v in S.ACCEPTED_LABELS) + "))", "mart")


@register("dq_accepted", _M(_ACCEPTED_SQL))
def dq_accepted(spark, sf_dir):
    """Labels come from the accepted set (NULL is a failure)."""
    return Q.accepted_values(gold(spark, sf_dir), "demand_pressure", S.ACCEPTED_LABELS, "gold")


_WARMUP_SQL = _chk("gold.warmup_first_days", f"""count(*) FILTER (WHERE
        (day_rank <= {S.WARMUP_MIN_DAYS} AND demand_pressure IS DISTINCT FROM 'WARMUP')
     OR (day_rank > {S.WARMUP_MIN_DAYS} AND demand_pressure = 'WARMUP'))""",
    "(SELECT demand_pressure, row_number() OVER (PARTITION BY market "
    "ORDER BY arrival_date_local) AS day_rank FROM mart)")


@register("dq_warmup", _M(_WARMUP_SQL))
def dq_warmup(spark, sf_dir):
    """WARMUP covers exactly each market's first seven days."""
    return Q.warmup_window(gold(spark, sf_dir))


_POINTS_SQL = "(SELECT points FROM totals t WHERE t.market = m.market AND t.arrival_date_local = m.arrival_date_local)"


@register("driver_reconcile", _M(f"""
    SELECT daily_key, pressure_score, coalesce({_POINTS_SQL}, 0) AS driver_points,
           coalesce(pressure_score = coalesce({_POINTS_SQL}, 0), false) AS reconciled
    FROM mart m"""))
def driver_reconcile(spark, sf_dir):
    """The points of the rules that fired (kept as an array in the
    gold table) add up to the score."""
    return Q.reconcile_rows(gold(spark, sf_dir))


_TEXT_POINTS_SQL = ("list_sum(list_transform(regexp_extract_all(score_drivers, '\\(\\+(\\d+)\\)', 1), "
                    "lambda x: CAST(x AS INTEGER)))")


@register("driver_text_points", _M(f"""
    SELECT daily_key, pressure_score, CAST(coalesce({_TEXT_POINTS_SQL}, 0) AS INTEGER) AS text_points
    FROM mart"""))
def driver_text_points(spark, sf_dir):
    """Points read back from the drivers text, a report beside the
    check (an event's name may hold such a mark itself)."""
    return gold(spark, sf_dir).select("daily_key", "pressure_score",
                                      Q.driver_points_from_text("score_drivers").alias("text_points"))


_RECONCILE_SQL = _chk("gold.drivers_reconcile",
                      f"count(*) FILTER (WHERE NOT coalesce(pressure_score = coalesce({_POINTS_SQL}, 0), false))",
                      "mart m")
_KNOWN_SQL = _chk("silver_flights.known_market",
                  "count(*) FILTER (WHERE market IS NULL OR market NOT IN (SELECT market FROM markets))", "flights")


@register("dq_known_market", _M(_KNOWN_SQL))
def dq_known_market(spark, sf_dir):
    """Arrivals of markets that the dimension lacks are counted; they
    stay in every table."""
    return Q.known_markets(_flights(spark, sf_dir), feeds.markets(spark), "silver_flights")


@register("dq_suite", O.with_ctes(" UNION ALL ".join(
    _UNIQUE_SQL + _NOT_NULL_SQL + [_ACCEPTED_SQL, _WARMUP_SQL, _RECONCILE_SQL, _KNOWN_SQL]),
    O.FEEDS, O.MART, _HOURLY_CTE))
def dq_suite(spark, sf_dir):
    """Every check in one DataFrame (one row per check)."""
    m = gold(spark, sf_dir)
    checks = _unique_checks(spark, sf_dir) + _not_null_checks(spark, sf_dir)
    checks += [Q.accepted_values(m, "demand_pressure", S.ACCEPTED_LABELS, "gold"),
               Q.warmup_window(m), Q.reconcile(m), dq_known_market(spark, sf_dir)]
    return Q.suite(checks)


# ---------------------------------------------------------------------------
# 2.11 streaming (availableNow over the landed raw files)
# ---------------------------------------------------------------------------

_SILVER_COLS = ["market", "icao24", "callsign", "departure_airport", "arrival_ts_utc",
                "arrival_date_local", "arrival_hour_local"]


@register("stream_ingest", O.with_ctes("""
    SELECT market, icao24, callsign, departure_airport, arrival_ts_utc,
           arrival_date_local, arrival_hour_local, extracted_at_utc
    FROM arrivals_feed""", O.FEEDS))
def stream_ingest(spark, sf_dir):
    """K1: raw files streamed (availableNow, micro-batches of a byte size)
    into a typed, dt-partitioned table; equals the batch typed projection."""
    out = work_dir(spark, "stream-ingest")
    t = K.ingest(spark, landing.landed_flights(spark, sf_dir), f"{out}/table", f"{out}/_checkpoint")
    return t.select(*S.FLIGHTS_COLUMNS)


@register("stream_upsert", O.with_ctes("SELECT * FROM flights", O.FEEDS))
def stream_upsert(spark, sf_dir):
    """K2: freshest-wins upsert of the landed files (the two pulls overlap on
    natural keys); equals the batch dedupe."""
    out = work_dir(spark, "stream-upsert")
    t = K.upsert(spark, landing.landed_flights(spark, sf_dir), f"{out}/silver", f"{out}/_checkpoint")
    return t.select(*_SILVER_COLS)


@register("stream_tumbling", O.with_ctes("""
    SELECT date_trunc('day', arrival_ts_utc) AS window_start,
           date_trunc('day', arrival_ts_utc) + INTERVAL 1 DAY AS window_end,
           market, count(*) AS rows
    FROM arrivals_feed GROUP BY ALL""", O.FEEDS))
def stream_tumbling(spark, sf_dir):
    """K3: per-market arrival rows in one-day tumbling event-time windows,
    state kept across micro-batches."""
    out = work_dir(spark, "stream-tumbling")
    return K.tumbling_counts(spark, landing.landed_flights(spark, sf_dir), f"{out}/counts",
                             f"{out}/_checkpoint")


TOLERANCE = "36 hours"


@register("stream_tumbling_watermark", O.with_ctes("""
    SELECT * FROM (
        SELECT date_trunc('day', arrival_ts_utc) AS window_start,
               date_trunc('day', arrival_ts_utc) + INTERVAL 1 DAY AS window_end,
               market, count(*) AS rows
        FROM arrivals_feed GROUP BY 1, 2, 3)
    WHERE window_end <= (SELECT max(arrival_ts_utc) FROM arrivals_feed) - INTERVAL 36 HOUR""", O.FEEDS))
def stream_tumbling_watermark(spark, sf_dir):
    """K3 for a live stream: daily windows are written once the watermark has
    passed them, and their state is dropped."""
    out = work_dir(spark, "stream-watermark")
    return K.tumbling_counts(spark, landing.landed_flights(spark, sf_dir), f"{out}/counts",
                             f"{out}/_checkpoint", late_tolerance=TOLERANCE)


# ---------------------------------------------------------------------------
# 2.1 A7/A8/A10-A12: the full medallion build over landed raw files
# ---------------------------------------------------------------------------


@register("medallion_gold", O.mart_sql("SELECT * FROM mart"))
def medallion_gold(spark, sf_dir):
    """Raw CSV (flights and weather) and seeds from header CSV -> seed and
    bronze tables -> silver tables -> gold table, in the shared folder;
    returns the written gold table."""
    root = work_dir(spark, "warehouse")
    db = "signalmart_" + root.rsplit("-", 1)[-1]
    seeds = {}
    for name, seed, ddl in (("events", _calendar(spark), S.CALENDAR_EVENTS_DDL),
                            ("holidays", _holidays(spark), S.HOLIDAYS_DDL)):
        seed.write.option("header", "true").csv(f"{root}/seeds/{name}")
        seeds[name] = read_seed(spark, f"{root}/seeds/{name}", ddl)
    medallion.build(spark, landing.landed_flights(spark, sf_dir),
                    landing.landed_weather(spark, sf_dir), seeds["events"],
                    seeds["holidays"], root, database=db)
    return medallion.gold(spark, db).select(*S.DAILY_COLUMNS)


@register("model_graph", O.mart_sql("SELECT market, arrival_date_local, arrival_hour_local, count(*) AS arrivals "
                                    "FROM flights GROUP BY ALL"))
def model_graph(spark, sf_dir):
    """One mart of the model graph: its staging view (a persistent
    catalog view over the raw zone's table) and itself, nothing else."""
    root = landing.landed_flights(spark, sf_dir)
    db, out = "models_" + root.rsplit("-", 1)[-1], work_dir(spark, "models")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{out}/_db'")
    pulls.catalog_table(spark, f"{db}.raw_flights", root, S.RAW_FLIGHTS_SCHEMA)
    models.build(spark, ["mart_hourly_curve"], db, out)
    return spark.table(f"{db}.mart_hourly_curve")


# ---------------------------------------------------------------------------
# K2 + I10: incremental path - streams keep daily rollups current, the mart
# is scored from the rollups (daily grain only)
# ---------------------------------------------------------------------------


@register("stream_tumbling_hourly", O.with_ctes("""
    SELECT date_trunc('hour', arrival_ts_utc) AS window_start,
           date_trunc('hour', arrival_ts_utc) + INTERVAL 1 HOUR AS window_end,
           market, count(*) AS rows
    FROM arrivals_feed GROUP BY ALL""", O.FEEDS))
def stream_tumbling_hourly(spark, sf_dir):
    """K3 (hourly): per-market arrival rows in one-hour tumbling windows."""
    out = work_dir(spark, "stream-tumbling-hourly")
    return K.tumbling_counts(spark, landing.landed_flights(spark, sf_dir), f"{out}/counts",
                             f"{out}/_checkpoint", every="1 hour")


@register("stream_daily_signals", O.mart_sql("SELECT * FROM mart"))
def stream_daily_signals(spark, sf_dir):
    """Both feeds streamed through the freshest-wins upsert into silver
    tables partitioned by (dt, key bucket); each micro-batch writes a new
    version of only the partitions it touches and of their partial daily
    rollups; the mart combines the partials per market-day and is scored from
    them."""
    out = work_dir(spark, "stream-mart")
    incremental.refresh(spark, landing.landed_flights(spark, sf_dir),
                        landing.landed_weather(spark, sf_dir), out)
    return incremental.signals(spark, out, _calendar(spark), _holidays(spark)).select(*S.DAILY_COLUMNS)


@register("incremental_gold", O.mart_sql("SELECT * FROM mart"))
def incremental_gold(spark, sf_dir):
    """Gold kept current in two runs. The first takes in all but
    the last three days' late pull, the second just that: it rescored the days
    that pull reaches, and the rows are those of a rebuild."""
    out, raw = work_dir(spark, "incremental"), work_dir(spark, "raw-in-two")
    feed = landing.raw_flights(spark, sf_dir)
    last = _latest(feed, F.col("dt").cast("date"))
    late = (F.col("dt").cast("date") >= F.date_sub(last, 2)) & (F.col("pull") == "late")
    columns = [*S.FLIGHTS_COLUMNS, S.EXTRACTION_COLUMN]
    seeds = _calendar(spark), _holidays(spark)
    for part in (feed.filter(~late), feed.filter(late).withColumn("pull", F.lit("last"))):
        pulls.land_pulls(part, raw, columns)
        incremental.refresh(spark, raw, landing.landed_weather(spark, sf_dir), out)
        incremental.refresh_gold(spark, out, *seeds)
    return incremental.gold(spark, out).select(*S.DAILY_COLUMNS)
