"""Landed API payloads (JSON, one document per line) -> raw feed rows.

Extractors commonly normalise such payloads in a Python loop on one machine,
which stops at a bad value or drops it. Here the landed documents are the input
of a Spark job: each is parsed once into a VARIANT (`try_parse_json`) and every
field is taken from it with its own type (`try_variant_get`), all JVM-side.

Nothing is lost uncounted: `arrival_records` and `weather_records` give one row
per record of every document, and one for a document that can't be read, with
a `reason` why it gives no raw row (NULL: it does). NO_TIME is the one reason
that is no fault: such records are left out by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.functions.columns import clean_code, epoch_to_utc, utc_to_local

# ---------------------------------------------------------------------------
# FIXED VALUES: payload field names, exactly as the source APIs return them
# ---------------------------------------------------------------------------
ARRIVAL_TIME = "lastSeen"
ARRIVAL_TEXTS = ["icao24", "callsign", "estDepartureAirport"]
WEATHER_PATH, WEATHER_TIME = "hourly", "time"
WEATHER_VALUES = {"temperature_2m": "temp_f", "precipitation": "precip_mm", "wind_speed_10m": "wind_kmh"}

ARRIVALS_PAYLOAD, WEATHER_PAYLOAD = "arrivals", "weather"
NO_TIME = "no time"
#: Seconds of the years 1 to 9999, which timestamps can hold.
_EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Documents as text lines, with the file they came from and its time."""
    return (spark.read.option("recursiveFileLookup", "true").text(path)
            .select(F.col("value").alias("payload"),
                    F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_modification_time").alias("file_time")))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _kept(docs: DataFrame) -> list[str]:
    return [c for c in (S.EXTRACTION_COLUMN, S.PULL_COLUMN) if c in docs.columns]


def _kind(v: Column) -> Column:
    """What a variant holds: OBJECT..., ARRAY..., STRING, BOOLEAN, VOID (a JSON
    null) or a number's type; NULL for nothing."""
    return F.schema_of_variant(v)


def _is_number(v: Column) -> Column:
    return _kind(v).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)")


def _missing(v: Column) -> Column:
    return v.isNull() | (_kind(v) == "VOID")


def _first_of(*cases: tuple[Column, str]) -> Column:
    """The first reason whose condition holds, or NULL."""
    out = F.when(cases[0][0], cases[0][1])
    for condition, reason in cases[1:]:
        out = out.when(condition, reason)
    return out


def _documents(docs: DataFrame, payload: str | Column, **columns: Column) -> DataFrame:
    """Documents that are not blank, as text (`_text`) and parsed (`_doc`)."""
    text = F.trim(F.coalesce(_col(payload), F.lit("")))
    return (docs.select(*[c.alias(n) for n, c in columns.items()], *_kept(docs), text.alias("_text"))
            .filter("_text <> ''").withColumn("_doc", F.try_parse_json("_text")))


def _unreadable(body: Column, shape: str) -> Column:
    """Why a document gives no records. The parser stops at the end of the
    first value, so what follows it is looked for in the text."""
    more = F.col("_text").rlike(r"[\]}]\s*[\[{]") | ~F.col("_text").rlike(r"[\]}]$")
    return _first_of((F.col("_doc").isNull(), "malformed document"), (body.isNull(), f"malformed document: {shape}"),
                     (more, "malformed document: text behind its end"))


def arrival_records(docs: DataFrame, payload: str | Column, market: str | Column,
                    tz: str | Column, extracted_at: str | Column) -> DataFrame:
    """Array-of-objects payloads, one row per record: the raw flights columns,
    `record` (its JSON text) and `reason`.

    A record without an arrival time (lastSeen null, 0 or missing) has the
    reason NO_TIME. Fractions of a second are dropped; missing text fields
    default to ''; the callsign is stripped and loses its commas; local date and
    hour come from the market's zone. A document that is no array of records is
    one row. Columns of `docs` named `extraction_id` and `pull` are kept.
    """
    read = _documents(docs, payload, market=_col(market), _tz=_col(tz), extracted_at_utc=_col(extracted_at))
    body = F.try_variant_get("_doc", "$", "array<variant>")
    read = read.withColumn("_bad", _unreadable(body, "not an array of records"))
    each = F.when(F.col("_bad").isNull(), body).otherwise(F.array(F.lit(None).cast("variant")))
    rec = read.withColumn("r", F.explode(each))
    part = lambda f: F.try_variant_get("r", f"$.{f}", "variant")
    rec = rec.withColumns({"_seen": part(ARRIVAL_TIME),
                           "_at": F.floor(F.try_variant_get("r", f"$.{ARRIVAL_TIME}", "double"))})
    low, high = _EPOCH_RANGE
    rec = rec.withColumn("reason", F.coalesce("_bad", _first_of(
        (~F.coalesce(_kind(F.col("r")), F.lit("")).startswith("OBJECT"), "record is no object"),
        (_missing(F.col("_seen")), NO_TIME),
        (~_is_number(F.col("_seen")), f"{ARRIVAL_TIME} is no number"),
        (F.try_variant_get("r", f"$.{ARRIVAL_TIME}", "double") == 0, NO_TIME),
        (~F.coalesce(F.col("_at").between(low, high), F.lit(False)), f"{ARRIVAL_TIME} is out of range"),
        *[(F.coalesce(_kind(part(f)), F.lit("")).rlike("^(OBJECT|ARRAY)"), f"{f} is no text") for f in ARRIVAL_TEXTS])))
    fits = F.when(F.col("reason").isNull(), F.col("_at").cast("long"))
    text = lambda f: F.coalesce(F.try_variant_get("r", f"$.{f}", "string"), F.lit(""))
    utc = epoch_to_utc(fits)
    local = utc_to_local(utc, F.col("_tz"))
    icao, callsign, departed = (text(f) for f in ARRIVAL_TEXTS)
    return rec.select(
        "market", icao.alias("icao24"), clean_code(callsign).alias("callsign"), departed.alias("departure_airport"),
        F.date_format(utc, S.RAW_TS_FORMAT).alias("arrival_ts_utc"),
        F.date_format(local, "yyyy-MM-dd").alias("arrival_date_local"),
        F.hour(local).cast("string").alias("arrival_hour_local"),
        F.col("extracted_at_utc").cast("string").alias("extracted_at_utc"), *_kept(docs),
        F.when(F.col("_bad").isNull(), F.to_json("r")).otherwise(F.col("_text")).alias("record"), "reason")


def arrival_rows(docs: DataFrame, payload: str | Column, market: str | Column,
                 tz: str | Column, extracted_at: str | Column) -> DataFrame:
    """The raw flights rows of `arrival_records`."""
    return arrival_records(docs, payload, market, tz, extracted_at).filter("reason IS NULL").drop("record", "reason")


def rejects(docs: DataFrame, payload: str, kind: str) -> DataFrame:
    """The documents that are no payload of this kind: not JSON, or JSON of
    another shape. Blank lines are no documents."""
    none = F.lit(None).cast("string")
    records = arrival_records(docs, payload, none, F.lit("UTC"), none) if kind == ARRIVALS_PAYLOAD \
        else weather_records(docs, payload, none, none)
    return records.filter(F.col("reason").startswith("malformed document"))


def iso_parts(iso: Column) -> list[Column]:
    """'2026-07-17T14:00' -> local timestamp text, local date, hour."""
    return [
        F.concat(F.regexp_replace(iso, "T", " "), F.lit(":00")).alias("observed_at_local"),
        F.substring(iso, 1, 10).alias("observed_date_local"),
        F.substring(iso, 12, 2).cast("int").cast("string").alias("hour_local"),
    ]


def weather_records(docs: DataFrame, payload: str | Column, market: str | Column,
                    extracted_at: str | Column) -> DataFrame:
    """Parallel-array payloads, one row per hour (index i across time,
    temperature, precipitation and wind): the raw weather columns, `record`
    and `reason`. An array may be missing or short: its values are NULL. A value
    that is there and no number sets the hour aside, and an array that is there
    and no array the document."""
    read = _documents(docs, payload, market=_col(market), extracted_at_utc=_col(extracted_at))
    at = lambda f, kind: F.try_variant_get("_doc", f"$.{WEATHER_PATH}.{f}", kind)
    read = read.withColumns({f"_{f}": at(f, "array<variant>") for f in (WEATHER_TIME, *WEATHER_VALUES)})
    read = read.withColumn("_bad", F.coalesce(
        _unreadable(F.col(f"_{WEATHER_TIME}"), f"no array {WEATHER_PATH}.{WEATHER_TIME}"),
        *[F.when(F.col(f"_{f}").isNull() & ~_missing(at(f, "variant")), f"malformed document: {f} is no array")
          for f in WEATHER_VALUES]))
    none = F.array().cast("array<variant>")
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"_{f}"), none).alias(f) for f in (WEATHER_TIME, *WEATHER_VALUES)])
    nothing = F.struct(*[F.lit(None).cast("variant").alias(f) for f in (WEATHER_TIME, *WEATHER_VALUES)])
    rec = read.withColumn("r", F.explode(F.when(F.col("_bad").isNull(), zipped).otherwise(F.array(nothing))))
    time = F.col("r")[WEATHER_TIME]
    iso = F.try_variant_get(time, "$", "string")
    stamp = F.try_to_timestamp(F.substring(F.translate(iso, "T", " "), 1, 16), F.lit("yyyy-MM-dd HH:mm"))
    rec = rec.withColumn("reason", F.coalesce("_bad", _first_of(
        (_missing(time), NO_TIME),
        ((_kind(time) != "STRING") | ~iso.rlike(_ISO) | stamp.isNull(), f"{WEATHER_TIME} is no ISO time"),
        *[(~_missing(F.col("r")[f]) & ~_is_number(F.col("r")[f]), f"{f} is no number") for f in WEATHER_VALUES])))
    values = [F.try_variant_get(F.col("r")[f], "$", "double").cast("string").alias(c) for f, c in WEATHER_VALUES.items()]
    return rec.withColumn("_iso", F.when(F.col("reason").isNull(), iso)).select(
        "market", *iso_parts(F.col("_iso")), *values,
        F.col("extracted_at_utc").cast("string").alias("extracted_at_utc"), *_kept(docs),
        F.when(F.col("_bad").isNull(), F.to_json("r")).otherwise(F.col("_text")).alias("record"), "reason")


def weather_rows(docs: DataFrame, payload: str | Column, market: str | Column,
                 extracted_at: str | Column) -> DataFrame:
    """The raw weather rows of `weather_records`."""
    return weather_records(docs, payload, market, extracted_at).filter("reason IS NULL").drop("record", "reason")
