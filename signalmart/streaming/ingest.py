"""Incremental paths with Structured Streaming.

K1 ingest:   new raw CSV files -> typed rows appended to a parquet table.
K2 upsert:   new raw files -> freshest-wins merge into a versioned silver
             table (foreachBatch; see streaming.versioned).
K3 tumbling: per-market counts in fixed (daily / hourly) event-time windows.

All three run with `trigger(availableNow=True)`: process every file present
at start, in micro-batches of about `max_bytes` (with a watermark: in one), then
stop. Offsets and state
live in the checkpoint folder, so a restarted job resumes where it stopped.
A micro-batch writes new versions of the partitions it touches and never the
files it reads, so a crash at any point loses nothing, and a new checkpoint on
an old table takes the files in again without losing what the table holds.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalmart import schemas as S
from signalmart.operators.dedupe import latest_per_key
from signalmart.sources.raw import typed_projection, with_extraction_id
from signalmart.streaming import versioned

#: Input of one micro-batch, and of one (day, key bucket) of a silver table.
BATCH_BYTES = 1 << 30
BUCKET_BYTES = 1 << 30
BUCKET_COLUMN = "key_bucket"


def raw_stream(spark: SparkSession, root: str, schema: StructType,
               max_files: int | None = None, max_bytes: int | None = BATCH_BYTES) -> DataFrame:
    """Streaming read of headerless CSV below `root`, dt from the path. A
    micro-batch takes about `max_bytes`, or `max_files` files if given, or
    with neither all there is."""
    r = spark.readStream.schema(schema).option("header", "false").option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return (with_extraction_id(r.csv(root))
            .withColumn(S.PARTITION_COLUMN,
                        F.regexp_extract(F.col("_metadata.file_path"), S.PARTITION_PATTERN, 1)))


def buckets_for(spark: SparkSession, src: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Key buckets a day needs so that the largest day landed so far has
    about `bucket_bytes` in each. Only file sizes are read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
             .select(F.regexp_extract("path", S.PARTITION_PATTERN, 1).alias("day"), "length"))
    most = files.groupBy("day").agg(F.sum("length").alias("bytes")).agg(F.max("bytes")).first()[0]
    return max(1, math.ceil((most or 0) / bucket_bytes))


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to caller
        raise query.exception()


def ingest(spark: SparkSession, src: str, sink: str, checkpoint: str,
           types: dict = S.FLIGHTS_TYPES, schema: StructType = S.RAW_FLIGHTS_SCHEMA,
           max_files: int | None = None) -> DataFrame:
    """K1: append typed rows of every new file to a dt-partitioned table."""
    s = typed_projection(raw_stream(spark, src, schema, max_files), types,
                         keep=(S.PARTITION_COLUMN,))
    q = (s.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint)
         .partitionBy(S.PARTITION_COLUMN)
         .trigger(availableNow=True)
         .start(sink))
    _finish(q)
    return spark.read.parquet(sink)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def upsert_batch(table: str, keys: list[str], order: list[str],
                 partition_cols: list[str] = (S.PARTITION_COLUMN,),
                 rollups: list[tuple] = (), checkpoint: str | None = None):
    """foreachBatch function: merge a micro-batch into `table`, freshest wins.

    Only the current files of the partitions the batch touches (dt, or dt x
    key bucket) are listed and read; the merged rows become a new version of
    those partitions, and one small append makes it current. For each of
    `rollups` (an aggregate DataFrame -> DataFrame that keeps the partition
    columns, and its table) the same partitions get a new version too: late
    data for an old day rewrites that day's (bucket of the) rollup only.

    The table's own commit comes last and names the stream and the batch. A
    batch that died before it is merged again, from the rows that are still
    current; one that died after it is left alone.
    """
    cols = list(partition_cols)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint) if checkpoint else None
        if stream and versioned.applied(spark, table, stream, batch_id):
            return
        touched = batch.select(*cols).distinct().collect()  # at most days x buckets of the batch
        if not touched:
            return
        old = versioned.read_partitions(spark, table, cols, batch.schema, touched)
        merged = latest_per_key(old.unionByName(batch), keys, order)
        version = versioned.last_version(spark, table) + 1
        versioned.write(merged, table, cols, version)
        for rollup, to in rollups:
            fresh = versioned.read_version(spark, table, cols, batch.schema, touched, version)
            next_one = versioned.last_version(spark, to) + 1
            versioned.write(rollup(fresh), to, cols, next_one)
            versioned.commit(spark, to, cols, touched, next_one, stream, batch_id)
        versioned.commit(spark, table, cols, touched, version, stream, batch_id)
    return merge


def upsert(spark: SparkSession, src: str, table: str, checkpoint: str,
           keys: list[str] = S.FLIGHTS_KEY, order: list[str] = S.FRESHEST,
           types: dict = S.FLIGHTS_TYPES, schema: StructType = S.RAW_FLIGHTS_SCHEMA,
           max_files: int | None = None, rollup=None, rollup_table: str | None = None,
           buckets: int | None = None, max_bytes: int = BATCH_BYTES, rollups: list[tuple] = (),
           day: str | None = None) -> DataFrame:
    """K2: stream raw files into a freshest-wins silver table (and keep
    rollup tables current: `rollup` and its table, or several `rollups`).

    buckets=B also partitions the table by a hash bucket of the natural key
    (`key_bucket`), so a batch with a few late rows for an old day rewrites
    only their buckets of that day, not the whole day. The bucket is a
    function of the key, so freshest-wins inside a bucket is complete; a
    table keeps the number it was begun with.

    day="..." names the date column that rows are partitioned by (NULL as
    NO_DAY) instead of the folder they were landed in: extractions of one key
    that were landed under two days then meet, as in a batch.
    """
    s = typed_projection(raw_stream(spark, src, schema, max_files, max_bytes), types,
                         keep=(S.PARTITION_COLUMN,))
    if day:
        s = s.withColumn(S.PARTITION_COLUMN, F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(S.NO_DAY)))
    cols = [S.PARTITION_COLUMN]
    if buckets:
        s = s.withColumn(BUCKET_COLUMN, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)))
        cols.append(BUCKET_COLUMN)
    every = [*rollups, (rollup, rollup_table)] if rollup is not None else list(rollups)
    q = (s.writeStream.foreachBatch(upsert_batch(table, keys, order, cols, every, checkpoint))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    _finish(q)
    return versioned.read(spark, table, cols, s.schema)


def late_rows(query, every_s: float = 0.5) -> int:
    """Wait for a query to end; the rows it dropped because they came after
    the watermark. Only the last progress reports are kept, so they are
    gathered while it runs."""
    late: dict[tuple, int] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(every_s)
        for p in query.recentProgress:
            late[p["batchId"], p["timestamp"]] = sum(int(op["numRowsDroppedByWatermark"]) for op in p["stateOperators"])
    return sum(late.values())


def tumbling_counts(spark: SparkSession, src: str, sink: str, checkpoint: str,
                    ts_col: str = "arrival_ts_utc", keys: tuple[str, ...] = ("market",),
                    every: str = "1 day", types: dict = S.FLIGHTS_TYPES,
                    schema: StructType = S.RAW_FLIGHTS_SCHEMA,
                    max_files: int | None = None, late_tolerance: str | None = None,
                    max_bytes: int | None = None) -> DataFrame:
    """K3: counts per key in tumbling event-time windows.

    Default (late_tolerance=None): complete mode. The state is one counter
    per (window, key), i.e. markets x days, so keeping all of it is cheap and
    no late file is ever dropped, whatever order the files arrive in. Each
    micro-batch replaces the versioned sink with the full current result: a
    reader has the last whole one at any time. A micro-batch takes about
    `max_bytes` (BATCH_BYTES).

    late_tolerance="4 hours" (a live stream with bounded lateness): event
    time gets a watermark, a window is appended to the sink once the
    watermark passes its end and its state is dropped. Rows later than the
    tolerance are not counted; how many is appended to `<sink>_late`, and a
    warning says so. Windows still open when the stream stops stay in the
    checkpointed state until later data closes them. Files come in order of
    their write time, not of their days, so all that is present at a start
    is one micro-batch: within a backlog nothing is late, whatever its size.
    `max_files` or `max_bytes` cut it, for files that come in order of time.
    """
    if late_tolerance is None:
        max_bytes = max_bytes or BATCH_BYTES
    s = typed_projection(raw_stream(spark, src, schema, max_files, max_bytes), types)
    if late_tolerance is None:
        counts = (s.groupBy(F.window(ts_col, every).alias("w"), *keys)
                  .agg(F.count(F.lit(1)).alias("rows"))
                  .select(F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), *keys, "rows"))

        def write(batch: DataFrame, batch_id: int) -> None:
            versioned.replace(batch, sink)

        q = (counts.writeStream.outputMode("complete").foreachBatch(write)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        _finish(q)
        return versioned.read(spark, sink, [], counts.schema)

    # Watermarks need an instant type: read the UTC wall clock as a UTC
    # instant (session zone pinned to UTC for this query only).
    from signalmart.session import session_conf
    with session_conf(spark, spark__sql__session__timeZone="UTC"):
        ev = s.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
        counts = (ev.withWatermark("_event_time", late_tolerance)
                  .groupBy(F.window("_event_time", every).alias("w"), *keys)
                  .agg(F.count(F.lit(1)).alias("rows"))
                  .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                          *keys, "rows"))
        q = (counts.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start(sink))
        late = late_rows(q)
        _finish(q)
    spark.createDataFrame([(str(q.runId), late)], "run_id string, rows_dropped long") \
        .write.mode("append").parquet(f"{sink.rstrip('/')}_late")
    if late:
        warnings.warn(f"{late} rows came later than {late_tolerance} and were not counted", stacklevel=2)
    return spark.read.parquet(sink)
