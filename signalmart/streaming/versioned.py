"""Partitions with versions, for merges that must survive a crash.

    <table>/data/<partition folders>/version=<n>/...   rows
    <table>/commits/            (partition values, version, stream, batch)

A merge writes new rows as a new version of the partitions it touches and
then appends one commit row per partition (one file, so it appears whole or
not at all). Readers take the greatest committed version of each partition,
so a merge that dies before its commit leaves the old version current.

Versions belong to the table and only grow: a merge takes the greatest
committed one plus one, whatever stream it comes from. Who wrote it is told by
the stream (the id of a checkpoint) and its batch number: a batch that is
committed already is a replay and changes nothing, and a renewed checkpoint
is a new stream, whose batches begin at 0 again. A table without partition
columns is replaced as a whole. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

VERSION, STREAM, BATCH = "version", "stream", "batch"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, table: str) -> bool:
    """Whether anything was ever committed."""
    fs, at = _fs(spark, f"{table}/commits")
    return fs.exists(at)


def _kind(cols: list[str], schema: StructType) -> StructType:
    return StructType([schema[c] for c in cols] + [
        StructField(VERSION, LongType()), StructField(STREAM, StringType()), StructField(BATCH, LongType())])


def commits(spark: SparkSession, table: str, cols: list[str], schema: StructType) -> DataFrame:
    """Every commit row; none for a table that does not exist."""
    kind = _kind(cols, schema)
    if not exists(spark, table):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(f"{table}/commits")


def current(spark: SparkSession, table: str, cols: list[str], schema: StructType) -> DataFrame:
    """(partition values, version) of the partitions as they stand."""
    rows = commits(spark, table, cols, schema)
    return rows.groupBy(*cols).agg(F.max(VERSION).alias(VERSION)).filter(F.col(VERSION).isNotNull())


def last_version(spark: SparkSession, table: str) -> int:
    """The greatest committed version of the table, -1 for none."""
    top = commits(spark, table, [], StructType()).agg(F.max(VERSION)).first()[0]
    return -1 if top is None else top


def applied(spark: SparkSession, table: str, stream: str, batch: int) -> bool:
    """Whether a stream's batch is committed. Batches of a stream come in
    order, so a later one tells it too."""
    rows = commits(spark, table, [], StructType()).filter(F.col(STREAM) == stream)
    top = rows.agg(F.max(BATCH)).first()[0]
    return top is not None and top >= batch


def _folder(table: str, cols: list[str], row, version) -> str:
    return "/".join([f"{table}/data", *(f"{c}={row[c]}" for c in cols), f"{VERSION}={version}"])


def _load(spark: SparkSession, table: str, schema: StructType, folders: list[str]) -> DataFrame:
    names = [f.name for f in schema.fields]
    if not folders:
        return spark.createDataFrame([], schema)
    kind = StructType(schema.fields + [StructField(VERSION, LongType())])
    return spark.read.schema(kind).option("basePath", f"{table}/data").parquet(*folders).select(*names)


def read(spark: SparkSession, table: str, cols: list[str], schema: StructType) -> DataFrame:
    """The current rows. The driver holds one path per partition."""
    rows = current(spark, table, cols, schema).collect()
    return _load(spark, table, schema, [_folder(table, cols, r, r[VERSION]) for r in rows])


def read_partitions(spark: SparkSession, table: str, cols: list[str], schema: StructType, touched: list,
                    on: list[str] | None = None) -> DataFrame:
    """The current rows of some partitions; only their folders are listed.
    ``touched``: rows with the values of the columns ``on`` (all of ``cols``);
    with fewer columns, every partition that has them."""
    on = on or cols
    if not touched:
        return _load(spark, table, schema, [])
    wanted = spark.createDataFrame([tuple(t[c] for c in on) for t in touched], StructType([schema[c] for c in on]))
    rows = current(spark, table, cols, schema).join(wanted.distinct(), on, "left_semi").collect()
    return _load(spark, table, schema, [_folder(table, cols, r, r[VERSION]) for r in rows])


def read_version(spark: SparkSession, table: str, cols: list[str], schema: StructType, touched: list,
                 version: int) -> DataFrame:
    """The rows of one version of some partitions, committed or not."""
    return _load(spark, table, schema, [_folder(table, cols, t, version) for t in touched])


def write(df: DataFrame, table: str, cols: list[str], version: int) -> None:
    """Rows as a version of their partitions. Files of other versions are not
    touched; those of the same version, from a merge that died, are replaced."""
    spread = df.hint("rebalance", *[F.col(c) for c in cols]) if cols else df.hint("rebalance")
    (spread.withColumn(VERSION, F.lit(version).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols, VERSION).parquet(f"{table}/data"))


def commit(spark: SparkSession, table: str, cols: list[str], touched: list, version: int,
           stream: str | None = None, batch: int | None = None, marks: dict[str, int] | None = None) -> None:
    """Make a version current. A repeated commit changes nothing. ``marks``
    names several streams with their batches."""
    if not touched:
        return
    kinds = [StructField(c, LongType() if isinstance(touched[0][c], int) else StringType()) for c in cols]
    kind = _kind(cols, StructType(kinds))
    rows = [(*(t[c] for c in cols), version, s, b) for t in touched for s, b in (marks or {stream: batch}).items()]
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{table}/commits")


def replace(df: DataFrame, table: str) -> str:
    """Replace a table without partition columns as a whole; readers see the
    old rows until the commit. Returns the folder of the new rows."""
    spark = df.sparkSession
    version = last_version(spark, table) + 1
    write(df, table, [], version)
    commit(spark, table, [], [()], version)
    return _folder(table, [], (), version)


def changed(spark: SparkSession, table: str, cols: list[str], schema: StructType, since: int) -> list:
    """The partitions committed in versions above ``since``, each once."""
    rows = commits(spark, table, cols, schema).filter(F.col(VERSION) > since)
    return rows.select(*cols).distinct().collect()


def compact(spark: SparkSession, table: str, cols: list[str], schema: StructType) -> int:
    """Commit files into one: the current version of each partition, and the
    last batch of each stream. The new file comes first, so a crash leaves
    rows twice, which reads the same. Returns how many files went."""
    if not exists(spark, table):
        return 0
    every = commits(spark, table, cols, schema)
    old = [f for f in every.inputFiles()]
    now = every.groupBy(*cols).agg(F.max(F.struct(VERSION, STREAM, BATCH)).alias("x")).select(*cols, "x.*")
    last = every.filter(F.col(STREAM).isNotNull()).groupBy(STREAM).agg(
        F.max(F.struct(BATCH, VERSION, *cols)).alias("x")).select(*[F.col(f"x.{c}") for c in cols], f"x.{VERSION}",
                                                                   STREAM, f"x.{BATCH}")
    kept = now.unionByName(last).distinct().collect()  # partitions and streams
    spark.createDataFrame(kept, _kind(cols, schema)).coalesce(1).write.mode("append").parquet(f"{table}/commits")
    for f in old:
        fs, at = _fs(spark, f)
        fs.delete(at, False)
    return len(old)


def vacuum(spark: SparkSession, table: str, cols: list[str], schema: StructType) -> int:
    """Delete the folders of versions that are not current: replaced ones, and
    those of merges that died. No reader or merge of the table may be running.
    Returns their number."""
    if not exists(spark, table):
        return 0
    live = {_folder("", cols, r, r[VERSION]) for r in current(spark, table, cols, schema).collect()}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{table}/data")
    # one row per partition and version
    held = files.select(F.regexp_extract("path", rf"^(.*/data/(?:.*/)?{VERSION}=\d+)/", 1).alias("f")).distinct().collect()
    old = [r["f"] for r in held if r["f"] and r["f"][r["f"].rindex("/data/"):] not in live]
    for f in old:
        fs, at = _fs(spark, f)
        fs.delete(at, True)
    return len(old)
