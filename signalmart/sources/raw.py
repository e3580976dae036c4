"""Raw zone: headerless CSV under dt=YYYY-MM-DD folders, header CSV seeds,
and parquet tables.

Readers always pass an explicit schema (no inference pass over the files)
and leave column pruning / filter pushdown to the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from signalmart import schemas as S
from signalmart.functions.columns import typed


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of a dataset folder (`<root>/<name>.parquet`)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


CORRUPT_COLUMN = "_corrupt_record"


def with_extraction_id(df: DataFrame) -> DataFrame:
    """Rows of files landed without an extraction id get their file's path:
    one pull is one set of files."""
    if S.EXTRACTION_COLUMN in df.columns:
        return df
    return df.withColumn(S.EXTRACTION_COLUMN, F.col("_metadata.file_path"))


def read_raw(spark: SparkSession, path: str, schema: StructType,
             dt_from: str = "path", corrupt: bool = False) -> DataFrame:
    """Headerless delimited files, every column a string, plus `dt` and
    `extraction_id`.

    dt_from="path": everything below `path` (a root; one path, listed in
    parallel), with `dt` cut out of each file's path by a regex.
    dt_from="discovery": `path` is the table root; Spark discovers the
    `dt=` folders, so filters on `dt` prune whole folders at planning time.
    corrupt=True adds `_corrupt_record`: the raw line of rows with too few or
    too many fields, NULL for the others, so a load can count them.
    """
    reader = (spark.read.option("header", "false")
              .option("mode", "PERMISSIVE"))
    if corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if dt_from == "discovery":
        df = with_extraction_id(reader.schema(schema).csv(path))
        # discovery infers `date`; keep the raw zone all-string.
        return df.withColumn(S.PARTITION_COLUMN,
                             F.col(S.PARTITION_COLUMN).cast("string"))
    df = with_extraction_id(reader.schema(schema).option("recursiveFileLookup", "true").csv(path))
    return df.withColumn(
        S.PARTITION_COLUMN,
        F.regexp_extract(F.col("_metadata.file_path"), S.PARTITION_PATTERN, 1))


def read_partitioned(spark: SparkSession, root: str, schema: StructType,
                     dt_from: str | None = None, dt_to: str | None = None) -> DataFrame:
    """Partitioned raw table with an optional inclusive dt range.

    With both bounds the days of the range are named in the path, so only
    folders that exist among them are listed and indexed; an open range reads
    the root and prunes by `dt` (PartitionFilters in the plan)."""
    full = StructType(schema.fields + [StructField(S.PARTITION_COLUMN, StringType(), True)])
    reader = spark.read.schema(full).option("header", "false").option("basePath", root)
    columns = [f.name for f in full.fields]
    if dt_from is None or dt_to is None:
        df = reader.csv(root).select(*columns)
        if dt_from is not None:
            df = df.filter(F.col(S.PARTITION_COLUMN) >= F.lit(dt_from))
        if dt_to is not None:
            df = df.filter(F.col(S.PARTITION_COLUMN) <= F.lit(dt_to))
        return df
    first, last = dt.date.fromisoformat(dt_from), dt.date.fromisoformat(dt_to)
    days = [str(first + dt.timedelta(days=k)) for k in range((last - first).days + 1)]
    try:
        return reader.csv(f"{root.rstrip('/')}/{S.PARTITION_COLUMN}={{{','.join(days)}}}").select(*columns)
    except AnalysisException as e:  # no day of the range has landed
        if days and e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def sql_literal(v) -> str:
    """Python value -> Spark SQL literal (for small fixed dimension tables)."""
    import datetime as _dt
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A fixed dimension table as an inline VALUES relation.

    The planner sees its exact (tiny) size, so joins against it become
    broadcast joins through the size threshold, with no job to measure it.
    """
    schema = StructType.fromDDL(ddl)
    names = [f.name for f in schema.fields]
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Header CSV seed with an explicit schema (dates typed at read)."""
    return (spark.read.schema(ddl).option("header", "true")
            .option("dateFormat", "yyyy-MM-dd").csv(path))


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition value together, in tasks of the session's advisory
    size (`spark.sql.adaptive.advisoryPartitionSizeInBytes`): adaptive
    execution joins small values into one task and splits a value that holds
    a third of the data over many, so a partitioned write makes about
    (bytes of the value / advisory size) files per value."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def land_raw(df: DataFrame, path: str, columns: list[str],
             partition_cols: tuple[str, ...] = (S.PARTITION_COLUMN,), mode: str = "overwrite") -> None:
    """Write rows as headerless CSV, one folder per partition value.

    The overwrite is a dynamic partition overwrite (set on the writer, not
    left to the session default): it replaces only the partitions present
    in `df`, so re-landing a day (or, with a pull folder below it, a pull of
    a day) is idempotent and others are untouched.
    """
    out = df.select(*[F.col(c).cast("string").alias(c) for c in columns],
                    *[F.col(c).cast("string").alias(c) for c in partition_cols])
    (rebalanced(out, *partition_cols).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("header", "false")
     .partitionBy(*partition_cols)
     .csv(path))


def typed_projection(raw: DataFrame, types: dict[str, str | None],
                     tolerant: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast the all-string raw columns to their silver types.

    Blank strings become NULL before casting (ANSI mode raises on
    cast('' as double)); `tolerant=True` turns malformed values into NULL
    instead of failing the job.
    """
    return raw.select(*[typed(c, t, tolerant) for c, t in types.items()], *keep)


def reject_counts(raw: DataFrame, types: dict[str, str | None]) -> DataFrame:
    """Per typed column, how many non-blank raw values fail the cast.

    One aggregate pass (count_if per column), for loads that run with
    `typed_projection(tolerant=True)` and must report what they dropped.
    """
    checks = []
    for c, t in types.items():
        if t is None or t.startswith("text:"):
            continue
        src = F.nullif(F.trim(F.col(c)), F.lit(""))
        checks.append(F.count_if(src.isNotNull() & src.try_cast(t).isNull()).alias(c))
    return raw.agg(*checks)
