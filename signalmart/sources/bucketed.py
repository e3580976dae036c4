"""Tables bucketed and sorted by a natural key.

A bucketed table is hash-partitioned on disk: the scan already has the
distribution that a grouping or a row_number on the key asks for, so uniqueness
checks, a dedupe and a join with a table of the same buckets run without an
exchange. The writer's own shuffle gets as many partitions as there are
buckets, so each bucket is one file.

A table's bucket number stands beside its files, so another session can put it
in its catalog again (`attach`); the files are the table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart.session import session_conf
from signalmart.streaming import versioned

#: Bytes of raw input that one bucket should hold, and buckets at most.
BUCKET_BYTES, MOST = 1 << 28, 50_000


def buckets_for(spark: SparkSession, *sources: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a table made from the files below `sources`: by their
    bytes, and at least one for each of the session's task slots. Only file
    sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(sources))
    total = files.agg(F.sum("length")).first()[0] or 0
    return min(MOST, max(spark.sparkContext.defaultParallelism, math.ceil(total / bucket_bytes)))


def _note(path: str) -> str:
    return f"{path.rstrip('/')}_buckets"


def write(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """(Over)write `df` as the table `name`; `df` should end in an operator
    that is partitioned by `keys` already, whose shuffle then is the only one."""
    spark = df.sparkSession
    with session_conf(spark, spark__sql__shuffle__partitions=buckets):
        (df.write.mode("overwrite").format("parquet").option("path", path)
         .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    versioned.replace(spark.createDataFrame([(buckets,)], "buckets int"), _note(path))
    return spark.table(name)


def attach(spark: SparkSession, name: str, path: str, keys: list[str]) -> DataFrame:
    """The bucketed table below `path`, in this session's catalog."""
    from pyspark.sql.types import StructType
    buckets = versioned.read(spark, _note(path), [], StructType.fromDDL("buckets int")).first()[0]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = ", ".join(keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # of an earlier build, maybe; the files stay
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return versioned.exists(spark, _note(path))
