"""Raw files landed by pull, with a manifest, and the catalog table over them.

    <root>/dt=<day>/pull=<pull>/landing=<id>/*.csv    rows of one landing of a pull
    <root>/_manifest/                                 (pull, landing, dt, rows)

A pull is one call of an extractor. Landing it writes its rows under a landing
id of its own and then appends one manifest row per day, or one without a day
if it has no rows at all. The newest landing of a pull is what counts, so a
repeated pull replaces the whole of the earlier one, days that it no longer has
included. Folders of replaced landings are deleted afterwards; a reader that
goes by the manifest never sees them, and a run that dies before its manifest
row leaves the earlier landing in place.

`catalog_table` makes the raw zone a table whose partitions stand in the
catalog, taken from the manifest: planning a query looks the wanted ones up and
lists only their folders, with no crawler and no listing of the root.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalmart import schemas as S
from signalmart.sources.raw import land_raw

LANDING = "landing"
PARTS = (S.PARTITION_COLUMN, S.PULL_COLUMN, LANDING)
_ROW = "pull string, landing string, dt string, rows long"
#: Partitions in one catalog statement.
_AT_ONCE = 500
#: Manifest files from which they are made one.
MANIFEST_FILES = 64


def _manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def landings(spark: SparkSession, root: str) -> DataFrame:
    """Every manifest row."""
    if not _exists(spark, _manifest_path(root)):
        return spark.createDataFrame([], _ROW)
    return spark.read.schema(_ROW).parquet(_manifest_path(root))


def current(spark: SparkSession, root: str) -> DataFrame:
    """(pull, landing, dt, rows) of the newest landing of each pull."""
    every = landings(spark, root)
    newest = every.groupBy("pull").agg(F.max(LANDING).alias(LANDING))
    return every.join(newest, ["pull", LANDING], "left_semi").filter("dt IS NOT NULL")


def land_pulls(df: DataFrame, root: str, columns: list[str], pulls: DataFrame | None = None) -> str:
    """Land rows (with `dt` and `pull`) as one landing of each of their pulls;
    `pulls` (column pull) names those that may have no rows. Returns the
    landing id."""
    spark, root = df.sparkSession, root.rstrip("/")
    landing = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:6]}"
    land_raw(df.withColumn(LANDING, F.lit(landing)), root, columns, PARTS)
    found = df.groupBy(*[F.col(c).cast("string").alias(c) for c in ("pull", "dt")]).agg(F.count(F.lit(1)).alias("rows"))
    if pulls is not None:
        found = pulls.select(F.col("pull").cast("string")).distinct().join(found, "pull", "left")
    (found.select("pull", F.lit(landing).alias(LANDING), "dt", F.coalesce("rows", F.lit(0)).alias("rows"))
     .coalesce(1).write.mode("append").parquet(_manifest_path(root)))
    sweep(spark, root, landing)
    if len(landings(spark, root).inputFiles()) > MANIFEST_FILES:
        compact(spark, root)
    return landing


def compact(spark: SparkSession, root: str) -> int:
    """Manifest files into one that holds the newest landing of each pull. The
    new file comes first, so a crash leaves rows twice, which reads the same.
    Returns how many files went."""
    every = landings(spark, root)
    old = every.inputFiles()
    newest = every.groupBy("pull").agg(F.max(LANDING).alias(LANDING))
    kept = every.join(newest, ["pull", LANDING], "left_semi").distinct()
    kept.coalesce(1).write.mode("append").parquet(_manifest_path(root))
    for f in old:
        at = spark._jvm.org.apache.hadoop.fs.Path(f)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False)
    return len(old)


def sweep(spark: SparkSession, root: str, landing: str) -> int:
    """Delete the folders that this landing replaced. Returns their number."""
    every = landings(spark, root)
    mine = every.filter(F.col(LANDING) == landing).select("pull").distinct()
    old = every.filter((F.col(LANDING) != landing) & F.col("dt").isNotNull()).join(mine, "pull", "left_semi")
    gone = 0
    for r in old.select(*PARTS).distinct().collect():  # days of the pulls that were landed again
        at = spark._jvm.org.apache.hadoop.fs.Path(_folder(root, r))
        gone += bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))
    return gone


def _folder(root: str, row) -> str:
    return "/".join([root.rstrip("/"), *(f"{c}={row[c]}" for c in PARTS)])


def read_pulls(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Rows of the newest landings, with `dt`; folders that the manifest does
    not name are not read."""
    named = [_folder(root, r) for r in current(spark, root).collect()]  # one per day and pull
    names = [f.name for f in schema.fields] + [S.PARTITION_COLUMN]
    full = StructType.fromDDL(", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
                                        + [f"{c} string" for c in PARTS]))
    if not named:
        return spark.createDataFrame([], full).select(*names)
    return spark.read.schema(full).option("header", "false").option("basePath", root).csv(named).select(*names)


# ---- catalog ---------------------------------------------------------------
def _partition(values) -> str:
    return "PARTITION (" + ", ".join(f"{c} = '{values[c]}'" for c in PARTS) + ")"


def catalog_table(spark: SparkSession, name: str, root: str, schema: StructType) -> DataFrame:
    """Create the table `name` over the raw zone if there is none, bring its
    partitions up to the manifest and return it. Only the differences are
    written to the catalog."""
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + [f"{c} STRING" for c in PARTS])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING csv OPTIONS (header 'false') "
              f"PARTITIONED BY ({', '.join(PARTS)}) LOCATION '{root}'")
    wanted = {tuple(r[c] for c in PARTS): r for r in current(spark, root).select(*PARTS).distinct().collect()}
    held = {tuple(p.split("=", 1)[1] for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for change, keys in (("ADD IF NOT EXISTS", sorted(set(wanted) - held)), ("DROP IF EXISTS", sorted(held - set(wanted)))):
        for k in range(0, len(keys), _AT_ONCE):
            parts = [_partition(dict(zip(PARTS, key))) for key in keys[k:k + _AT_ONCE]]
            spark.sql(f"ALTER TABLE {name} {change} {(', ' if change.startswith('DROP') else ' ').join(parts)}")
    return spark.table(name)
