"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import signalmart
from signalmart.session import work_dir

_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application, for
    sessions that were not started with it (``--py-files``, PYTHONPATH). The
    driver serves the archive to the executors."""
    sc, root = spark.sparkContext, Path(signalmart.__file__).parent
    if sc.applicationId in _SENT or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="signalmart-py-"), "signalmart.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SENT.add(sc.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage
    with files every executor can reach, so a lost executor costs nothing
    that was already written."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_column(df: DataFrame, name: str) -> Column:
    """A text column as a string, null counted as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: of '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def utf8_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary array and its row offsets
    (rows + 1 of them). Null rows have length 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    n = len(texts)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64) \
        if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, ends


def text_groups(ends: np.ndarray, most: int, rows: int | None = None):
    """Row ranges [a, b) whose bytes sum to about ``most`` at most, and that
    hold at most ``rows`` rows; a longer row stands alone. Bounds the arrays a
    task holds at a time."""
    a, n = 0, len(ends) - 1
    while a < n:
        b = int(np.searchsorted(ends, ends[a] + most, side="right")) - 1
        b = min(max(b, a + 1), n, a + (rows or n))
        yield a, b
        a = b
