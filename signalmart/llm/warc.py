"""WARC records and a Merkle fixity audit of replicas.

A replica is a table of records (archive, offset, record). Records are hashed
where they lie; each archive's records are grouped by ordered offset ranges of
``RANGE`` bytes, each range's digest is the hash of its records' places and
digests in offset order, and every ``FANOUT`` neighbouring ranges hash into a
node of the next level up to the archive's root. Two replicas compare roots
first; only the children of nodes that differ are joined, level by level,
down to the records. No group is larger than a range or a fan-out, so an
archive of any size is spread over all tasks, and no tree passes the driver.

Defined results: a record in one replica alone is ``missing`` or ``extra``,
one with other bytes ``altered``. Records of one replica with equal archive
and offset are compared as a list in the order of their digests. Null archive
or offset counts as '' and 0, a null record as empty. Empty replicas give
roots that are missing or extra, or no rows if both are empty. Pages with
null columns become records with empty values.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart.llm.common import stored

RANGE, FANOUT = 1 << 16, 16
ARCHIVE_BYTES = 1 << 30
#: What a record begins with.
_START = re.compile(rb"WARC/\d+\.\d+\r\n|\x1f\x8b\x08")
_CHUNK = 1 << 16
DATE = "1970-01-01T00:00:00Z"
RECORDS = "archive string, offset long, record_id string, record binary"


def record_bytes(record_id: str, url: str, body: bytes, date: str = DATE) -> bytes:
    """One WARC/1.1 resource record."""
    digest = hashlib.sha256(body).hexdigest()
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{record_id}>\r\n"
            f"WARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nWARC-Block-Digest: sha256:{digest}\r\n"
            f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode("utf-8", "replace") + body + b"\r\n\r\n"


def _inflated(data: bytes, at: int):
    """(bytes, stored length) of the gzip member at ``at``; None if it is
    damaged or does not hold a record."""
    inflater, parts, end = zlib.decompressobj(wbits=31), [], at
    try:
        while not inflater.eof:
            if end >= len(data):
                return None
            parts.append(inflater.decompress(data[end:end + _CHUNK]))
            end += _CHUNK
            if len(parts) == 1 and not b"WARC/".startswith(parts[0][:5]):
                return None
    except zlib.error:
        return None
    return b"".join(parts), min(end, len(data)) - len(inflater.unused_data) - at


def _record(data: bytes, at: int):
    """(length, headers, block) of the record at ``at``; None if it is damaged."""
    raw, begin, used = data, at, None
    if data.startswith(b"\x1f\x8b", at):
        member = _inflated(data, at)
        if member is None:
            return None
        raw, begin, used = member[0], 0, member[1]
    if not raw.startswith(b"WARC/", begin):
        return None
    gap = raw.find(b"\r\n\r\n", begin)
    if gap < 0:
        return None
    lines = raw[begin:gap].decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = headers.get("content-length", "0")
    if not (size.isascii() and size.isdigit() and len(size) < 19):
        return None
    end = gap + 4 + int(size)
    if end > len(raw) or not b"\r\n\r\n".startswith(raw[end:end + 4]):
        return None
    return used if used is not None else end + 4 - begin, headers, raw[gap + 4:end]


def pieces(data: bytes):
    """(offset, length, headers, block) of each record of a WARC file, plain
    or with one gzip member a record; offsets are those in the file. What is
    damaged, up to the next whole record, has None for headers and block."""
    at = 0
    while at < len(data):
        found = _record(data, at)
        if found is not None:
            yield at, *found
            at += found[0]
            continue
        start = next((m.start() for m in _START.finditer(data, at + 1) if _record(data, m.start()) is not None), len(data))
        yield at, start - at, None, None
        at = start


def parse_records(data: bytes):
    """The whole records among the pieces."""
    return (p for p in pieces(data) if p[2] is not None)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: archive (the file), offset, record_id and
    record (the bytes as stored). Damaged bytes up to the next whole record are
    a row of their own with an empty id. A file is read as a whole (2 GB at
    most)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = list(pieces(data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found)), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([(f[2] or {}).get("warc-record-id", "") for f in found], pa.string()),
                     pa.array([data[f[0]:f[0] + f[1]] for f in found], pa.binary())],
                    names=["archive", "offset", "record_id", "record"])

    return files.mapInArrow(run, RECORDS)


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
             archive_bytes: int = ARCHIVE_BYTES, compress: bool = False) -> DataFrame:
    """Pages as WARC records laid one after the other: each task fills
    archives of its own, of ``archive_bytes`` at most unless a record alone
    is larger."""
    def run(batches):
        from pyspark import TaskContext
        part, number, offset = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for name, place, body in zip(*(c.to_pylist() for c in batch.columns)):
                body = (body or "").encode("utf-8", "replace")
                key = hashlib.md5(f"{name}\n{place}\n".encode("utf-8", "replace") + body).hexdigest()
                data = record_bytes(f"{key[:8]}-{key[8:12]}-{key[12:16]}-{key[16:20]}-{key[20:]}", place or "", body)
                if compress:
                    packed = io.BytesIO()
                    with gzip.GzipFile(fileobj=packed, mode="wb", mtime=0) as f:
                        f.write(data)
                    data = packed.getvalue()
                if offset and offset + len(data) > archive_bytes:
                    number, offset = number + 1, 0
                for column, value in zip(rows, (f"part-{part:05d}-{number:05d}.warc", offset,
                                                "" if name is None else str(name), data)):
                    column.append(value)
                offset += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string()),
                 pa.array(rows[3], pa.binary())], names=["archive", "offset", "record_id", "record"])

    return pages.select(pages[page_id].cast("string"), pages[url].cast("string"), pages[html].cast("string")).mapInArrow(run, RECORDS)


def _hash(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, "\n").cast("binary"), 256)


def leaves(replica: DataFrame) -> DataFrame:
    """(archive, offset, records): per place the records' digests, lengths
    and ids, in order. Only these narrow rows are shuffled."""
    rows = replica.select(
        F.coalesce("archive", F.lit("")).alias("archive"), F.coalesce("offset", F.lit(0).cast("long")).alias("offset"),
        F.struct(F.sha2(F.coalesce("record", F.lit(b"")), 256).alias("digest"),
                 F.coalesce(F.octet_length("record"), F.lit(0)).cast("long").alias("length"),
                 F.coalesce(F.col("record_id").cast("string"), F.lit("")).alias("record_id")).alias("r"))
    return rows.groupBy("archive", "offset").agg(F.sort_array(F.collect_list("r")).alias("records"))


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: ``FANOUT`` neighbours hash into one node."""
    return nodes.groupBy("archive", F.floor(F.col("node") / FANOUT).alias("up")).agg(
        _hash(F.transform(F.sort_array(F.collect_list(F.struct("node", "digest"))),
                          lambda n: F.concat_ws(" ", n["node"].cast("string"), n["digest"]))).alias("digest")) \
        .withColumnRenamed("up", "node")


def ranges(places: DataFrame) -> DataFrame:
    """The lowest nodes: offset ranges of ``RANGE`` bytes."""
    line = F.concat_ws(" ", F.col("offset").cast("string"), F.concat_ws(" ", F.transform("records", lambda r: r["digest"])))
    return places.select("archive", F.floor(F.col("offset") / RANGE).alias("node"), "offset", line.alias("line")) \
        .groupBy("archive", "node").agg(_hash(F.transform(
            F.sort_array(F.collect_list(F.struct("offset", "line"))), lambda x: x["line"])).alias("digest"))


def tree(places: DataFrame, levels: int) -> list[DataFrame]:
    """Levels from the offset ranges up to the roots, each written once."""
    out = [stored(ranges(places), "ranges")]
    for _ in range(levels - 1):
        out.append(stored(parents(out[-1]), "nodes"))
    return out


def levels_for(*places: DataFrame) -> int:
    """Levels until every archive has one node."""
    top = max(p.agg(F.max("offset")).first()[0] or 0 for p in places) // RANGE
    n = 1
    while top:
        top, n = top // FANOUT, n + 1
    return n


def _differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys, "full_outer")
    return both.filter(~F.col("a").eqNullSafe(F.col("b")))


def audit(replica_a: DataFrame, replica_b: DataFrame) -> DataFrame:
    """The records that differ: archive, offset, kind, record_id, and length
    and digest in either replica."""
    a, b = stored(leaves(replica_a), "leaves"), stored(leaves(replica_b), "leaves")
    depth = levels_for(a, b)
    trees = tree(a, depth), tree(b, depth)
    bad = _differing(trees[0][-1], trees[1][-1], ["archive", "node"], "digest").select("archive", "node")
    for level in range(depth - 2, -1, -1):
        bad = stored(bad, "differ").withColumnRenamed("node", "up")
        below = [t[level].withColumn("up", F.floor(F.col("node") / FANOUT)).join(bad, ["archive", "up"], "left_semi")
                 for t in trees]
        bad = _differing(*below, ["archive", "node"], "digest").select("archive", "node")
    bad = stored(bad, "differ")
    sides = [x.withColumn("node", F.floor(F.col("offset") / RANGE)).join(bad, ["archive", "node"], "left_semi") for x in (a, b)]
    found = _differing(*sides, ["archive", "offset"], "records")
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("altered")
    each = found.select("archive", "offset", kind.alias("kind"),
                        F.explode(F.arrays_zip(F.coalesce("a", F.array().cast(found.schema["a"].dataType)).alias("a"),
                                               F.coalesce("b", F.array().cast(found.schema["b"].dataType)).alias("b"))).alias("x"))
    each = each.filter(~F.col("x.a").eqNullSafe(F.col("x.b")))
    return each.select("archive", "offset", "kind", F.coalesce("x.a.record_id", "x.b.record_id").alias("record_id"),
                       F.col("x.a.length").alias("length_a"), F.col("x.b.length").alias("length_b"),
                       F.col("x.a.digest").alias("digest_a"), F.col("x.b.digest").alias("digest_b"))


def damaged(replica: DataFrame, one_in: int = 100) -> DataFrame:
    """A copy of a replica with planted damage, chosen by a hash of the
    record: a byte changed, a record cut short, lost, or written twice."""
    draw = F.pmod(F.xxhash64("record_id", F.md5("record")), F.lit(one_in * 4))
    half = F.floor(F.octet_length("record") / 2).cast("int")
    flipped = F.concat(F.substring("record", F.lit(1), half), F.lit(b"\x00"),
                       F.expr("substring(record, CAST(floor(octet_length(record) / 2) AS INT) + 2)"))
    changed = replica.withColumn("draw", draw).filter("draw <> 2").withColumn(
        "record", F.when(F.col("draw") == 0, flipped).when(F.col("draw") == 1, F.substring("record", F.lit(1), half))
        .otherwise(F.col("record")))
    again = replica.filter(draw == 3).withColumn("offset", F.col("offset") + 1)
    return changed.drop("draw").unionByName(again)
