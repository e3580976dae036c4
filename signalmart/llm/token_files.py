"""Token ids in binary files: documents as one concatenated id array, their
boundaries and ids Elias-Fano coded.

A file is one segment, little-endian:

    header        HEADER: magic, part, place in the part, documents, documents
                  with a null id, ids, bytes per id, least document id
    ids           all ids of the documents, one after another, 2 or 4 bytes each
    boundaries    Elias-Fano: where each document starts, and the end
    document ids  Elias-Fano: those that are not null, less the least of them
    end           one line feed

Elias-Fano coding of m ascending numbers up to u keeps the lowest log2(u / m)
bits of each as they are and the rest in unary, as one bit vector, so a boundary
takes about 2 + log2(ids per document) bits where a plain table takes 64. The
i-th number is found by ``select``: the place of the i-th one in the bit vector.
The place of every SAMPLE-th one is stored in 32 bits, and the rest is counted
from there, so any document is found without decoding the others.

Files are in ascending order of document ids (null first; equal ids by text):
Spark deals the documents out by sampled ranges of the id, sorts each range and
encodes it, and its text writer puts one file per segment into any store that
Spark can write. A lost executor costs its unfinished ranges only. A segment
ends at ``SEGMENT_IDS`` ids or ``SEGMENT_DOCS`` documents; a longer document
has one of its own. Files are read with Spark's ``binaryFile`` reader.

Defined results: null text counts as the empty text, which holds the end id
only; rows that repeat an id, or a row, are documents of their own; ids are
whole numbers of 64 bits; an empty table gives a folder without segments, which
reads as no rows.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalmart.llm.common import text_column, text_groups, utf8_parts

#: FIXED VALUES of the format.
MAGIC = b"SMTOKEF1"
HEADER = struct.Struct("<8sIIIIQBxxxq")
SAMPLE = 256
#: A segment's ids and documents at most (a document is never split).
SEGMENT_IDS, SEGMENT_DOCS = 16 << 20, 1 << 20
#: Text encoded at a time.
GROUP_BYTES, GROUP_ROWS = 8 << 20, 20_000

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.array([c < 128 and chr(c).isalnum() for c in range(256)])
_MARKS = np.array([32 < c < 127 and not chr(c).isalnum() for c in range(256)])


# ---- Elias-Fano ------------------------------------------------------------
def elias_fano(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers: count, largest, width of the low bits, low
    bits, length of the high bits and high bits, places of every SAMPLE-th one."""
    values = values.astype(np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    head = struct.pack("<QQB", n, top, low)
    if not n:
        return head
    bits = np.concatenate([
        ((values[i:i + 65536, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        for i in range(0, n, 65536)])
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1, np.uint8)
    high[ones] = 1
    return b"".join((head, np.packbits(bits, bitorder="little").tobytes(), struct.pack("<Q", len(high)),
                     np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes()))


class EliasFano:
    """Numbers of an Elias-Fano coded list, any of them by its place."""

    def __init__(self, data: memoryview):
        self.n, self.top, self.low = struct.unpack_from("<QQB", data)
        at = 17
        self.size = at
        if not self.n:
            return
        width = -(-self.n * self.low // 8)
        # eight bytes more, so that any number lies in a window of nine
        self.low_bits = np.concatenate((np.frombuffer(data, np.uint8, width, at), np.zeros(9, np.uint8)))
        at += width
        (self.length,) = struct.unpack_from("<Q", data, at)
        self.high = np.frombuffer(data, np.uint8, -(-self.length // 8), at + 8)
        at += 8 + len(self.high)
        self.samples = np.frombuffer(data, "<u4", -(-self.n // SAMPLE), at)
        self.size = at + 4 * len(self.samples)

    def select(self, places: np.ndarray) -> np.ndarray:
        """Where the ones of these numbers (from 0) stand in the bit vector."""
        out = np.empty(len(places), np.int64)
        block = places // SAMPLE
        for b in np.unique(block):
            first = int(self.samples[b])
            last = int(self.samples[b + 1]) if b + 1 < len(self.samples) else self.length
            bits = np.unpackbits(self.high[first >> 3:(last + 7) >> 3], bitorder="little")
            ones = np.flatnonzero(bits[first & 7:]) + first
            here = block == b
            out[here] = ones[places[here] - b * SAMPLE]
        return out

    def get(self, places: np.ndarray) -> np.ndarray:
        """The numbers at these places, unsigned."""
        places = np.asarray(places, np.int64)
        if not len(places):
            return np.zeros(0, np.uint64)
        high = (self.select(places) - places).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        bit = places * self.low
        byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
        low = np.zeros(len(places), np.uint64)
        for k in range(8):
            low |= self.low_bits[byte + k].astype(np.uint64) << np.uint64(8 * k)
        ninth = self.low_bits[byte + 8].astype(np.uint64) << np.uint64(1) << (np.uint64(63) - shift)  # 0 for shift 0
        return high | ((low >> shift | ninth) & np.uint64((1 << self.low) - 1))

    def first_at_least(self, value: int) -> int:
        """The place of the first number that is not below ``value``."""
        a, b = 0, self.n
        while a < b:
            m = (a + b) // 2
            if int(self.get(np.array([m]))[0]) < value:
                a = m + 1
            else:
                b = m
        return a


# ---- segments --------------------------------------------------------------
def segment(part: int, place: int, ids: list[np.ndarray], sizes: np.ndarray, names: np.ndarray, nulls: int) -> bytes:
    """A file's bytes without its end. ``ids``: in parts, one behind another;
    ``sizes``: ids of each document; ``names``: ascending document ids of those
    behind the ``nulls`` first."""
    least = int(names[0]) if len(names) else 0
    head = HEADER.pack(MAGIC, part, place, len(sizes), nulls, sum(map(len, ids)), ids[0].dtype.itemsize, least)
    # differences of 64-bit ids, modulo 2^64
    apart = names.astype(np.int64).view(np.uint64) - np.int64(least).view(np.uint64)
    bounds = elias_fano(np.concatenate(([0], np.cumsum(sizes))))
    return b"".join((head, *(memoryview(np.ascontiguousarray(x)).cast("B") for x in ids), bounds, elias_fano(apart)))


class Segment:
    """A file as it was read."""

    def __init__(self, body: bytes):
        data = memoryview(body)
        magic, self.part, self.place, self.docs, self.nulls, self.n, width, self.least = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.ids = np.frombuffer(data, f"<u{width}", self.n, HEADER.size)
        at = HEADER.size + self.n * width
        self.bounds = EliasFano(data[at:])
        self.names = EliasFano(data[at + self.bounds.size:])

    def tokens(self, k: int) -> np.ndarray:
        """The ids of the k-th document."""
        start, stop = self.bounds.get(np.array([k, k + 1]))
        return self.ids[int(start):int(stop)]

    def doc_ids(self) -> list:
        names = (self.names.get(np.arange(self.names.n)) + np.int64(self.least).view(np.uint64)).view(np.int64)
        return [None] * self.nulls + names.tolist()

    def find(self, doc_id: int) -> list[int]:
        """The places of the documents of an id (none, or several)."""
        apart = doc_id - self.least
        if apart < 0 or not self.names.n or apart > self.names.top:
            return []
        a, b = self.names.first_at_least(apart), self.names.first_at_least(apart + 1)
        return [self.nulls + k for k in range(a, b)]


# ---- encoding --------------------------------------------------------------
#: Characters that never stand in a piece of white-space separated text.
_MARK = "|"


def _ends_in_marks(text: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where the ASCII marks at the end of a word begin, if a letter or digit
    stands before them that is ASCII or of Latin-1 (two bytes, C3 first).
    ``last``: which bytes end a word."""
    marks = _MARKS[text]
    behind = np.append(marks[1:], False) & ~last  # a mark of the same word follows
    tail = marks & ~behind & last                 # a word's last byte, if a mark
    start = marks.copy()
    start[1:] &= ~marks[:-1] | last[:-1]          # first mark of a series
    first = np.flatnonzero(start)
    # a series ends its word if its last mark does
    stop = np.flatnonzero(marks & ~behind)
    first = first[tail[stop]]
    first = first[first > 0]
    before = text[first - 1]
    latin = (before >= 0x80) & (text[np.maximum(first - 2, 0)] == 0xC3) & (before != 0x97) & (before != 0xB7)
    return first[(_LETTER[before] | latin) & ~last[first - 1]]


def word_encoder(path: str, white_space_dropped: bool = True, kind: str = "<u4") -> Callable[[np.ndarray, np.ndarray], tuple]:
    """A function from texts (bytes, row offsets) to all their ids and the
    number of ids of each row, by the ``tokenizers`` library.

    For a tokenizer that drops white space and never joins what it separates,
    each different word of a batch is encoded once, many in one call, and texts
    are put together from their words' ids. Where a word ends in such a call is
    told by the ids that carry the end-of-word suffix, if it is letters only,
    and else by a marked word put between; words that hold the mark are encoded
    one by one. Words are cut further where a letter or digit meets the marks
    at the end of its word (``_ends_in_marks``), which such a tokenizer
    separates too. Other tokenizers get whole texts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)

    def encode(texts: list[str], by: Tokenizer = coder) -> Iterator[np.ndarray]:
        for k in range(0, len(texts), 256):  # few results are held at a time
            for e in by.encode_batch_fast(texts[k:k + 256], add_special_tokens=False):
                yield np.array(e.ids, np.uint32)

    def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = list(encode(texts))
        sizes = np.array([len(p) for p in parts], np.int64)
        return (np.concatenate(parts) if len(parts) else np.zeros(0)).astype(kind), sizes

    def whole(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = raw.tobytes()
        return joined([data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])])

    if not white_space_dropped:
        return whole
    mark = next(encode([_MARK]))
    if len(mark) != 1:
        raise ValueError("the mark is more than one id")

    form = json.loads(coder.to_str())
    steps = (form.get("normalizer") or {}).get("normalizers", [{"type": "other"}])
    if {x["type"] for x in steps} <= {"NFC", "Replace", "Lowercase"}:
        # none of these changes ASCII letters in lower case with single blanks
        ascii_coder = Tokenizer(coder.model)  # the vocabulary is held once
        ascii_coder.pre_tokenizer = coder.pre_tokenizer
    else:
        ascii_coder = coder
    suffix = form["model"].get("end_of_word_suffix")
    closing = np.zeros(coder.get_vocab_size(with_added_tokens=True), bool)  # ids that end a piece
    if suffix:
        closing[[i for token, i in coder.get_vocab().items() if token.endswith(suffix)]] = True

    def parted(words: list[str], between: str, ends: Callable[[np.ndarray], tuple], by: Tokenizer = coder) -> tuple:
        """The words' ids in runs, and behind which of them a word ends; runs
        in which it can't be told are encoded word by word."""
        runs = [words[i:i + 64] for i in range(0, len(words), 64)]
        flat, size = [], []
        for ids, run in zip(encode([between.join(r) for r in runs], by), runs):
            ids, cut = ends(ids)
            if len(cut) != len(run):
                ids, sizes = joined(run)
            else:
                sizes = np.diff(cut, prepend=0)
            flat.append(ids)
            size.append(sizes)
        return flat, size

    def by_closing(ids: np.ndarray) -> tuple:
        return ids, np.flatnonzero(closing[ids]) + 1

    def by_mark(ids: np.ndarray) -> tuple:
        here = np.flatnonzero(ids == mark[0])
        return np.delete(ids, here), np.append(here - np.arange(len(here)), len(ids) - len(here))

    added = [t.content.lower().encode() for t in coder.get_added_tokens_decoder().values() if t.content]

    def added_places(text: np.ndarray) -> np.ndarray:
        """Bytes that an added token takes, in whatever case: such words are
        left as they are."""
        out, data, lower = np.zeros(len(text), bool), text.tobytes(), False
        for token in added:
            sign = token[:next((k for k, c in enumerate(token) if chr(c).isalpha()), len(token))]
            if sign and sign not in data:
                continue
            data, lower = (data if lower else data.lower()), True
            at = data.find(token)
            while at >= 0:
                out[at:at + len(token)] = True
                at = data.find(token, at + 1)
        return out

    def run(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, text = ends[0], raw[ends[0]:ends[-1]]
        inside = ~_BLANK[text]
        begin = np.zeros(len(text) + 1, bool)
        begin[ends - at] = True
        begin[1:-1] |= ~inside[:-1]
        own_token = added_places(text)
        cut = _ends_in_marks(text, np.append(begin[1:-1] | ~inside[1:], True))
        begin[cut[~(own_token[cut] & own_token[cut - 1])]] = True
        begin = begin[:-1] & inside
        starts, body = np.flatnonzero(begin), text[inside]
        places = np.append(np.flatnonzero(begin[inside]), len(body))
        # ASCII words in lower case, as the tokenizer sees them
        if len(starts):
            narrow = np.bitwise_or.reduceat(body, places[:-1]) < 128
            if own_token.any():
                narrow &= ~np.logical_or.reduceat(own_token[inside], places[:-1])
            body[(body - 65 < 26) & np.repeat(narrow, np.diff(places))] |= 32
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(body)]).dictionary_encode()
        words = [w.decode("utf-8", "replace") for w in coded.dictionary.to_pylist()]
        kinds: tuple[list, ...] = ([], [], [], [])
        for i, w in enumerate(words):
            kinds[3 if _MARK in w else (0 if w.isascii() else 1) if suffix and w.isalpha() else 2].append(i)
        plain, alpha, mixed, marked = ([words[i] for i in k] for k in kinds)
        parts = (parted(plain, " ", by_closing, ascii_coder), parted(alpha, " ", by_closing),
                 parted(mixed, f" {_MARK} ", by_mark))
        own, own_sizes = joined(marked)
        ids = np.concatenate([x for p in parts for x in p[0]] + [own]).astype(kind)
        sizes = np.concatenate([x for p in parts for x in p[1]] + [own_sizes]).astype(np.int32)
        slot = np.empty(len(words), np.int32)
        slot[[i for k in kinds for i in k]] = np.arange(len(words))
        word = slot[coded.indices.to_numpy()]
        del words, kinds, plain, alpha, mixed, marked, parts
        per_word = sizes[word]
        before = np.concatenate(([0], np.cumsum(per_word)))
        # places fit 32 bits unless a single text is longer than that
        small = np.int32 if before[-1] + len(ids) < 1 << 31 else np.int64
        take = np.repeat((np.concatenate(([0], np.cumsum(sizes)))[word] - before[:-1]).astype(small), per_word)
        take += np.arange(before[-1], dtype=small)
        return ids[take], np.diff(before[np.searchsorted(starts, ends - at)])

    return run


# ---- files -----------------------------------------------------------------
def _with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The end id behind each document's ids."""
    if end_id is None:
        return ids, sizes
    stops = np.cumsum(sizes)
    return np.insert(ids, stops, end_id), sizes + 1


def id_kind(path: str, end_id: int | None) -> str:
    """The numpy type that holds the ids of a tokenizer: 2 or 4 bytes."""
    from tokenizers import Tokenizer
    vocabulary = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    return "<u2" if max(vocabulary, (end_id or 0) + 1) <= 1 << 16 else "<u4"


def _packer(path: str, kind: str, end_id: int | None, white_space_dropped: bool, most_ids: int, most_docs: int):
    """mapInArrow function: sorted (doc_id, text) rows to segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path, white_space_dropped, kind)
        part, place = TaskContext.get().partitionId(), 0
        held: list[tuple] = []  # (ids, sizes, doc ids, nulls)

        def flush() -> pa.RecordBatch:
            nonlocal held, place
            sizes, names = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            body = segment(part, place, [h[0] for h in held], sizes, names, sum(h[3] for h in held))
            held, place = [], place + 1
            one = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, len(body)], np.int32)), pa.py_buffer(body)])
            return pa.RecordBatch.from_arrays([one], names=["body"])

        for batch in batches:
            raw, ends = utf8_parts(batch.column(1))
            names = batch.column(0)
            for a, b in text_groups(ends, GROUP_BYTES, GROUP_ROWS):
                ids, sizes = _with_end(*encode(raw, ends[a:b + 1]), end_id)
                starts = np.concatenate(([0], np.cumsum(sizes)))
                row = 0
                while row < len(sizes):
                    ids_held, docs_held = sum(len(h[0]) for h in held), sum(len(h[1]) for h in held)
                    fit = int(np.searchsorted(starts, starts[row] + most_ids - ids_held, side="right")) - 1
                    fit = min(max(fit, row), row + most_docs - docs_held, len(sizes))
                    if fit == row and held:
                        yield flush()
                        continue
                    fit = max(fit, row + 1)  # a long document alone
                    own = names.slice(a + row, fit - row)
                    held.append((ids[starts[row]:starts[fit]], sizes[row:fit],
                                 own.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), own.null_count))
                    row = fit
        if held:
            yield flush()
    return run


def write_token_files(df: DataFrame, path: str, tokenizer: str, end_id: int | None = None, text: str = "text",
                      doc_id: str = "doc_id", white_space_dropped: bool = True, segment_ids: int = SEGMENT_IDS,
                      segment_docs: int = SEGMENT_DOCS) -> None:
    """Write every document's ids to files below ``path``, in ascending order
    of document ids. ``tokenizer``: a file of the ``tokenizers`` library, at the
    same place on every machine."""
    rows = df.select(df[doc_id].cast("long").alias("doc_id"), text_column(df, text).alias("text"))
    # equal ids lie together; a tie of very many is dealt out by text, then row
    dealt = (rows.withColumn("tie", F.xxhash64("text"))
             .withColumn("turn", F.pmod(F.monotonically_increasing_id(), F.lit(997)))
             .repartitionByRange("doc_id", "tie", "turn").sortWithinPartitions("doc_id", "tie", "text"))
    place = str(Path(tokenizer).resolve())
    packed = dealt.select("doc_id", "text").mapInArrow(
        _packer(place, id_kind(place, end_id), end_id, white_space_dropped, segment_ids, segment_docs), "body binary")
    (packed.select(F.col("body").cast("string").alias("value")).write.option("maxRecordsPerFile", 1)
     .option("compression", "none").option("lineSep", "\n").text(path))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(body) of every file that holds a segment."""
    return spark.read.format("binaryFile").load(path).filter("length > 0").select(F.col("content").alias("body"))


DOCS = "part long, place long, row long, doc_id long, at long, n_tokens long, ids_crc32 long"


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: segments to one row per document."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in DOCS.split(", ")])
    for batch in batches:
        for body in batch.column(0):
            s = Segment(body.as_buffer())
            bounds = s.bounds.get(np.arange(s.docs + 1)).astype(np.int64)
            wide = memoryview(s.ids.astype("<u4")).cast("B")
            sums = [zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(s.docs, s.part)), pa.array(np.full(s.docs, s.place)), pa.array(np.arange(s.docs)),
                pa.array(s.doc_ids(), pa.int64()), pa.array(bounds[:-1]), pa.array(np.diff(bounds)),
                pa.array(sums, pa.int64())], schema=schema)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files below ``path``: where it stands
    (``part``, ``place`` of the file, ``row`` in it, ``at`` in its ids), and of
    what size and checksum its ids are."""
    return read_segments(spark, path).mapInArrow(_documents, DOCS)


def with_starts(docs: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before. Only one row per file
    is summed up in order."""
    files = docs.groupBy("part", "place").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("part", "place", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(base, ["part", "place"]).withColumn("start", F.col("base") + F.col("at")).drop("base")


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents: their places by binary search over the
    coded document ids, their ids by ``select``, nothing else decoded."""
    wanted = sorted(set(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                s = Segment(body.as_buffer())
                found = [(i, s.tokens(k).tolist()) for i in wanted for k in s.find(i)]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                                  pa.array([f[1] for f in found], pa.list_(pa.int64()))],
                                                 names=["doc_id", "ids"])

    return read_segments(spark, path).mapInArrow(run, "doc_id long, ids array<long>")
