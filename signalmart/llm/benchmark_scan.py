"""Benchmark decontamination with a broadcast hash set of test n-grams.

Every benchmark item gives its windows of 13 consecutive words (an item of
fewer words is one window). The hashes of the distinct windows form the set
that is broadcast, 8 MB at most. The windows themselves, against which hits
are verified, are broadcast up to ``BROADCAST_ROWS``; beyond that the same
join runs as a shuffle join. Each document's token windows
are scanned against the set where they lie (a bit set over each window's
first, middle and last word), a hit is verified on all its words, and only
verified hits are shuffled.

Built-in functions only, no Python runs on the executors.

Defined results: null or empty text has no words and no hits; items without
words have no windows. Rows with equal text get equal results. Empty tables
give empty results or documents without hits. Output columns are added to a
struct of the input's, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmart.llm.common import stored, text_column

WINDOW = 13
#: About 0.2 kB each in a broadcast hash relation: 200 MB at most.
BROADCAST_ROWS = 1_000_000
#: FIXED VALUE: bytes of ASCII that are no letter or digit separate words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ANY_SEPARATOR = SEPARATORS[:-1]
_ANY_WORD = "[^" + _ANY_SEPARATOR[1:]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), SEPARATORS), lambda w: w != "")


def item_windows(items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Distinct windows: ``length``, ``hash``, ``window`` (the words) and the
    ``items`` that hold it."""
    words = items.select(items[item_id].cast("string").alias("item"),
                         words_of(text_column(items, text)).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    each = words.select("item", length.alias("length"), F.explode(F.transform(
        starts, lambda i: F.slice("words", i, F.least(F.size("words"), F.lit(WINDOW))))).alias("window"))
    return (each.groupBy("length", "window").agg(F.collect_set("item").alias("items"))
            .withColumn("hash", F.xxhash64("window")))


def probe(words: Column, start: Column | int, size: int) -> Column:
    """A hash of a window's first, middle and last word."""
    return F.xxhash64(*[F.get(words, F.lit(start) + k) for k in sorted({0, (size - 1) // 2, size - 1})])


def _bits(count: int) -> int:
    """Size of the hash set: 64 bits a window or more, a power of two, 2^26
    (8 MB) at most; a fuller set only lets more candidates through."""
    return 1 << min(26, max(12, (64 * count - 1).bit_length()))


def hash_set(windows: DataFrame, count: int) -> Column:
    """The windows' probes as a bit set, an array of 64-bit words: one value
    that a scalar subquery ships to every task."""
    size = _bits(count)
    spot = None
    for k in range(1, WINDOW + 1):
        one = windows.filter(F.col("length") == k).select(probe(F.col("window"), 0, k).alias("h"))
        spot = one if spot is None else spot.unionByName(one)
    spot = spot.select(F.col("h").bitwiseAND(F.lit(size - 1)).alias("h"))
    held = spot.select(F.shiftright("h", 6).alias("at"), F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit")) \
        .groupBy("at").agg(F.bit_or("bit").alias("bits"))
    every = windows.sparkSession.range(size // 64).withColumnRenamed("id", "at").join(held, "at", "left")
    whole = every.agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
                      .alias("a")).select(F.col("a.bits"))
    return whole.scalar()


def in_set(bits: str, h: Column) -> Column:
    spot = h.bitwiseAND(F.size(bits).cast("long") * 64 - 1)
    word = F.get(bits, F.shiftright(spot, 6).cast("int"))
    return F.getbit(word, spot.bitwiseAND(F.lit(63))) == 1


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text",
         item_id: str = "item_id") -> DataFrame:
    """One row per distinct text that has a verified hit: ``key`` (SHA-256 of
    the text), ``spans`` (sorted disjoint word ranges [start, stop)),
    ``n_hit`` (words in them) and ``items`` (sorted as strings)."""
    windows = stored(item_windows(items, item_text, item_id), "windows")
    lengths = windows.groupBy("length").count().collect()  # 13 rows at most
    count = sum(r["count"] for r in lengths)
    test = F.broadcast(windows) if count <= BROADCAST_ROWS else windows

    whole = text_column(docs, text)
    bits = hash_set(windows, count)
    words = docs.select(text_key(whole).alias("key"), words_of(whole).alias("words"), bits.alias("bits"))

    def candidates(size: int) -> Column:
        starts = F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size))
        starts = F.filter(starts, lambda i: in_set("bits", probe(F.col("words"), i, size)))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.struct(
            i.alias("start"), F.lit(size).alias("length"), F.slice("words", i + 1, size).alias("window")))

    sizes = sorted(r["length"] for r in lengths) or [WINDOW]
    each = words.select("key", F.explode(
        candidates(sizes[0]) if len(sizes) == 1 else F.flatten(F.array(*map(candidates, sizes)))).alias("w"))
    each = each.select("key", "w.*").withColumn("hash", F.xxhash64("window"))
    # equal words make the hit
    hits = each.join(test, ["hash", "length", "window"]).select("key", "start", "length", "items")
    hits = hits.groupBy("key", "start", "length").agg(F.first("items").alias("items"))

    before = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.col("start") + F.col("length")
    # ranges that overlap or touch share an island
    islands = (hits.withColumn("new", F.coalesce(F.max(stop).over(before) < F.col("start"), F.lit(True)).cast("int"))
               .withColumn("island", F.sum("new").over(until))
               .groupBy("key", "island").agg(F.min("start").alias("start"), F.max(stop).alias("stop"),
                                             F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")))
    return islands.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def mark_documents(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text",
                   item_id: str = "item_id", carry: list[str] | None = None) -> DataFrame:
    """One row per document: struct ``row`` of the columns ``carry`` (all),
    ``n_words``, ``n_hit``, ``spans``, ``items`` and ``contaminated``."""
    # written first, so that the join's other side, where one text may hold a
    # third of the rows, can be split
    found = stored(scan(docs, items, text, item_text, item_id), "spans")
    whole = text_column(docs, text)
    rows = docs.select(F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"), text_key(whole).alias("key"),
                       F.size(words_of(whole)).cast("long").alias("n_words"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, "key", "left").select(
        "row", "n_words", hit.alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        is_contaminated(hit, F.col("n_words")).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The documents that are not contaminated, with the input's columns."""
    return mark_documents(docs, items, **names).filter("NOT contaminated").select("row.*")


def cut_spans(docs: DataFrame, items: DataFrame, text: str = "text", **names) -> DataFrame:
    """Every document without its hit words, with the input's columns: a hit
    word goes with the separators before it; what follows the last word
    stays."""
    marked = mark_documents(docs, items, text, **names)
    whole = F.col("row")[text].cast("string")
    parts = F.regexp_extract_all(whole, F.lit(f"(?s)({_ANY_SEPARATOR}*{_ANY_WORD}+)"), F.lit(1))
    tail = F.regexp_extract(whole, f"(?s)({_ANY_SEPARATOR}*)$", 1)
    clean = F.filter(parts, lambda p, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["stop"])))
    cut = F.when(F.col("n_hit") > 0, F.concat(F.array_join(clean, ""), tail)).otherwise(F.col("row")[text])
    return marked.select(F.col("row").withField(text, cut).alias("row")).select("row.*")
