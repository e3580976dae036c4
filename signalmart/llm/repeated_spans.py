"""Removal of long repeated byte strings with a range-partitioned suffix sort.

Every 200-byte string (a window) has a leading token: the least-hashed
32-byte gram in it, the leftmost of equal ones. Equal windows have equal
tokens at equal places, so the suffixes that start at a token's windows can
be compared among those of the same token alone, and a run of neighbouring
windows that share a token occurrence travels as one row: the bytes around
it (its context) and the range of windows.

1. Tokens that occur once cannot lie in a repeated window. The others are
   counted over the whole corpus; a bit set of their hashes (at most
   ``FILTER_BITS`` bits) tells which contexts to ship. A full bit set lets
   more contexts pass and changes no result.
2. Contexts are range-partitioned by their token with sampled splitters.
   Equal tokens are never split, so no match crosses a bucket boundary.
3. A bucket sorts the suffixes from the token by multikey quicksort, eight
   bytes a step, and the reversed prefixes likewise. The common-prefix lengths
   of sorted neighbours give classes of equal right and left parts of any
   length, and a window is repeated where its pair of classes is.
4. A token with more than ``GROUP`` rows is not sent to one task: its windows
   are cut in bands of 16 with longer leading tokens and partitioned anew, and
   if need be in single windows, which are counted by a grouped sum.

Defined results: null text counts as empty; texts under 200 bytes lose
nothing; of equal texts of 200 bytes or more every byte goes. Matches never
cross documents, overlapping occurrences count, and strings are judged on the
input. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart.llm.common import stored, text_column, utf8_parts
from signalmart.llm.shingles import mix

SPAN, GRAM = 200, 32
#: 32 MB at most.
FILTER_BITS = 1 << 28
GROUP = 50_000
#: Contexts that a task sorts together, besides those of the last token.
TOGETHER = 12_000
#: Widths of the bands of windows that share a row, level by level.
BANDS = (SPAN - GRAM + 1, 16, 1)
_SEGMENT = 1 << 19
U = np.uint64
_rng = np.random.Generator(np.random.PCG64(7919))
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=U)
_BASE = 0xB5297A4D3F84D5B5


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base), U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _SEGMENT + 2 * SPAN)
_DOWN = _powers(pow(_BASE, -1, 2 ** 64), _SEGMENT + 2 * SPAN)

CONTEXT = "hash binary, key binary, at array<int>, low int, high int, context binary"
SETTLED = "hash binary, lo int, hi int"
#: Tokens of 32 bytes and more, with their counts: a few MB.
BROADCAST_ROWS = 50_000


def tokens(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: the token occurrences' positions and hashes, and the
    first and last window start of each."""
    places, hashes, first, last = [], [], [], []
    width = SPAN - GRAM + 1
    for at in range(0, max(0, len(raw) - SPAN + 1), _SEGMENT):
        part = raw[at:at + _SEGMENT + SPAN - 1]
        total = np.zeros(len(part) + 1, U)
        np.cumsum(_BYTE[part] * _UP[:len(part)], out=total[1:])
        n = len(part) - GRAM + 1
        gram = mix((total[GRAM:] - total[:n]) * _DOWN[:n])
        # least hash, leftmost of equal ones: the place in the low bits
        code = (gram & ~U(0xFFFFF)) | np.arange(n, dtype=U)
        full = -(-n // width) * width
        blocks = np.full(full, np.iinfo(np.uint64).max, U)
        blocks[:n] = code
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - width + 1
        spot = (np.minimum(back[:windows], ahead[width - 1:width - 1 + windows]) & U(0xFFFFF)).astype(np.int64)
        edge = np.flatnonzero(np.concatenate(([True], spot[1:] != spot[:-1])))
        places.append(spot[edge] + at)
        hashes.append(gram[spot[edge]])
        first.append(edge + at)
        last.append(np.append(edge[1:], windows) - 1 + at)
    if not places:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, U), none, none
    return tuple(np.concatenate(x) for x in (places, hashes, first, last))


def _token_counts(batches):
    """mapInArrow over (key hash, text): the hash of each token and a hash of
    where it stands, once per text and token; ``twice`` if it stands there
    more than once."""
    for batch in batches:
        raw, ends = utf8_parts(batch.column(1))
        owner = batch.column(0).to_numpy(zero_copy_only=False).view(U) if len(ends) > 1 else np.zeros(0, U)
        out, who = [np.zeros(0, U)], [np.zeros(0, U)]
        for i in range(len(ends) - 1):
            place, gram, _, _ = tokens(raw[ends[i]:ends[i + 1]])
            out.append(gram)
            who.append(mix(owner[i] ^ mix(place.astype(U) + U(1))))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)),
                                          pa.array(np.concatenate(who).view(np.int64))], names=["token", "place"])


def shared_tokens(keyed: DataFrame) -> DataFrame:
    """Hashes of the tokens that stand in more than one place; equal places
    of equal texts are one."""
    found = keyed.select(F.xxhash64("key"), "text").mapInArrow(_token_counts, "token long, place long")
    return (found.groupBy("token").agg(F.min("place").alias("a"), F.max("place").alias("b"))
            .filter("a <> b").select("token"))


def _bit_set(shared: DataFrame, limit: int) -> np.ndarray:
    count = shared.count()
    size = 1 << min((limit - 1).bit_length(), max(12, (32 * count).bit_length()))
    rows = (shared.select(F.col("token").bitwiseAND(F.lit(size - 1)).alias("h"))
            .groupBy(F.shiftright("h", 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias("bits")).toArrow())
    bits = np.zeros(size // 64, U)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(U)
    return bits


def contexts(bits):
    """mapInArrow over (key, text): a row per different context of a text
    that has a shared token; equal contexts of a batch carry the bytes once."""
    def run(batches):
        filter_bits = bits.value
        mask = U(len(filter_bits) * 64 - 1)
        for batch in batches:
            raw, ends = utf8_parts(batch.column(1))
            sent: set[bytes] = set()
            rows: list[list] = [[] for _ in range(6)]
            for i in range(len(ends) - 1):
                text = raw[ends[i]:ends[i + 1]]
                place, gram, first, last = tokens(text)
                spot = gram & mask
                live = np.flatnonzero((filter_bits[(spot >> U(6)).astype(np.int64)] >> (spot & U(63))) & U(1))
                if not len(live):
                    continue
                data, key, mine = text.tobytes(), batch.column(0)[i].as_py(), {}
                for a, s, e in zip(place[live].tolist(), first[live].tolist(), last[live].tolist()):
                    mine.setdefault((data[s:e + SPAN], a - e, a - s), []).append(a)
                for (context, low, high), at in mine.items():
                    name = hashlib.blake2b(context + bytes((low, high)), digest_size=16).digest()
                    new = name not in sent
                    sent.add(name)
                    for column, value in zip(rows, (name, key, at, low, high, context if new else None)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, (pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int32(),
                                                       pa.int32(), pa.binary()))],
                names=["hash", "key", "at", "low", "high", "context"])
    return run


def _sorted_suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows of big-endian 8-byte words: the order, and
    the number of bytes each row shares with the one before it."""
    n, steps = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    shared = np.full(n, 8 * steps, np.int64)
    shared[:1] = 0
    group = np.zeros(n, np.int64)  # rows equal so far have the same number
    live = np.arange(n)            # places in the order that are not settled
    for step in range(steps):
        if step:
            word = words[order[live], step]
            turn = np.lexsort((word, group[live]))
            order[live] = order[live][turn]
        word = words[order[live], step]
        same = np.zeros(len(live), bool)
        same[1:] = group[live[1:]] == group[live[:-1]]
        differ = same.copy()
        differ[1:] &= word[1:] != word[:-1]
        cut = np.flatnonzero(differ)
        x = word[cut] ^ word[cut - 1]
        lead = np.zeros(len(cut), np.int64)
        for byte in range(1, 8):  # equal leading bytes of the two words
            lead += (x >> U(64 - 8 * byte)) == 0
        shared[live[cut]] = 8 * step + lead
        # whoever equals a neighbour stays live, under the number of its run
        head = ~same | differ
        number = np.cumsum(head)
        size = np.bincount(number)
        group[live] = live[head][number - 1]
        live = live[size[number] > 1]
        if len(live) < 2:
            break
    return order, shared


def _classes(order: np.ndarray, shared: np.ndarray, length: int) -> np.ndarray:
    """Of each row the number of its class of equal first ``length`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < length) if length else 0
    return out


def _as_words(parts: list[bytes], size: int) -> np.ndarray:
    padded = b"".join(p.ljust(size, b"\0") for p in parts)
    return np.frombuffer(padded, ">u8").reshape(len(parts), size // 8).astype(U)


def repeated_windows(context: list[bytes], low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For different contexts (bytes, distance from the token back to the last
    and the first window start, number of occurrences): whether the window at
    each distance is repeated, as a matrix rows x distances."""
    rows, width = len(context), int(high.max(initial=0)) + 1
    distance = np.arange(width)
    inside = (distance >= low[:, None]) & (distance <= high[:, None])
    out = inside & (n > 1)[:, None]
    right = _sorted_suffixes(_as_words([c[h:] for c, h in zip(context, high.tolist())], SPAN))
    left = _sorted_suffixes(_as_words([c[:h][::-1] for c, h in zip(context, high.tolist())],
                                      -(-max(width, 8) // 8) * 8))

    def most(order, shared):  # what a row shares with its nearest neighbour
        near = np.maximum(shared, np.append(shared[1:], 0))
        found = np.empty(rows, np.int64)
        found[order] = near
        return found

    # only rows whose best left and right parts could make up a window
    open_ = np.flatnonzero(most(*right) + most(*left) >= SPAN)
    if len(open_) < 2:
        return out
    for k in range(int(low[open_].min()), int(high[open_].max()) + 1):
        some = open_[(low[open_] <= k) & (high[open_] >= k)]
        if len(some) < 2:
            continue
        pair = _classes(*right, SPAN - k)[some] * rows + _classes(*left, k)[some]
        _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
        out[some[count[which] > 1], k] = True
    return out


def _runs(line: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], line.astype(np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


def settle(batches):
    """mapInArrow over (token, hash, base, low, high, context, n) in token
    order: the repeated windows of each context as ranges of distances."""
    held: dict[tuple, list] = {}   # (hash, base) -> [low, high, context, n], of whole tokens
    last = None

    def done():
        flat = [(*k, *v) for k, v in held.items()]
        found = repeated_windows([r[4] for r in flat], np.array([r[2] for r in flat]),
                                 np.array([r[3] for r in flat]), np.array([r[5] for r in flat]))
        rows = [(r[0], a + r[1], b + r[1]) for r, line in zip(flat, found) if line.any() for a, b in _runs(line)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.binary(), pa.int32(), pa.int32()))],
            names=["hash", "lo", "hi"])

    for batch in batches:
        for token, name, base, low, high, context, n in zip(*(c.to_pylist() for c in batch.columns)):
            if token != last and len(held) >= TOGETHER:
                yield done()
                held.clear()
            last = token
            if (name, base) in held:
                held[name, base][3] += n
            else:
                held[name, base] = [low, high, context, n]
    if held:
        yield done()


def _with_token(rows: DataFrame, width: int) -> DataFrame:
    """The leading token of rows whose windows span ``width`` at most."""
    return rows.select(F.expr(f"substring(context, high + 1, {SPAN - width + 1})").alias("token"),
                       "hash", "base", "low", "high", "context", "n")


def _bands(rows: DataFrame, width: int) -> DataFrame:
    """Rows cut in bands of ``width`` windows; distances count from the
    band's first, which ``base`` keeps."""
    first = F.sequence((F.floor(F.col("low") / width) * width).cast("int"), F.col("high"), F.lit(width))
    cut = rows.select("hash", "base", "low", "high", "context", "n", F.explode(first).alias("first"))
    cut = cut.withColumn("a", F.greatest("first", "low")).withColumn("b", F.least(F.col("first") + width - 1, "high"))
    return cut.select("hash", (F.col("base") + F.col("first")).alias("base"), (F.col("a") - F.col("first")).alias("low"),
                      (F.col("b") - F.col("first")).alias("high"),
                      F.expr(f"substring(context, high - b + 1, b - a + {SPAN})").alias("context"), "n")


def _repeated(rows: DataFrame, group: int) -> DataFrame:
    """(hash, lo, hi): the repeated windows of each context. ``rows``: hash,
    base, low, high, context, n."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settled = []
    for width, narrower in zip(BANDS, BANDS[1:]):
        level = _with_token(rows, width)
        hot = stored(level.groupBy("token").agg(F.count("*").alias("rows")).filter(F.col("rows") > group).select("token"), "hot")
        many = hot.count()
        test = F.broadcast(hot) if many <= BROADCAST_ROWS else hot
        cold = level.join(test, "token", "left_anti") if many else level
        # splitters are sampled; equal tokens share a partition
        cold = cold.repartitionByRange(parts, "token").sortWithinPartitions("token")
        settled.append(stored(cold.mapInArrow(settle, SETTLED), "settled"))
        if not many:
            break
        rows = stored(_bands(level.join(test, "token", "left_semi"), narrower), "bands")
    else:  # single windows: the token is the window
        level = _with_token(rows, 1)
        twice = level.groupBy("token").agg(F.sum("n").alias("seen")).filter("seen > 1").select("token")
        settled.append(level.join(twice, "token").select("hash", F.col("base").alias("lo"), F.col("base").alias("hi")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def repeated_ranges(keyed: DataFrame, group: int = GROUP, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(key, ranges) of the texts that lose something: the byte ranges
    [start, stop) of runs of repeated windows. ``keyed``: key, text."""
    sc = keyed.sparkSession.sparkContext
    bits = sc.broadcast(_bit_set(stored(shared_tokens(keyed), "tokens"), filter_bits))
    rows = stored(keyed.select("key", "text").mapInArrow(contexts(bits), CONTEXT), "contexts")
    level = rows.filter("context IS NOT NULL").select("hash", F.lit(0).alias("base"), "low", "high", "context",
                                                      F.size("at").alias("n"))
    extra = rows.filter("context IS NULL").groupBy("hash").agg(F.sum(F.size("at")).cast("int").alias("more"))
    level = level.join(extra, "hash", "left").withColumn("n", F.col("n") + F.coalesce("more", F.lit(0))).drop("more")
    each = rows.select("hash", "key", F.explode("at").alias("a")).join(_repeated(level, group), "hash")
    return each.groupBy("key").agg(F.collect_set(F.struct(
        (F.col("a") - F.col("hi")).alias("start"), (F.col("a") - F.col("lo") + SPAN).alias("stop"))).alias("ranges"))


CUT = "struct<n_removed: bigint, n_spans: bigint, kept: binary>"


def cut(text: Column, ranges: Column) -> Column:
    """Bytes removed, maximal removed runs, and the bytes that remain."""
    @F.arrow_udf(CUT)
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(texts)
        removed, spans, kept = [], [], []
        for i in range(len(ends) - 1):
            data = raw[ends[i]:ends[i + 1]]
            step = np.zeros(len(data) + 1, np.int64)
            pairs = lists[i].values
            np.add.at(step, pairs.field(0).to_numpy(), 1)
            np.add.at(step, pairs.field(1).to_numpy(), -1)
            gone = np.cumsum(step)[:-1] > 0
            removed.append(int(gone.sum()))
            spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum()))
            kept.append(data[~gone].tobytes())
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                           pa.array(kept, pa.binary())], names=["n_removed", "n_spans", "kept"])

    return run(text, ranges)


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id", group: int = GROUP,
                   filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per input row: ``id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept`` (the bytes that remain, null where that is the whole text) and
    ``whole_sha256``."""
    base = df.select(df[doc_id].alias("id"), text_column(df, text).cast("binary").alias("text"))
    keyed = base.withColumn("key", F.unhex(F.md5("text")))
    copies = keyed.groupBy("key").agg(F.count("*").alias("copies"))
    ranges = repeated_ranges(keyed, group, filter_bits)
    # texts that occur once; copies lose all, so their bytes are not moved
    once = ranges.join(copies.filter("copies = 1"), "key")
    parts = keyed.select("key", "text").join(once, "key").select("key", cut(F.col("text"), F.col("ranges")).alias("c"))
    parts = stored(parts.select("key", "c.*"), "cut")
    narrow = keyed.select("id", "key", F.octet_length("text").cast("long").alias("n_bytes"),
                          F.sha2("text", 256).alias("whole_sha256"))
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= SPAN)
    zero = F.lit(0).cast("long")
    return narrow.join(copies, "key").join(parts, "key", "left").select(
        "id", "n_bytes", F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(all_gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(all_gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"), "whole_sha256")
