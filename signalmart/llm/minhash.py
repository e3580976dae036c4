"""Near-duplicate groups by MinHash.

1. Each text becomes its set of five-word shingles and a signature: the least
   value of the set under each of ``bands * rows`` universal hash functions
   (multiply and add modulo 2^64). Texts with equal sets share one vertex, so
   a group of copies is one row from here on.
2. Banding: a vertex enters one bucket per band. Buckets with one vertex go.
3. Every bucket links its vertices to one hub, the member that meets most
   others over all bands. An edge is first verified on the signatures and
   then confirmed on the full sets, exactly.
4. Components of the confirmed edges (large-star and small-star). Buckets
   that still hold several components are finished exactly: a prefix filter
   over the full sets of their members finds every pair of different
   components that can be similar enough, and these are verified in the same
   way. So no link of a bucket is lost, while a bucket of near copies costs
   its size and not the square of it.

With 25 bands of 5 rows, two texts of similarity 0.85 miss every band with
probability 4e-7, of 0.8 with 5e-5, of 0.9 with 1e-10.

Defined results: a null or empty text has the empty set, is linked with
nothing and is its own component; ``component_id`` is the least non-null id
of the component (null if it has none); rows with equal id and text are in
the same component. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmart.llm.common import stored, text_column, utf8_parts
from signalmart.llm.components import components, meet
from signalmart.llm.shingles import overlap_counts, set_key, shingle_set

BANDS, ROWS = 25, 5
#: Signature check: standard deviations below the threshold that still pass.
SLACK = 5.0
_BLOCK = 1 << 15

SKETCH = "struct<n: bigint, vertex: binary, signature: array<int>>"


def hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the universal hash functions."""
    rng = np.random.Generator(np.random.PCG64(977))
    return rng.integers(0, 2 ** 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), \
        rng.integers(0, 2 ** 63, count, dtype=np.uint64)


def minima(shingles: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The least value of a set under each hash function, top 32 bits."""
    least = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, _BLOCK // len(mult))
    for at in range(0, len(shingles), step):
        part = shingles[at:at + step, None] * mult[None, :]
        part += add[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch(texts: Column, size: int) -> Column:
    """Set size, set key and signature of each text (null for no words)."""
    mult, add = hash_family(size)

    @F.arrow_udf(SKETCH)
    def run(column: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(column)
        counts, keys, signs = [], [], []
        for i in range(len(ends) - 1):
            found = shingle_set(raw[ends[i]:ends[i + 1]])
            counts.append(len(found))
            keys.append(set_key(found) if len(found) else None)
            signs.append(minima(found, mult, add) if len(found) else None)
        flat = [s for s in signs if s is not None]
        starts = np.cumsum([0] + [0 if s is None else size for s in signs]).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            pa.array(starts, pa.int32()),
            pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32()))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), lists],
            names=["n", "vertex", "signature"])

    return run(texts)


def exact_link(left: Column, right: Column, percent: int) -> Column:
    """Whether the full sets of two texts are at least ``percent`` alike."""
    @F.arrow_udf("boolean")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        (ra, ea), (rb, eb) = utf8_parts(a), utf8_parts(b)
        out, last, kept = [], None, None
        for i in range(len(ea) - 1):
            one = bytes(rb[eb[i]:eb[i + 1]])
            if one != last:  # rows of one hub often follow each other
                last, kept = one, shingle_set(rb[eb[i]:eb[i + 1]])
            both, union = overlap_counts(shingle_set(ra[ea[i]:ea[i + 1]]), kept)
            out.append(union > 0 and 100 * both >= percent * union)
        return pa.array(out, pa.bool_())

    return run(left, right)


def _confirmed(pairs: DataFrame, signatures: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (u, v) that signatures admit and full sets confirm."""
    share = percent / 100
    floor = share - SLACK * (share * (1 - share) / size) ** 0.5
    sides = [signatures.select(F.col("vertex").alias(c), F.col("signature").alias(f"s{c}"),
                               F.col("n").alias(f"n{c}")) for c in "uv"]
    agree = F.aggregate(F.zip_with("su", "sv", lambda a, b: (a == b).cast("int")), F.lit(0), lambda x, y: x + y)
    # written, so that its true size decides how the texts are joined
    likely = stored(pairs.join(sides[0], "u").join(sides[1], "v")
                    .filter(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
                    .filter(agree >= floor * size).select("u", "v"), "likely")
    paired = (likely.join(texts.select(F.col("vertex").alias("u"), F.col("text").alias("tu")), "u")
              .join(texts.select(F.col("vertex").alias("v"), F.col("text").alias("tv")), "v"))
    return stored(paired.filter(exact_link(F.col("tu"), F.col("tv"), percent)).select("u", "v"), "links")


def prefix_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of different roots that may be linked, from ``rest``
    (vertex, root, text). Shingles are ordered by how many of these sets hold
    them, rare ones first. Two sets that are alike enough share one among
    their first (100 - percent) %, and from the place of the first shared one
    in both follows a bound on all they share; so sets whose own changes come
    first, as near copies of one text have, do not meet."""
    @F.arrow_udf("array<bigint>")
    def shingles(column: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(column)
        found = [shingle_set(raw[ends[i]:ends[i + 1]]).view(np.int64) for i in range(len(ends) - 1)]
        starts = np.cumsum([0] + [len(f) for f in found]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(
            np.concatenate(found) if found else np.zeros(0, np.int64)))

    sets = rest.select("vertex", "root", shingles("text").alias("s"))
    tokens = sets.select("vertex", "root", F.size("s").alias("n"), F.explode("s").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = (tokens.join(common, "token").groupBy("vertex", "root", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s")))
    own = F.col("n") - F.size("s")  # shingles of this set alone come first
    most = F.col("n") - F.ceil(F.col("n") * percent / 100)
    head = (ranked.withColumn("own", own).filter(F.col("own") <= most)
            .select("vertex", "root", "n", "own", F.posexplode(F.slice("s", F.lit(1), (most - own + 1).cast("int"))))
            .select("vertex", "root", "n", (F.col("own") + F.col("pos")).alias("place"), F.col("col.token").alias("token")))
    head = stored(head, "heads")
    a, b = (head.select("token", F.col("vertex").alias(x), F.col("root").alias(f"r{x}"), F.col("n").alias(f"n{x}"),
                        F.col("place").alias(f"p{x}")) for x in "uv")
    bound = F.least(F.col("nu") - F.col("pu"), F.col("nv") - F.col("pv"))
    may = ((F.col("u") < F.col("v")) & (F.col("ru") != F.col("rv"))
           & (F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
           & (bound * (100 + percent) >= (F.col("nu") + F.col("nv")) * percent))
    return a.join(b, (a["token"] == b["token"]) & may).select("u", "v").distinct()


def vertex_roots(drawn: DataFrame, rows_of: DataFrame, percent: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(vertex, root) of the vertices that are linked with another one.
    ``drawn``: key, vertex, n, signature of each row with words; ``rows_of``:
    key, text of each row."""
    size = bands * rows
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(
        b, F.slice("signature", b * rows + 1, rows)))
    # of each vertex one text and its signature: copies are one row from here on
    one = stored(drawn.groupBy("vertex").agg(F.min("key").alias("key"), F.first("n").alias("n"),
                                             F.first("signature").alias("signature")), "vertices")
    entries = one.select("vertex", F.explode(keys).alias("bucket"))
    # large buckets and components are split where they meet what was summed up of them
    shared = entries.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(meet(entries, shared, "bucket"), "members")
    fame = members.groupBy("vertex").agg(F.sum("size").alias("fame"))
    signatures = stored(one.join(fame, "vertex"), "signatures")
    texts = stored(rows_of.join(signatures.select("key", "vertex"), "key")
                   .groupBy("vertex").agg(F.first("text").alias("text")), "texts")

    hubs = (members.join(fame, "vertex").groupBy("bucket")
            .agg(F.max(F.struct("fame", "vertex"))["vertex"].alias("v")))
    tried = stored(meet(members.select("bucket", F.col("vertex").alias("u")), hubs, "bucket")
                   .filter("u <> v").select("u", "v").distinct(), "tried")
    roots = stored(components(_confirmed(tried, signatures, texts, percent, size)), "roots")

    placed = stored(members.join(roots, "vertex", "left").select(
        "bucket", "vertex", F.coalesce("root", "vertex").alias("root")), "placed")
    mixed = (placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .filter("lo <> hi").select("bucket"))
    left_open = meet(placed, mixed, "bucket").select("vertex", "root").distinct()
    cross = prefix_pairs(left_open.join(texts, "vertex"), percent)
    done = tried.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    # written first, or all signatures would be shuffled beside this search, however few pairs it finds
    untried = stored(cross.join(done, ["u", "v"], "left_anti"), "untried")
    more = _confirmed(untried, signatures, texts, percent, size)
    known = roots.select(F.col("vertex").alias("u"), F.col("root").alias("v"))
    return components(known.unionByName(more))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text: no two among 10^12 are likely to agree."""
    return F.unhex(F.md5(text.cast("binary")))


def near_groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 80,
                bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: ``id``, ``key`` (128 bits of its text),
    ``n_shingles``, ``root`` (null for no words), ``component_id`` and
    ``stays``, the least key of the component's rows of that id."""
    base = df.select(df[doc_id].alias("id"), text_column(df, text).alias("text")).withColumn(
        "key", text_key(F.col("text")))
    drawn = stored(base.select("id", "key", sketch(F.col("text"), bands * rows).alias("s"))
                   .select("id", "key", "s.*"), "sketches")
    worded = drawn.filter("vertex IS NOT NULL")
    roots = vertex_roots(worded, base.select("key", "text"), percent, bands, rows)
    # null ids last
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    named = stored(worded.groupBy("vertex").agg(first.alias("least")).join(roots, "vertex", "left")
                   .withColumn("root", F.coalesce("root", "vertex")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("least"))
    label = meet(named.select("vertex", "root"), least, "root").select(
        "vertex", "root", F.col("least.id").alias("component_id"), F.col("least.key").alias("stays"))
    return drawn.select("id", "key", "n", "vertex").join(label, "vertex", "left").select(
        "id", "key", F.col("n").alias("n_shingles"), "root", "stays",
        F.when(F.col("vertex").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 80) -> DataFrame:
    """One row of each group stays, with the input's columns: one of the
    least id. Rows without words all stay."""
    marked = stored(near_groups(df, text, doc_id, percent), "marked")
    # one text of the component's id stands for it; all else goes
    leaves = stored(marked.filter("root IS NOT NULL AND NOT (id <=> component_id AND key = stays)")
                    .select("id", "key").distinct(), "leaves")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[doc_id].alias("id"),
                     text_key(text_column(df, text)).alias("key"))
    gone = (rows["key"] == leaves["key"]) & rows["id"].eqNullSafe(leaves["id"])
    kept = rows.join(leaves, gone, "left_anti")
    # rows that repeat both id and text
    twice = stored(marked.filter("root IS NOT NULL").groupBy("id", "key").count().filter("count > 1")
                   .select("id", "key"), "twice")
    if twice.isEmpty():
        return kept.select("row.*")
    again = (kept["key"] == twice["key"]) & kept["id"].eqNullSafe(twice["id"])
    same = kept.join(twice, again, "left_semi")
    turn = Window.partitionBy("key", "id").orderBy(F.xxhash64("row"))
    return kept.join(twice, again, "left_anti").select("row.*").unionByName(
        same.withColumn("turn", F.row_number().over(turn)).filter("turn = 1").select("row.*"))
