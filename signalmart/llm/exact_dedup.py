"""Exact deduplication with a heavy-hitter split.

A Misra-Gries summary of the text digests, one bounded set of counters per
partition, names the digests that may be frequent. Their exact counts and
winners come from one aggregation over just those rows; the winners (at most
``counters`` rows) are broadcast, and rows that lose to one are settled in
the map stage. Only the remaining digests are shuffled, and none of them can
be frequent, so no reducer receives a hot group.

Defined results: null text counts as the empty text. Of equal texts the row
with the largest id stays; a null id loses to any other. Of rows equal in
text and id exactly one stays (of a frequent text: one of the greatest hash
of its columns). An empty table gives an empty result. Columns
of the input are carried as one struct, so no name in it can clash.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmart.llm.common import text_column

COUNTERS = 1024


def _shrink(counts: dict, counters: int) -> dict:
    """Keep ``counters`` counters: take the first count that does not fit off
    every other (the mergeable form of the Misra-Gries decrement)."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {k: c - cut for k, c in counts.items() if c > cut}


def summarise(counters: int):
    """mapInArrow function: the Misra-Gries summary of each partition."""
    def run(batches):
        counts: dict = {}
        for batch in batches:
            found = batch.column(0).value_counts()
            for k, c in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counts[k] = counts.get(k, 0) + c
            counts = _shrink(counts, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["digest", "seen"])
    return run


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each that makes up more than
    one in ``counters`` of all rows."""
    parts = digests.mapInArrow(summarise(counters), "digest string, seen long")
    return (parts.groupBy("digest").agg(F.sum("seen").alias("seen"))
            .orderBy(F.desc("seen"), "digest").limit(counters).select("digest"))


def mark_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                counters: int = COUNTERS) -> DataFrame:
    """One row per input row: struct ``row`` (all input columns), ``digest``
    (SHA-256 hex of the text), ``id``, ``keep_id``, ``group_size``, ``kept``."""
    plain = [df[f.name] for f in df.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    keyed = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), F.xxhash64(*plain).alias("content"),
                      df[doc_id].alias("id"), F.sha2(text_column(df, text).cast("binary"), 256).alias("digest"))
    frequent = frequent_digests(keyed.select("digest"), counters)
    winners = (keyed.join(F.broadcast(frequent), "digest", "left_semi")
               .groupBy("digest").agg(F.max(F.struct("id", "content")).alias("winner"), F.count("*").alias("copies"))
               .filter("copies > 1"))
    # bounded by `counters` rows, whatever the input
    seen = keyed.join(F.broadcast(winners), "digest", "left")
    # of rows that repeat the winner's id, or have none as it has, only those
    # that equal it in every column go on
    same = F.col("id").eqNullSafe(F.col("winner.id")) & (F.col("content") == F.col("winner.content"))
    loses = F.col("copies").isNotNull() & ~same
    settled = seen.filter(loses).select(
        "row", "digest", "id", F.col("winner.id").alias("keep_id"), F.col("copies").alias("group_size"),
        F.lit(False).alias("kept"))
    group = Window.partitionBy("digest")
    rest = seen.filter(~loses).select(
        "row", "digest", "id", F.max("id").over(group).alias("keep_id"),
        F.coalesce("copies", F.count("*").over(group)).alias("group_size"),
        (F.row_number().over(group.orderBy(F.desc_nulls_last("id"))) == 1).alias("kept"))
    return settled.unionByName(rest)


def drop_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with the input's columns."""
    return mark_copies(df, text, doc_id, counters).filter("kept").select("row.*")
