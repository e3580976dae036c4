"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its lower-cased words and its three-byte sequences as they
stand, hashed into a fixed number of buckets, and a few style terms (levels
of repetition, capitals, signs). Inverse document frequencies are counted over the whole
corpus. A bounded sample of labelled rows gives the latent space (truncated
SVD of its TF-IDF matrix) and the labelled vectors, which are broadcast.
Every document is folded into the space and its cosines with all labelled
vectors are computed exactly, in blocks of documents; the nearest vote with
their similarity as weight.

Defined results: null text counts as empty; a text without terms has no
neighbours and scores the labelled rows' share of label 1 (0.5 without
labelled rows). Labels that are null are not used; a repeated or
contradictory label counts as its maximum. Repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart.llm.common import stored, text_column, text_groups, utf8_parts
from signalmart.llm.shingles import word_hashes

#: Hash buckets of words and of byte sequences, and those of the style terms.
WORDS, BYTES, STYLE = 2048, 2048, 55
BUCKETS = WORDS + BYTES + STYLE
_BLOCKS = (slice(0, WORDS), slice(WORDS, WORDS + BYTES), slice(WORDS + BYTES, BUCKETS))
#: Bounds of the model: labelled rows per class, rows the space is fitted on.
EXAMPLES, FITTED = 4_000, 2_000
DIMENSIONS, NEIGHBOURS, SHARPNESS = 48, 15, 6
#: Bytes and rows of the texts handled at a time.
_GROUP, _ROWS = 1 << 19, 1_000
_KIND = np.zeros(256, np.int64)  # 1 small letter, 2 capital, 3 white space, 4 other ASCII but digits
_KIND[97:123], _KIND[65:91], _KIND[[9, 10, 11, 12, 13, 32]] = 1, 2, 3
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = 4


def style(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Five terms: shares of words that repeat the one before, of distinct
    words, of capitals, of white space and of other signs, each as one of
    eleven levels that are finer near 0."""
    kinds = np.bincount(_KIND[text], minlength=5)
    n = max(1, len(words))
    shares = np.array([np.count_nonzero(words[1:] == words[:-1]) / n, len(np.unique(words)) / n,
                       kinds[2] / max(1, kinds[1] + kinds[2]), kinds[3] / len(text), kinds[4] / len(text)])
    return np.arange(5) * 11 + np.floor(10 * np.sqrt(shares)).astype(np.int64)


def term_matrix(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of the hashed terms, one row per text."""
    out = np.zeros((len(ends) - 1, BUCKETS), np.float32)
    for i in range(len(ends) - 1):
        text = raw[ends[i]:ends[i + 1]]
        if len(text) == 0:
            continue
        words = word_hashes(text)
        out[i, :WORDS] = np.bincount((words >> np.uint64(40)).astype(np.int64) % WORDS, minlength=WORDS)
        out[i, WORDS + BYTES + style(text, words)] = 1
        if len(text) > 2:
            for at in range(0, len(text) - 2, _GROUP):  # a long text in pieces
                part = text[at:at + _GROUP + 2].astype(np.uint32)
                code = (part[:-2] * np.uint32(65_599) + part[1:-1]) * np.uint32(65_599) + part[2:]
                code = (code * np.uint32(2_654_435_761)) >> np.uint32(16)
                out[i, WORDS:WORDS + BYTES] += np.bincount(code % BYTES, minlength=BYTES)
    return out


def _document_frequencies(batches):
    """mapInArrow: in how many texts of the partition each bucket occurs."""
    df, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        raw, ends = utf8_parts(batch.column(0))
        for a, b in text_groups(ends, _GROUP, _ROWS):
            df += (term_matrix(raw, ends[a:b + 1]) > 0).sum(axis=0)
        n += len(ends) - 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(BUCKETS + 1), pa.int32()), pa.array([*df.tolist(), n], pa.int64())], names=["bucket", "df"])


@dataclass
class Model:
    idf: np.ndarray      # (BUCKETS,)
    space: np.ndarray    # (BUCKETS, dimensions)
    vectors: np.ndarray  # (examples, dimensions), length 1
    labels: np.ndarray
    weights: np.ndarray
    prior: float


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of (1 + ln tf) * idf , with words, byte sequences and style
    terms each of length 1."""
    out = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    for block in _BLOCKS:
        out[:, block] /= np.maximum(np.sqrt((out[:, block] ** 2).sum(axis=1, keepdims=True)), 1e-9)
    return out


def folded(counts: np.ndarray, idf: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Latent vectors of length 1 (0 for a text without terms)."""
    out = weighted(counts, idf) @ space
    return out / np.maximum(np.sqrt((out ** 2).sum(axis=1, keepdims=True)), 1e-9)


def latent_space(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration."""
    k = min(dimensions, *matrix.shape)
    basis = np.random.Generator(np.random.PCG64(11)).normal(size=(matrix.shape[1], k)).astype(np.float32)
    for _ in range(8):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    return basis.astype(np.float32)


def vote(vectors: np.ndarray, model: Model, k: int = NEIGHBOURS) -> np.ndarray:
    """Scores of a block of latent vectors."""
    if len(model.vectors) == 0:
        return np.full(len(vectors), model.prior)
    cosine = vectors @ model.vectors.T
    k = min(k, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(float) ** SHARPNESS * model.weights[near]
    total = weight.sum(axis=1)
    return np.where(total > 1e-12, (weight * model.labels[near]).sum(axis=1) / np.maximum(total, 1e-12), model.prior)


def fit(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", doc_id: str = "doc_id",
        label: str = "quality", examples: int = EXAMPLES, fitted: int = FITTED) -> Model:
    """Learn from the rows of ``labels`` where ``train`` holds (a condition on
    the id column of ``labels``): at most about ``examples`` rows of each
    class, drawn by a hash of the id."""
    texts = docs.select(docs[doc_id].alias("id"), text_column(docs, text).alias("text"))
    counts = {r["bucket"]: r["df"] for r in texts.select("text").mapInArrow(_document_frequencies, "bucket int, df long")
              .groupBy("bucket").agg(F.sum("df").alias("df")).collect()}  # BUCKETS + 1 rows
    total = counts.get(BUCKETS, 0)
    idf = (np.log((1 + total) / (1 + np.array([counts.get(b, 0) for b in range(BUCKETS)]))) + 1e-3).astype(np.float32)

    known = (labels.filter(train & labels[label].isNotNull() & labels[doc_id].isNotNull())
             .groupBy(labels[doc_id].alias("id")).agg(F.max((labels[label] > 0).cast("int")).alias("label")))
    known = stored(known, "labels")
    size = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(1_000_000)) / 1e6
    rate = {k: min(1.0, examples / max(1, size.get(k, 0))) for k in (0, 1)}
    drawn = known.filter(draw < F.when(F.col("label") == 1, rate[1]).otherwise(rate[0]))
    sample = stored(texts.join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
                    .withColumn("turn", F.xxhash64("id", F.lit("turn"))), "sample")

    @F.arrow_udf("array<float>")
    def tally(column: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(column)
        found = term_matrix(raw, ends)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * BUCKETS),
                                        pa.array(found.ravel(), pa.float32()))

    # `fitted` rows of BUCKETS numbers: 32 MB whatever the corpus
    first = sample.orderBy("turn", "id").limit(fitted).select(tally("text").alias("v")).toArrow()
    matrix = first.column("v").combine_chunks().flatten().to_numpy().reshape(-1, BUCKETS) if first.num_rows else \
        np.zeros((1, BUCKETS), np.float32)
    space = latent_space(weighted(matrix, idf), DIMENSIONS)

    @F.arrow_udf("array<float>")
    def fold(column: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(column)
        found = [folded(term_matrix(raw, ends[a:b + 1]), idf, space) for a, b in text_groups(ends, _GROUP, _ROWS)]
        flat = np.concatenate(found) if found else np.zeros((0, space.shape[1]), np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * space.shape[1]),
                                        pa.array(flat.ravel(), pa.float32()))

    rows = sample.select("id", "label", fold("text").alias("v")).orderBy("id").collect()  # 2 * examples small rows
    rows = [r for r in rows if any(r["v"])]
    got = {k: sum(r["label"] == k for r in rows) for k in (0, 1)}
    share = {k: size.get(k, 0) / max(1, got[k]) for k in (0, 1)}
    n = sum(size.values())
    return Model(idf, space, np.array([r["v"] for r in rows], np.float32).reshape(-1, space.shape[1]),
                 np.array([r["label"] for r in rows], float),
                 np.array([share[r["label"]] for r in rows], float), size.get(1, 0) / n if n else 0.5)


def scored(text: Column, model: Model) -> Column:
    """The score of each text."""
    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        raw, ends = utf8_parts(column)
        out = [np.zeros(0)]
        for a, b in text_groups(ends, _GROUP, _ROWS):
            out.append(vote(folded(term_matrix(raw, ends[a:b + 1]), model.idf, model.space), model))
        return pa.array(np.concatenate(out), pa.float64())

    return run(text)
