"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

The model is a bounded set of labelled examples. Its terms are words and
word edges (beginnings and ends of four to eight letters) that the examples'
labels depend on (chi-square, over class shares as they are among all labelled
rows). An example counts for them by how much of it is its own (``own_shares``),
so a term cannot come from one copied text or passage. Near copies (five-word
shingles, 0.8, found by MinHash bands and confirmed on the full sets) stand in the
index once; texts that only have a passage in common are examples of their own. Inverse document frequencies are counted over
all documents, whose terms are written once and read for the scores. Examples
lie in an inverted index
whose postings are cut into blocks of examples, each with its greatest
weight: for a query, blocks are visited by their score bound and the search
ends when no bound reaches the k-th best score, so the k nearest are exact.

A score is the share of toxic neighbours, weighted by squared cosine and by
how many labelled rows an example stands for, with the rate among labelled
texts without any term as prior. A text without terms gets that prior. The
neighbours' ids and the terms found are the evidence.

Defined results: null text counts as empty. Labels that are null are not
used; a repeated or contradictory label counts as its maximum. Without
labelled rows every score is 0. Repeated rows score alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart.llm import minhash
from signalmart.llm.common import stored, text_column

#: Bounds of the model: labelled rows per class, terms.
EXAMPLES, TERMS = 12_000, 3_000
#: Least chi-square of a term, and least number of examples that have it.
CHI_SQUARE, LEAST_DF = 30.0, 4
#: Of the examples with a term, at least this share has one label.
PURITY = 0.8
NEIGHBOURS, PRIOR_WEIGHT, BLOCK = 15, 0.25, 64
#: Similarity from which examples are copies of each other.
COPY_PERCENT = 80
EDGES = (4, 5, 6, 7, 8)
_WORD = re.compile(r"[^\W\d_]+")
_MEMO, _LONG = 100_000, 1 << 20
#: Different terms that a task counts at a time.
_TERMS = 100_000

SCORE = "struct<score: double, neighbours: array<bigint>, terms: array<string>>"


def word_terms(word: str) -> list[str]:
    """A word and its edges; "x*" begins with x, "*x" ends with it."""
    out = [word]
    for n in EDGES:
        if len(word) > n:
            out += [word[:n] + "*", "*" + word[-n:]]
    return out


def copy_groups(signatures: np.ndarray, labels: np.ndarray, confirm, bands: int = minhash.BANDS,
                rows: int = minhash.ROWS) -> np.ndarray:
    """A group number for each example: near copies of one label share it.
    Each bucket of a band links its examples to its first one; ``confirm`` says
    which of the links (rows of u and v) hold on the full sets."""
    links = [np.zeros((0, 2), np.int64)]
    for b in range(bands):
        part = np.concatenate([labels[:, None], signatures[:, b * rows:(b + 1) * rows]], axis=1)
        _, first, name = np.unique(part, axis=0, return_index=True, return_inverse=True)
        hub = first[name.ravel()]
        who = np.flatnonzero(hub != np.arange(len(hub)))
        links.append(np.stack([hub[who], who], axis=1))
    group = list(range(len(labels)))

    def root(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    held = np.array(confirm(np.unique(np.concatenate(links), axis=0)), np.int64)
    for u, v in held.reshape(-1, 2).tolist():
        a, b = sorted((root(u), root(v)))
        group[b] = a
    return np.array([root(x) for x in range(len(labels))], np.int64)


def own_shares(signatures: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How much of each example is its own among those of its label: a minimum
    that it shares with n others counts 1 / (n + 1), on average over all. Copies
    share a weight of one; a text that has a passage in common with others loses
    that part of its weight and no more."""
    out = np.zeros(len(labels))
    for column in signatures.T:
        _, name, count = np.unique(np.stack([labels, column]), axis=1, return_inverse=True, return_counts=True)
        out += 1 / count[name.ravel()]
    return out / max(1, signatures.shape[1])


def _count_terms(batches):
    """mapInArrow: how much of each class holds each term, within the
    partition, by the examples' weights."""
    counts: dict[str, list[float]] = {}

    def found() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.float64()),
             pa.array([c[1] for c in counts.values()], pa.float64())], names=["term", "clean", "toxic"])

    for batch in batches:
        for text, label, weight in zip(*(c.to_pylist() for c in batch.columns)):
            for term in {t for w in set(_WORD.findall(text.lower())) for t in word_terms(w)}:
                counts.setdefault(term, [0.0, 0.0])[label] += weight
            if len(counts) > _TERMS:  # the rest of the sum is made behind the shuffle
                yield found()
                counts.clear()
    yield found()


@dataclass
class Model:
    """Terms with their inverse document frequency, the examples' ids, labels
    and weights, and the block-max inverted index over their unit vectors."""
    terms: list[str]
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    prior: float
    start: np.ndarray   # (terms, blocks + 1): where a block's postings begin
    posting: np.ndarray  # example numbers, ordered by term, then example
    value: np.ndarray
    peak: np.ndarray    # (terms, blocks): greatest value of each block

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS):
        """The k examples of greatest cosine above 0 (equal ones: the lower
        number first), exactly, and their cosines."""
        if len(term) == 0 or len(self.ids) == 0:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weight @ self.peak[term]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        who, score, least = np.zeros(0, np.int64), np.zeros(0), -1.0
        at, step = 0, 4
        while at < len(order) and bound[order[at]] >= least - 1e-9:
            blocks = order[at:at + step]
            # the postings of all terms in these blocks, one range after another
            first = self.start[term][:, blocks]
            size = self.start[term][:, blocks + 1] - first
            ends = np.cumsum(size.ravel())
            place = np.arange(ends[-1]) + np.repeat(first.ravel() - (ends - size.ravel()), size.ravel())
            by_term = np.repeat(weight, size.sum(axis=1))
            column = np.repeat(np.tile(np.arange(len(blocks)), len(term)), size.ravel())
            slot = column * BLOCK + self.posting[place] % BLOCK
            found = np.bincount(slot, by_term * self.value[place], len(blocks) * BLOCK).reshape(-1, BLOCK)
            row, col = np.nonzero(found)
            who = np.concatenate([who, blocks[row] * BLOCK + col])
            score = np.concatenate([score, found[row, col]])
            if len(who) > k:
                top = np.lexsort((who, -np.round(score, 9)))[:k]
                who, score = who[top], score[top]
            if len(who) == k:
                least = score.min()
            at, step = at + step, min(2 * step, 64)
        top = np.lexsort((who, -np.round(score, 9)))
        return who[top], score[top]

    def score(self, who: np.ndarray, cosine: np.ndarray) -> float:
        w = cosine ** 2 * self.weights[who]
        return float((w @ self.labels[who] + PRIOR_WEIGHT * self.prior) / (w.sum() + PRIOR_WEIGHT))


def unit_vector(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted term numbers and weights (1 + ln tf) * idf of length 1."""
    term = np.array(sorted(counts), np.int64)
    if len(term) == 0:
        return term, np.zeros(0)
    weight = (1 + np.log([counts[t] for t in term])) * idf[term]
    return term, weight / np.sqrt(weight @ weight)


def build(terms, idf, ids, labels, weights, prior, vectors) -> Model:
    """Index the examples. They are ordered by their strongest term, so that
    similar ones share blocks."""
    order = sorted(range(len(ids)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), ids[i]))
    blocks = -(-len(order) // BLOCK)
    t = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0, np.int64)]).astype(np.int64)
    v = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)])
    e = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order]) if order else np.zeros(0, np.int64)
    by = np.lexsort((e, t))
    t, v, e = t[by], v[by], e[by]
    cell = t * blocks + e // BLOCK
    start = np.searchsorted(cell, np.arange(len(terms) * blocks + 1)).astype(np.int64)
    peak = np.zeros(len(terms) * blocks)
    np.maximum.at(peak, cell, v)
    edges = np.stack([start[k:k + len(terms) * blocks:max(blocks, 1)] for k in range(blocks + 1)], axis=1) \
        if blocks and len(terms) else np.zeros((len(terms), 1), np.int64)
    return Model(terms, idf, np.array([ids[i] for i in order], np.int64), np.array([labels[i] for i in order], float),
                 np.array([weights[i] for i in order], float), prior, edges, e, v,
                 peak.reshape(len(terms), blocks))


class TermCounter:
    """How often each model term occurs in a text."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        # most words have neither a first nor a last part that any term has
        short = min(EDGES)
        self.whole = {t for t in terms if "*" not in t}
        self.heads = {t[:short] for t in terms if t.endswith("*")}
        self.tails = {t[-short:] for t in terms if t.startswith("*")}
        self.short = short
        self.memo: dict[str, tuple[int, ...]] = {}

    def _terms(self, word: str) -> tuple[int, ...]:
        if len(self.memo) >= _MEMO:
            self.memo.clear()
        found = self.memo[word] = tuple(self.number[t] for t in word_terms(word) if t in self.number)
        return found

    def __call__(self, text: str) -> dict[int, int]:
        out: dict[int, int] = {}
        text = text.lower()
        # a very long text's words are not held together
        words = _WORD.findall(text) if len(text) <= _LONG else (m.group() for m in _WORD.finditer(text))
        short, whole, heads, tails = self.short, self.whole, self.heads, self.tails
        for word in words:
            if word[:short] in heads or word[-short:] in tails or word in whole:
                found = self.memo.get(word)
                for t in self._terms(word) if found is None else found:
                    out[t] = out.get(t, 0) + 1
        return out


TALLY = "struct<term: array<int>, n: array<int>>"


def tallied(text: Column, terms: list[str]) -> Column:
    """The model terms of each text (their numbers) and how often they occur."""
    counter = TermCounter(terms)

    @F.arrow_udf(TALLY)
    def run(column: pa.Array) -> pa.Array:
        found = [counter(column[i].as_py() or "") for i in range(len(column))]  # one text at a time as Python text
        return pa.StructArray.from_arrays([pa.array([list(f) for f in found], pa.list_(pa.int32())),
                                           pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                                          names=["term", "n"])

    return run(text)


def _columns(df: DataFrame) -> list[pa.Array]:
    """The columns of a bounded result as Arrow arrays: no object for each
    number on the driver."""
    table = df.toArrow()
    return [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in table.columns]


def _confirmer(sample: DataFrame, ids: np.ndarray, percent: int):
    """Which links between examples hold on the full shingle sets."""
    def confirm(links: np.ndarray) -> np.ndarray:
        if not len(links):
            return links
        spark = sample.sparkSession
        place = spark.createDataFrame(pa.table({"k": np.arange(len(ids)), "id": ids}), "k long, id long")
        texts = stored(sample.join(F.broadcast(place), "id").select("k", "text"), "examples-by-place")
        pairs = spark.createDataFrame(pa.table({"u": links[:, 0], "v": links[:, 1]}), "u long, v long")
        both = (pairs.join(texts.select(F.col("k").alias("u"), F.col("text").alias("tu")), "u")
                .join(texts.select(F.col("k").alias("v"), F.col("text").alias("tv")), "v"))
        held = both.filter(minhash.exact_link(F.col("tu"), F.col("tv"), percent)).select("u", "v")
        return np.stack([c.to_numpy() for c in _columns(held)], axis=1)
    return confirm


def fit(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", doc_id: str = "doc_id",
        label: str = "toxic", examples: int = EXAMPLES, terms: int = TERMS,
        carry: list[str] | None = None) -> tuple[Model, DataFrame]:
    """Learn from the rows of ``labels`` where ``train`` holds (a condition on
    the id column of ``labels``): at most about ``examples`` rows of each
    class, drawn by a hash of the id. Returns the model and the documents that
    it counted its terms in: struct ``row`` of the columns ``carry`` (all) and
    ``tally``, for ``scored_tally``."""
    known = (labels.filter(train & labels[label].isNotNull() & labels[doc_id].isNotNull())
             .groupBy(labels[doc_id].cast("long").alias("id")).agg(F.max((labels[label] > 0).cast("int")).alias("label")))
    known = stored(known, "labels")
    size = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    rate = {k: min(1.0, examples / max(1, size.get(k, 0))) for k in (0, 1)}
    draw = F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(1_000_000)) / 1e6
    drawn = known.filter(draw < F.when(F.col("label") == 1, rate[1]).otherwise(rate[0]))
    texts = docs.select(docs[doc_id].cast("long").alias("id"), text_column(docs, text).alias("text"))
    sample = stored(texts.join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text")), "examples")

    # bounded: at most about 2 * examples signatures of half a kilobyte
    width = minhash.BANDS * minhash.ROWS
    ids, kinds, found = _columns(sample.select("id", "label", minhash.sketch(F.col("text"), width)["signature"].alias("s"))
                                 .orderBy("id"))
    ids, kinds = ids.to_numpy(), kinds.to_numpy().astype(np.int64)
    signs = np.zeros((len(ids), width), np.int32)  # texts without words (no signature) are one group
    signs[found.value_lengths().fill_null(0).to_numpy() > 0] = found.flatten().to_numpy().reshape(-1, width)
    group = copy_groups(signs, kinds, _confirmer(sample, ids, COPY_PERCENT)) if len(ids) else np.zeros(0, np.int64)
    stand = group == np.arange(len(ids))
    weight = own_shares(signs, kinds)
    placed = sample.sparkSession.createDataFrame(
        pa.table({"id": ids, "weight": weight, "stands": stand}), "id long, weight double, stands boolean")
    weighted = stored(sample.join(F.broadcast(placed), "id"), "weighted")

    # class shares as among all labelled rows, the sum as in the sample
    n = {k: float(weight[kinds == k].sum()) for k in (0, 1)}
    total = n[0] + n[1]
    share = {k: size.get(k, 0) / n[k] if n[k] else 0.0 for k in (0, 1)}
    scale = total / max(1, sum(size.values()))
    clean, toxic = (n[k] * share[k] * scale for k in (0, 1))
    counts = weighted.select("id", "text", "label", "weight").repartition("id").drop("id").mapInArrow(
        _count_terms, "term string, clean double, toxic double").groupBy("term").agg(
        F.sum("clean").alias("c0"), F.sum("toxic").alias("t0")).select(
        "term", (F.col("c0") + F.col("t0")).alias("seen"),
        (F.col("c0") * (share[0] * scale)).alias("c"), (F.col("t0") * (share[1] * scale)).alias("t"))
    cross = F.col("t") * (clean - F.col("c")) - F.col("c") * (toxic - F.col("t"))
    df = F.col("t") + F.col("c")
    chi = total * F.pow(cross, 2) / (df * (total - df) * float(max(1.0, clean) * max(1.0, toxic)))
    pure = (F.col("t") >= PURITY * df) | (F.col("c") >= PURITY * df) & (F.col("c") * toxic > F.col("t") * clean)
    # sums of parts of one, in whatever order: compared with some room, ordered by a rounded value
    picked = (counts.filter((F.col("seen") >= LEAST_DF - 1e-6) & (df < total - 1e-6) & pure)
              .withColumn("chi", F.round(chi, 6)).filter(F.col("chi") >= CHI_SQUARE)
              .orderBy(F.desc("chi"), "term").limit(terms).select("term").collect())
    names = [r["term"] for r in picked]

    # the terms of every document, written once: for the frequencies and the scores
    rows_of = docs.select(F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"),
                          tallied(text_column(docs, text), names).alias("tally"))
    counted = stored(rows_of, "tallies")
    seen = {r["term"]: r["df"] for r in counted.select(F.explode("tally.term").alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("df")).collect()}  # at most `terms` rows
    idf = np.log((1 + counted.count()) / (1 + np.array([seen.get(k, 0) for k in range(len(names))], float))) + 1

    # bounded: at most 2 * examples rows of a few numbers each
    rows = weighted.filter("stands").select("id", "label", tallied(F.col("text"), names).alias("v")).orderBy("id").collect()
    unit = share[1] or 1.0
    empty = [r["label"] for r in rows if not r["v"]["term"]]
    bare = {k: empty.count(k) * share[k] for k in (0, 1)}
    prior = bare[1] / (bare[0] + bare[1] + 1)
    rows = [r for r in rows if r["v"]["term"]]
    vectors = [unit_vector(dict(zip(r["v"]["term"], r["v"]["n"])), idf) for r in rows]
    model = build(names, idf, [r["id"] for r in rows], [r["label"] for r in rows],
                  [share[r["label"]] / unit for r in rows], prior, vectors)
    return model, counted


def _scorer(model: Model):
    """A function from a text's counts to score, neighbours' ids and terms."""
    known: dict[tuple, tuple] = {}

    def run(counts: dict[int, int]) -> tuple[float, list, list]:
        if not counts:
            return model.prior, [], []
        key = tuple(sorted(counts.items()))
        if key not in known:
            if len(known) >= _MEMO:
                known.clear()
            who, cosine = model.nearest(*unit_vector(counts, model.idf))
            known[key] = model.score(who, cosine), model.ids[who].tolist()
        return *known[key], [model.terms[t] for t in sorted(counts)]

    return run


def _scores(found: list[tuple]) -> pa.StructArray:
    score, near, terms = ([f[k] for f in found] for k in range(3))
    return pa.StructArray.from_arrays(
        [pa.array(score, pa.float64()), pa.array(near, pa.list_(pa.int64())),
         pa.array(terms, pa.list_(pa.string()))], names=["score", "neighbours", "terms"])


def scored_tally(tally: Column, model: Model) -> Column:
    """score, neighbours' ids and terms found, from the terms of each text."""
    @F.arrow_udf(SCORE)
    def run(terms: pa.Array, counts: pa.Array) -> pa.Array:
        score = _scorer(model)
        return _scores([score(dict(zip(t or [], n or []))) for t, n in zip(terms.to_pylist(), counts.to_pylist())])

    return run(tally["term"], tally["n"])


def scored(text: Column, model: Model) -> Column:
    """score, neighbours' ids and terms found, for each text (of documents the
    model did not count)."""
    counter = TermCounter(model.terms)

    @F.arrow_udf(SCORE)
    def run(column: pa.Array) -> pa.Array:
        score = _scorer(model)
        return _scores([score(counter(column[i].as_py() or "")) for i in range(len(column))])

    return run(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, train: Column, limit: float = 0.5, **columns) -> DataFrame:
    """The documents that score below ``limit``, with the input's columns, by a
    model that is fitted on them (see ``fit``)."""
    model, counted = fit(docs, labels, train, **columns)
    return counted.filter(scored_tally(F.col("tally"), model)["score"] < limit).select("row.*")
