"""Quality and toxicity: exact neighbours, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalmart.llm import quality, queries, toxicity
from signalmart.llm.common import remainder, text_column
from tests.conftest import SF_ORACLE
from tests.llm.fixtures import docs, odd, prose


def test_block_max_search_finds_the_exact_neighbours():
    r = np.random.default_rng(5)
    terms, examples = 40, 700
    idf = r.uniform(1, 4, terms)
    vectors = [toxicity.unit_vector({int(t): int(n) for t, n in zip(r.choice(terms, r.integers(1, 6), replace=False), r.integers(1, 5, 6))}, idf)
               for _ in range(examples)]
    labels = r.integers(0, 2, examples)
    model = toxicity.build([str(t) for t in range(terms)], idf, list(range(examples)), labels, np.ones(examples), 0.1, vectors)
    dense = np.zeros((examples, terms))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for _ in range(60):
        t, w = toxicity.unit_vector({int(x): 1 for x in r.choice(terms, 3, replace=False)}, idf)
        who, cosine = model.nearest(t, w, 10)
        exact = np.sort(dense[:, t] @ w)[::-1][:10]
        assert np.allclose(cosine, exact[exact > 0][:len(cosine)]) and len(cosine) == min(10, (exact > 0).sum())
        assert np.allclose(dense[model.ids[who]][:, t] @ w, cosine)


@pytest.mark.parametrize("name,label,least", [("op2_quality", "quality", 0.95), ("op8_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    labels = queries.table(spark, SF_ORACLE, "labels")
    scored = queries.QUERIES[name](spark, SF_ORACLE)
    assert scored.count() == queries.table(spark, SF_ORACLE, "documents").count()
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL OR predicted <> CAST(score >= 0.5 AS INT)").count() == 0
    right = scored.filter("held_out").join(labels, "doc_id").select(F.avg((F.col("predicted") == F.col(label)).cast("int")))
    assert right.first()[0] >= least


def test_toxic_words_count_and_copies_do_not(spark):
    clean = [" ".join(prose(k, 60)) for k in range(60)]
    insults = ["scumbucket", "dirtface", "wormbrain"]
    toxic = [" ".join(prose(900 + k, 40) + [insults[k % 3], insults[(k + 1) % 3]]) for k in range(30)]
    copied = " ".join(prose(5000, 60))          # one text, labelled toxic twenty times over
    rows_ = clean + toxic + [copied + f" tail{k}" for k in range(20)]
    df = docs(spark, list(enumerate(rows_)))
    labels = spark.createDataFrame([(i, 0 if i < 60 else 1) for i in range(len(rows_))] + [(3, None), (None, 1), (0, 0)],
                                   "doc_id long, toxic int")
    model, _ = toxicity.fit(df, labels, F.lit(True))
    assert {"scumbucket", "scumb*"} <= set(model.terms)
    assert not set(copied.split()) & set(model.terms)
    new = docs(spark, [(1, "such a SCUMBUCKET he is"), (2, " ".join(prose(77, 50))), (3, None), (4, "")])
    got = {r.doc_id: r.s for r in new.select("doc_id", toxicity.scored(text_column(new, "text"), model).alias("s")).collect()}
    assert got[1].score > 0.5 and "scumbucket" in got[1].terms and set(got[1].neighbours) <= set(range(60, 90))
    assert max(got[k].score for k in (2, 3, 4)) < 0.5


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_rows_and_empty_tables(spark, module, label):
    df = odd(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 10)] + [(None, 1), (2, None)], f"doc_id long, {label} int")
    for known in (labels, labels.limit(0)):
        model = module.fit(df, known, remainder(known["doc_id"], 5) != 0)
        if module is toxicity:
            model, counted = model
            own = counted.select(toxicity.scored_tally(F.col("tally"), model)["score"].alias("s"))
            assert counted.count() == df.count() and own.filter("s < 0 OR s > 1 OR s IS NULL").count() == 0
        score = module.scored(text_column(df, "text"), model)
        value = score["score"] if module is toxicity else score
        got = df.select("doc_id", value.alias("s")).collect()
        assert len(got) == df.count() and all(0 <= r.s <= 1 for r in got)
    empty = module.fit(df.limit(0), labels, F.lit(True))
    empty = empty[0] if module is toxicity else empty
    assert df.limit(0).select(module.scored(text_column(df, "text"), empty)).count() == 0
    if module is toxicity:
        kept = toxicity.drop_toxic(df, labels.limit(0), F.lit(True))
        assert kept.columns == df.columns and kept.count() == df.count()


def test_fit_is_bounded_and_uses_only_the_rows_it_may(spark):
    texts = [" ".join(prose(k, 20)) + (" fine" if k % 2 else " BAD!! BAD!!") for k in range(120)]
    df = docs(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    model = quality.fit(df, labels, labels["doc_id"] < 60, examples=10, fitted=8)
    assert 4 <= len(model.vectors) <= 40 and model.space.shape[1] <= 8
    full = quality.fit(df, labels, labels["doc_id"] < 60)
    assert len(full.vectors) == 60


def toxic_corpus():
    """Clean and toxic texts, near copies among them, a passage that many have
    in common, and rows without a label."""
    insults = ["scumbucket", "dirtface", "wormbrain", "slimehead"]
    passage = " ".join(prose(4242, 45))
    texts = [" ".join(prose(k, 30 + k % 40)) for k in range(90)]
    texts += [" ".join(prose(900 + k, 20 + k % 30) + [insults[k % 4], insults[(k + 1) % 4]] * (1 + k % 3)) for k in range(40)]
    texts += [passage + " " + " ".join(prose(2000 + k, 60)) + (" dirtface wormbrain" if k % 2 else "") for k in range(16)]
    near = " ".join(prose(5000, 80) + ["wormbrain"])
    texts += [near + f" tail{k}" for k in range(12)]
    labels = [0] * 90 + [1] * 40 + [k % 2 for k in range(16)] + [1] * 12
    return texts, labels


def test_examples_with_a_common_passage_all_stay():
    texts, labels = toxic_corpus()
    import pyarrow as pa
    from signalmart.llm import minhash
    from signalmart.llm.common import utf8_parts
    from signalmart.llm.shingles import overlap_counts, shingle_set
    raw, ends = utf8_parts(pa.array(texts))
    sets = [shingle_set(raw[ends[k]:ends[k + 1]]) for k in range(len(texts))]
    mult, add = minhash.hash_family(125)
    signs = np.array([minhash.minima(s, mult, add) for s in sets], np.int64)

    def confirm(links):
        return [(u, v) for u, v in links if 100 * overlap_counts(sets[u], sets[v])[0] >= 80 * overlap_counts(sets[u], sets[v])[1]]

    group = toxicity.copy_groups(signs, np.array(labels), confirm)
    assert (group[:146] == np.arange(146)).all()            # half a text in common: an example of its own
    assert len(set(group[146:])) == 1                       # one word apart: copies


def test_signatures_reach_the_driver_as_arrays(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    texts, labels = toxic_corpus()
    df = docs(spark, list(enumerate(texts + ["", None])))
    known = spark.createDataFrame(list(enumerate([*labels, 0, 1])), "doc_id long, toxic int")
    collected, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(self.dtypes) or collect(self))
    toxicity.fit(df, known, F.lit(True))
    assert collected and not [d for d in collected if "array<int>" in dict(d).values()]


def test_a_scored_document_by_brute_force(spark):
    """Selection of terms, corpus frequencies, vectors, all cosines and the
    vote, in plain Python from the definitions."""
    texts, labels = toxic_corpus()
    more = ["no such word", "you DIRTFACE and slimehead", "wormbrain " * 5 + "scumbucket", "", None]
    df = docs(spark, list(enumerate(texts + more)))
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    model, counted = toxicity.fit(df, known, F.lit(True))
    import pyarrow as pa
    from signalmart.llm import minhash
    from signalmart.llm.common import utf8_parts
    from signalmart.llm.shingles import shingle_set
    group = [k if k < 146 else 146 for k in range(len(texts))]
    raw, ends = utf8_parts(pa.array(texts))
    mult, add = minhash.hash_family(125)
    signs = [minhash.minima(shingle_set(raw[ends[k]:ends[k + 1]]), mult, add).tolist() for k in range(len(texts))]
    weight = [np.mean([1 / sum(labels[j] == labels[k] and signs[j][b] == signs[k][b] for j in range(len(texts)))
                       for b in range(125)]) for k in range(len(texts))]
    assert weight[0] == 1 and weight[150] < 0.15 and 0.5 < weight[135] < 0.9
    terms_of = [{t for w in set(toxicity._WORD.findall((t_ or "").lower())) for t in toxicity.word_terms(w)}
                for t_ in texts + more]
    size = {c: labels.count(c) for c in (0, 1)}
    n = {c: sum(w for w, l in zip(weight, labels) if l == c) for c in (0, 1)}
    share = {c: size[c] / n[c] for c in (0, 1)}
    total = n[0] + n[1]
    scale = total / len(labels)
    whole = {c: n[c] * share[c] * scale for c in (0, 1)}
    chosen = []
    for term in set().union(*terms_of[:len(texts)]):
        part = [sum(w for w, l, t in zip(weight, labels, terms_of) if l == c and term in t) for c in (0, 1)]
        c, t = (part[k] * share[k] * scale for k in (0, 1))
        if sum(part) < 4 - 1e-6 or c + t >= total - 1e-6:
            continue
        if not (t >= 0.8 * (c + t) or (c >= 0.8 * (c + t) and c * whole[1] > t * whole[0])):
            continue
        chi = total * (t * (whole[0] - c) - c * (whole[1] - t)) ** 2 / ((c + t) * (total - c - t) * whole[0] * whole[1])
        if chi >= 30:
            chosen.append((-round(chi, 6), term))
    names = [t for _, t in sorted(chosen)]
    assert sorted(names) == sorted(model.terms) and len(names) > 5
    names = model.terms

    def count(text):
        found = {}
        for w in toxicity._WORD.findall((text or "").lower()):
            for t in toxicity.word_terms(w):
                if t in names:
                    found[t] = found.get(t, 0) + 1
        return found

    every = [count(t) for t in texts + more]
    idf = {t: np.log((1 + len(every)) / (1 + sum(t in e for e in every))) + 1 for t in names}

    def unit(found):
        v = np.array([(1 + np.log(found[t])) * idf[t] if t in found else 0.0 for t in names])
        return v / (np.sqrt(v @ v) or 1)

    stands = [k for k in range(len(texts)) if group[k] == k]
    empty = [labels[k] for k in stands if not every[k]]
    bare = {c: empty.count(c) * share[c] for c in (0, 1)}
    prior = bare[1] / (bare[0] + bare[1] + 1)
    examples = [k for k in stands if every[k]]
    vectors = np.array([unit(every[k]) for k in examples])
    got = {r.id: r.s for r in counted.select("row.doc_id", toxicity.scored_tally(F.col("tally"), model).alias("s")).toDF("id", "s").collect()}
    for k, found in enumerate(every):
        if not found:
            assert got[k].score == pytest.approx(prior) and got[k].neighbours == []
            continue
        cosine = vectors @ unit(found)
        kth = np.sort(cosine)[::-1][:15][-1]
        near = [cosine[examples.index(i)] for i in got[k].neighbours]
        assert len(near) == min(15, (cosine > 0).sum()) and min(near) >= kth - 1e-9
        w = [c ** 2 * share[labels[i]] / share[1] for c, i in zip(near, got[k].neighbours)]
        toxic = sum(x for x, i in zip(w, got[k].neighbours) if labels[i])
        assert got[k].score == pytest.approx((toxic + 0.25 * prior) / (sum(w) + 0.25))
    assert got[len(texts) + 1].score > 0.5 and got[len(texts)].score < 0.5


def test_scores_are_calibrated(spark):
    """Held-out bins of the score follow their share of toxic rows."""
    labels = queries.table(spark, SF_ORACLE, "labels")
    rows_ = (queries.QUERIES["op8_toxicity"](spark, SF_ORACLE).filter("held_out").join(labels, "doc_id")
             .select("score", "toxic").collect())
    for low, high in ((0.0, 0.2), (0.8, 1.0)):
        inside = [r for r in rows_ if low <= r.score <= high]
        assert inside and abs(np.mean([r.score for r in inside]) - np.mean([r.toxic for r in inside])) < 0.12


def test_quality_by_brute_force(spark):
    """Document frequencies, TF-IDF, the latent space, all cosines and the
    vote, in plain numpy over dense matrices."""
    texts = [" ".join(prose(k, 30 + k % 25)) + (" fine words." if k % 2 else " BAD!! BAD!! $$ $$ $$") for k in range(90)]
    more = ["", None, "x", "BAD!! $$ $$", "calm words and fine words"]
    df = docs(spark, list(enumerate(texts + more)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, quality int")
    model = quality.fit(df, labels, labels["doc_id"] < 60)

    def counts(text):
        """Counts of a text's terms, by their definitions."""
        from signalmart.llm.shingles import word_hashes
        raw = (text or "").encode()
        out = np.zeros(quality.BUCKETS)
        if not raw:
            return out
        words = word_hashes(np.frombuffer(raw, np.uint8))
        for w in words.tolist():
            out[(w >> 40) % quality.WORDS] += 1
        for k in range(len(raw) - 2):
            code = ((raw[k] * 65_599 + raw[k + 1]) * 65_599 + raw[k + 2]) % 2 ** 32 * 2_654_435_761 % 2 ** 32 >> 16
            out[quality.WORDS + code % quality.BYTES] += 1
        n = max(1, len(words))
        letters = [sum(97 <= c <= 122 for c in raw), sum(65 <= c <= 90 for c in raw)]
        white, signs = sum(c in b" \t\n\x0b\x0c\r" for c in raw), sum(33 <= c < 127 and not chr(c).isalnum() for c in raw)
        repeats = sum(a == b for a, b in zip(words.tolist(), words.tolist()[1:]))
        shares = [repeats / n, len(set(words.tolist())) / n, letters[1] / max(1, sum(letters)), white / len(raw), signs / len(raw)]
        for k, x in enumerate(shares):
            out[quality.WORDS + quality.BYTES + 11 * k + int(10 * np.sqrt(x))] = 1
        return out

    every = np.array([counts(t) for t in texts + more])
    idf = np.log((1 + len(every)) / (1 + (every > 0).sum(axis=0))) + 1e-3
    assert np.allclose(model.idf, idf, atol=1e-5)

    def vectors(rows_):
        w = np.where(rows_ > 0, 1 + np.log(np.maximum(rows_, 1)), 0) * idf
        for block in quality._BLOCKS:
            w[:, block] /= np.maximum(np.linalg.norm(w[:, block], axis=1, keepdims=True), 1e-9)
        return w

    # the space holds what a full decomposition of the fitted rows holds
    fitted = vectors(every[:60])
    top = np.linalg.svd(fitted, full_matrices=False)[2][:model.space.shape[1]]
    strong = np.linalg.svd(top[:10] @ model.space)[1]
    assert model.space.shape[1] == min(quality.DIMENSIONS, 60) and (strong > 0.98).all()
    latent = vectors(every) @ model.space
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    known = latent[:60]
    got = {r.doc_id: r.s for r in df.select("doc_id", quality.scored(text_column(df, "text"), model).alias("s")).collect()}
    prior = 0.5
    for k, v in enumerate(latent):
        cosine = known @ v
        near = np.argsort(-cosine)[:quality.NEIGHBOURS]
        w = np.maximum(cosine[near], 0) ** quality.SHARPNESS
        want = (w * (near % 2)).sum() / w.sum() if w.sum() > 1e-12 else prior
        assert got[k] == pytest.approx(want, abs=2e-3), k
    assert got[93] < 0.5 < got[94] and got[90] == got[91] == prior


def test_many_short_texts_are_taken_in_groups_of_rows():
    import pyarrow as pa
    from signalmart.llm.common import text_groups, utf8_parts
    _, ends = utf8_parts(pa.array(["a few short words here"] * 10_000))
    groups = list(text_groups(ends, quality._GROUP, quality._ROWS))
    assert max(b - a for a, b in groups) == quality._ROWS and groups[-1][1] == 10_000
