"""Periodic runs, fill-in-middle and token files against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from signalmart.llm import fill_middle, periodic_runs, queries, token_files
from signalmart.llm.common import text_column, utf8_parts
from tests.conftest import SF_SMALL, rows
from tests.llm.fixtures import docs, odd, prose


# ---- periodic runs ---------------------------------------------------------
def brute_runs(words):
    """Every lag of every word, and of equal stretches the smallest lag."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(6, 4 * q):
                out.setdefault((first - q, i - first + q), q)
            i += 1
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def loopy(r):
    """Few different words, and blocks that repeat up to seven times."""
    kinds = r.choice([1, 2, 2, 3, 5, 40])
    words = [f"w{r.randrange(kinds)}" for _ in range(r.randint(0, 50))]
    for _ in range(r.randint(0, 3)):
        block = [f"w{r.randrange(kinds)}" for _ in range(r.randint(1, 14))]
        words += (block * 8)[:r.randint(0, 7 * len(block))] + [f"w{r.randrange(kinds)}" for _ in range(r.randint(0, 5))]
    return words


def test_runs_match_every_lag():
    r = random.Random(11)
    for _ in range(400):
        texts = [loopy(r) for _ in range(r.randint(1, 4))]
        bounds = np.cumsum([0] + [len(t) for t in texts])
        codes = np.unique([w for t in texts for w in t], return_inverse=True)[1].astype(np.int64)
        got = periodic_runs.online_runs(periodic_runs.occurrences(codes, bounds))
        want = [(a + bounds[k], n, q) for k, t in enumerate(texts) for a, n, q in brute_runs(t)]
        assert got == sorted(want, key=lambda x: (x[0], x[2])), texts


def test_long_texts_of_equal_words_take_no_squared_time():
    for codes in (np.zeros(400_000, np.int64), np.arange(400_000) % 3, np.arange(400_000) % 90_000):
        began = time.time()
        (run,) = periodic_runs.online_runs(periodic_runs.occurrences(codes, np.array([0, len(codes)])))
        assert run == (0, 400_000, int(codes.max()) + 1) and time.time() - began < 30


def test_runs_and_collapsed_texts(spark):
    r = random.Random(4)
    texts = [" ".join(loopy(r)) for _ in range(120)] + ["A a " * 9, "x\ty\nx y\x0bx y x y", "ü ü ü ü ü ü", "a b" * 40]
    df = docs(spark, list(enumerate(texts))).repartition(3)
    found = df.select("doc_id", periodic_runs.runs_of(F.col("text")).alias("f")).select(
        "doc_id", "f.*", periodic_runs.strongest(F.col("f.runs")).alias("best"))
    for row in found.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row.doc_id])
        runs = brute_runs(words)
        assert row.n_words == len(words) and [tuple(x) for x in row.runs] == runs
        gone = {i for a, n, q in runs for i in range(a + q, a + n)}
        assert row.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
        best = sorted(runs, key=lambda x: (-(x[1] * 720720) // x[2], x[0], x[2]))
        assert (tuple(row.best) if row.best else None) == (best[0] if best else None)


def test_small_groups_give_the_same_runs(spark, monkeypatch):
    df = docs(spark, list(enumerate("a b c " * k for k in range(9))))
    want = rows(df.select("doc_id", periodic_runs.runs_of(F.col("text")).alias("f")), "doc_id", "f.runs")
    raw, ends = utf8_parts(pa.array(["a b c " * k for k in range(9)]))
    got = [periodic_runs._group(raw, ends[k:k + 2]).to_pylist()[0] for k in range(9)]
    assert [[(x["start"], x["length"], x["period"]) for x in g["runs"]] for g in got] == \
        [[tuple(x) for x in runs] for _, runs in want]


def test_runs_of_odd_rows(spark):
    df = odd(spark)
    got = df.withColumn("f", periodic_runs.runs_of(text_column(df, "text")))
    assert got.columns[:-1] == df.columns and got.count() == df.count()
    found = {r.doc_id: (r.f.n_words, [tuple(x) for x in r.f.runs], len(r.f.collapsed.split())) for r in got.collect()}
    assert found[6] == found[7] == (60_000, [(0, 60_000, 997)], 997)
    assert found[1] == found[2] == found[3] == (0, [], 0) and found[8] == (1, [], 1)
    empty = df.limit(0)
    assert empty.select(periodic_runs.runs_of(text_column(empty, "text"))).count() == 0


# ---- fill in the middle ----------------------------------------------------
MIXED = ["", "one line", "a\nb\nc\n", "\n", "\n\n", "é\nü漢\n🎉x\nlast", "漢字" * 50 + "\n" + "ß" * 7, "crlf\r\nline\r\n",
         "has <S> in it\n", "<P", "S>\n<\nM>", "\x00\n\x00", "plain ascii\n" * 40, "🎉" * 30]


def brute_cut(i, text, unit, seed=7, rate=100, spm_rate=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "lines" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    spm = h[3] % 100 < spm_rate
    return (n, "spm" if spm else "psm", len(p), len(m),
            f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit", fill_middle.UNITS)
@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (60, 20), (0, 50)])
def test_cuts_match_plain_python(spark, unit, rate, spm_rate):
    r = random.Random(6)
    texts = MIXED + ["".join(r.choice("ab\né漢🎉") for _ in range(r.randint(1, 80))) for _ in range(200)]
    df = docs(spark, list(enumerate(texts))).repartition(3)
    got = df.select("doc_id", fill_middle.rearranged(F.col("text"), F.col("doc_id"), 7, unit, rate, spm_rate).alias("c"))
    back = got.select("doc_id", "c.*", fill_middle.restored(F.col("c.output"), F.col("c.form")).alias("text")).collect()
    for x in back:
        assert tuple(x[1:6]) == brute_cut(x.doc_id, texts[x.doc_id], unit, 7, rate, spm_rate)
        assert x.text == texts[x.doc_id]


def test_the_exception_index_converts_both_ways():
    text = "aé漢🎉b" * 30 + "ascii only"
    raw = np.frombuffer(text.encode(), np.uint8)
    index = fill_middle.ExceptionIndex(raw)
    points = np.arange(len(text) + 1)
    places = np.array([len(text[:k].encode()) for k in points])
    assert (index.to_bytes(points) == places).all() and (index.to_points(places) == points).all()
    assert len(index.behind) == 90 and len(fill_middle.ExceptionIndex(raw[-10:]).behind) == 0


def test_cuts_of_odd_rows(spark):
    df = odd(spark)
    for unit in fill_middle.UNITS:
        got = df.withColumn("c", fill_middle.rearranged(text_column(df, "text"), df["doc_id"], unit=unit))
        assert got.columns[:-1] == df.columns
        for x in got.collect():
            assert tuple(x.c) == brute_cut(x.doc_id, x.text or "", unit)
    empty = df.limit(0)
    assert empty.select(fill_middle.rearranged(text_column(empty, "text"), empty["doc_id"])).count() == 0
    with pytest.raises(ValueError):
        fill_middle.rearranged(F.col("text"), F.col("doc_id"), unit="words")


# ---- token files -----------------------------------------------------------
@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_file(queries.TOKENS)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected(coder, pairs, end_id):
    """(doc_id, start, n_tokens, crc32) by whole texts, in order."""
    out, at = [], 0
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0)):
        ids = coder.encode(t or "", add_special_tokens=False).ids + [end_id] * (end_id is not None)
        out.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def stored_rows(spark, path):
    found = token_files.with_starts(token_files.documents(spark, path))
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.orderBy("start", "n_tokens").collect()]


def test_elias_fano_lists():
    r = np.random.default_rng(2)
    for k in range(150):
        n, top = int(r.integers(0, 1500)), 2 ** int(r.integers(0, 63))
        values = np.sort(r.integers(0, top + 1, n, dtype=np.uint64))
        data = token_files.elias_fano(values)
        coded = token_files.EliasFano(memoryview(data + b"\n"))
        assert coded.size == len(data) and (coded.get(np.arange(n)) == values).all()
        some = r.integers(0, n, 9) if n else np.zeros(0, np.int64)
        assert (coded.get(some) == values[some]).all()
        probe = int(r.integers(0, top + 1))
        assert coded.first_at_least(probe) == int(np.searchsorted(values, np.uint64(probe)))
    # 10,000 documents of about 500 ids: far below 64 bits each
    bounds = np.cumsum(r.integers(1, 1000, 10_000))
    assert len(token_files.elias_fano(bounds)) * 8 / 10_000 < 12


def test_words_encoded_once_give_the_ids_of_whole_texts():
    r = random.Random(3)
    letters = "aAbB'sSdDtTlLrRvVeEmM.,|!?%*()09 \t\n\r\x0b\x0c\x85\xa0 éÉñ×÷́̊WİKΣσß漢　🎉…»"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["a|b", "|", " | ", "x<|endoftext|>y", "<|startoftext|>", "A<|startoftext|>...", "<|StartOfText|>", "don't.", "it's, they're. we'll", "", "W̊ ẘ"]
    raw, ends = utf8_parts(pa.array(texts))
    for a, b in ((0, len(texts)), (17, 40)):
        got, want = (token_files.word_encoder(queries.TOKENS, fast)(raw, ends[a:b + 1]) for fast in (True, False))
        assert (got[1] == want[1]).all() and (got[0] == want[0]).all()


@pytest.mark.parametrize("most_ids, most_docs", [(40, 1 << 20), (1 << 20, 3), (1 << 20, 1 << 20)])
@pytest.mark.parametrize("end_id", [1, None])
def test_files_hold_every_document_in_order(spark, coder, tmp_dir, most_ids, most_docs, end_id):
    r = random.Random(8)
    pairs = [(r.randrange(-10**12, 10**12), " ".join(prose(k, r.randint(1, 40)))) for k in range(60)]
    pairs += [(7, "Ein größerer Text"), (8, "x " * 200), (2**62, "far"), (-2**62, "away")]
    token_files.write_token_files(docs(spark, pairs).repartition(5), f"{tmp_dir}/f", queries.TOKENS, end_id,
                                  segment_ids=most_ids, segment_docs=most_docs)
    assert stored_rows(spark, f"{tmp_dir}/f") == expected(coder, pairs, end_id)
    sizes = token_files.read_segments(spark, f"{tmp_dir}/f").collect()
    for x in sizes:
        s = token_files.Segment(bytes(x.body))
        assert s.docs <= most_docs and (s.n <= most_ids or s.docs == 1)
    some = dict(pairs[::7])
    got = {x.doc_id: x.ids for x in token_files.lookup(spark, f"{tmp_dir}/f", [*some, 123]).collect()}
    assert {i: crc(ids) for i, ids in got.items()} == {x[0]: x[3] for x in expected(coder, pairs, end_id) if x[0] in some}


def test_files_of_odd_rows(spark, coder, tmp_dir):
    df = odd(spark)
    token_files.write_token_files(df, f"{tmp_dir}/f", queries.TOKENS, 1)
    pairs = [(r.doc_id, r.text) for r in df.collect()]
    key = lambda x: (x[0] is not None, x[0] or 0, x[2], x[3])  # noqa: E731  ties stand in the order of a hash
    got = stored_rows(spark, f"{tmp_dir}/f")
    assert sorted(map(key, got)) == sorted(map(key, expected(coder, pairs, 1)))
    assert [x[1] for x in got] == [0, *np.cumsum([x[2] for x in got]).tolist()[:-1]]
    assert [x[0] for x in got] == sorted((i for i, _ in pairs), key=lambda i: (i is not None, i or 0))
    token_files.write_token_files(df.limit(0), f"{tmp_dir}/none", queries.TOKENS, 1)
    assert stored_rows(spark, f"{tmp_dir}/none") == []


def test_the_query_holds_every_document(spark, coder):
    found = queries.QUERIES["op13_token_files"](spark, SF_SMALL)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.collect())
    pairs = [(r.doc_id, r.text) for r in queries.table(spark, SF_SMALL, "documents").collect()]
    assert got == expected(coder, pairs, queries.END_ID)
