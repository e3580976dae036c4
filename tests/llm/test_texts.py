"""Benchmark scan, licence scan, site lines, pieces and WARC."""

import gzip
import hashlib
import os
import textwrap

import pytest
from pyspark.sql import functions as F

from signalmart.llm import benchmark_scan, license_scan, queries, sentence_pieces, site_lines, warc
from signalmart.llm.common import stored, text_column
from tests.conftest import SF_SMALL, plan_text, rows
from tests.llm.fixtures import docs, odd, prose, with_clashes
from tools.parity import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    r = compare(spark, name, queries.QUERIES[name], queries.ORACLE[name], SF_SMALL, duck(SF_SMALL))
    assert r.get("exact") and r["spark_rows"] == r["oracle_rows"] > 0, r


@pytest.mark.parametrize("name", ["op9_license_scan", "op10_benchmark_decontamination"])
def test_native_queries_run_no_python(spark, name):
    plan = plan_text(queries.QUERIES[name](spark, SF_SMALL))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# ---- benchmark -------------------------------------------------------------
def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_windows_of_every_length_and_their_spans(spark):
    passage = [f"p{k}" for k in range(20)]
    bench = items(spark, [" ".join(passage), "Tiny one", "", None, "p3 p4", "tiny ONE"])
    df = docs(spark, [
        (1, "a b " + ", ".join(passage[2:15]).upper() + " c"),       # 13 words: p2..p14
        (2, "a b " + " ".join(passage[2:14]) + " c"),                # 12 words: none but p3 p4
        (3, "so tiny,one! and tiny one"), (4, None), (5, ""), (6, "p3"), (7, " ".join(passage * 2))])
    got = {r.row.doc_id: r for r in benchmark_scan.mark_documents(df, bench).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1]["items"]) == (16, 13, ["0", "4"])
    assert [tuple(s) for s in got[1].spans] == [(2, 15)] and got[1].contaminated
    assert (got[2].n_hit, got[2]["items"]) == (2, ["4"])
    assert [tuple(s) for s in got[3].spans] == [(1, 3), (4, 6)] and got[3]["items"] == ["1", "5"]
    assert [got[k].n_hit for k in (4, 5, 6)] == [0, 0, 0] and not got[4].contaminated
    assert got[7].n_hit == 40 and [tuple(s) for s in got[7].spans] == [(0, 40)]
    assert sorted(r.doc_id for r in benchmark_scan.drop_contaminated(df, bench).collect()) == [4, 5, 6]
    cut = {r.doc_id: r.text for r in benchmark_scan.cut_spans(df, bench).collect()}
    assert cut[1] == "a b c" and cut[3] == "so! and" and cut[4] is None and cut[6] == "p3"


def test_benchmark_scan_of_odd_rows(spark):
    df, bench = odd(spark), with_clashes(items(spark, ["one two", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14", None]))
    marked = benchmark_scan.mark_documents(df, bench)
    assert marked.count() == df.count()
    assert rows(marked.filter("contaminated"), "row.doc_id", "n_hit") == [(4, 2), (5, 2), (5, 2)]
    assert {r.n_hit for r in marked.filter("row.doc_id IN (6, 7)").collect()} == {14 * 61}
    assert benchmark_scan.drop_contaminated(df, bench).columns == df.columns
    assert benchmark_scan.mark_documents(df, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert benchmark_scan.mark_documents(df.limit(0), bench).count() == 0


def test_a_large_window_table_joins_by_shuffle(spark, monkeypatch):
    bench = items(spark, [" ".join(f"p{k}" for k in range(20))])
    df = docs(spark, [(1, "x " + " ".join(f"p{k}" for k in range(20)))])
    want = rows(benchmark_scan.mark_documents(df, bench), "n_words", "n_hit", "items")
    monkeypatch.setattr(benchmark_scan, "BROADCAST_ROWS", 0)
    assert rows(benchmark_scan.mark_documents(df, bench), "n_words", "n_hit", "items") == want


# ---- licences --------------------------------------------------------------
def test_canonical_forms(spark):
    mit = license_scan.KNOWN[0][1]
    df = docs(spark, [
        (1, "The MIT text\n" + mit), (2, "Copyright (c) 2020 A. Person\n\n" + mit.upper().replace("\n", "  \n ")),
        (3, mit.replace("sublicense", "sub-licence")), (4, "text\nLicenced under the Apache Licence,  version 2.0\nmore"),
        (5, None), (6, ""), (7, "(c) 2001 Someone"), (8, "Released under the MIT License.\nLicensed under CC BY 4.0.")])
    got = {r.row.doc_id: r for r in license_scan.scan(df, license_scan.default_known(spark)).collect()}
    assert [got[k].license for k in range(1, 9)] == [None, "MIT", "MIT", None, None, None, None, None]
    assert got[4].notices == ["Apache-2.0"] and got[8].notices == ["CC-BY-4.0", "MIT"] and got[5].notices == []
    assert got[5].digest == got[7].digest == hashlib.sha256(b"").hexdigest()


def test_known_texts_in_any_wrapping(spark):
    texts = [(name, t) for name, t in license_scan.KNOWN if len(t) > 300]
    layouts = [lambda t, w=w: "\n".join(textwrap.wrap(" ".join(t.split()), w))
               for w in (40, 60, 72, 76, 78, 79, 80, 100, 10_000)]
    heads = ["", "Copyright (c) 2020 A. Person\n\n", "Copyright 2020 B\n(c) 2021 C\nAll rights reserved.\n", "Copyright Jane Doe\n\n",
             "(c) Copyright Jane Doe\nCopyright Some Body\nAll rights reserved.\n\n"]
    want = [(name, head + layout(t)) for name, t in texts for layout in layouts for head in heads]
    other = [layout(" ".join(texts[0][1].split()).replace("copyright notice and this", "copyright notice or this"))
             for layout in layouts]
    df = docs(spark, list(enumerate([t for _, t in want] + other)))
    got = {r.row.doc_id: r.license for r in license_scan.scan(df, license_scan.default_known(spark)).collect()}
    assert [got[k] for k in range(len(want) + len(other))] == [name for name, _ in want] + [None] * len(other)


def test_license_files_with_titles(spark):
    full = {name: t for name, t in license_scan.KNOWN if len(t) > 300}
    titles = {"MIT": ["MIT License", "The MIT License (MIT)", "(The MIT License)"], "ISC": ["ISC License", "The ISC License"],
              "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License"], "BSD-2-Clause": ["BSD 2-Clause License"],
              "Zlib": ["zlib License"], "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"],
              "Unlicense": ["The Unlicense"], "0BSD": ["Zero-Clause BSD License"]}
    notices = ["", "Copyright (c) 2020 A\n\n", "Copyright Jane Doe\n\n", "Copyright (c) 2020, A\nAll rights reserved.\n\n"]
    wrap = [lambda t: t, lambda t: "\n".join(textwrap.wrap(" ".join(t.split()), 78))]
    want = [(name, f"{title}\n\n{notice}{w(full[name])}\n") for name, heads in titles.items() for title in heads
            for notice in notices for w in wrap]
    other = ["MIT License", "MIT License\n\nCopyright (c) 2020 A", "A license story\n\nOnce upon a time.",
             "MIT License\n\n" + full["MIT"].replace("free of charge", "for a charge")]
    df = docs(spark, list(enumerate([t for _, t in want] + other)))
    found = rows(license_scan.scan(df, license_scan.default_known(spark)), "row.doc_id", "license", "digest", "notices")
    assert [r[1] for r in found] == [name for name, _ in want] + [None] * len(other)
    # the SQL has the same rules
    con = duck(SF_SMALL)
    con.execute("CREATE OR REPLACE TABLE texts(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO texts VALUES (?, ?)", list(enumerate([t for _, t in want] + other)))
    sql = con.execute(queries._license_sql("texts")).fetchall()
    assert sorted((r[0], r[2], r[1], r[4]) for r in sql) == [(i, n, d, ",".join(x)) for i, n, d, x in found]


def test_known_texts_can_be_files(spark, tmp_dir):
    for name, t in (("X-1.0.txt", "Do as you like\nwith this."), ("Y", "Do nothing with it.")):
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.write(t)
    known = license_scan.read_known(spark, tmp_dir)
    df = docs(spark, [(1, "X License\n\n(c) 2020 A\n\nDO AS YOU LIKE with this"), (2, "Do nothing with it!"), (3, "else")])
    assert rows(license_scan.scan(df, known), "row.doc_id", "license") == [(1, "X-1.0"), (2, "Y"), (3, None)]


def test_known_texts_with_a_notice_to_fill_in(spark):
    known = spark.createDataFrame([("X", "Copyright <YEAR> <COPYRIGHT HOLDER>\n\nDo as you like with this.")],
                                  "license_id string, text string")
    df = docs(spark, [(1, "Copyright 2020 Foo\n\nDo as you like\nwith this."), (2, "Copyright Foo\nDo as you like with this."),
                      (3, "Do as you like with this."), (4, "Do as you\ncopyright like with this.")])
    got = rows(license_scan.scan(df, known), "row.doc_id", "license")
    assert got == [(1, "X"), (2, "X"), (3, "X"), (4, None)]


def test_license_scan_of_odd_rows(spark, monkeypatch):
    df, known = odd(spark), spark.createDataFrame([("B", "ONE, two"), ("A", "one two"), ("C", None), ("D", "")],
                                                  "license_id string, text string")
    got = rows(license_scan.scan(df, known).filter("license IS NOT NULL"), "row.doc_id", "license")
    assert got == [(4, "A"), (5, "A"), (5, "A")]
    monkeypatch.setattr(license_scan, "BROADCAST_ROWS", 0)
    assert rows(license_scan.scan(df, known).filter("license IS NOT NULL"), "row.doc_id", "license") == got
    assert license_scan.scan(df, known).count() == df.count()
    assert license_scan.scan(df.limit(0), known).count() == 0
    assert license_scan.scan(df, known.limit(0)).filter("license IS NOT NULL").count() == 0


# ---- site lines ------------------------------------------------------------
def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string")


def test_lines_are_judged_per_host(spark):
    data = [(k, f"https://a.example.com/{k}", f"<p>menu</p><p>own {k}</p><p>menu</p>") for k in range(6)]
    data += [(k, f"http://b.example.com:80/{k}?q", f"<p>menu</p><div>b {k}<br>x</div>") for k in range(10, 12)]
    data += [(k, f"https://c.example.com/{k}", "<li>once</li>" if k == 20 else f"<script>menu</script>c{k}") for k in range(20, 40)]
    df = with_clashes(pages(spark, data))
    got = {r.row.page_id: (r.host, r.n_lines, r.n_dropped, r.text)
           for r in site_lines.drop_site_lines(df, site_lines.html_text(df["html"]), df["url"]).collect()}
    assert got[0] == ("a.example.com", 3, 2, "own 0")
    assert got[10] == ("b.example.com", 3, 0, "menu\nb 10\nx")    # on two pages only
    assert got[20] == ("c.example.com", 1, 0, "once") and got[21][3] == "c21"


def test_the_join_carries_no_page(spark):
    """Only the lines and the asked columns of a page meet its host's lines."""
    import re
    plan = plan_text(queries.QUERIES["op3_site_lines"](spark, SF_SMALL))
    moved = re.findall(r"(?:Exchange|Join)[^\n]*\n(?:Input|Left keys)[^\n]*", plan)
    assert moved and not any("html" in m or "url" in m for m in moved)
    row = re.search(r"struct\(([^)]*)\) AS row", plan)
    assert row.group(1).replace(" ", "").startswith("page_id") and "html" not in row.group(1)


def test_lines_of_odd_pages(spark):
    df = pages(spark, [(1, None, None), (2, "no url", ""), (None, "https://h/x", "<p>a</p>" * 20_000), (3, "https://h/y", "<p>a"),
                       (3, "https://h/y", "<p>a"), (4, "HTTPS://u:p@H:8/z", "<!-- x --><style>q</style>a<b>b</b>")])
    got = rows(site_lines.drop_site_lines(df, site_lines.html_text(df["html"]), df["url"]), "row.page_id", "host", "n_lines", "n_dropped")
    assert got == [(None, "h", 20_000, 20_000), (1, "", 0, 0), (2, "", 0, 0), (3, "h", 1, 1), (3, "h", 1, 1), (4, "h", 1, 0)]
    assert site_lines.drop_site_lines(df.limit(0), site_lines.html_text(df["html"]), df["url"]).count() == 0


# ---- pieces ----------------------------------------------------------------
@pytest.fixture(scope="module")
def model():
    if not os.path.exists(queries.PIECES):
        pytest.skip("no public vocabulary here")
    return sentence_pieces.read_model(queries.PIECES)


def test_pieces_equal_the_models_own(model):
    import sentencepiece
    own, coder = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES), sentence_pieces.Encoder(model)
    texts = ["", " ", "  a  b\n c\t", "ﬁ ① é á", "\x00abc", "<s>hi</s>", "a\r\nb", " ​ x", "日本語のテキスト。", "🎉🎉 ok",
             "a" * 500, "=" * 1000, "x_,y __init__(self):", "▁x ▁▁ y", "3.14159 12345", "²."]
    texts += [" " * k + w for k in range(40) for w in ("q", "①", "")] + ["a" + " " * k + "b" for k in range(40)]
    texts += [" ".join(prose(k, 80)) for k in range(30)]
    texts += [open(__file__, encoding="utf-8").read(), open(queries.__file__, encoding="utf-8").read()]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == own.encode(text), text[:60]
        assert coder.decode(ids.tolist()) == text or "▁" in text


def test_unigram_models_take_the_best_sum():
    pieces = {"▁": -5.0, "a": -3.0, "b": -3.0, "c": -3.0, "▁a": -2.5, "ab": -4.0, "bc": -2.0, "abc": -9.0}
    model = {"pieces": ["<unk>", *pieces], "scores": [0.0, *pieces.values()], "bytes": {}, "special": [0],
             "kind": "unigram", "unknown": 0}
    coder = sentence_pieces.Encoder(model)

    def best(word):  # all segmentations
        if not word:
            return 0.0, []
        return max((pieces[word[:k]] + best(word[k:])[0], [word[:k], *best(word[k:])[1]])
                   for k in range(1, len(word) + 1) if word[:k] in pieces)

    for text in ("abc", "a", "bcab", "cabcab abc"):
        want = [p for word in ("▁" + text.replace(" ", " ▁")).split() for p in best(word)[1]]
        assert [model["pieces"][i] for i in coder.encode([text])[0]] == want
    assert coder.encode(["a?"])[0].tolist()[-1] == 0


def test_very_long_texts_are_taken_in_parts(model, monkeypatch):
    text = "  ".join(prose(1, 3000)) + " " * 70 + "x\n" * 300
    want = sentence_pieces.Encoder(model).encode([text])[0].tolist()
    monkeypatch.setattr(sentence_pieces, "TOGETHER", 500)
    coder = sentence_pieces.Encoder(model)
    assert coder.encode([text, "", "short"])[0].tolist() == want
    assert len(list(coder._parts(text.replace(" ", sentence_pieces.MARK)))) > 10


def test_long_unbroken_words_equal_the_models_own(model):
    import base64
    import random
    import time
    import sentencepiece
    own, coder = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES), sentence_pieces.Encoder(model)
    r = random.Random(3)
    texts = ["x" * 100_000, "ab" * 50_000, base64.b64encode(r.randbytes(75_000)).decode(),
             "".join(r.choice("ACGT") for _ in range(100_000)), "é漢x" * 3000, "a" * 999 + "é" * 2, "q" * 1001,
             "".join(r.choice("abcdefghijklmnopqrstuvwxyz漢🎉é\x01") for _ in range(70_000))]
    began = time.time()
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == own.encode(text), text[:30]
    assert time.time() - began < 60


def test_long_words_of_unigram_models_take_the_best_sum(monkeypatch):
    import random
    r = random.Random(1)
    pieces = {"▁": -5.0, "a": -3.0, "b": -3.0, "c": -3.0, "▁a": -2.5, "ab": -4.0, "bc": -2.0, "abc": -9.0, "cabca": -6.5}
    model = {"pieces": ["<unk>", *pieces], "scores": [0.0, *pieces.values()], "bytes": {}, "special": [0],
             "kind": "unigram", "unknown": 0}
    texts = ["".join(r.choice("abc?") for _ in range(300)) for _ in range(8)]
    want = [x.tolist() for x in sentence_pieces.Encoder(model).encode(texts)]
    monkeypatch.setattr(sentence_pieces, "_ALONE", 40)
    monkeypatch.setattr(sentence_pieces, "_LONG_BLOCK", 7)
    assert [x.tolist() for x in sentence_pieces.Encoder(model).encode(texts)] == want


def test_a_small_memo_and_small_batches_change_nothing(model, monkeypatch):
    texts = [" ".join(prose(k, 50)) for k in range(20)]
    want = [x.tolist() for x in sentence_pieces.Encoder(model).encode(texts)]
    monkeypatch.setattr(sentence_pieces, "_MEMO", 10)
    coder = sentence_pieces.Encoder(model)
    assert [coder.encode([t])[0].tolist() for t in texts] == want


def test_pieces_of_odd_rows(spark, model):
    df = odd(spark)
    got = df.select("doc_id", "text", sentence_pieces.encoded(text_column(df, "text"), model).alias("e"))
    got = got.withColumn("back", sentence_pieces.decoded(F.col("e.ids"), model))
    assert got.filter("NOT e.exact OR back <> coalesce(text, '')").count() == 0 and got.count() == df.count()
    assert got.filter("doc_id = 1").first().e.ids == []
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r[0] for r in nothing.select(sentence_pieces.decoded(F.col("ids"), model)).collect()] == ["", ""]
    assert df.limit(0).select(sentence_pieces.encoded(text_column(df, "text"), model)).count() == 0


# ---- WARC ------------------------------------------------------------------
def differences(spark, a, b):
    return sorted((r.archive, r.offset, r.kind, r.digest_a, r.digest_b) for r in warc.audit(a, b).collect())


@pytest.mark.parametrize("archive_bytes", [1 << 16, 1 << 22])
def test_audit_finds_what_a_direct_comparison_finds(spark, archive_bytes):
    first = stored(warc.archived(queries.table(spark, SF_SMALL, "pages").repartition(3), archive_bytes=archive_bytes), "a")
    second = stored(warc.damaged(first, 2), "b")
    a, b = ({(r.archive, r.offset): hashlib.sha256(r.record).hexdigest() for r in x.collect()} for x in (first, second))
    want = sorted((*k, "missing" if k not in b else "extra" if k not in a else "altered", a.get(k), b.get(k))
                  for k in a.keys() | b.keys() if a.get(k) != b.get(k))
    assert len({w[2] for w in want}) == 3
    key = lambda rows_: sorted(map(str, rows_))
    got = [(r.archive, r.offset, r.kind, r.digest_a, r.digest_b) for r in warc.audit(first, second).collect()]
    assert key(got) == key(want)
    assert warc.audit(first, first).count() == 0


@pytest.mark.parametrize("compress", [False, True])
def test_damage_in_a_file_costs_no_other_record(spark, tmp_dir, compress):
    df = pages(spark, [(k, f"http://h/{k}", f"<p>{k}</p>" * (200 + k)) for k in range(12)])
    laid = warc.archived(df.coalesce(1), compress=compress).orderBy("offset").collect()
    data, at = bytearray(b"".join(r.record for r in laid)), [r.offset for r in laid]
    if compress:
        hit = [2, 5, 9]
        data[at[2]] = 0                                        # magic
        data[at[5] + len(laid[5].record) // 2] ^= 0xFF         # inside the member
        data[at[9] + len(laid[9].record) - 6] ^= 0xFF          # checksum
    else:
        hit = [0, 3, 5, 7, 9]
        data[0] = data[at[3] + 1] = 0                          # the version line
        for k, length in ((5, b"9"), (7, b"x"), (9, b"0")):    # too large, no number, too small
            where = data.index(b"Content-Length: ", at[k]) + 16
            data[where] = length[0]
    for name, content in (("good", b"".join(r.record for r in laid)), ("bad", bytes(data))):
        with open(f"{tmp_dir}/{name}.warc", "wb") as fh:
            fh.write(content)
    good, bad = (stored(warc.read_warc(spark, f"{tmp_dir}/{n}.warc").withColumn("archive", F.lit("a")), n) for n in ("good", "bad"))
    assert [r.offset for r in bad.orderBy("offset").collect()] == at
    assert b"".join(r.record for r in bad.orderBy("offset").collect()) == bytes(data)
    found = sorted((r.offset, r.kind) for r in warc.audit(good, bad).collect())
    assert found == [(at[k], "altered") for k in hit]


def test_archives_read_back_as_warc_files(spark, tmp_dir):
    df = pages(spark, [(1, "https://h/1", "<p>é</p>"), (2, None, None), (None, "https://h/3", "x" * 100_000)]).coalesce(1)
    for compress in (False, True):
        laid = warc.archived(df, compress=compress).collect()
        os.makedirs(f"{tmp_dir}/{compress}")
        with open(f"{tmp_dir}/{compress}/a.warc", "wb") as fh:
            fh.write(b"".join(r.record for r in laid))
        back = warc.read_warc(spark, f"{tmp_dir}/{compress}/*.warc").orderBy("offset").collect()
        assert [(r.offset, bytes(r.record)) for r in back] == [(r.offset, bytes(r.record)) for r in laid]
    data = b"".join(r.record for r in warc.archived(df).collect())
    assert [block for *_, block in warc.parse_records(data)] == ["<p>é</p>".encode(), b"", b"x" * 100_000]
    assert len(list(warc.parse_records(data[:-5000]))) == 2      # cut short
    assert list(warc.parse_records(gzip.compress(b"junk"))) == []


def test_audit_of_odd_replicas(spark):
    kind = "archive string, offset long, record_id string, record binary"
    a = spark.createDataFrame([("x", 0, "r0", b"1"), ("x", 0, "r0", b"1"), ("x", 1 << 40, "r1", None), (None, None, None, b"n")], kind)
    b = spark.createDataFrame([("x", 0, "r0", b"1"), ("x", 1 << 40, "r1", b""), (None, None, None, b"n"), ("y", 5, "q", b"z")], kind)
    got = [(r.archive, r.offset, r.kind, r.record_id) for r in warc.audit(a, b).collect()]
    assert sorted(got) == [("x", 0, "altered", "r0"), ("y", 5, "extra", "q")]
    assert warc.audit(a.limit(0), b.limit(0)).count() == 0
    assert {r.kind for r in warc.audit(a, b.limit(0)).collect()} == {"missing"}
