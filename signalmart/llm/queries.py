"""Registered queries of the corpus operators: name -> (spark, sf_dir) ->
DataFrame, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from signalmart.llm import (
    benchmark_scan, exact_dedup, fill_middle, license_scan, minhash, periodic_runs, quality, repeated_spans,
    sentence_pieces, site_lines, token_files, toxicity, warc)
from signalmart.llm.common import remainder, send_package, stored, text_column
from signalmart.session import work_dir

#: A public SentencePiece model; the environment names another.
PIECES = os.environ.get("SIGNALMART_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
#: A public tokenizer of the ``tokenizers`` library, and the id that ends a document.
TOKENS, END_ID = os.environ.get("SIGNALMART_TOKENS", "/opt/tokenizers/word_bpe_49k.json"), 1

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark, sf_dir: str, name: str):
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_minhash_near_dedup", """
    WITH RECURSIVE w AS (
        SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS words
        FROM documents),
    s AS (
        SELECT DISTINCT r, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')] ELSE
            list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) END) AS shingle
        FROM w WHERE len(words) > 0),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    shared AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.r < b.r GROUP BY 1, 2),
    links AS (SELECT x, y FROM shared JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (SELECT r, r AS m FROM w UNION SELECT reach.r, y FROM reach JOIN edges ON x = m),
    least AS (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN w ON w.r = m GROUP BY reach.r)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
    FROM w JOIN least USING (r) LEFT JOIN n USING (r)""")
def op1_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate components of whole texts at a similarity of 0.85."""
    marked = minhash.near_groups(table(spark, sf_dir, "documents"), percent=85)
    return marked.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


@register("op4_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op4_exact_dedup(spark, sf_dir):
    """Copies of whole texts; the row with the largest doc_id stays."""
    marked = exact_dedup.mark_copies(table(spark, sf_dir, "documents"))
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.col("digest").alias("text_sha256"))


@register("op10_benchmark_decontamination", """
    WITH d AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
        FROM documents),
    b AS (
        SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
        FROM benchmark),
    grams AS (
        SELECT DISTINCT item, k, list_slice(w, s, s + k - 1) AS gram
        FROM (SELECT item, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s
              FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT k FROM grams),
    places AS (
        SELECT doc_id, k, s, list_slice(w, s, s + k - 1) AS gram
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k)),
    hits AS (SELECT doc_id, s, p.k, item FROM places p JOIN grams g ON p.k = g.k AND p.gram = g.gram),
    covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit
                FROM (SELECT doc_id, unnest(range(s, s + k)) AS x FROM hits) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op10_benchmark_decontamination(spark, sf_dir):
    """Words of each document inside a test window, and the items hit."""
    marked = benchmark_scan.mark_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                           carry=["doc_id"])
    return marked.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    """Toxicity score of every document; a fifth of the ids is held out."""
    labels = table(spark, sf_dir, "labels")
    model, counted = toxicity.fit(table(spark, sf_dir, "documents"), labels, remainder(labels["doc_id"], 5) != 0,
                                  carry=["doc_id"])
    # rows of a few numbers each, but a search for each: over as many tasks as a shuffle has
    counted = counted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = counted.select("row.doc_id", toxicity.scored_tally(F.col("tally"), model).alias("s"))
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "s.score",
                        (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.neighbours", "s.terms")


@register("op6_sentence_pieces")
def op6_sentence_pieces(spark, sf_dir):
    """Pieces of every document and the text they decode to."""
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", sentence_pieces.encoded(
        text_column(docs, "text"), sentence_pieces.read_model(PIECES)).alias("e"))
    return coded.select("doc_id", F.size("e.ids").cast("long").alias("n_tokens"), "e.ids", "e.exact", "e.decoded_sha256")


@register("op2_quality")
def op2_quality(spark, sf_dir):
    """Quality score of every document; a third of the ids is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, remainder(labels["doc_id"], 3) != 1)
    found = docs.select("doc_id", (remainder(docs["doc_id"], 3) == 1).alias("held_out"),
                        quality.scored(text_column(docs, "text"), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register("op7_suffix_array_dedup", """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
    b AS (
        SELECT r, p, hex(t[p:p]) AS byte, CASE WHEN p + 199 <= octet_length(t) THEN md5(t[p:p + 199]) END AS win
        FROM (SELECT r, t, unnest(range(1, octet_length(t) + 1)) AS p FROM d)),
    twice AS (SELECT win FROM b WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
    g AS (
        SELECT r, p, byte, max(CAST(twice.win IS NOT NULL AS INTEGER))
               OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) = 1 AS gone
        FROM b LEFT JOIN twice USING (win)),
    e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), false) AS begins FROM g),
    c AS (SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
                 string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM e GROUP BY r)
    SELECT doc_id, octet_length(t) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM d LEFT JOIN c USING (r)""")
def op7_suffix_array_dedup(spark, sf_dir):
    """Bytes of each document covered by a 200-byte string that repeats."""
    found = repeated_spans.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                        F.when(F.col("kept").isNull(), F.col("whole_sha256"))
                        .otherwise(F.sha2("kept", 256)).alias("kept_sha256"))


_LINES_SQL = f"""
    WITH p AS (
        SELECT row_number() OVER () AS r, page_id,
            lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
            list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                coalesce(html, ''), '{site_lines.HIDDEN}', '', 'g'), '{site_lines.BLOCK}', chr(10), 'g'),
                '{site_lines.TAG}', '', 'g'), '[ \\t\\r\\f]+', ' ', 'g'), chr(10)), lambda x: trim(x)),
                lambda x: x <> '') AS lines
        FROM pages),
    c AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p) GROUP BY ALL),
    t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
    b AS (SELECT host, line FROM c JOIN t USING (host) WHERE n >= {site_lines.LEAST_PAGES} AND n > pages * {site_lines.RATIO}),
    e AS (SELECT r, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM p),
    s AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY k) AS text
          FROM e ANTI JOIN b USING (host, line) GROUP BY r)
    SELECT page_id, host, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM p LEFT JOIN s USING (r)"""


@register("op3_site_lines", _LINES_SQL)
def op3_site_lines(spark, sf_dir):
    """Pages without the lines that are boilerplate on their host."""
    pages = table(spark, sf_dir, "pages")
    found = site_lines.drop_site_lines(pages, site_lines.html_text(pages["html"]), pages["url"], carry=["page_id"])
    return found.select("row.page_id", "host", "n_lines", "n_dropped",
                        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def _plain_sql(text: str) -> str:
    out = f"lower({text})"
    for spelling, same in license_scan.SPELLINGS:
        out = f"replace({out}, '{spelling}', '{same}')"
    return (f"list_transform(string_split(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10)), "
            f"lambda x: trim(x))")


def _body_sql(lines: str) -> str:
    return (f"list_filter({lines}, lambda x: x <> '' AND NOT (regexp_matches(x, '{license_scan.COPYRIGHT_LINE}') "
            f"AND regexp_matches(x, '{license_scan.NOTICE}')))")


def _headless_sql(lines: str) -> str:
    """Without titles at the head and copyright lines at the head of paragraphs."""
    whole = f"array_to_string({lines}, chr(10))"
    parts = (f"list_transform(string_split_regex(regexp_replace({whole}, '{license_scan.TITLES}', ''), '\\n\\n+'), "
             f"lambda x: regexp_replace(ltrim(x, chr(10)), '{license_scan.HEAD}', ''))")
    return _body_sql(f"string_split(array_to_string({parts}, chr(10)), chr(10))")


def _joined_sql(lines: str) -> str:
    out = f"array_to_string({lines}, ' ')"
    for spelling, same in license_scan.SPELLINGS:
        words = spelling.replace("-", " ")
        if " " in words:
            out = f"replace({out}, '{words}', '{same}')"
    return out


def _license_sql(documents: str = "documents") -> str:
    known = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in license_scan.KNOWN)
    return f"""
    WITH known(license, text) AS (VALUES {known}),
    p AS (SELECT license, {_plain_sql("text")} AS plain FROM known),
    k AS (SELECT {_joined_sql(_body_sql("plain"))} AS canonical, min(license) AS license FROM p GROUP BY 1),
    h AS (SELECT {_joined_sql(_headless_sql("plain"))} AS canonical, min(license) AS license FROM p GROUP BY 1),
    t AS (SELECT row_number() OVER () AS r, doc_id, {_plain_sql("coalesce(text, '')")} AS plain FROM {documents}),
    d AS (SELECT r, doc_id, {_body_sql("plain")} AS lines, {_joined_sql(_body_sql("plain"))} AS canonical,
                 {_joined_sql(_headless_sql("plain"))} AS headless FROM t),
    n AS (SELECT r, count(DISTINCT license) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS ids
          FROM (SELECT r, unnest(list_distinct(lines)) AS line FROM d) JOIN k ON line = canonical WHERE line <> '' GROUP BY r)
    SELECT doc_id, sha256(d.canonical) AS digest, coalesce(k.license, h.license) AS license,
           CAST(coalesce(n, 0) AS BIGINT) AS n_notices, coalesce(ids, '') AS notices
    FROM d LEFT JOIN k ON k.canonical = d.canonical AND d.canonical <> ''
           LEFT JOIN h ON h.canonical = d.headless AND d.headless <> '' LEFT JOIN n USING (r)"""


@register("op9_license_scan", _license_sql())
def op9_license_scan(spark, sf_dir):
    """The known licence each document is, and the notices it holds."""
    found = license_scan.scan(table(spark, sf_dir, "documents"), license_scan.default_known(spark), carry=["doc_id"])
    return found.select("row.doc_id", "digest", "license", F.size("notices").cast("long").alias("n_notices"),
                        F.array_join("notices", ",").alias("notices"))


@register("op5_warc_fixity")
def op5_warc_fixity(spark, sf_dir):
    """Pages as WARC records in two replicas, one of them damaged: the
    records that the audit finds."""
    first = stored(warc.archived(table(spark, sf_dir, "pages")), "replica")
    second = stored(warc.damaged(first), "replica")
    return warc.audit(first, second)


def with_loops(text: Column, doc_id: Column) -> Column:
    """The words of a text; in a tenth of the documents, from some word on,
    they go round in a loop (as the query's contract says)."""
    @F.arrow_udf("string")
    def run(texts: pa.Array, h: pa.Array) -> pa.Array:
        out = texts.to_pylist()
        for i, x in enumerate(h.to_pylist()):
            words = re.split(r"[\x20\x09-\x0D]+", out[i]) if x % 10 == 0 else []
            words = [w for w in words if w]
            if words:
                n, g = len(words), x // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                tail = words[a:a + p]
                out[i] = " ".join(words[:a] + (tail * -(-(n - a) // len(tail)))[:n - a])
        return pa.array(out, texts.type)

    return run(text, F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")))


# crc32 of a text of ASCII characters: byte by byte, eight shifts each
_CRC32_SQL = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
        string_split({0}, ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


@register("op11_periodic_runs", f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, {_CRC32_SQL.format("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h,
               list_filter(string_split_regex(coalesce(text, ''), '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS w
        FROM documents),
    e AS (SELECT r, w, CAST(len(w) AS BIGINT) AS n, h % 10 = 0 AS looped, (h // 10) % len(w) AS a,
                 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM d WHERE len(w) > 0),
    words AS (
        SELECT r, n, i, CASE WHEN looped AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
        FROM (SELECT *, unnest(range(n)) AS i FROM e)),
    pairs AS (SELECT y.r, y.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word
              WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
    stretches AS (SELECT r, q, min(i) - q AS start, count(*) + q AS length FROM islands GROUP BY r, q, island),
    runs AS (SELECT r, start, length, min(q) AS period FROM stretches
             WHERE length >= 6 AND length >= 4 * q GROUP BY r, start, length),
    best AS (SELECT r, start, length, period FROM (
                 SELECT *, row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) AS turn FROM runs)
             WHERE turn = 1),
    listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
                      ORDER BY start, period) AS text FROM runs GROUP BY r),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words WHERE NOT EXISTS (
                 SELECT 1 FROM runs WHERE runs.r = words.r AND i >= start + period AND i < start + length) GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM d LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)""")
def op11_periodic_runs(spark, sf_dir):
    """Runs of repeated words of each document, and its text without them."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", periodic_runs.runs_of(with_loops(text_column(docs, "text"), docs["doc_id"])).alias("f"))
    best = found.select("doc_id", "f.runs", "f.collapsed", periodic_runs.strongest(F.col("f.runs")).alias("best"))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@register("op12_fill_in_middle", """
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
               sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    e AS (
        SELECT r, doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
               [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN [0, 1, 2, 3]] AS h FROM d),
    c AS (
        SELECT *, CAST(len(units) AS BIGINT) AS n,
               least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
               greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100
                    THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e),
    p AS (
        SELECT doc_id, t, n, form, array_to_string(units[1:a], '') AS prefix,
               array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p""")
def op12_fill_in_middle(spark, sf_dir):
    """Every document cut at lines, with its middle moved behind."""
    docs = table(spark, sf_dir, "documents")
    cut = docs.select("doc_id", fill_middle.rearranged(text_column(docs, "text"), docs["doc_id"], seed=7).alias("c"))
    return cut.select("doc_id", "c.n", "c.form", "c.prefix_chars", "c.middle_chars",
                      F.sha2(F.col("c.output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored(F.col("c.output"), F.col("c.form")).cast("binary"), 256)
                      .alias("restored_sha256"))


@register("op13_token_files")
def op13_token_files(spark, sf_dir):
    """Ids of every document, written to token files and read from them."""
    path = work_dir(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, TOKENS, END_ID)
    found = token_files.with_starts(stored(token_files.documents(spark, path), "documents"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")
