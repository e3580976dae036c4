"""Boilerplate lines by site-relative frequency.

For each host the share of its pages that contain a line is the line's
ratio. Lines over ``ratio`` that stand on ``least`` pages or more are
boilerplate and are dropped from every page of the host; elsewhere the same
line stays. A host's ratios sum to its mean number of distinct lines, so it
has at most that number divided by ``ratio`` boilerplate lines: they travel
as one short array per host, written before it meets the pages. Counting is
aggregated before its shuffle by (host, line), never by host alone, and the join
carries a page's lines and the columns asked for, nothing else of the page; its
sides share no exchange with an aggregate, so adaptive execution splits a hot
host's pages by their size, whatever it is.

Defined results: null text or html has no lines; a null or odd url belongs to
the host ''; a line that a page repeats counts once for that page and goes
everywhere in it; repeated rows are pages of their own. Lines are compared
after trimming, empty ones are left out. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart.llm.common import stored

RATIO, LEAST_PAGES = 0.2, 3
#: FIXED VALUES: what holds no text, and the tags that begin a new line.
HIDDEN = r"(?is)<!--.*?-->|<(script|style|template|noscript)\b.*?</(script|style|template|noscript)\s*>"
BLOCK = (r"(?i)</?(p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|table|tr|td|th|nav|header|footer|article|section|aside|main"
         r"|title|head|body|html|blockquote|pre|form|figure|figcaption)\b[^>]*>")
TAG = r"<[^>]*>"


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user and port."""
    place = F.coalesce(url.cast("string"), F.lit(""))
    return F.lower(F.regexp_extract(place, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def html_text(html: Column) -> Column:
    """The text of a page, one line per block."""
    plain = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), HIDDEN, "")
    return F.regexp_replace(F.regexp_replace(plain, BLOCK, "\n"), TAG, "")


def lines_of(text: Column) -> Column:
    """The trimmed lines of a text that are not empty."""
    parts = F.split(F.regexp_replace(text, r"[ \t\r\f]+", " "), "\n")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def _name(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): hashes of each host's boilerplate lines. ``pages``:
    host, lines."""
    total = pages.groupBy("host").agg(F.count("*").alias("pages"))
    each = pages.select("host", F.explode(F.transform(F.array_distinct("lines"), _name)).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return (counts.join(total, "host").filter(F.col("n") > F.col("pages") * ratio)
            .groupBy("host").agg(F.collect_list("line").alias("common")))


def drop_site_lines(df: DataFrame, text: Column, url: Column, ratio: float = RATIO,
                    least: int = LEAST_PAGES, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: struct ``row`` of the columns ``carry`` (all),
    ``host``, ``n_lines``, ``n_dropped`` and ``text`` (the lines that stay)."""
    pages = df.select(F.struct(*[df[c] for c in carry or df.columns]).alias("row"), host_of(url).alias("host"),
                      lines_of(text).alias("lines"))
    common = stored(boilerplate(pages.select("host", "lines"), ratio, least), "boilerplate")
    found = pages.join(common, "host", "left")
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("common", _name(x))))
    return found.select("row", "host", "lines", kept.alias("kept")).select(
        "row", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
