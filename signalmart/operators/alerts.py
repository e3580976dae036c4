"""Latest-day snapshot, HIGH alert rows and the per-day alert digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart import schemas as S

def latest_snapshot(mart: DataFrame, date_col: str = "arrival_date_local",
                    columns: list[str] = tuple(S.ALERT_COLUMNS)) -> DataFrame:
    """All markets' rows on the *global* latest date (a market whose feed
    lags that day is absent), ordered by market.

    The latest date is a scalar subquery: it runs first and its value
    reaches the main scan as a filter, so no join against an aggregate and
    no cross join is needed.
    """
    latest = mart.select(F.max(date_col)).scalar()
    return (mart.filter(F.col(date_col) == latest)
            .select(*columns).orderBy("market"))


def alert_rows(snapshot: DataFrame, label: str = "HIGH") -> DataFrame:
    """Rows that trigger an alert; zero rows means no alert."""
    return snapshot.filter(F.col("demand_pressure") == label)


def _fmt_pct(c):
    return F.coalesce(F.col(c).cast("string"), F.lit("n/a"))


def digest_line():
    """Two lines per market: label, counts, deviation and drivers, then what
    the label means."""
    return F.concat(
        F.col("market"), F.lit(": "), F.col("demand_pressure"),
        F.lit(" | "), F.col("arrivals").cast("string"), F.lit(" arrivals, "),
        _fmt_pct("arrivals_vs_7day_avg_pct"), F.lit("% vs trailing avg | why: "),
        F.col("score_drivers"), F.lit("\n  "), F.coalesce("interpretation", F.lit("")))


def alert_digest(rows: DataFrame, date_col: str = "arrival_date_local") -> DataFrame:
    """One message per day: a subject that names the HIGH markets, and a text
    of header, two lines per market (sorted) and footer.

    The group is the markets of one day, so it is bounded by the market
    dimension, not by the fact data.
    """
    lines = F.array_sort(F.collect_list(F.struct(F.col("market"), digest_line().alias("line"))))
    high = F.array_sort(F.collect_list(F.when(F.col("demand_pressure") == "HIGH", F.col("market"))))
    g = rows.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("markets"), high.alias("_high"), lines.alias("_lines"))
    body = F.array_join(F.transform("_lines", lambda s: s["line"]), "\n")
    day = F.col(date_col).cast("string")
    subject = F.concat(F.lit("Demand signals "), day, F.lit(": "),
                       F.when(F.size("_high") > 0, F.concat(F.lit("HIGH in "), F.array_join("_high", ", ")))
                       .otherwise(F.lit("no HIGH market")))
    text = F.concat(F.lit("Demand signals for "), day, F.lit("\n"), body, F.lit("\n"), F.lit(S.DIGEST_FOOTER))
    return g.select(date_col, "markets", F.size("_high").cast("long").alias("high_markets"),
                    subject.alias("subject"), text.alias("digest"))


#: What is kept of a digest that was sent: its day and a hash of its content.
OUTBOX = "arrival_date_local date, content string, sent_at timestamp"


def _content():
    return F.sha2(F.concat_ws("\n", "subject", "digest").cast("binary"), 256)


def sent_rows(digests: DataFrame) -> DataFrame:
    return digests.select("arrival_date_local", _content().alias("content"), F.current_timestamp().alias("sent_at"))


def unsent(digests: DataFrame, sent: DataFrame) -> DataFrame:
    """The digests that the outbox does not hold with the same content: a day
    is told again only if what is said about it has changed. (Day, content) is
    one row per day, so both sides are small."""
    known = sent.select(F.col("arrival_date_local").alias("_day"), F.col("content").alias("_content"))
    own = digests.withColumn("_own", _content())
    same = own["arrival_date_local"].eqNullSafe(known["_day"]) & (own["_own"] == known["_content"])
    return own.join(known, same, "left_anti").drop("_own")


def top_recent(mart: DataFrame, n: int = 10) -> DataFrame:
    """Most recent market-days first (top-n: TakeOrderedAndProject, one
    partial top-n per task, no full sort)."""
    return (mart.orderBy(F.col("arrival_date_local").desc(), F.col("market"))
            .select(*S.RECENT_COLUMNS).limit(n))
