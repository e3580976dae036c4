"""Data-quality checks as DataFrames of (check, bad_rows, passed).

Every check is an aggregate over the table it guards, so a suite is one
union of small aggregates; nothing is collected until the caller asks
(`assert_passed`), and then only one row per check reaches the driver.
Shared inputs appear as identical subplans, which Spark executes once
(ReusedExchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmart import schemas as S


def _result(df: DataFrame, name: str, bad: Column) -> DataFrame:
    return df.agg(bad.cast("long").alias("bad_rows")).select(
        F.lit(name).alias("check"), F.col("bad_rows"),
        (F.col("bad_rows") == 0).alias("passed"))


def not_null(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """One pass over `df` counting NULLs in every listed column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = agg.unpivot([], columns, "column", "bad_rows")
    return long.select(
        F.concat(F.lit(f"{table}.not_null."), F.col("column")).alias("check"),
        F.col("bad_rows").cast("long").alias("bad_rows"),
        (F.col("bad_rows") == 0).alias("passed"))


def unique(df: DataFrame, keys: list[str], table: str, ignore_nulls: bool = False) -> DataFrame:
    """Number of key values that occur more than once (as column tests usually do: with
    ignore_nulls, rows with a NULL key are not tested)."""
    src = df
    if ignore_nulls:
        cond = None
        for k in keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        src = df.filter(cond)
    dupes = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return _result(dupes, f"{table}.unique.{'+'.join(keys)}", F.count(F.lit(1)))


def accepted_values(df: DataFrame, column: str, values: list[str], table: str) -> DataFrame:
    """Rows whose value is outside the set; NULL counts as bad."""
    bad = F.count_if(~F.coalesce(F.col(column).isin(*values), F.lit(False)))
    return _result(df, f"{table}.accepted.{column}", bad)


def warmup_window(mart: DataFrame, days: int = S.WARMUP_MIN_DAYS) -> DataFrame:
    """WARMUP exactly on each market's first `days` observed days."""
    w = Window.partitionBy("market").orderBy("arrival_date_local")
    ranked = mart.select("demand_pressure", F.row_number().over(w).alias("day_rank"))
    is_warm = F.coalesce(F.col("demand_pressure") == S.WARMUP_LABEL, F.lit(False))
    early = (F.col("day_rank") <= days) & ~is_warm
    late = (F.col("day_rank") > days) & is_warm
    return _result(ranked, "gold.warmup_first_days", F.count_if(early | late))


def driver_points_from_text(text: str | Column = "score_drivers") -> Column:
    """Sum of the '(+n)' markers in a drivers string."""
    t = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(t, F.lit(r"\(\+(\d+)\)"), 1)
    return F.aggregate(F.transform(found, lambda x: x.cast("int")), F.lit(0),
                       lambda acc, x: acc + x)


def reconcile_rows(mart: DataFrame, points: str = "driver_points") -> DataFrame:
    """Per market-day: score, sum of the points of the rules that fired (an
    array column of the gold table) and whether they agree (NULL on either
    side disagrees)."""
    pts = F.aggregate(F.col(points), F.lit(0), lambda acc, x: acc + x)
    return mart.select("daily_key", "pressure_score", pts.alias("driver_points"),
                       F.coalesce(F.col("pressure_score") == pts, F.lit(False))
                       .alias("reconciled"))


def reconcile(mart: DataFrame, points: str = "driver_points") -> DataFrame:
    rows = reconcile_rows(mart, points)
    return _result(rows, "gold.drivers_reconcile", F.count_if(~F.col("reconciled")))


def text_points(mart: DataFrame) -> DataFrame:
    """A report, not a check: rows whose drivers *text* reads as other points
    than the score (an event may have '(+3)' in its name)."""
    pts = driver_points_from_text("score_drivers")
    return mart.filter(~F.coalesce(F.col("pressure_score") == pts, F.lit(False))).select(
        "daily_key", "pressure_score", pts.alias("text_points"), "score_drivers")


def known_markets(df: DataFrame, markets: DataFrame, table: str) -> DataFrame:
    """Rows whose market is NULL or missing from the market dimension."""
    per = df.groupBy("market").agg(F.count(F.lit(1)).alias("n"))
    return _result(per.join(markets.select("market").distinct(), "market", "left_anti"),
                   f"{table}.known_market", F.coalesce(F.sum("n"), F.lit(0)))


def suite(checks: list[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def assert_passed(results: DataFrame) -> list:
    """Run the suite, print every check, raise once if any failed."""
    rows = results.collect()  # one row per check
    failed = [r for r in rows if not r["passed"]]
    for r in rows:
        print(("PASS " if r["passed"] else "FAIL ") + f"{r['check']} ({r['bad_rows']} bad)")
    if failed:
        raise AssertionError(f"{len(failed)} checks failed: {[r['check'] for r in failed]}")
    return rows
