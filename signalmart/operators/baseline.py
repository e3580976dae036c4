"""Trailing baseline over *observed* days and the deviation from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmart import schemas as S


def trailing_baseline(df: DataFrame, part: list[str], order: str, value: str,
                      n: int = S.TRAILING_DAYS, avg_name: str = "trailing_7day_avg",
                      count_name: str = "days_in_window") -> DataFrame:
    """Average and count of `value` over the previous `n` rows per partition.

    ROWS n PRECEDING .. 1 PRECEDING: the current row is excluded and the
    frame counts rows (observed days), not calendar days, so a gap in the
    data reaches further back. Both functions share one window spec, so the
    plan has one Exchange, one Sort and one Window node. The input is
    already one row per entity-day, so a partition holds at most the
    number of days of one entity.
    """
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(-n, -1)
    return (df.withColumn(avg_name, F.avg(value).over(w))
            .withColumn(count_name, F.count(value).over(w)))


def pct_vs_baseline(value: str | Column, baseline: str | Column) -> Column:
    """round((v - b) / b * 100, 1) only when b > 0, else NULL.

    Computed on the unrounded baseline; thresholds later test the rounded
    result, so 19.95 becomes 20.0 and scores like 20.
    """
    v = F.col(value) if isinstance(value, str) else value
    b = F.col(baseline) if isinstance(baseline, str) else baseline
    return F.when(b > 0, F.round((v - b) / b * 100, 1))
