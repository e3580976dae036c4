"""Per-entity, per-day (or per-hour) rollups.

All of them are hash aggregates with a partial (map-side) step, so a market
holding a third of all rows is reduced inside each map task before the
shuffle; what crosses the network is one row per (task, group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.functions.columns import exact_sum


def rollup_counts(df: DataFrame, keys: list[str], name: str = "arrivals") -> DataFrame:
    """count(*) per key tuple (daily arrivals, hourly curve, ...)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def daily_weather(df: DataFrame, keys=("market", "observed_date_local"),
                  date_alias: str | None = None) -> DataFrame:
    """Daily max/min temperature, precipitation total and max wind.

    Precipitation is summed as decimal(18,6), so the 1-dp total is the same
    whatever order partial sums arrive in; the rounded values are what the
    thresholds test (1.95 mm counts as 2 mm of rain).
    """
    out = df.groupBy(*keys).agg(
        F.max("temp_f").alias("temp_max_f"),
        F.min("temp_f").alias("temp_min_f"),
        F.round(exact_sum("precip_mm", 6), 1).cast("double").alias("precip_total_mm"),
        F.round(F.max("wind_kmh"), 1).alias("wind_max_kmh"),
    )
    if date_alias:
        out = out.withColumnRenamed(keys[-1], date_alias)
    return out


# Decomposable form of daily_weather, for rollups kept per partition of a
# table (e.g. per (day, key bucket)): partial results combine exactly, and
# rounding happens once, on the combined value.

def weather_partials(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.max("temp_f").alias("temp_max_f"),
        F.min("temp_f").alias("temp_min_f"),
        exact_sum("precip_mm", 6).alias("precip_sum"),
        F.max("wind_kmh").alias("wind_max"),
    )


def weather_from_partials(partials: DataFrame, keys) -> DataFrame:
    return partials.groupBy(*keys).agg(
        F.max("temp_max_f").alias("temp_max_f"),
        F.min("temp_min_f").alias("temp_min_f"),
        F.round(F.sum("precip_sum"), 1).cast("double").alias("precip_total_mm"),
        F.round(F.max("wind_max"), 1).alias("wind_max_kmh"),
    )


def counts_from_partials(partials: DataFrame, keys, name: str = "arrivals") -> DataFrame:
    return partials.groupBy(*keys).agg(F.sum(name).cast("long").alias(name))
