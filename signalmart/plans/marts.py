"""The gold marts, composed from operators.

daily_signals(flights, weather, calendar, holidays): one row per
market-day with arrivals, trailing baseline, weather, calendar flags, the
rules score, label, drivers and interpretation.

Physical shape (see tests/test_plans.py):
  flights --WindowGroupLimit(partial)--> Exchange(natural key) --> dedupe
          --> HashAggregate(partial) --> Exchange(market, date) --> daily
  weather --(same)--> daily weather stats
  daily LEFT JOIN daily weather on (market, date): both sides are already
          hash-partitioned on that key, so the join adds no exchange
  LEFT JOIN calendars: broadcast when the planner finds them small enough
  Window(market) over daily rows (tiny: one row per market-day)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.functions.columns import weekend_flag
from signalmart.operators import rules as R
from signalmart.operators.baseline import pct_vs_baseline, trailing_baseline
from signalmart.operators.calendar import guard_calendar, join_calendar
from signalmart.operators.rollups import daily_weather, rollup_counts

DAY = ["market", "arrival_date_local"]


def daily_arrivals(flights: DataFrame) -> DataFrame:
    return rollup_counts(flights, DAY, "arrivals")


def weather_stats(weather: DataFrame) -> DataFrame:
    """Daily weather per market-day, keyed like the arrivals rollup."""
    return daily_weather(weather, ("market", "observed_date_local"),
                         date_alias="arrival_date_local")


def with_calendar(df: DataFrame, calendar: DataFrame, holidays: DataFrame,
                  guard: bool = True) -> DataFrame:
    """Event flag/name per market-day and the global holiday flag.

    guard=True collapses several events on one market-day into one row
    first, so the mart keeps its grain; guard=False is the plain left join
    (one output row per matching event).
    """
    cal = calendar.select("market", F.col("event_date").cast("date").alias("event_date"),
                          "event_name")
    if guard:
        cal = guard_calendar(cal, ["market", "event_date"], "event_name")
    hol = holidays.select(F.col("holiday_date").cast("date").alias("holiday_date")).distinct()
    out = join_calendar(df, cal, {"market": "market", "arrival_date_local": "event_date"},
                        "is_major_event", keep=["event_name"])
    return join_calendar(out, hol, {"arrival_date_local": "holiday_date"}, "is_holiday")


def scored(df: DataFrame, rules: list[R.Rule] | None = None,
           points_name: str | None = None) -> DataFrame:
    """Baseline, deviation, flags, score, label, drivers, interpretation."""
    rules = rules or R.demand_rules()
    out = trailing_baseline(df, ["market"], "arrival_date_local", "arrivals")
    out = out.withColumns({
        "arrivals_vs_7day_avg_pct": pct_vs_baseline("arrivals", "trailing_7day_avg"),
        "is_weekend": weekend_flag("arrival_date_local"),
    })
    out = R.with_flags(out, R.weather_flag_predicates())
    out = R.score(out, rules)
    out = R.label(out, warmup=R.warmup_condition())
    out = R.drivers(out, rules, points_name=points_name)
    return R.interpret(out)


def finish(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Output projection: surrogate key (NULL if market is NULL) + fixed order."""
    key = F.concat(F.col("market"), F.lit(S.KEY_SEPARATOR),
                   F.col("arrival_date_local").cast("string"))
    return (df.withColumn("daily_key", key)
            .withColumn("trailing_7day_avg", F.round("trailing_7day_avg", 1))
            .select(*S.DAILY_COLUMNS, *extra))


def daily_signals(flights: DataFrame, weather: DataFrame, calendar: DataFrame,
                  holidays: DataFrame, rules: list[R.Rule] | None = None,
                  points_name: str | None = None, keep_window: bool = False) -> DataFrame:
    return signals_from_rollups(daily_arrivals(flights), weather_stats(weather), calendar,
                                holidays, rules, points_name, keep_window)


def signals_from_rollups(daily: DataFrame, wx_stats: DataFrame, calendar: DataFrame,
                         holidays: DataFrame, rules: list[R.Rule] | None = None,
                         points_name: str | None = None, keep_window: bool = False) -> DataFrame:
    """The mart from the two daily rollups (arrivals; weather stats), each
    one row per market-day. Everything from here on runs on the daily grain,
    so an incremental job only has to keep the rollups current."""
    daily = daily.select(*DAY, "arrivals").join(
        wx_stats.select(*DAY, "temp_max_f", "temp_min_f", "precip_total_mm", "wind_max_kmh"),
        DAY, "left")
    daily = with_calendar(daily, calendar, holidays)
    out = scored(daily, rules, points_name)
    extra = ([points_name] if points_name else []) + (["days_in_window"] if keep_window else [])
    return finish(out, extra)


def hourly_curve(flights: DataFrame) -> DataFrame:
    return rollup_counts(flights, ["market", "arrival_date_local", "arrival_hour_local"],
                         "arrivals").select(*S.HOURLY_COLUMNS)
