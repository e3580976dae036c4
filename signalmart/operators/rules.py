"""Rules as data: one list of rules yields the score, the driver text, the
per-rule points and (with bands) the label.

A Rule belongs to a *ladder*; within a ladder the first rule whose condition
holds wins (arrivals >=20 before >=10, heat before rain). The score is the
sum over ladders; the drivers are the texts of the winning rules joined with
'; ' (a silent ladder is NULL and simply skipped by concat_ws).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.functions.columns import flag


@dataclass(frozen=True)
class Rule:
    ladder: str
    when: Column
    points: int
    text: Column


def fill(template: str, **values) -> Column:
    """'event: {name} (+2)' with name=<Column> -> concat(lit, col, lit)."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            if piece:
                parts.append(F.lit(piece))
        else:
            v = values[piece]
            parts.append(v.cast("string") if isinstance(v, Column) else F.lit(str(v)))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _ladders(rules: list[Rule]) -> dict[str, list[Rule]]:
    out: dict[str, list[Rule]] = {}
    for r in rules:
        out.setdefault(r.ladder, []).append(r)
    return out


def _first_match(rules: list[Rule], value) -> Column:
    expr = None
    for r in rules:
        cond = F.coalesce(r.when, F.lit(False))
        v = value(r)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


def ladder_points(rules: list[Rule]) -> dict[str, Column]:
    return {name: _first_match(rs, lambda r: F.lit(r.points)).otherwise(F.lit(0))
            for name, rs in _ladders(rules).items()}


def score(df: DataFrame, rules: list[Rule], name: str = "pressure_score") -> DataFrame:
    total = None
    for pts in ladder_points(rules).values():
        total = pts if total is None else total + pts
    return df.withColumn(name, total.cast("int"))


def driver_text(rules: list[Rule], sep: str = S.DRIVER_SEPARATOR,
                empty: str = S.NO_DRIVERS) -> Column:
    texts = [_first_match(rs, lambda r: r.text) for rs in _ladders(rules).values()]
    joined = F.concat_ws(sep, *texts)
    return F.when(joined == "", F.lit(empty)).otherwise(joined)


def driver_points(rules: list[Rule]) -> Column:
    """array<int> of the points each fired ladder contributed (structural
    reconciliation; immune to rule texts that contain '(+n)')."""
    pts = [_first_match(rs, lambda r: F.lit(r.points)) for rs in _ladders(rules).values()]
    return F.filter(F.array(*pts), lambda x: x.isNotNull())


def drivers(df: DataFrame, rules: list[Rule], name: str = "score_drivers",
            points_name: str | None = None) -> DataFrame:
    out = df.withColumn(name, driver_text(rules))
    if points_name:
        out = out.withColumn(points_name, driver_points(rules))
    return out


def label(df: DataFrame, score_col: str = "pressure_score",
          bands: list[tuple[int, str]] = tuple(S.BANDS), default: str = S.DEFAULT_BAND,
          warmup: Column | None = None, warmup_label: str = S.WARMUP_LABEL,
          name: str = "demand_pressure") -> DataFrame:
    """Ordered (min_score, label) bands; `warmup` (a condition) overrides."""
    expr = F.when(warmup, F.lit(warmup_label)) if warmup is not None else None
    for lo, lab in bands:
        cond = F.col(score_col) >= lo
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return df.withColumn(name, expr.otherwise(F.lit(default)))


def interpret(df: DataFrame, label_col: str = "demand_pressure",
              mapping: dict[str, str] = None, name: str = "interpretation") -> DataFrame:
    """Label -> sentence via a literal map (constant-folded, no join)."""
    mapping = mapping or S.INTERPRETATIONS
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(name, F.element_at(m, F.col(label_col)))


def with_flags(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Add 0/1 int flags; an unknown (NULL) predicate counts as 0."""
    return df.withColumns({k: flag(v) for k, v in flags.items()})


# ---------------------------------------------------------------------------
# The demand-pressure rule set
# ---------------------------------------------------------------------------

def weather_flag_predicates(temp_max: str = "temp_max_f",
                            precip: str = "precip_total_mm") -> dict[str, Column]:
    p = F.coalesce(F.col(precip), F.lit(0.0))
    lo, hi = S.POOL_TEMP_RANGE_F
    return {
        "is_extreme_heat": F.col(temp_max) >= S.HEAT_MIN_F,
        "is_pool_weather": F.col(temp_max).between(lo, hi) & (p < S.POOL_MAX_PRECIP_MM),
        "is_rain": p >= S.RAIN_MIN_MM,
    }


def demand_rules(pct: str = "arrivals_vs_7day_avg_pct") -> list[Rule]:
    rules = [Rule("arrivals", F.col(pct) >= lo, pts,
                  fill(S.ARRIVALS_TEXT, pct=F.col(pct), points=pts))
             for lo, pts in S.ARRIVALS_LADDER]
    rules += [
        Rule("weekend", F.col("is_weekend") == 1, S.WEEKEND_POINTS, F.lit(S.WEEKEND_TEXT)),
        Rule("holiday", F.col("is_holiday") == 1, S.HOLIDAY_POINTS, F.lit(S.HOLIDAY_TEXT)),
        Rule("event", F.col("is_major_event") == 1, S.EVENT_POINTS,
             fill(S.EVENT_TEXT, name=F.coalesce(F.col("event_name"), F.lit(S.UNNAMED_EVENT)))),
        Rule("weather", F.col("is_extreme_heat") == 1, S.WEATHER_POINTS, F.lit(S.HEAT_TEXT)),
        Rule("weather", F.col("is_rain") == 1, S.WEATHER_POINTS, F.lit(S.RAIN_TEXT)),
    ]
    return rules


def warmup_condition(days: str = "days_in_window") -> Column:
    return F.col(days) < S.WARMUP_MIN_DAYS
