"""The marts as a graph of models with declared inputs.

A model names what it reads and how it is kept: a source (a table that is
there already), a view (staging: a persistent catalog view, so it is worked out
anew by whoever reads it) or a table (marts: a new version that the table is
pointed to when it is whole). `build` makes what a target needs, in the order of
its inputs, and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import schemas as S
from signalmart.plans import marts, medallion


@dataclass(frozen=True)
class Model:
    """`sql` (of a view) has a {name} for each input; `rows` (of a table) gets
    the inputs as DataFrames, in their order."""
    name: str
    kind: str  # source, view, table
    inputs: tuple[str, ...] = ()
    sql: str = ""
    rows: Callable[..., DataFrame] | None = field(default=None, compare=False)


def typed_sql(column: str, sql_type: str | None) -> str:
    """The cast of a raw string column, as `functions.columns.typed` has it."""
    if sql_type is None:
        return column
    if sql_type == "text:trim":
        return f"nullif(trim({column}), '') AS {column}"
    if sql_type == "text:blank":
        return f"nullif({column}, '') AS {column}"
    return f"CAST(nullif(trim({column}), '') AS {sql_type}) AS {column}"


def freshest_sql(source: str, types: dict, keys: list[str]) -> str:
    """Typed columns of the freshest extraction per key. A row_number that is
    filtered to 1 keeps one row per key and task before its shuffle."""
    kept = [c for c in types if c not in S.FRESHEST]
    order = ", ".join(f"{c} DESC" for c in S.FRESHEST)
    typed = ", ".join(typed_sql(c, t) for c, t in types.items())
    return (f"SELECT {', '.join(kept)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) AS rn FROM (SELECT {typed} FROM {source})) WHERE rn = 1")


MODELS = {m.name: m for m in (
    Model("raw_flights", "source"), Model("raw_weather", "source"),
    Model("seed_calendar_events", "source"), Model("seed_holidays", "source"),
    Model("stg_flights", "view", ("raw_flights",), freshest_sql("{raw_flights}", S.FLIGHTS_TYPES, S.FLIGHTS_KEY)),
    Model("stg_weather", "view", ("raw_weather",), freshest_sql("{raw_weather}", S.WEATHER_TYPES, S.WEATHER_KEY)),
    Model("mart_daily_signals", "table", ("stg_flights", "stg_weather", "seed_calendar_events", "seed_holidays"),
          rows=lambda f, w, c, h: marts.daily_signals(f, w, c, h, points_name="driver_points")),
    Model("mart_hourly_curve", "table", ("stg_flights",), rows=marts.hourly_curve),
    Model("mart_alerts", "table", ("mart_daily_signals",),
          rows=lambda m: m.filter(F.col("demand_pressure") == "HIGH").select(*S.ALERT_COLUMNS)),
)}


def order(targets: list[str], models: dict[str, Model] = MODELS) -> list[str]:
    """The targets and all they need, each behind its inputs."""
    out: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"models read each other: {' -> '.join([*path, name])}")
        if name not in models:
            raise ValueError(f"{name} is no model{f' ({path[-1]} reads it)' if path else ''}")
        if name not in out:
            for i in models[name].inputs:
                visit(i, (*path, name))
            out.append(name)

    for t in targets:
        visit(t, ())
    return out


def build(spark: SparkSession, targets: list[str], database: str, root: str,
          models: dict[str, Model] = MODELS) -> list[str]:
    """Build the targets and what they need in `database` (tables below
    `root`); the sources must be there. Returns what was built, in order."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/_db'")
    built, table = [], {name: f"{database}.{name}" for name in models}
    for name in order(targets, models):
        model = models[name]
        if model.kind == "source":
            if not spark.catalog.tableExists(table[name]):
                raise ValueError(f"source {table[name]} is not there")
            continue
        if model.kind == "view":
            spark.sql(f"CREATE OR REPLACE VIEW {table[name]} AS {model.sql.format(**table)}")
        else:
            medallion.swap_table(model.rows(*[spark.table(table[i]) for i in model.inputs]), table[name],
                                 f"{root.rstrip('/')}/{name}")
        built.append(name)
    return built
