"""Calendar enrichment: market events and global holidays.

Calendars are dimensions: a few rows per market per year. The join is left to
the planner, whose broadcast threshold is a size check (exact for inline
VALUES tables, file size for seeds, runtime size under AQE); above it the
join is a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart import schemas as S

def guard_calendar(cal: DataFrame, keys: list[str], name_col: str = "event_name",
                   sep: str = S.CALENDAR_NAME_SEPARATOR) -> DataFrame:
    """One row per calendar key, so the join cannot fan out the fact grain.

    Names of events sharing a key are sorted and joined with `sep` (NULL
    names are skipped; all-NULL gives NULL, which the driver text shows as
    'unnamed'). The group is the events of one market-day: bounded by the
    calendar, never by the fact data.
    """
    names = F.array_sort(F.collect_list(name_col))
    return (cal.groupBy(*keys)
            .agg(names.alias("_names"))
            .select(*keys, F.when(F.size("_names") > 0, F.array_join("_names", sep))
                    .alias(name_col)))


def join_calendar(df: DataFrame, cal: DataFrame, on: dict[str, str], flag_name: str,
                  keep: list[str] = ()) -> DataFrame:
    """Left join `df` to `cal` on {fact column: calendar column} and add a
    0/1 match flag. Calendar key columns are typed before the join, so the
    condition is a plain equi-join on columns (no cast inside the key)."""
    right_keys = list(on.values())
    marker = f"_{flag_name}_hit"
    side = cal.select(*[F.col(c).alias(f"_k_{c}") for c in right_keys],
                      F.lit(1).alias(marker), *keep)
    cond = [F.col(l) == F.col(f"_k_{r}") for l, r in on.items()]
    joined = df.join(side, cond, "left")
    return (joined.withColumn(flag_name, F.coalesce(F.col(marker), F.lit(0)).cast("int"))
            .drop(marker, *[f"_k_{c}" for c in right_keys]))
