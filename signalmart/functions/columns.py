"""Column-level helpers. Each returns a built-in Spark expression, so they
stay inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalmart import schemas as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c, trim: bool = True) -> Column:
    """'' (or only spaces, with trim) -> NULL; other values kept."""
    c = col(c)
    return F.nullif(F.trim(c) if trim else c, F.lit(""))


# FIXED VALUE: white space of any kind (ASCII, control separators, Unicode).
WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]+"


def strip(c) -> Column:
    """Without the white space at either end."""
    return F.regexp_replace(col(c), f"^{WHITE}|{WHITE}$", "")


def clean_code(c) -> Column:
    """Strip and drop commas so the value is safe in a delimited file; NULL -> ''."""
    return F.replace(strip(F.coalesce(col(c), F.lit(""))), F.lit(","), F.lit(""))


def typed(c: str, sql_type: str | None, tolerant: bool = False) -> Column:
    """Cast a raw string column; `tolerant` turns malformed values into NULL.

    sql_type None keeps the text as is; "text:trim" trims and turns '' into
    NULL; "text:blank" only turns '' into NULL; anything else is a SQL type
    (blank -> NULL, then cast).
    """
    if sql_type is None:
        return F.col(c).alias(c)
    if sql_type == "text:trim":
        return blank_to_null(c).alias(c)
    if sql_type == "text:blank":
        return blank_to_null(c, trim=False).alias(c)
    src = F.nullif(F.trim(F.col(c)), F.lit(""))
    return (src.try_cast(sql_type) if tolerant else src.cast(sql_type)).alias(c)


def trunc_hour(ts) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour without touching the session zone."""
    ts = col(ts)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts),
                                F.hour(ts), F.lit(0), F.lit(0))


def epoch_to_utc(seconds) -> Column:
    """Unix seconds -> UTC wall clock as TIMESTAMP_NTZ (session-zone free)."""
    return F.timestamp_add("SECOND", col(seconds),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc_to_local(ts, tz) -> Column:
    """UTC wall clock (NTZ) -> wall clock in zone `tz` (a zone column or
    column name; wrap a fixed zone in F.lit)."""
    return F.convert_timezone(F.lit("UTC"), col(tz), col(ts))


def format_ts(ts, fmt: str = S.RAW_TS_FORMAT) -> Column:
    return F.date_format(col(ts), fmt)


def weekend_flag(date_col) -> Column:
    """1 on Saturday/Sunday. Spark numbers days 1=Sunday .. 7=Saturday."""
    return F.dayofweek(col(date_col)).isin(1, 7).cast("int")


def flag(predicate: Column) -> Column:
    """NULL-safe boolean -> 0/1 int (unknown counts as not fired)."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def exact_sum(c, scale: int, precision: int = 18) -> Column:
    """Sum a money-like double exactly (as decimal(precision, scale)), so the
    result does not depend on the order partial sums are combined in. The
    sum widens to decimal(precision + 10, scale)."""
    return F.sum(col(c).cast(f"decimal({precision},{scale})"))
