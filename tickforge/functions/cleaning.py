"""Cleaning and ingest expressions: null handling, lenient casts, stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the missing-value sentinel of the wide price files.
MISSING_SENTINEL = "#N/A N/A"
TICK_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SESSION_OPEN = "09:30:00"


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def normalized_symbol(s: Column) -> Column:
    """Case- and surrounding-space-insensitive symbol: TRIM and UPPER, as the table's own filter does."""
    return F.upper(F.trim(s))


def valid_price(p: Column) -> Column:
    """Tradeable price: not null, not NaN, > 0."""
    return p.isNotNull() & ~F.isnan(p) & (p > 0)


def sentinel_to_null(c: Column, sentinel: str = MISSING_SENTINEL) -> Column:
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(c)


def lenient_double(c: Column) -> Column:
    """String -> double; anything unparsable becomes null (never an error)."""
    return c.try_cast("double")


def parse_tick_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TICK_TIME_FORMAT))


def session_open_text(date_text: Column) -> Column:
    """Tick envelope time: '<date> 09:30:00'."""
    return F.concat(date_text, F.lit(" " + SESSION_OPEN))


def default_if_missing(x: Column, default: float) -> Column:
    """Null, NaN and 0 fall back to the default (Python ``x or d`` semantics)."""
    return F.coalesce(F.nullif(F.nanvl(x, F.lit(None).cast("double")), F.lit(0.0)), F.lit(float(default)))


def ingest_stamps(df: DataFrame, time_text: str = "timestamp") -> DataFrame:
    """processing_time (wall clock), event_time (parsed, now when missing)."""
    return df.withColumns({
        "processing_time": F.current_timestamp(),
        "event_time": F.coalesce(parse_tick_time(F.col(time_text)), F.current_timestamp()),
    })
