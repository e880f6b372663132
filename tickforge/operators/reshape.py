"""Wide price table -> clean long series (unpivot, sentinel, lenient cast, dropna)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import MISSING_SENTINEL, lenient_double, sentinel_to_null


def unpivot_clean(wide: DataFrame, id_cols: list, date_col: str = "Dates",
                  value_cols: list | None = None, sentinel: str = MISSING_SENTINEL,
                  date_format: str | None = None) -> DataFrame:
    """Unpivot + sentinel/lenient parsing, nulls kept (see ``wide_to_long``)."""
    ids = [date_col] + [c for c in id_cols if c != date_col]
    values = value_cols or [c for c in wide.columns if c not in ids]
    # every value column as string so the unpivot has one value type
    w = wide.select(*ids, *[F.col(c).cast("string").alias(c) for c in values])
    long = w.unpivot(ids, values, "symbol", "price")
    date = (F.try_to_date(F.col(date_col), F.lit(date_format)) if date_format
            else F.col(date_col).cast("string").try_cast("date"))
    return long.select(
        date.alias("date"),
        *[F.col(c) for c in ids if c != date_col],
        F.col("symbol"),
        lenient_double(sentinel_to_null(F.col("price"), sentinel)).alias("price"),
    )


def wide_to_long(wide: DataFrame, id_cols: list, date_col: str = "Dates",
                 value_cols: list | None = None, sentinel: str = MISSING_SENTINEL,
                 date_format: str | None = None) -> DataFrame:
    """One row per (id..., symbol) with a parsable price.

    ``date_col`` is renamed to ``date`` and parsed; the sentinel and
    unparsable prices become null and rows with any null are dropped.
    Output: date, other id columns, symbol, price (double).
    """
    return unpivot_clean(wide, id_cols, date_col, value_cols, sentinel, date_format).na.drop("any")
