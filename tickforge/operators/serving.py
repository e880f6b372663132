"""Serving queries over a predictions / feature table.

All per-symbol results are computed for every symbol at once; per-symbol
limits use ``row_number() <= k`` which Spark plans as a two-phase
``WindowGroupLimit`` (a partial top-k runs before the shuffle, so a hot
symbol sends at most k rows per task).  Callers cut the raw ticks to what the
newest rows depend on (``indicators.newest``) before they compute features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cleaning import normalized_symbol
from ..functions.rowfeatures import NA, fixed, money
from ..functions.signals import macd_color, rsi_color, signal_color, signal_glyph

DASHBOARD_ROWS = 100     # rows per symbol in the chart
RECENT_ROWS = 10         # rows per symbol in the recent table


def symbol_directory(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Distinct raw symbols with their normalised form, sorted."""
    return (df.select(F.col(symbol).alias("symbol")).distinct()
            .withColumn("symbol_norm", normalized_symbol(F.col("symbol")))
            .orderBy("symbol"))


def requested_symbols(spark: SparkSession, df: DataFrame, requested: list, symbol: str = "symbol") -> DataFrame:
    """Membership of user-requested symbols (case / space insensitive).

    The request list is a parameter (bounded by what a user types) and is
    broadcast; the directory side is a distinct aggregate of the table.
    """
    req = spark.createDataFrame([(r,) for r in requested], "requested string") \
        .withColumn("symbol_norm", normalized_symbol(F.col("requested")))
    known = df.select(normalized_symbol(F.col(symbol)).alias("symbol_norm")).distinct() \
        .withColumn("found", F.lit(True))
    return (known.join(F.broadcast(req), "symbol_norm", "right")
            .select("requested", "symbol_norm", F.coalesce("found", F.lit(False)).alias("found")))


def for_symbol(df: DataFrame, symbol: str, normalized: bool = False) -> DataFrame:
    """Rows of one symbol (filter ahead of any series operator; the tick
    adapter's symbol is computed, so it is not pushed into the parquet scan)."""
    if normalized:
        return df.filter(normalized_symbol(F.col("symbol")) == F.lit(symbol.strip().upper()))
    return df.filter(F.col("symbol") == F.lit(symbol))


def latest_per_symbol(df: DataFrame, k: int = DASHBOARD_ROWS, order=("ts", "event_id"),
                      keys=("symbol",)) -> DataFrame:
    """The k newest rows of every symbol (``rank_desc`` 1 = newest)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("rank_desc", F.row_number().over(w)).filter(F.col("rank_desc") <= k)


def latest_snapshot(df: DataFrame, order=("ts", "event_id"), keys=("symbol",)) -> DataFrame:
    """Newest row per symbol plus KPI status colours."""
    newest = latest_per_symbol(df, 1, order, keys).drop("rank_desc")
    extra = {
        "rsi_color": rsi_color(F.col("rsi_14")),
        "macd_color": macd_color(F.col("macd_line")),
    }
    return newest.withColumns(extra)


def recent_table(df: DataFrame, k: int = RECENT_ROWS, order=("ts", "event_id")) -> DataFrame:
    """Last k rows per symbol with display formatting (absent columns skipped)."""
    t = latest_per_symbol(df, k, order)
    fmt = {
        "current_price": lambda c: money(c),
        "rsi_14": lambda c: fixed(c, 1),
        "macd_line": lambda c: fixed(c, 4),
        "volatility_20": lambda c: fixed(c, 3),
    }
    shown = [c for c in ["current_price", "rsi_14", "macd_line", "volatility_20",
                         "XGBoost", "RandomForest", "RSI_Rule", "MACD_Rule"] if c in df.columns]
    sel = ["symbol", *order, "rank_desc"]
    return t.select(*sel, *[(fmt[c](F.col(c)) if c in fmt else F.col(c)).alias(c) for c in shown])


def chart_series(df: DataFrame, series: list, order=("ts", "event_id")) -> DataFrame:
    """Long (symbol, time, series, value) rows; each series keeps only its non-null points."""
    present = [c for c in series if c in df.columns]
    long = df.unpivot(["symbol", *order], present, "series", "value")
    return long.filter(F.col("value").isNotNull())


def signal_badges(df: DataFrame, signals: list) -> DataFrame:
    """Per row and signal column: label, colour and glyph."""
    present = [c for c in signals if c in df.columns]
    long = df.unpivot(["symbol", "ts", "event_id"], present, "signal", "label")
    return long.withColumns({"color": signal_color(F.col("label")), "glyph": signal_glyph(F.col("label"))})


def head(df: DataFrame, n: int = 5, order=("ts", "event_id")) -> DataFrame:
    """First n rows in order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


__all__ = ["NA", "symbol_directory", "requested_symbols", "for_symbol", "latest_per_symbol",
           "latest_snapshot", "recent_table", "chart_series", "signal_badges", "head"]
