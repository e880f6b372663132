"""Up/down signals: rule signals on indicators, stand-in rules on the
stateless record, label helpers and dashboard status bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import default_if_missing

UP, DOWN, NEUTRAL, TRAINING = "UP", "DOWN", "NEUTRAL", "TRAINING"

# Rule names and their defaults for missing inputs.
RULE_SIGNALS = ["RSI_Rule", "MACD_Rule", "Momentum_Rule", "PriceChange_Rule", "BB_Rule"]
MODEL_SIGNALS = ["XGBoost", "RandomForest", "AdaBoost", "LogisticReg"]
STATELESS_SIGNALS = ["PriceMovement", "XGBoost", "AdaBoost", "RandomForest", "LogisticReg"]
RSI_DEFAULT, ZERO_DEFAULT, PRICE_DEFAULT = 50.0, 0.0, 100.0
RSI_THRESHOLD = 50.0
# Dashboard status bands: RSI above 70 / below 30, colours and glyphs.
RSI_HIGH, RSI_LOW = 70.0, 30.0
COLOR_UP, COLOR_DOWN, COLOR_OTHER = "#00FF00", "#FF0000", "#FFFF00"
GLYPH_UP, GLYPH_DOWN, GLYPH_OTHER = "▲", "▼", "●"


def up_down(cond: Column) -> Column:
    return F.when(cond, F.lit(UP)).otherwise(F.lit(DOWN))


def _nan_to_null(x: Column) -> Column:
    return F.nanvl(x, F.lit(None).cast("double"))


def rule_signals(rsi="rsi_14", macd="macd_line", momentum="momentum_10",
                 change_pct="price_change_pct", price="current_price",
                 bb_upper="bb_upper", bb_lower="bb_lower") -> dict:
    p = default_if_missing(F.col(price), PRICE_DEFAULT)
    up, lo = _nan_to_null(F.col(bb_upper)), _nan_to_null(F.col(bb_lower))
    bb = (F.when(up.isNull() | lo.isNull(), F.lit(NEUTRAL))
          .when(p > up, F.lit(DOWN))
          .when(p < lo, F.lit(UP))
          .otherwise(F.lit(NEUTRAL)))
    return {
        "RSI_Rule": up_down(default_if_missing(F.col(rsi), RSI_DEFAULT) > F.lit(RSI_THRESHOLD)),
        "MACD_Rule": up_down(default_if_missing(F.col(macd), ZERO_DEFAULT) > 0),
        "Momentum_Rule": up_down(default_if_missing(F.col(momentum), ZERO_DEFAULT) > 0),
        "PriceChange_Rule": up_down(default_if_missing(F.col(change_pct), ZERO_DEFAULT) > 0),
        "BB_Rule": bb,
    }


def stateless_signals() -> dict:
    """Stand-in rules over the stateless feature record (names as published)."""
    return {
        "PriceMovement": up_down(F.col("current_price") > F.col("price_bucket_50")),
        "XGBoost": up_down((F.col("price_log") > F.lit(5.0)) & (F.col("price_volatility_estimate") < F.lit(0.03))),
        "AdaBoost": up_down(F.col("price_category").isin("high", "very_high")),
        "RandomForest": up_down((F.col("symbol_type") == F.lit("index")) & (F.col("market_session") == F.lit("morning"))),
        # dayofweek 1..5 is Sunday..Thursday; kept as published
        "LogisticReg": up_down(F.col("day_of_week").isin(1, 2, 3, 4, 5)),
    }


def class_label(code: Column) -> Column:
    """1 -> UP, anything else -> DOWN."""
    return up_down(code == F.lit(1))


def training_gate(ready: Column, label: Column) -> Column:
    return F.when(ready, label).otherwise(F.lit(TRAINING))


def rsi_color(rsi: Column) -> Column:
    return (F.when(rsi.isNull() | F.isnan(rsi), F.lit(None))
            .when(rsi > F.lit(RSI_HIGH), F.lit(COLOR_UP))
            .when(rsi < F.lit(RSI_LOW), F.lit(COLOR_DOWN))
            .otherwise(F.lit(COLOR_OTHER)))


def macd_color(macd: Column) -> Column:
    return (F.when(macd.isNull() | F.isnan(macd), F.lit(None))
            .when(macd > 0, F.lit(COLOR_UP)).otherwise(F.lit(COLOR_DOWN)))


def signal_color(sig: Column) -> Column:
    return F.when(sig == F.lit(UP), F.lit(COLOR_UP)).when(sig == F.lit(DOWN), F.lit(COLOR_DOWN)).otherwise(F.lit(COLOR_OTHER))


def signal_glyph(sig: Column) -> Column:
    return F.when(sig == F.lit(UP), F.lit(GLYPH_UP)).when(sig == F.lit(DOWN), F.lit(GLYPH_DOWN)).otherwise(F.lit(GLYPH_OTHER))
