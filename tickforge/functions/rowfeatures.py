"""Row-level features: native column expressions only (no Python UDF).

Two families:

* *stateless* features of one tick (price transforms, symbol text, calendar,
  tiers, buckets) - the 35-field stateless record;
* *estimate* features: single-tick stand-ins for indicators (the 24-field
  estimate record), computed from the price alone.

All builders return ``dict[name, Column]`` so they can be applied with one
``withColumns`` / ``select`` and stay inside one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (thresholds and constants that define the features) ----
PRICE_CATEGORY_TIERS = [(50, "low"), (200, "medium"), (1000, "high")]          # else very_high
PRICE_CATEGORY_TOP = "very_high"
VOLATILITY_ESTIMATE_TIERS = [(100, 0.05), (500, 0.03), (2000, 0.02)]           # else 0.01
VOLATILITY_ESTIMATE_TOP = 0.01
PRICE_PERCENTILE_TIERS = [(100, "low"), (1000, "medium")]                      # else high
PRICE_PERCENTILE_TOP = "high"
VOLATILITY_10_TIERS = [(50, 0.05), (200, 0.03), (1000, 0.02), (5000, 0.015)]   # else 0.01
VOLATILITY_10_TOP = 0.01
SESSION_TIERS = [(12, "morning"), (17, "afternoon")]                           # else evening
SESSION_TOP = "evening"
SYMBOL_TYPES = [("Index", "index"), ("Comdty", "commodity")]                   # else other
SYMBOL_TYPE_OTHER = "other"
PRICE_BUCKETS = (10, 50, 100)
SMA_ESTIMATE_WINDOWS = (5, 10, 20)
EMA_ESTIMATE_WINDOWS = (12, 26)
LAG_ESTIMATE_OFFSETS = (1, 2, 5)
BB_ESTIMATE_VOL = (0.02, 0.015)          # below / from 1000
MACD_SIGNAL_FACTOR = 0.7
VOLATILITY_20_FACTOR = 0.9


def tiers(x: Column, table, top) -> Column:
    """``x < t1 -> v1, x < t2 -> v2, ... else top`` (strict ``<``)."""
    expr = None
    for bound, value in table:
        cond = x < F.lit(bound)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(top))


def price_transforms(p: Column) -> dict:
    """squared, sqrt, log (null for p <= 0), reciprocal (null for 0), x100,
    rounded (2 dp, half-up), ceiling/floor (as double), abs, sign."""
    return {
        "price_squared": p * p,
        "price_sqrt": F.sqrt(p),
        "price_log": F.when(p > 0, F.log(p)),
        "price_reciprocal": F.try_divide(F.lit(1.0), p),
        "price_percentage": p * F.lit(100.0),
        "price_rounded": F.round(p, 2),
        "price_ceiling": F.ceil(p).cast("double"),
        "price_floor": F.floor(p).cast("double"),
        "price_abs": F.abs(p),
        "price_sign": F.signum(p),
    }


def price_buckets(p: Column) -> dict:
    return {f"price_bucket_{k}": (F.floor(p / F.lit(float(k))) * F.lit(k)).cast("double")
            for k in PRICE_BUCKETS}


def symbol_text(s: Column) -> dict:
    return {
        "symbol_length": F.length(s),
        "symbol_upper": F.upper(s),
        "symbol_lower": F.lower(s),
    }


def symbol_type(s: Column) -> Column:
    expr = None
    for needle, label in SYMBOL_TYPES:
        cond = s.contains(needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(SYMBOL_TYPE_OTHER))


def symbol_signature(s: Column) -> Column:
    """"<length>_<count of Index>_<count of Comdty>" (non-overlapping counts)."""
    return F.concat_ws("_", F.length(s).cast("string"),
                       F.regexp_count(s, F.lit("Index")).cast("string"),
                       F.regexp_count(s, F.lit("Comdty")).cast("string"))


def symbol_hash_bucket(s: Column) -> Column:
    """abs(murmur3 hash) mod 1000 (Spark's hash)."""
    return F.abs(F.hash(s).cast("long")) % F.lit(1000)


def calendar(t: Column) -> dict:
    """Calendar parts of a timestamp; day_of_week 1 = Sunday, ISO week."""
    return {
        "date_year": F.year(t),
        "date_month": F.month(t),
        "date_day": F.dayofmonth(t),
        "date_hour": F.hour(t),
        "date_minute": F.minute(t),
        "date_second": F.second(t),
        "day_of_week": F.dayofweek(t),
        "day_of_year": F.dayofyear(t),
        "week_of_year": F.weekofyear(t),
        "quarter": F.quarter(t),
        "unix_timestamp": F.unix_timestamp(t),
    }


def is_weekday(t: Column) -> Column:
    """Monday..Friday (dayofweek 2..6)."""
    return F.dayofweek(t).between(2, 6)


def market_session(hour: Column) -> Column:
    return tiers(hour, SESSION_TIERS, SESSION_TOP)


def price_category(p: Column) -> Column:
    return tiers(p, PRICE_CATEGORY_TIERS, PRICE_CATEGORY_TOP)


def volatility_estimate(p: Column) -> Column:
    return tiers(p, VOLATILITY_ESTIMATE_TIERS, VOLATILITY_ESTIMATE_TOP)


def price_percentile(p: Column) -> Column:
    return tiers(p, PRICE_PERCENTILE_TIERS, PRICE_PERCENTILE_TOP)


def volatility_10_estimate(p: Column) -> Column:
    return tiers(p, VOLATILITY_10_TIERS, VOLATILITY_10_TOP)


STATELESS_RECORD = [
    "symbol", "current_price", "date", "processing_time",
    "price_squared", "price_sqrt", "price_log", "price_reciprocal", "price_percentage",
    "price_rounded", "price_ceiling", "price_floor", "price_abs", "price_sign",
    "symbol_length", "symbol_upper", "symbol_lower",
    "date_year", "date_month", "date_day", "date_hour", "date_minute", "date_second",
    "day_of_week", "day_of_year", "week_of_year", "quarter", "unix_timestamp",
    "price_bucket_10", "price_bucket_50", "price_bucket_100",
    "price_category", "symbol_type", "price_volatility_estimate", "market_session",
]


def stateless_features(price: str = "price", symbol: str = "symbol", event_time: str = "event_time") -> dict:
    """All stateless features of one tick, keyed by output name."""
    p, s, t = F.col(price), F.col(symbol), F.col(event_time)
    out = {"current_price": p}
    out.update(price_transforms(p))
    out.update(symbol_text(s))
    out.update(calendar(t))
    out.update(price_buckets(p))
    out["price_category"] = price_category(p)
    out["symbol_type"] = symbol_type(s)
    out["price_volatility_estimate"] = volatility_estimate(p)
    out["market_session"] = market_session(F.hour(t))
    return out


ESTIMATE_RECORD = [
    "symbol", "current_price", "date", "processing_time",
    "simple_return", "log_return", "sma_5", "sma_10", "sma_20", "ema_12", "ema_26",
    "macd_line", "macd_signal", "macd_histogram", "volatility_10", "volatility_20",
    "bb_upper", "bb_lower", "bb_position", "rsi", "lag_1", "lag_2", "lag_5", "price_percentile",
]


def cents_return(p: Column) -> Column:
    """((int(p * 100) mod 100) - 50) / 1000: a return-like number from the cents."""
    return (F.pmod((p * F.lit(100)).cast("long"), F.lit(100)) - F.lit(50)) / F.lit(1000.0)


def lag_estimate(p: Column, k: int) -> Column:
    return p + F.sin(p * F.lit(0.01) + F.lit(float(k))) * (p * F.lit(0.001))


def estimate_features(price: str = "price", symbol: str = "symbol") -> dict:
    """Single-tick indicator estimates (the estimate record)."""
    p, s = F.col(price), F.col(symbol)
    cycle = F.pmod(p, F.lit(100.0)) / F.lit(100.0)
    macd = F.sin(F.pmod(p + F.length(s), F.lit(30.0)) * F.lit(0.2)) * (p * F.lit(0.0001))
    vol10 = volatility_10_estimate(p)
    bb_vol = F.when(p < F.lit(1000), F.lit(BB_ESTIMATE_VOL[0])).otherwise(F.lit(BB_ESTIMATE_VOL[1]))
    out = {
        "current_price": p,
        "simple_return": cents_return(p),
        "log_return": F.when(p <= 0, F.lit(0.0)).otherwise(F.log(p) / F.lit(10.0)),
    }
    for k in SMA_ESTIMATE_WINDOWS:
        out[f"sma_{k}"] = p * F.lit(1.0 - k * 0.001)
    for k in EMA_ESTIMATE_WINDOWS:
        out[f"ema_{k}"] = p * (F.lit(1.0) - F.lit(float(k)) * cycle * F.lit(0.01))
    out["macd_line"] = macd
    out["macd_signal"] = macd * F.lit(MACD_SIGNAL_FACTOR)
    out["macd_histogram"] = macd - macd * F.lit(MACD_SIGNAL_FACTOR)
    out["volatility_10"] = vol10
    out["volatility_20"] = vol10 * F.lit(VOLATILITY_20_FACTOR)
    out["bb_upper"] = p * (F.lit(1.0) + F.lit(2.0) * bb_vol)
    out["bb_lower"] = p * (F.lit(1.0) - F.lit(2.0) * bb_vol)
    out["bb_position"] = F.greatest(F.lit(0.1), F.least(F.lit(0.9), F.pmod(p, F.lit(50.0)) / F.lit(50.0)))
    out["rsi"] = F.lit(30.0) + cycle * F.lit(40.0)
    for k in LAG_ESTIMATE_OFFSETS:
        out[f"lag_{k}"] = lag_estimate(p, k)
    out["price_percentile"] = price_percentile(p)
    return out


# ---- display formats ----
NA = "N/A"


def money(x: Column) -> Column:
    """$1,234.56 / $-1,847.99 (null -> N/A)."""
    return F.when(x.isNotNull() & ~F.isnan(x), F.concat(F.lit("$"), F.format_number(x, 2))).otherwise(F.lit(NA))


def fixed(x: Column, digits: int) -> Column:
    """Fixed decimals (null -> N/A)."""
    return F.when(x.isNotNull() & ~F.isnan(x), F.format_string(f"%.{digits}f", x)).otherwise(F.lit(NA))
