"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Conventions shared with the Spark side: doubles rounded to 6 decimals
(equity-sized values to 4), timestamps left as TIMESTAMP, ints cast to the
Spark type.  The oracle always uses the plain per-key window; run
``tools/compare.py`` with CHUNK_ROWS=120 to compare the chunked plan with it.
"""

from __future__ import annotations

# Fixed values of the tick adapter (same as sources.tables.MARKET_SUFFIXES).
TICKS_CTE = """ticks AS (
  SELECT upper(event_type) || ' ' || CASE user_id % 3 WHEN 0 THEN 'Index' WHEN 1 THEN 'Comdty' ELSE 'Spot' END AS symbol,
         value AS price, ts, event_id, CAST(ts AS DATE) AS date
  FROM events)"""

W = "PARTITION BY symbol ORDER BY ts, event_id"


def over(frame: int | None = None, spec: str = W) -> str:
    if frame is None:
        return f"OVER ({spec})"
    return f"OVER ({spec} ROWS BETWEEN {frame} PRECEDING AND CURRENT ROW)"


def r6(x: str) -> str:
    return f"round({x}, 6)"


# indicator record over a CTE named `src` (symbol, ts, event_id, price)
def indicators_cte(src: str = "ticks", name: str = "ind") -> str:
    a12, a26, a9 = 2.0 / 13, 2.0 / 27, 2.0 / 10
    fold = (
        "list_reduce(h[2:], lambda acc, x: {"
        "'k': acc.k + 1, "
        f"'fast': {a12!r}::double * x + {1 - a12!r}::double * acc.fast, "
        f"'slow': {a26!r}::double * x + {1 - a26!r}::double * acc.slow, "
        "'sig': CASE WHEN acc.k + 1 = greatest(27, len(h) - 49) "
        f"THEN ({a12!r}::double * x + {1 - a12!r}::double * acc.fast) - ({a26!r}::double * x + {1 - a26!r}::double * acc.slow) "
        "WHEN acc.k + 1 > greatest(27, len(h) - 49) "
        f"THEN {a9!r}::double * (({a12!r}::double * x + {1 - a12!r}::double * acc.fast) - ({a26!r}::double * x + {1 - a26!r}::double * acc.slow)) + {1 - a9!r}::double * acc.sig "
        "ELSE NULL END}, "
        "{'k': 1, 'fast': h[1], 'slow': h[1], 'sig': NULL::double})"
    )
    return f"""{name}_b AS (
  SELECT symbol, ts, event_id, price,
         count(*) {over(99)} AS n,
         list(price) {over(99)} AS h,
         avg(price) {over(4)} AS s5, avg(price) {over(9)} AS s10, avg(price) {over(19)} AS s20,
         stddev_pop(price) {over(19)} AS sd20,
         lag(price, 1) {over()} AS l1, lag(price, 2) {over()} AS l2, lag(price, 5) {over()} AS l5,
         lag(price, 9) {over()} AS l9,
         row_number() {over()} AS rn
  FROM {src}),
{name}_c AS (
  SELECT *, price - l1 AS d, CASE WHEN l1 <> 0 THEN (price - l1) / l1 END AS r FROM {name}_b),
{name}_d AS (
  SELECT *,
         sum(CASE WHEN d > 0 THEN d ELSE 0.0::double END) {over(13)} AS g,
         sum(CASE WHEN d < 0 THEN -d ELSE 0.0::double END) {over(13)} AS lo,
         stddev_pop(r) {over(18)} AS v
  FROM {name}_c),
{name}_e AS (
  SELECT *, {fold} AS f FROM {name}_d WHERE rn >= 5),
{name} AS (
  SELECT symbol, ts, event_id, price AS current_price, rn AS tick_number,
         s5 AS sma_5,
         CASE WHEN n >= 10 THEN s10 END AS sma_10,
         CASE WHEN n >= 20 THEN s20 END AS sma_20,
         CASE WHEN n >= 12 THEN f.fast END AS ema_12,
         CASE WHEN n >= 26 THEN f.slow END AS ema_26,
         CASE WHEN n >= 15 THEN (CASE WHEN lo / 14.0::double = 0 THEN 100.0::double
              ELSE 100.0::double - 100.0::double / (1.0::double + (g / 14.0::double) / (lo / 14.0::double)) END) END AS rsi_14,
         CASE WHEN n >= 26 THEN f.fast - f.slow END AS macd_line,
         CASE WHEN n >= 35 THEN f.sig END AS macd_signal,
         CASE WHEN n >= 35 THEN (f.fast - f.slow) - f.sig END AS macd_histogram,
         CASE WHEN n >= 20 THEN s20 + 2.0::double * sd20 END AS bb_upper,
         CASE WHEN n >= 20 THEN s20 END AS bb_middle,
         CASE WHEN n >= 20 THEN s20 - 2.0::double * sd20 END AS bb_lower,
         CASE WHEN n >= 20 THEN v * sqrt(252.0::double) END AS volatility_20,
         CASE WHEN n >= 10 AND l9 <> 0 THEN (price - l9) / l9 END AS momentum_10,
         price - l1 AS price_change,
         CASE WHEN l1 <> 0 THEN (price - l1) / l1 * 100.0::double END AS price_change_pct,
         l1 AS lag_1, l2 AS lag_2, l5 AS lag_5
  FROM {name}_e)"""


INDICATOR_COLUMNS = [
    "sma_5", "sma_10", "sma_20", "ema_12", "ema_26", "rsi_14",
    "macd_line", "macd_signal", "macd_histogram",
    "bb_upper", "bb_middle", "bb_lower", "volatility_20", "momentum_10",
    "price_change", "price_change_pct", "lag_1", "lag_2", "lag_5",
]


def rounded(cols, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


ORACLES: dict[str, str] = {}

ORACLES["indicators_full"] = f"""
WITH {TICKS_CTE},
{indicators_cte()}
SELECT symbol, ts, event_id, tick_number, round(current_price, 6) AS current_price,
       {rounded(INDICATOR_COLUMNS)}
FROM ind
"""


# ------------------------------------------------------------------ helpers
def d(x) -> str:
    """A double literal."""
    return f"{float(x)!r}::double"


def tiers_sql(x: str, table, top) -> str:
    parts = " ".join(f"WHEN {x} < {b} THEN {v!r}" if isinstance(v, str) else f"WHEN {x} < {b} THEN {d(v)}"
                     for b, v in table)
    t = repr(top) if isinstance(top, str) else d(top)
    return f"CASE {parts} ELSE {t} END"


CAT = tiers_sql("price", [(50, "low"), (200, "medium"), (1000, "high")], "very_high")
VOLEST = tiers_sql("price", [(100, 0.05), (500, 0.03), (2000, 0.02)], 0.01)
PCTL = tiers_sql("price", [(100, "low"), (1000, "medium")], "high")
VOL10 = tiers_sql("price", [(50, 0.05), (200, 0.03), (1000, 0.02), (5000, 0.015)], 0.01)
SESSION = "CASE WHEN hour(ts) < 12 THEN 'morning' WHEN hour(ts) < 17 THEN 'afternoon' ELSE 'evening' END"
SYMTYPE = ("CASE WHEN contains(symbol, 'Index') THEN 'index' WHEN contains(symbol, 'Comdty') THEN 'commodity' "
           "ELSE 'other' END")
NORM = "upper(trim(symbol))"

PRICE_TRANSFORMS = {
    "price_squared": "price * price",
    "price_sqrt": "sqrt(price)",
    "price_log": "CASE WHEN price > 0 THEN ln(price) END",
    "price_reciprocal": f"CASE WHEN price <> 0 THEN {d(1)} / price END",
    "price_percentage": f"price * {d(100)}",
    "price_rounded": "round(price, 2)",
    "price_ceiling": "CAST(ceil(price) AS DOUBLE)",
    "price_floor": "CAST(floor(price) AS DOUBLE)",
    "price_abs": "abs(price)",
    "price_sign": "CAST(sign(price) AS DOUBLE)",
}
BUCKETS = {f"price_bucket_{k}": f"CAST(floor(price / {d(k)}) * {k} AS DOUBLE)" for k in (10, 50, 100)}
CALENDAR = {
    "date_year": "CAST(year(ts) AS INTEGER)",
    "date_month": "CAST(month(ts) AS INTEGER)",
    "date_day": "CAST(day(ts) AS INTEGER)",
    "date_hour": "CAST(hour(ts) AS INTEGER)",
    "date_minute": "CAST(minute(ts) AS INTEGER)",
    "date_second": "CAST(second(ts) AS INTEGER)",
    "day_of_week": "CAST(dayofweek(ts) + 1 AS INTEGER)",
    "day_of_year": "CAST(dayofyear(ts) AS INTEGER)",
    "week_of_year": "CAST(weekofyear(ts) AS INTEGER)",
    "quarter": "CAST(quarter(ts) AS INTEGER)",
    "unix_timestamp": "CAST(floor(epoch(ts)) AS BIGINT)",
}
SYMBOL_TEXT = {
    "symbol_length": "CAST(length(symbol) AS INTEGER)",
    "symbol_upper": "upper(symbol)",
    "symbol_lower": "lower(symbol)",
}


def sel(cols: dict, digits: int | None = 6) -> str:
    out = []
    for k, v in cols.items():
        out.append(f"round({v}, {digits}) AS {k}" if digits is not None else f"{v} AS {k}")
    return ", ".join(out)


def stateless_cols() -> dict:
    c = {"current_price": "price"}
    c.update(PRICE_TRANSFORMS)
    c.update(SYMBOL_TEXT)
    c.update(CALENDAR)
    c.update(BUCKETS)
    c["price_category"] = CAT
    c["symbol_type"] = SYMTYPE
    c["price_volatility_estimate"] = VOLEST
    c["market_session"] = SESSION
    return c


DOUBLE_STATELESS = set(PRICE_TRANSFORMS) | set(BUCKETS) | {"current_price", "price_volatility_estimate"}


def stateless_select() -> str:
    parts = []
    for k, v in stateless_cols().items():
        parts.append(f"round({v}, 6) AS {k}" if k in DOUBLE_STATELESS else f"{v} AS {k}")
    return ", ".join(parts)


def estimate_cols() -> dict:
    cyc = f"((price % {d(100)}) / {d(100)})"
    macd = f"(sin(((price + length(symbol)) % {d(30)}) * {d(0.2)}) * (price * {d(0.0001)}))"
    c = {
        "current_price": "price",
        "simple_return": f"((CAST(trunc(price * 100) AS BIGINT) % 100) - 50) / {d(1000)}",
        "log_return": f"CASE WHEN price <= 0 THEN {d(0)} ELSE ln(price) / {d(10)} END",
    }
    for k in (5, 10, 20):
        c[f"sma_{k}"] = f"price * {d(1.0 - k * 0.001)}"
    for k in (12, 26):
        c[f"ema_{k}"] = f"price * ({d(1)} - {d(k)} * {cyc} * {d(0.01)})"
    c["macd_line"] = macd
    c["macd_signal"] = f"{macd} * {d(0.7)}"
    c["macd_histogram"] = f"{macd} - {macd} * {d(0.7)}"
    c["volatility_10"] = VOL10
    c["volatility_20"] = f"{VOL10} * {d(0.9)}"
    bbv = f"CASE WHEN price < 1000 THEN {d(0.02)} ELSE {d(0.015)} END"
    c["bb_upper"] = f"price * ({d(1)} + {d(2)} * {bbv})"
    c["bb_lower"] = f"price * ({d(1)} - {d(2)} * {bbv})"
    c["bb_position"] = f"greatest({d(0.1)}, least({d(0.9)}, (price % {d(50)}) / {d(50)}))"
    c["rsi"] = f"{d(30)} + {cyc} * {d(40)}"
    for k in (1, 2, 5):
        c[f"lag_{k}"] = f"price + sin(price * {d(0.01)} + {d(k)}) * (price * {d(0.001)})"
    return c


def nz(x: str, default: float) -> str:
    """Python ``x or default``: null, NaN and 0 -> default."""
    return f"coalesce(nullif(CASE WHEN isnan({x}) THEN NULL ELSE {x} END, 0), {d(default)})"


def updown(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'UP' ELSE 'DOWN' END"


RULES = {
    "RSI_Rule": updown(f"{nz('rsi_14', 50)} > 50"),
    "MACD_Rule": updown(f"{nz('macd_line', 0)} > 0"),
    "Momentum_Rule": updown(f"{nz('momentum_10', 0)} > 0"),
    "PriceChange_Rule": updown(f"{nz('price_change_pct', 0)} > 0"),
    "BB_Rule": (f"CASE WHEN bb_upper IS NULL OR bb_lower IS NULL THEN 'NEUTRAL' "
                f"WHEN {nz('current_price', 100)} > bb_upper THEN 'DOWN' "
                f"WHEN {nz('current_price', 100)} < bb_lower THEN 'UP' ELSE 'NEUTRAL' END"),
}
RULE_NAMES = list(RULES)
PRED_FEATURES = ["rsi_14", "macd_line", "volatility_20", "momentum_10", "price_change_pct",
                 "sma_10", "sma_20", "bb_upper", "bb_lower"]

PRED_CTE = f"""{TICKS_CTE},
{indicators_cte()},
pred AS (
  SELECT symbol, current_price, ts, event_id, tick_number, {', '.join(PRED_FEATURES)},
         'TRAINING' AS XGBoost, 'TRAINING' AS RandomForest, 'TRAINING' AS AdaBoost, 'TRAINING' AS LogisticReg,
         {', '.join(f'{v} AS {k}' for k, v in RULES.items())}
  FROM ind)"""

# ---------------------------------------------------------- ingest / reshape
ORACLES["ticks_json_roundtrip"] = f"""
WITH {TICKS_CTE}
SELECT symbol, price, strftime(date, '%Y-%m-%d') AS date,
       strftime(date, '%Y-%m-%d') || ' 09:30:00' AS timestamp,
       CAST(date AS TIMESTAMP) + INTERVAL 9 HOUR + INTERVAL 30 MINUTE AS event_time,
       CAST(epoch(CAST(date AS TIMESTAMP) + INTERVAL 9 HOUR + INTERVAL 30 MINUTE) AS BIGINT) AS event_time_seconds
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

ORACLES["event_props_json"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS prop_k FROM events
"""

ORACLES["wide_to_long_clean"] = """
WITH w AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS Dates, l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 3 THEN '#N/A N/A' ELSE CAST(l_quantity AS VARCHAR) END AS l_quantity,
         CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
         CASE WHEN l_linenumber = 5 THEN 'abc' ELSE CAST(l_discount AS VARCHAR) END AS l_discount,
         CAST(l_tax AS VARCHAR) AS l_tax
  FROM lineitem),
u AS (UNPIVOT w ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME symbol VALUE price),
c AS (SELECT TRY_CAST(Dates AS DATE) AS date, l_orderkey, l_linenumber, symbol,
             TRY_CAST(CASE WHEN price = '#N/A N/A' THEN NULL ELSE price END AS DOUBLE) AS price FROM u)
SELECT * FROM c WHERE date IS NOT NULL AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
                  AND symbol IS NOT NULL AND price IS NOT NULL
"""

ORACLES["csv_roundtrip"] = "SELECT date, symbol, price FROM (" + ORACLES["wide_to_long_clean"] + ")"

# ------------------------------------------------------------- row features
ORACLES["price_transforms"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, round(price, 6) AS price, {sel({**PRICE_TRANSFORMS, **BUCKETS})}
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

ORACLES["symbol_features"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, {sel(SYMBOL_TEXT, None)}, {SYMTYPE} AS symbol_type,
       CAST(length(symbol) AS VARCHAR) || '_' ||
       CAST((length(symbol) - length(replace(symbol, 'Index', ''))) // 5 AS VARCHAR) || '_' ||
       CAST((length(symbol) - length(replace(symbol, 'Comdty', ''))) // 6 AS VARCHAR) AS symbol_signature,
       {NORM} AS symbol_norm
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

ORACLES["calendar_features"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, {sel(CALENDAR, None)}, {SESSION} AS market_session,
       isodow(ts) BETWEEN 1 AND 5 AS is_weekday
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

ORACLES["price_tiers"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, round(price, 6) AS price, {CAT} AS price_category,
       round({VOLEST}, 6) AS price_volatility_estimate, {PCTL} AS price_percentile,
       round({VOL10}, 6) AS volatility_10, round({VOL10} * {d(0.9)}, 6) AS volatility_20
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

ORACLES["indicator_estimates"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, date, {sel({k: v for k, v in estimate_cols().items()})}, {PCTL} AS price_percentile
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

ORACLES["stateless_feature_record"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, date, {stateless_select()}
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

# ------------------------------------------------------------- indicators
GROUPS = {
    "sma": ["sma_5", "sma_10", "sma_20"],
    "ema": ["ema_12", "ema_26"],
    "rsi": ["rsi_14"],
    "macd": ["macd_line", "macd_signal", "macd_histogram"],
    "bollinger": ["bb_upper", "bb_middle", "bb_lower"],
    "volatility": ["volatility_20"],
    "momentum": ["momentum_10"],
    "price_change_lags": ["price_change", "price_change_pct", "lag_1", "lag_2", "lag_5"],
}
for _n, _c in GROUPS.items():
    ORACLES[_n] = f"""
WITH {TICKS_CTE},
{indicators_cte()}
SELECT symbol, ts, event_id, round(current_price, 6) AS current_price, {rounded(_c)} FROM ind
"""

ORACLES["order_indicators"] = f"""
WITH src AS (SELECT o_custkey AS symbol, o_orderdate AS ts, o_orderkey AS event_id, o_totalprice AS price FROM orders),
{indicators_cte('src')}
SELECT symbol AS custkey, ts AS odate, event_id AS orderkey, round(current_price, 6) AS current_price,
       {rounded(["sma_5", "ema_12", "rsi_14", "macd_line", "bb_upper", "momentum_10", "lag_1"])}
FROM ind
"""

# ---------------------------------------------------------------- signals
ORACLES["rule_signals"] = f"""
WITH {TICKS_CTE},
{indicators_cte()}
SELECT symbol, ts, event_id, round(current_price, 6) AS current_price,
       {rounded(["rsi_14", "macd_line", "momentum_10", "price_change_pct", "bb_upper", "bb_lower"])},
       {', '.join(f'{v} AS {k}' for k, v in RULES.items())}
FROM ind
"""

ORACLES["stateless_signals"] = f"""
WITH {TICKS_CTE},
r AS (SELECT symbol, ts, event_id, date, {stateless_select()}
      FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL)
SELECT symbol, ts, event_id, date, current_price, price_log, price_volatility_estimate, price_category,
       symbol_type, market_session, day_of_week, price_bucket_50, price_sqrt, price_squared,
       {updown('current_price > price_bucket_50')} AS PriceMovement,
       {updown(f'price_log > {d(5)} AND price_volatility_estimate < {d(0.03)}')} AS XGBoost,
       {updown("price_category IN ('high', 'very_high')")} AS AdaBoost,
       {updown("symbol_type = 'index' AND market_session = 'morning'")} AS RandomForest,
       {updown('day_of_week IN (1, 2, 3, 4, 5)')} AS LogisticReg,
       {updown(f'price_log > {d(5)}')} AS price_level_label
FROM r
"""

ORACLES["prediction_records"] = f"""
WITH {PRED_CTE}
SELECT symbol, round(current_price, 6) AS current_price, ts, event_id, {rounded(PRED_FEATURES)},
       XGBoost, RandomForest, AdaBoost, LogisticReg, {', '.join(RULE_NAMES)}
FROM pred
"""

# --------------------------------------------------------------- backtest
BT = "PARTITION BY symbol, signal ORDER BY ts, event_id"
BT_CTE = f"""{PRED_CTE},
v AS (SELECT * FROM pred WHERE current_price IS NOT NULL AND NOT isnan(current_price) AND current_price > 0),
u AS (UNPIVOT (SELECT symbol, ts, event_id, current_price, {', '.join(RULE_NAMES)} FROM v)
      ON {', '.join(RULE_NAMES)} INTO NAME signal VALUE label),
b1 AS (SELECT *, CASE WHEN label IN ('UP', 'DOWN') THEN label END AS dir,
              lag(current_price) OVER ({BT}) AS pp, row_number() OVER ({BT}) - 1 AS ord FROM u),
b2 AS (SELECT *,
              coalesce(last_value(dir IGNORE NULLS) OVER ({BT} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'DOWN') = 'UP' AS long_prev,
              coalesce(last_value(dir IGNORE NULLS) OVER ({BT} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'DOWN') = 'UP' AS long
       FROM b1),
b3 AS (SELECT *,
              {d(100000)} * product(CASE WHEN long_prev AND pp IS NOT NULL THEN current_price / pp ELSE {d(1)} END)
                 OVER ({BT} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS equity,
              CASE WHEN ord > 0 THEN (CASE WHEN long_prev THEN current_price / pp - {d(1)} ELSE {d(0)} END) END AS ret,
              CASE WHEN long AND NOT long_prev THEN 'BUY' WHEN long_prev AND NOT long THEN 'SELL' END AS side
       FROM b2),
bt AS (SELECT *,
              CASE WHEN side = 'SELL' THEN last_value(CASE WHEN side = 'BUY' THEN current_price END IGNORE NULLS)
                   OVER ({BT} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS entry_price
       FROM b3)"""

ORACLES["backtest_equity"] = f"""
WITH {BT_CTE}
SELECT symbol, ts, event_id, signal, label, long, round(equity, 4) AS equity, round(ret, 6) AS ret FROM bt
"""

ORACLES["backtest_trades"] = f"""
WITH {BT_CTE}
SELECT symbol, ts, event_id, signal, side, round(current_price, 6) AS price,
       round(equity / current_price, 4) AS units, round(entry_price, 6) AS entry_price,
       round(CASE WHEN side = 'SELL' THEN (equity / current_price) * current_price - (equity / current_price) * entry_price END, 4) + 0.0::double AS pnl,
       round(CASE WHEN side = 'SELL' THEN ((equity / current_price) * current_price - (equity / current_price) * entry_price)
             / (equity / current_price * entry_price) * {d(100)} END, 6) + 0.0::double AS pnl_pct
FROM bt WHERE side IS NOT NULL
"""

BT_METRICS = f"""m AS (
  SELECT symbol, signal, {d(100000)} AS initial_value, arg_max(equity, ord) AS final_value,
         avg(ret) AS mr, stddev_samp(ret) AS sr, count(side) AS trades, count(*) AS points
  FROM bt GROUP BY symbol, signal)"""

ORACLES["backtest_metrics"] = f"""
WITH {BT_CTE},
{BT_METRICS}
SELECT symbol, signal, initial_value, round(final_value, 4) AS final_value,
       round(final_value - initial_value, 4) + 0.0::double AS net_pnl,
       round((final_value - initial_value) / initial_value * {d(100)}, 6) + 0.0::double AS return_pct,
       round(CASE WHEN sr <> 0 THEN mr / sr * sqrt({d(252)}) END, 6) AS sharpe,
       CAST(trades AS BIGINT) AS trades, CAST(points AS BIGINT) AS points
FROM m
"""


def money_sql(x: str) -> str:
    return f"'$' || format('{{:,.2f}}', {x})"


ORACLES["backtest_report_lines"] = f"""
WITH {BT_CTE},
{BT_METRICS},
lines AS (
  SELECT symbol, signal, 0 AS section, 0 AS seq, repeat('=', 60) AS line FROM m
  UNION ALL SELECT symbol, signal, 0, 1, '      FINANCIAL STRATEGY BACKTEST REPORT' FROM m
  UNION ALL SELECT symbol, signal, 0, 2, repeat('=', 60) FROM m
  UNION ALL SELECT symbol, signal, 0, 3, '--- PERFORMANCE METRICS ---' FROM m
  UNION ALL SELECT symbol, signal, 0, 4, 'Initial Portfolio Value: ' || {money_sql('initial_value')} FROM m
  UNION ALL SELECT symbol, signal, 0, 5, 'Final Portfolio Value:   ' || {money_sql('final_value')} FROM m
  UNION ALL SELECT symbol, signal, 0, 6, 'Total Net PnL:           ' || {money_sql('final_value - initial_value')} FROM m
  UNION ALL SELECT symbol, signal, 0, 7, 'Total Return:            ' || printf('%.2f', (final_value - initial_value) / initial_value * {d(100)}) || '%' FROM m
  UNION ALL SELECT symbol, signal, 0, 8, 'Sharpe Ratio (Annualized): ' || coalesce(printf('%.2f', CASE WHEN sr <> 0 THEN mr / sr * sqrt({d(252)}) END), 'N/A') FROM m
  UNION ALL SELECT symbol, signal, 0, 9, 'Total Trades Executed:   ' || CAST(trades AS VARCHAR) FROM m
  UNION ALL SELECT symbol, signal, 0, 10, '--- TRANSACTION LOG ---' FROM m
  UNION ALL SELECT symbol, signal, 1, 0, 'No trades were executed.' FROM m WHERE trades = 0
  UNION ALL SELECT symbol, signal, 2, 0, repeat('=', 60) FROM m
  UNION ALL
  SELECT symbol, signal, 1, ord,
         CASE WHEN side = 'BUY'
              THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' | BUY   | ' || printf('%.4f', equity / current_price) || ' units @ ' || {money_sql('current_price')}
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' | SELL  | All units @ ' || {money_sql('current_price')} || ' | PnL: ' ||
                   {money_sql('(equity / current_price) * current_price - (equity / current_price) * entry_price')} || ' (' ||
                   printf('%.2f', ((equity / current_price) * current_price - (equity / current_price) * entry_price) / (equity / current_price * entry_price) * {d(100)}) || '%)'
         END
  FROM bt WHERE side IS NOT NULL)
SELECT symbol, signal, CAST(section AS INTEGER) AS section, CAST(seq AS BIGINT) AS seq, line FROM lines
"""

# ---------------------------------------------------------------- serving
ORACLES["symbol_directory"] = f"""
WITH {TICKS_CTE}
SELECT symbol, {NORM} AS symbol_norm FROM (SELECT DISTINCT symbol FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL)
"""

ORACLES["requested_symbols"] = f"""
WITH {TICKS_CTE},
req AS (SELECT requested, upper(trim(requested)) AS symbol_norm
        FROM (VALUES (' click index '), ('VIEW Spot'), ('purchase comdty'), ('XYZ')) t(requested)),
known AS (SELECT DISTINCT {NORM} AS symbol_norm FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL)
SELECT requested, req.symbol_norm, known.symbol_norm IS NOT NULL AS found
FROM req LEFT JOIN known ON req.symbol_norm = known.symbol_norm
"""

ORACLES["earliest_rows"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, price FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
ORDER BY ts, event_id LIMIT 5
"""

LATEST = "PARTITION BY symbol ORDER BY ts DESC, event_id DESC"

ORACLES["latest_100_per_symbol"] = f"""
WITH {PRED_CTE}
SELECT * FROM (
  SELECT symbol, ts, event_id, round(current_price, 6) AS current_price, round(rsi_14, 6) AS rsi_14,
         round(macd_line, 6) AS macd_line, CAST(row_number() OVER ({LATEST}) AS INTEGER) AS rank_desc FROM pred)
WHERE rank_desc <= 100
"""

ORACLES["latest_snapshot"] = f"""
WITH {PRED_CTE},
l AS (SELECT *, row_number() OVER ({LATEST}) AS rk FROM pred)
SELECT symbol, ts, event_id, round(current_price, 6) AS current_price, round(rsi_14, 6) AS rsi_14,
       round(macd_line, 6) AS macd_line, round(volatility_20, 6) AS volatility_20, RSI_Rule, BB_Rule,
       CASE WHEN rsi_14 IS NULL OR isnan(rsi_14) THEN NULL WHEN rsi_14 > 70 THEN '#00FF00'
            WHEN rsi_14 < 30 THEN '#FF0000' ELSE '#FFFF00' END AS rsi_color,
       CASE WHEN macd_line IS NULL OR isnan(macd_line) THEN NULL WHEN macd_line > 0 THEN '#00FF00'
            ELSE '#FF0000' END AS macd_color
FROM l WHERE rk = 1
"""

ORACLES["recent_table"] = f"""
WITH {PRED_CTE},
l AS (SELECT *, CAST(row_number() OVER ({LATEST}) AS INTEGER) AS rank_desc FROM pred)
SELECT symbol, ts, event_id, rank_desc,
       coalesce({money_sql('current_price')}, 'N/A') AS current_price,
       coalesce(printf('%.1f', rsi_14), 'N/A') AS rsi_14,
       coalesce(printf('%.4f', macd_line), 'N/A') AS macd_line,
       coalesce(printf('%.3f', volatility_20), 'N/A') AS volatility_20,
       XGBoost, RandomForest, RSI_Rule, MACD_Rule
FROM l WHERE rank_desc <= 10
"""

ORACLES["chart_series"] = f"""
WITH {PRED_CTE},
l AS (SELECT * FROM (SELECT *, row_number() OVER ({LATEST}) AS rk FROM pred) WHERE rk <= 100),
u AS (UNPIVOT (SELECT symbol, ts, event_id, current_price, sma_10, sma_20, bb_upper, bb_lower FROM l)
      ON current_price, sma_10, sma_20, bb_upper, bb_lower INTO NAME series VALUE value)
SELECT symbol, ts, event_id, series, round(value, 6) AS value FROM u WHERE value IS NOT NULL
"""

# --------------------------------------------------------------- learning
LBL = "PARTITION BY symbol ORDER BY ts, event_id"
LABELS_CTE = f"""{TICKS_CTE},
lab AS (SELECT symbol, ts, event_id, price, lead(price) OVER ({LBL}) AS next_price,
               row_number() OVER ({LBL}) - 1 AS tick_index
        FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL)"""

ORACLES["labels_next_tick"] = f"""
WITH {LABELS_CTE}
SELECT symbol, ts, event_id, round(price, 6) AS price, round(next_price, 6) AS next_price,
       CAST(CASE WHEN next_price > price THEN 1 ELSE 0 END AS INTEGER) AS label
FROM lab WHERE next_price IS NOT NULL
"""

ORACLES["sequential_split"] = f"""
WITH {LABELS_CTE},
x AS (SELECT *, row_number() OVER (ORDER BY symbol, ts, event_id) - 1 AS row_index,
             count(*) OVER () AS n FROM lab WHERE next_price IS NOT NULL)
SELECT symbol, ts, event_id, CAST(row_index AS BIGINT) AS row_index,
       CASE WHEN row_index < n - ceil(n * {d(0.2)}) THEN 'train' ELSE 'test' END AS split
FROM x
"""



def newton_cte(k: int, steps: int) -> str:
    """CTEs w0.. wN: weights (v0..vk, the last one the intercept) of standardised rows ``z``
    (z0.., zk = 1, y) with penalties in ``st`` (l0..), each from the one before by
    gradient and Hessian sums and an elimination written out."""
    n, out = k + 1, [f"w0 AS (SELECT {', '.join(f'{d(0)} AS v{i}' for i in range(k + 1))})"]
    for step in range(steps):
        margin = " + ".join(f"z{i} * v{i}" for i in range(n))
        sums = [f"sum(z{i} * (p - y)) AS s{i}" for i in range(n)]
        sums += [f"sum(z{i} * z{j} * p * (1 - p)) AS h{i}{j}" for i in range(n) for j in range(i, n)]
        out.append(f"p{step} AS (SELECT z.*, {d(1)} / ({d(1)} + exp(-({margin}))) AS p FROM z, w{step})")
        out.append(f"s{step} AS (SELECT {', '.join(sums)} FROM p{step})")
        pen = lambda i: f"l{i}" if i < k else d(0)
        cell = {(i, j): f"h{min(i, j)}{max(i, j)}" + (f" + {pen(i)} + {1e-12!r}::double" if i == j else "") for i in range(n) for j in range(n)}
        cols = [f"{cell[i, j]} AS a0_{i}{j}" for i in range(n) for j in range(n)] + [f"s{i} + {pen(i)} * v{i} AS b0_{i}" for i in range(n)]
        for c in range(n):  # column by column, all other rows
            for i in range(n):
                row = [f"a{c}_{i}{j} - a{c}_{i}{c} / a{c}_{c}{c} * a{c}_{c}{j}" if i != c else f"a{c}_{i}{j}" for j in range(n)]
                rhs = f"b{c}_{i} - a{c}_{i}{c} / a{c}_{c}{c} * b{c}_{c}" if i != c else f"b{c}_{i}"
                cols += [f"{e} AS a{c + 1}_{i}{j}" for j, e in enumerate(row)] + [f"{rhs} AS b{c + 1}_{i}"]
        new = ", ".join(f"v{i} - b{n}_{i} / a{n}_{i}{i} AS v{i}" for i in range(n))
        out.append(f"e{step} AS (SELECT v0, {', '.join(f'v{i}' for i in range(1, n))}, {', '.join(cols)} FROM s{step}, w{step}, st)")
        out.append(f"w{step + 1} AS (SELECT {new} FROM e{step})")
    return ",\n".join(out)


OFFLINE = ["simple_return", "lag_1", "price"]
ORACLES["model_logreg"] = f"""
WITH {LABELS_CTE},
f AS (SELECT symbol, ts, event_id, price, CASE WHEN next_price > price THEN 1 ELSE 0 END AS label,
             ((CAST(trunc(price * 100) AS BIGINT) % 100) - 50) / {d(1000)} AS simple_return, price + sin(price * {d(0.01)} + {d(1)}) * (price * {d(0.001)}) AS lag_1,
             row_number() OVER (ORDER BY symbol, ts, event_id) - 1 AS i, count(*) OVER () AS n FROM lab WHERE next_price IS NOT NULL),
x AS (SELECT *, i < n - ceil(n * {d(0.2)}) AS train FROM f),
st AS (SELECT {', '.join(f'avg({c}) AS m{i}, stddev_pop({c}) AS d{i}, 1 / (stddev_pop({c}) * stddev_pop({c})) AS l{i}' for i, c in enumerate(OFFLINE))} FROM x WHERE train),
z AS (SELECT {', '.join(f'({c} - m{i}) / d{i} AS z{i}' for i, c in enumerate(OFFLINE))}, {d(1)} AS z3, CAST(label AS DOUBLE) AS y FROM x, st WHERE train),
{newton_cte(3, 12)}
SELECT symbol, ts, event_id, CAST(label AS INTEGER) AS label,
       CASE WHEN {' + '.join(f'({c} - m{i}) / d{i} * v{i}' for i, c in enumerate(OFFLINE))} + v3 > 0 THEN 'UP' ELSE 'DOWN' END AS predicted
FROM x, st, w12 WHERE NOT train
"""

ONLINE = ["rsi_14", "macd_line", "volatility_20", "momentum_10", "price_change_pct", "current_price"]
ORACLES["training_window"] = f"""
WITH {TICKS_CTE},
{indicators_cte()},
l AS (SELECT *, CASE WHEN lead(current_price) OVER ({LBL}) > current_price THEN 1 ELSE 0 END AS y,
             row_number() OVER ({LBL}) - 1 AS ti, count(*) OVER (PARTITION BY symbol) AS kn FROM ind),
b AS (SELECT * FROM l WHERE ti >= kn - 5000),
s AS (SELECT symbol, {', '.join(f'avg({c}) AS m_{c}' for c in ONLINE)}, count(*) AS bn,
             count(DISTINCT y) AS classes FROM b GROUP BY symbol)
SELECT b.symbol, ts, event_id, tick_number, CAST(y AS INTEGER) AS y,
       (tick_number - 4) % 100 = 0 AS retrain_point, bn >= 50 AND classes >= 2 AS trainable,
       {', '.join(f'round(coalesce({c}, m_{c}), 6) AS {c}' for c in ONLINE)}
FROM b JOIN s ON b.symbol = s.symbol
"""

LABELLED_RULES = f"""{TICKS_CTE},
{indicators_cte()},
lr AS (SELECT * FROM (SELECT *, CASE WHEN lead(current_price) OVER ({LBL}) > current_price THEN 1 ELSE 0 END AS label,
                             lead(current_price) OVER ({LBL}) AS nx,
                             {', '.join(f'{v} AS {k}' for k, v in RULES.items())} FROM ind) WHERE nx IS NOT NULL),
lu AS (UNPIVOT (SELECT label, {', '.join(RULE_NAMES)} FROM lr) ON {', '.join(RULE_NAMES)} INTO NAME signal VALUE value)"""

ORACLES["signal_accuracy"] = f"""
WITH {LABELLED_RULES}
SELECT signal, round(avg(CASE WHEN (CASE WHEN value = 'UP' THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS support
FROM lu GROUP BY signal
"""

ORACLES["signal_classification_report"] = f"""
WITH {LABELLED_RULES},
c AS (SELECT signal,
             count(*) FILTER (WHERE label = 0 AND value <> 'UP') AS c00,
             count(*) FILTER (WHERE label = 0 AND value = 'UP') AS c01,
             count(*) FILTER (WHERE label = 1 AND value <> 'UP') AS c10,
             count(*) FILTER (WHERE label = 1 AND value = 'UP') AS c11
      FROM lu GROUP BY signal),
p AS (
  SELECT signal, '0' AS class, coalesce(c00 / nullif(c00 + c10, 0), 0) AS precision,
         coalesce(c00 / nullif(c00 + c01, 0), 0) AS recall, c00 + c01 AS support FROM c
  UNION ALL
  SELECT signal, '1', coalesce(c11 / nullif(c11 + c01, 0), 0), coalesce(c11 / nullif(c11 + c10, 0), 0), c10 + c11 FROM c),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p)
SELECT signal, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL
SELECT signal, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY signal
UNION ALL
SELECT signal, 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY signal
"""

# --------------------------------------------------------------- streaming
ORACLES["stream_price_change"] = f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, round(price, 6) AS price,
       round(coalesce(price - lag(price) OVER ({W}), 0.0::double), 6) AS price_change
FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL
"""

ORACLES["stream_indicators"] = ORACLES["stream_indicators_chunked"] = ORACLES["indicators_full"]
ORACLES["stream_price_change_keyed"] = ORACLES["stream_price_change"]

ORACLES["stream_predictions_table"] = f"""
WITH {TICKS_CTE},
r AS (SELECT symbol, ts, event_id, date, {stateless_select()}
      FROM ticks WHERE price IS NOT NULL AND symbol IS NOT NULL)
SELECT symbol, ts, event_id, date, current_price, price_log, price_volatility_estimate, price_category,
       symbol_type, market_session, day_of_week, price_bucket_50, price_sqrt, price_squared,
       {updown('current_price > price_bucket_50')} AS PriceMovement,
       {updown(f'price_log > {d(5)} AND price_volatility_estimate < {d(0.03)}')} AS XGBoost,
       {updown("price_category IN ('high', 'very_high')")} AS AdaBoost,
       {updown("symbol_type = 'index' AND market_session = 'morning'")} AS RandomForest,
       {updown('day_of_week IN (1, 2, 3, 4, 5)')} AS LogisticReg
FROM r
"""

# ------------------------------------------------------------ more serving
ORACLES["symbol_top100"] = f"""
WITH {PRED_CTE}
SELECT symbol, ts, event_id, round(current_price, 6) AS current_price, round(rsi_14, 6) AS rsi_14,
       round(macd_line, 6) AS macd_line
FROM (SELECT * FROM pred WHERE symbol = 'CLICK Index' ORDER BY ts DESC, event_id DESC LIMIT 100)
"""

ORACLES["normalized_symbol_rows"] = f"""
WITH {PRED_CTE}
SELECT symbol, ts, event_id, round(current_price, 6) AS current_price, {', '.join(RULE_NAMES)}
FROM pred WHERE {NORM} = 'CLICK INDEX'
"""

ORACLES["latest_signal_badges"] = f"""
WITH {PRED_CTE},
l AS (SELECT * FROM (SELECT *, row_number() OVER ({LATEST}) AS rk FROM pred) WHERE rk = 1),
u AS (UNPIVOT (SELECT symbol, ts, event_id, XGBoost, RandomForest, AdaBoost, LogisticReg, {', '.join(RULE_NAMES)} FROM l)
      ON XGBoost, RandomForest, AdaBoost, LogisticReg, {', '.join(RULE_NAMES)} INTO NAME signal VALUE label)
SELECT symbol, ts, event_id, signal, label,
       CASE WHEN label = 'UP' THEN '#00FF00' WHEN label = 'DOWN' THEN '#FF0000' ELSE '#FFFF00' END AS color,
       CASE WHEN label = 'UP' THEN '▲' WHEN label = 'DOWN' THEN '▼' ELSE '●' END AS glyph
FROM u
"""

ORACLES["reshape_counts"] = """
WITH w AS (SELECT l_shipdate, l_orderkey, l_linenumber,
                  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS q,
                  l_extendedprice AS e, CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount END AS d, l_tax AS t
           FROM lineitem)
SELECT count(*) AS wide_rows, 4 * count(*) AS long_rows,
       count(q) + count(e) + count(d) + count(t) AS clean_rows,
       4 * count(*) - (count(q) + count(e) + count(d) + count(t)) AS dropped_rows
FROM w
"""


def _word_mixed(h: str, w: str) -> str:
    """One Murmur3 step over 32-bit values kept in HUGEINT (seeded state ``h``, word ``w``)."""
    m = "4294967296"
    k = f"(({w} * 3432918353) % {m})"
    k = f"((({k} * 32768) % {m} + {k} // 131072) * 461845907 % {m})"
    x = f"xor({h}, {k})"
    return f"((({x} * 8192) % {m} + {x} // 524288) * 5 + 3864292196) % {m}"


# Murmur3 (32 bit, seed 42) over UTF-8 bytes: little-endian words, then each byte of the rest as a word of its own.
# The symbols are ASCII, so a character is a byte.
ORACLES["symbol_hash_bucket"] = f"""
WITH {TICKS_CTE},
s AS (SELECT DISTINCT symbol, length(symbol) AS n FROM ticks WHERE symbol IS NOT NULL),
b AS (SELECT *, list_transform(range(1, n + 1), lambda i: ascii(substr(symbol, CAST(i AS BIGINT), 1))::HUGEINT) AS c FROM s),
w AS (SELECT symbol, n, list_concat([42::HUGEINT], list_concat(
        list_transform(range(0, n // 4), lambda j: c[4 * j + 1] + 256 * c[4 * j + 2] + 65536 * c[4 * j + 3] + 16777216 * c[4 * j + 4]),
        c[4 * (n // 4) + 1:n])) AS words FROM b),
h0 AS (SELECT symbol, xor(list_reduce(words, lambda h, x: {_word_mixed('h', 'x')}), n::HUGEINT) AS h FROM w),
h1 AS (SELECT symbol, (xor(h, h // 65536) * 2246822507) % 4294967296 AS h FROM h0),
h2 AS (SELECT symbol, (xor(h, h // 8192) * 3266489909) % 4294967296 AS h FROM h1),
h3 AS (SELECT symbol, xor(h, h // 65536) AS h FROM h2),
f AS (SELECT symbol, CAST(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 1000 AS BIGINT) AS symbol_hash FROM h3)
SELECT t.symbol, ts, event_id, symbol_hash FROM ticks t JOIN f ON t.symbol = f.symbol WHERE price IS NOT NULL
"""

# the same results from another layout, or observed while writing
ORACLES["symbol_top100_stored"] = ORACLES["symbol_top100"]
ORACLES["csv_roundtrip_counts"] = ORACLES["reshape_counts"]
