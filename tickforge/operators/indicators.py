"""Windowed technical indicators over a keyed tick series (native expressions).

Semantics (n = prices seen so far, at most the last 100 are retained):

* ``sma_w``: mean of the last w prices, null while n < w (w = 5, 10, 20).
* ``ema_w``: EMA with alpha = 2/(w+1), seeded with the *oldest retained*
  price and folded over the retained (<= 100) prices; null while n < w.
* ``rsi_14``: simple averages of gains/losses over the last 14 price deltas,
  100 when the average loss is 0; null while n < 15.
* ``macd_line`` = ema_12 - ema_26 of the retained prices (n >= 26);
  ``macd_signal`` = 9-EMA (seeded with its oldest entry) over the MACD values
  of the retained-price prefixes of length 27..n, last 50 kept (n >= 35);
  ``macd_histogram`` = line - signal.
* ``bb_upper/middle/lower``: mean +- 2 population std of the last 20 prices.
* ``volatility_20``: population std of the returns between the last 20
  prices (returns after a zero price skipped) times sqrt(252).
* ``momentum_10``: (p - p[lag 9]) / p[lag 9].
* ``price_change``, ``price_change_pct``, ``lag_1``, ``lag_2``, ``lag_5``.
* Rows are emitted from the 5th price of a symbol on.

Divisions by a zero price give null instead of an error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..plans.sequence import CHUNK, ORD, REAL, Sequenced, plain, sequence

HISTORY = 100          # retained prices per symbol
WARMUP = 5             # first emitted tick
FAST, SLOW, SIGNAL = 12, 26, 9
MACD_KEEP = 50         # retained MACD history entries
ANNUALIZE = math.sqrt(252)

FEATURE_COLUMNS = [
    "sma_5", "sma_10", "sma_20", "ema_12", "ema_26", "rsi_14",
    "macd_line", "macd_signal", "macd_histogram",
    "bb_upper", "bb_middle", "bb_lower", "volatility_20", "momentum_10",
    "price_change", "price_change_pct", "lag_1", "lag_2", "lag_5",
]


def _alpha(w: int) -> float:
    return 2.0 / (w + 1)


def ema_fold(h: Column) -> Column:
    """One pass over the retained prices ``h`` -> struct(fast, slow, sig).

    fast/slow are the 12/26 EMAs of the whole array; sig is the 9-EMA over
    the MACD values of the prefixes whose index is >= max(27, size-49).
    """
    af, asl, ag = _alpha(FAST), _alpha(SLOW), _alpha(SIGNAL)
    first_kept = F.greatest(F.lit(SLOW + 1), F.size(h) - F.lit(MACD_KEEP - 1))
    init = F.struct(F.lit(1).alias("k"), F.element_at(h, 1).alias("fast"),
                    F.element_at(h, 1).alias("slow"), F.lit(None).cast("double").alias("sig"))

    def step(acc, x):
        k = acc["k"] + 1
        fast = F.lit(af) * x + F.lit(1 - af) * acc["fast"]
        slow = F.lit(asl) * x + F.lit(1 - asl) * acc["slow"]
        macd = fast - slow
        sig = (F.when(k == first_kept, macd)
               .when(k > first_kept, F.lit(ag) * macd + F.lit(1 - ag) * acc["sig"]))
        return F.struct(k.alias("k"), fast.alias("fast"), slow.alias("slow"), sig.alias("sig"))

    return F.aggregate(F.slice(h, 2, HISTORY - 1), init, step)


def fold_weights(m: int = HISTORY) -> dict:
    """Weights of the retained prices (oldest first) in ema_12, ema_26 and the
    MACD signal for a history of m prices.  The fold is linear in the prices,
    so running it on the unit vectors gives its coefficients."""
    import numpy as np
    af, asl, ag = _alpha(FAST), _alpha(SLOW), _alpha(SIGNAL)
    k0 = max(SLOW + 1, m - (MACD_KEEP - 1))
    eye = np.eye(m)
    fast = eye[0].copy()
    slow = eye[0].copy()
    sig = np.zeros(m)
    for k in range(2, m + 1):
        fast = af * eye[k - 1] + (1 - af) * fast
        slow = asl * eye[k - 1] + (1 - asl) * slow
        if k == k0:
            sig = fast - slow
        elif k > k0:
            sig = ag * (fast - slow) + (1 - ag) * sig
    return {"fast": fast.tolist(), "slow": slow.tolist(), "sig": sig.tolist()}


def ema_only_fold(h: Column, window: int) -> Column:
    """EMA of the whole array seeded with its first element (double accumulator)."""
    a = _alpha(window)
    return F.aggregate(F.slice(h, 2, HISTORY - 1), F.element_at(h, 1),
                       lambda acc, x: F.lit(a) * x + F.lit(1 - a) * acc)


def balanced_sql(terms: list) -> str:
    """SQL text of a sum as a balanced tree of additions."""
    while len(terms) > 1:
        terms = [f"({terms[i]} + {terms[i + 1]})" if i + 1 < len(terms) else terms[i]
                 for i in range(0, len(terms), 2)]
    return terms[0]


def indicator_frame(s: Sequenced, price: str = "price", with_next: bool = False) -> DataFrame:
    """Computes the indicator columns over a sequenced frame; returns the
    chunk's own rows (halo copies dropped) from the warm-up on.

    EMA / MACD: the fold is linear in the retained prices, so with a full
    history (n >= 100, all but the first 99 rows of a key) each value is a
    fixed weighted sum of the 100 retained prices - plain arithmetic inside
    whole-stage codegen.  Warm-up rows run the fold itself.  Only these two
    read the frame of retained prices; it is pruned where they are not asked for.
    """
    w: WindowSpec = s.window
    p = F.col(price)

    def frame(lo: int) -> WindowSpec:
        return w.rowsBetween(lo, 0)

    df = s.positioned()
    df = df.withColumns({"_n": F.count(F.lit(1)).over(frame(-(HISTORY - 1))), "_h": F.collect_list(p).over(frame(-(HISTORY - 1)))})
    if with_next:
        # next price of the key (needs a one-row trailing halo when chunked)
        df = df.withColumn("next_price", F.lead(p, 1).over(w))
    h = F.col("_h")
    df = df.withColumns({
        **{f"_L{k}": F.lag(p, k).over(w) for k in (1, 2, 5, 9)},
        "sma_5": F.avg(p).over(frame(-4)),
        "sma_10": F.avg(p).over(frame(-9)),
        "sma_20": F.avg(p).over(frame(-19)),
        "_sd20": F.stddev_pop(p).over(frame(-19)),
    })
    prev = F.col("_L1")
    df = df.withColumns({"_delta": p - prev, "_ret": F.try_divide(p - prev, prev)})
    # second window pass over the same partitioning/order: no new exchange or sort
    d = F.col("_delta")
    df = df.withColumns({
        "_gain": F.sum(F.when(d > 0, d).otherwise(F.lit(0.0))).over(frame(-13)),
        "_loss": F.sum(F.when(d < 0, -d).otherwise(F.lit(0.0))).over(frame(-13)),
        "_vol": F.stddev_pop("_ret").over(frame(-18)),
    })
    df = df.filter(F.col(REAL) & (F.col("_n") >= WARMUP))
    nn = F.col("_n")
    # Full history: fixed weights over h[0..99].  Warm-up (n < 100, at most 99
    # rows per key): the folds themselves; three different expressions, so
    # none is hoisted out of its CASE branch and they run on warm-up rows only.
    full = fold_weights(HISTORY)

    def steady(weights) -> Column:
        # one SQL expression (parsed once) instead of hundreds of Column calls
        return F.expr(balanced_sql([f"_h[{j}] * {wgt!r}D" for j, wgt in enumerate(weights) if wgt != 0.0]))

    df = df.withColumns({
        "_fast": F.when(nn >= HISTORY, steady(full["fast"])).otherwise(ema_only_fold(h, FAST)),
        "_slow": F.when(nn >= HISTORY, steady(full["slow"])).otherwise(ema_only_fold(h, SLOW)),
        "_sig": F.when(nn >= HISTORY, steady(full["sig"])).when(nn >= SLOW + SIGNAL, ema_fold(h)["sig"]),
    })
    avg_gain = F.col("_gain") / F.lit(14.0)
    avg_loss = F.col("_loss") / F.lit(14.0)
    rsi = F.when(avg_loss == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + avg_gain / avg_loss))
    macd_line = F.when(nn >= SLOW, F.col("_fast") - F.col("_slow"))
    macd_signal = F.when(nn >= SLOW + SIGNAL, F.col("_sig"))
    lag9 = F.col("_L9")
    out = df.withColumns({
        "current_price": p,
        "sma_5": F.when(nn >= 5, F.col("sma_5")),
        "sma_10": F.when(nn >= 10, F.col("sma_10")),
        "sma_20": F.when(nn >= 20, F.col("sma_20")),
        "ema_12": F.when(nn >= FAST, F.col("_fast")),
        "ema_26": F.when(nn >= SLOW, F.col("_slow")),
        "rsi_14": F.when(nn >= 15, rsi),
        "macd_line": macd_line,
        "macd_signal": macd_signal,
        "macd_histogram": macd_line - macd_signal,
        "bb_upper": F.when(nn >= 20, F.col("sma_20") + F.lit(2.0) * F.col("_sd20")),
        "bb_middle": F.when(nn >= 20, F.col("sma_20")),
        "bb_lower": F.when(nn >= 20, F.col("sma_20") - F.lit(2.0) * F.col("_sd20")),
        "volatility_20": F.when(nn >= 20, F.col("_vol") * F.lit(ANNUALIZE)),
        "momentum_10": F.when(nn >= 10, F.try_divide(p - lag9, lag9)),
        "price_change": F.when(nn >= 2, p - prev),
        "price_change_pct": F.when(nn >= 2, F.try_divide(p - prev, prev) * F.lit(100.0)),
        "lag_1": prev,
        "lag_2": F.col("_L2"),
        "lag_5": F.col("_L5"),
        "tick_number": F.col(ORD) + F.lit(1),
    })
    return out


def sequenced_indicators(df: DataFrame, keys=("symbol",), order=("ts", "event_id"), price: str = "price",
                         chunked: bool = True, with_next: bool = False) -> tuple[DataFrame, str | bool]:
    """``with_indicators`` that keeps the chunk and ordinal of every row, for
    operators that go on in the same partitions; and how keys were cut (``Sequenced.form``)."""
    keys, order = list(keys), list(order)
    s = sequence(df, keys, order, before=HISTORY - 1, after=1 if with_next else 0) if chunked else plain(df, keys, order)
    out = indicator_frame(s, price, with_next=with_next)
    return out.drop(*[c for c in out.columns if c.startswith("_") and c not in (CHUNK, ORD)]), s.form


def with_indicators(df: DataFrame, keys=("symbol",), order=("ts", "event_id"), price: str = "price",
                    chunked: bool = True, with_next: bool = False) -> DataFrame:
    """Feature record per tick: all input columns + ``current_price`` +
    FEATURE_COLUMNS + ``tick_number`` (1-based position in the key), and
    ``next_price`` (the key's next price, for labels) when ``with_next``."""
    return sequenced_indicators(df, keys, order, price, chunked, with_next)[0].drop(CHUNK, ORD)


def newest(df: DataFrame, rows: int, keys=("symbol",), order=("ts", "event_id")) -> DataFrame:
    """The newest ``rows`` of every key: a partial top-k runs before the
    shuffle, so a hot key sends at most ``rows`` rows per task."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_newest", F.row_number().over(w)).filter(F.col("_newest") <= rows).drop("_newest")
