"""Indicators against explicit weights and numpy on hand-made series, and
chunked plan == plain plan on real data."""

import math

import numpy as np
import pytest
from conftest import SF01, series_frame

from tickforge.operators import indicators as ind


# ---- expected values: explicit weights and numpy over the retained prices
def ema_weights(m, span):
    """Weights of m values, oldest first, in an EMA that starts from the oldest one."""
    a = 2.0 / (span + 1)
    w = a * (1 - a) ** np.arange(m - 1, -1, -1.0)
    w[0] /= a
    return w


def expected(prices):
    x = np.array(prices)
    for t in range(4, len(x)):
        kept = x[max(0, t - 99):t + 1]
        n, p = len(kept), kept[-1]
        ema = lambda k, span: float(ema_weights(k, span) @ kept[:k])
        back = lambda k: float(kept[-1 - k]) if n > k else None
        step = np.diff(kept)
        with np.errstate(divide="ignore", invalid="ignore"):
            change = np.where(kept[:-1] != 0, step / kept[:-1], np.nan)
        r = {"tick": t + 1, "lag_1": back(1), "lag_2": back(2), "lag_5": back(5), "price_change": float(step[-1]),
             "price_change_pct": None if np.isnan(change[-1]) else 100 * change[-1],
             "ema_12": ema(n, 12) if n >= 12 else None, "ema_26": ema(n, 26) if n >= 26 else None,
             "macd_line": ema(n, 12) - ema(n, 26) if n >= 26 else None}
        for w in (5, 10, 20):
            r[f"sma_{w}"] = kept[-w:].mean() if n >= w else None
        ups, downs = np.clip(step[-14:], 0, None).sum(), np.clip(-step[-14:], 0, None).sum()
        r["rsi_14"] = None if n < 15 else 100.0 if downs == 0 else 100 * ups / (ups + downs)
        line = np.array([ema(k, 12) - ema(k, 26) for k in range(27, n + 1)][-50:])
        r["macd_signal"] = float(ema_weights(len(line), 9) @ line) if len(line) >= 9 else None
        band = (kept[-20:].mean(), 2 * kept[-20:].std()) if n >= 20 else None
        r["bb_upper"], r["bb_lower"] = (band[0] + band[1], band[0] - band[1]) if band else (None, None)
        moves = change[-19:][~np.isnan(change[-19:])]
        r["volatility_20"] = moves.std() * math.sqrt(252) if n >= 20 and len(moves) else None
        r["momentum_10"] = p / back(9) - 1 if n >= 10 and back(9) else None
        yield r


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


SERIES = {
    "ramp": [float(i) for i in range(1, 121)],
    "flat": [42.0] * 50,
    "zigzag": [10.0 if i % 2 == 0 else 20.0 for i in range(60)],
    "zero_inside": [5.0, 6.0, 7.0, 6.0, 5.0, 6.0, 7.0, 0.0, 5.0, 6.0, 7.0, 8.0] * 3,
    "short": [1.0, 2.0, 3.0, 4.0],
    "wave": [100 + 10 * math.sin(i / 3.0) + (i % 7) for i in range(140)],
}


@pytest.mark.parametrize("chunked", [False, True])
def test_against_explicit_weights(spark, small_chunks, chunked):
    rows = []
    for s, prices in SERIES.items():
        rows += [(s, i, p) for i, p in enumerate(prices)]
    df = ind.with_indicators(series_frame(spark, rows), chunked=chunked)
    got = {(r["symbol"], r["tick_number"]): r.asDict() for r in df.collect()}
    cols = ["sma_5", "sma_10", "sma_20", "ema_12", "ema_26", "rsi_14", "macd_line", "macd_signal",
            "bb_upper", "bb_lower", "volatility_20", "momentum_10", "price_change", "price_change_pct",
            "lag_1", "lag_2", "lag_5"]
    expected_rows = 0
    for s, prices in SERIES.items():
        for e in expected(prices):
            expected_rows += 1
            g = got[(s, e["tick"])]
            for c in cols:
                assert _close(g[c], e[c]), (s, e["tick"], c, g[c], e[c])
    assert len(got) == expected_rows
    assert not any(k[0] == "short" for k in got)          # fewer than 5 ticks: no output


def test_warmups_on_ramp(spark):
    df = ind.with_indicators(series_frame(spark, [("R", i, float(i + 1)) for i in range(120)]), chunked=False)
    r = {x["tick_number"]: x for x in df.collect()}
    assert min(r) == 5
    assert r[9]["sma_10"] is None and r[10]["sma_10"] == pytest.approx(5.5)
    assert r[25]["ema_26"] is None and r[26]["macd_line"] is not None
    assert r[34]["macd_signal"] is None and r[35]["macd_signal"] is not None
    assert r[14]["rsi_14"] is None and r[15]["rsi_14"] == 100.0      # no losses
    assert r[50]["momentum_10"] == pytest.approx(9 / 41)             # lag 9
    assert r[50]["lag_5"] == 45.0


def test_chunked_equals_plain_on_events(spark, small_chunks):
    from tickforge.sources import tables
    t = tables.clean_ticks(tables.ticks(spark, SF01))
    cols = ["symbol", "ts", "event_id", "tick_number", *ind.FEATURE_COLUMNS]
    a = ind.with_indicators(t, chunked=True).select(*cols)
    b = ind.with_indicators(t, chunked=False).select(*cols)
    assert a.count() == b.count() == 9940
    ra = sorted(a.collect())
    rb = sorted(b.collect())
    for x, y in zip(ra, rb):
        for c in cols:
            assert _close(x[c], y[c]) if isinstance(x[c], float) else x[c] == y[c], (c, x, y)
