"""Keyed state: indicators and price changes per symbol, tick by tick.

``transformWithStateInPandas`` with one value per symbol in the RocksDB state
store: how many ticks the symbol has had and its newest 100 prices.  A
micro-batch reads and writes that one value per symbol it touches, so the state
is bounded by symbols x 100 prices and its cost by the batch, not by all keys
(the state table of ``streams.run_with_history`` is the form for symbols too hot
for one task per micro-batch).  An idle time in milliseconds lets the state of
symbols without ticks expire; such a stream looks at the clock for ever, so it
needs a trigger by time and does not end by draining.

The indicators of a batch's rows are array expressions over their 100 newest
prices (a sliding view); EMA and MACD, which are linear in these, are products
with the weights that the batch operator derives from the same fold.

``label_stream`` goes on to the models: it keeps a symbol's newest feature
messages as well, in slots of ``every`` messages of which a micro-batch writes
only those it adds to, and its newest models.  At each ``every``-th message the
models are refitted on the buffer; a message is labelled by the newest refit at
or before it.  Of a symbol's refits in one micro-batch only the newest, which the
state keeps, is fitted in the symbol's task; the others are dealt out in blocks, which
compiled code fits (module ``refits``).  That is the schedule of
``learning.walk_forward_labels``, tick by tick, with the same labels.

Within a micro-batch the ticks of a symbol are taken in (ts, event_id) order,
across batches in arrival order.  Missing values are null.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.signals import MODEL_SIGNALS, TRAINING
from ..operators import learning as ml
from ..operators import refits
from ..operators.indicators import ANNUALIZE, FAST, FEATURE_COLUMNS, HISTORY, SIGNAL, SLOW, WARMUP, fold_weights

SLICE = 20_000  # rows whose windows are held at once
RING = "seen long, prices array<double>"
INDICATORS_OUT = "symbol string, ts timestamp_ntz, event_id long, tick_number long, current_price double, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
LABELS_OUT = "symbol string, ts timestamp_ntz, event_id long, message_number long, model_epoch long, " + ", ".join(f"{c} string" for c in MODEL_SIGNALS)
CHANGES_OUT = "symbol string, ts timestamp_ntz, event_id long, price double, price_change double"


@lru_cache(maxsize=HISTORY + 1)
def _weights(n: int) -> np.ndarray:
    """Weights of n retained prices (oldest first) in the fast and slow EMA and the MACD signal."""
    w = fold_weights(n)
    return np.array([w["fast"], w["slow"], w["sig"]]).T


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, missing where b is zero."""
    return np.divide(a, b, out=np.full(a.shape, np.nan), where=b != 0)


def indicator_arrays(windows: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """FEATURE_COLUMNS of rows whose 100 newest prices are ``windows`` (rows x 100,
    newest last, NaN before the first) and whose retained prices number ``n``."""
    p, prev = windows[:, -1], windows[:, -2]
    delta = np.diff(windows, axis=1)

    def least(k: int, x: np.ndarray) -> np.ndarray:
        return np.where(n >= k, x, np.nan)

    folds = windows @ _weights(HISTORY)
    for k in np.unique(n[n < HISTORY]):
        of = n == k
        folds[of] = windows[of, -k:] @ _weights(int(k))
    gain, loss = (np.where(d > 0, d, 0.0).sum(axis=1) / 14 for d in (delta[:, -14:], -delta[:, -14:]))
    rsi = np.where(loss == 0, 100.0, 100.0 - 100.0 / (1.0 + _ratio(gain, loss)))
    middle, spread = windows[:, -20:].mean(axis=1), windows[:, -20:].std(axis=1)
    returns = _ratio(delta[:, -19:], windows[:, -20:-1])
    have = ~np.isnan(returns)
    mean = _ratio(np.where(have, returns, 0.0).sum(axis=1), have.sum(axis=1).astype(float))
    spread_r = np.sqrt(_ratio(np.where(have, (returns - mean[:, None]) ** 2, 0.0).sum(axis=1), have.sum(axis=1).astype(float)))
    line, signal = least(SLOW, folds[:, 0] - folds[:, 1]), least(SLOW + SIGNAL, folds[:, 2])
    return {
        "sma_5": least(5, windows[:, -5:].mean(axis=1)), "sma_10": least(10, windows[:, -10:].mean(axis=1)), "sma_20": least(20, middle),
        "ema_12": least(FAST, folds[:, 0]), "ema_26": least(SLOW, folds[:, 1]), "rsi_14": least(15, rsi),
        "macd_line": line, "macd_signal": signal, "macd_histogram": line - signal,
        "bb_upper": least(20, middle + 2.0 * spread), "bb_middle": least(20, middle), "bb_lower": least(20, middle - 2.0 * spread),
        "volatility_20": least(20, spread_r * ANNUALIZE), "momentum_10": least(10, _ratio(p - windows[:, -10], windows[:, -10])),
        "price_change": least(2, p - prev), "price_change_pct": least(2, _ratio(p - prev, prev) * 100.0),
        "lag_1": prev, "lag_2": windows[:, -3], "lag_5": windows[:, -6],
    }


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(["ts", "event_id"], kind="stable", ignore_index=True)


class RingProcessor(StatefulProcessor):
    """Holds the ring of a symbol and hands each micro-batch's rows on with it."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", RING, self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = _in_order(rows)
        seen, held = self.ring.get() if self.ring.exists() else (0, [])
        prices = np.concatenate((np.array(held, dtype=float), pdf["price"].to_numpy(dtype=float)))
        yield from self.compute(key[0], pdf, int(seen), prices)
        self.ring.update((int(seen) + len(pdf), prices[-HISTORY:].tolist()))

    def compute(self, symbol: str, pdf: pd.DataFrame, seen: int, prices: np.ndarray) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class Indicators(RingProcessor):
    def compute(self, symbol, pdf, seen, prices):
        before = len(prices) - len(pdf)
        padded = np.concatenate((np.full(HISTORY - 1, np.nan), prices))
        for lo in range(0, len(pdf), SLICE):
            part = pdf.iloc[lo:lo + SLICE]
            at = before + lo
            with np.errstate(invalid="ignore"):
                windows = np.lib.stride_tricks.sliding_window_view(padded[at:at + len(part) + HISTORY - 1], HISTORY)
                number = seen + lo + 1 + np.arange(len(part))
                out = indicator_arrays(np.where(np.arange(HISTORY) >= HISTORY - number[:, None], windows, np.nan), np.minimum(number, HISTORY))
            made = pd.DataFrame({"symbol": symbol, "ts": part["ts"].to_numpy(), "event_id": part["event_id"].to_numpy(), "tick_number": number,
                                 "current_price": part["price"].to_numpy(), **out})
            yield made[number >= WARMUP]


def _buffer(rows: np.ndarray, begin: int, at: int, buffer_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and labels that the refit at message ``at`` sees, of rows numbered from ``begin`` on."""
    x = rows[max(1, at - buffer_rows + 1) - begin:at - begin + 1]
    return x, np.append(x[1:, -1] > x[:-1, -1], False).astype(float)  # the newest has no next price yet


MISSING = np.iinfo(np.int64).min  # a missing time or event id in a packed block


def packed(begin: int, rows: np.ndarray, ids: pd.DataFrame, block: list) -> bytes:
    """A block of refits as 64-bit words: first number of its rows; how many rows, features, parts and
    messages; (first message, last message, refit) of each part; times in microseconds and event ids
    of the messages from the first part to the last; the rows."""
    times = ids["ts"].to_numpy("datetime64[us]").astype(np.int64)  # NaT is the least number
    events = ids["event_id"].astype("Int64").fillna(MISSING).to_numpy(np.int64)
    head = np.array([begin, *rows.shape, len(block), len(ids)], dtype=np.int64)
    return b"".join(np.ascontiguousarray(x).astype(x.dtype.newbyteorder("<")).tobytes() for x in (head, np.array(block, dtype=np.int64), times, events, rows))


def unpacked(job: bytes) -> tuple[int, np.ndarray, pd.DataFrame, list]:
    """What ``packed`` was given."""
    words = np.frombuffer(job, dtype="<i8")
    begin, n, features, parts, messages = (int(v) for v in words[:5])
    block, times, events = np.split(words[5:5 + 3 * parts + 2 * messages], [3 * parts, 3 * parts + messages])
    rows = np.frombuffer(job, dtype="<f8")[-n * features:].reshape(n, features)
    ids = pd.DataFrame({"ts": times.astype("datetime64[us]"), "event_id": pd.Series(events, dtype="Int64").mask(events == MISSING)})
    return begin, rows, ids, [tuple(map(int, p)) for p in block.reshape(-1, 3)]


class Labels(Indicators):
    """Buffer, refits and labels on top of the indicators.

    A micro-batch fits the newest refit of a symbol here, as the state holds its model.
    Where it has others, blocks of them leave in column ``refits`` with their rows and are
    fitted in other tasks."""

    def __init__(self, idle_ms: int | None = None, every: int = ml.RETRAIN_EVERY, buffer_rows: int = ml.BUFFER_ROWS, rounds: dict | None = None, n_bins: int = ml.MODEL_BINS):
        super().__init__(idle_ms)
        self.every, self.buffer_rows, self.rounds, self.n_bins = every, buffer_rows, rounds, n_bins
        self.slots = -(-buffer_rows // every) + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.messages = handle.getMapState("messages", "slot long", "number long, rows binary", self.idle_ms)
        self.models = handle.getValueState("models", "epoch long, fitted binary", self.idle_ms)

    def _slot(self, number: int) -> np.ndarray:
        """The held rows of a slot's messages (numbered from 1; slot k holds k * every + 1 ..), none if it holds others."""
        key = (number % self.slots,)
        found = self.messages.getValue(key) if self.messages.containsKey(key) else None
        rows = np.frombuffer(found[1]) if found and found[0] == number else np.empty(0)
        return rows.reshape(-1, len(ml.ONLINE_FEATURES))

    def compute(self, symbol, pdf, seen, prices):
        made = [x for x in super().compute(symbol, pdf, seen, prices) if len(x)]
        if not made:
            return
        made = pd.concat(made, ignore_index=True)
        first = int(made["tick_number"].iloc[0]) - (WARMUP - 1)  # message numbers count from the warm-up on
        new, last = made[ml.ONLINE_FEATURES].to_numpy(dtype=float), first + len(made) - 1
        low = max(1, min(first, -(-first // self.every) * self.every - self.buffer_rows + 1))  # its first refit may be at its first message
        slots = range((low - 1) // self.every, (first - 1) // self.every + 1)
        refit = (last // self.every) > ((first - 1) // self.every)
        held = [self._slot(k) for k in (slots if refit else slots[-1:])]
        rows = np.concatenate([*held, new])  # of the messages up to the last one, without a gap
        begin = last - len(rows) + 1
        epoch, fitted = self.models.get() if self.models.exists() else (None, None)
        model = None if fitted is None else pickle.loads(fitted)
        parts, at = [], first  # (first and last message, refit that labels them)
        while at <= last:
            if at % self.every == 0 and ml._trainable(_buffer(rows, begin, at, self.buffer_rows)[1]):
                epoch = at // self.every
            upto = min(last, (at // self.every + 1) * self.every - 1)
            parts.append((at, upto, epoch))
            at = upto + 1
        newest = [p for p in parts if p[2] == epoch]
        if epoch is not None and newest[0][0] == epoch * self.every:  # refitted in this batch
            model = ml.fit_online(*_buffer(rows, begin, epoch * self.every, self.buffer_rows), self.rounds, self.n_bins)
        # the newest refit goes into the state; those between it and the one held so far go to tasks of their own
        held_epoch = parts[0][2] if parts[0][2] is None or parts[0][2] * self.every < first else None
        held_model = None if fitted is None else pickle.loads(fitted)
        between, out = [], []
        for lo, hi, of in parts:
            if of is not None and of not in (epoch, held_epoch):
                between.append((lo, hi, of))
                continue
            known = made[["symbol", "ts", "event_id"]].iloc[lo - first:hi - first + 1]
            one = held_model if of == held_epoch else model
            said = dict.fromkeys(MODEL_SIGNALS, TRAINING) if of is None else ml.online_labels(one, rows[lo - begin:hi - begin + 1])
            out.append(known.assign(message_number=np.arange(lo, hi + 1), model_epoch=pd.array([of] * len(known), dtype="Int64"), **said, refits=None))
        last_slot = (last - 1) // self.every
        for k in range(max((first - 1) // self.every, last_slot - self.slots + 1), last_slot + 1):  # earlier ones have lost their place to these
            own = rows[max(0, k * self.every + 1 - begin):max(0, (k + 1) * self.every + 1 - begin)]
            self.messages.updateValue((k % self.slots,), (k, own.tobytes()))
        if epoch is not None and (fitted is None or refit):
            self.models.update((epoch, pickle.dumps(model)))
        yield from out
        for k in range(0, len(between), ml.MODEL_BLOCK):
            block = between[k:k + ml.MODEL_BLOCK]
            a, z = max(begin, block[0][2] * self.every - self.buffer_rows + 1), block[-1][1]
            ids = made[["ts", "event_id"]].iloc[block[0][0] - first:z - first + 1]
            job = packed(a, rows[a - begin:z - begin + 1], ids, block)
            yield pd.DataFrame({"symbol": [symbol], "ts": ids["ts"].iloc[:1].to_numpy(), "event_id": ids["event_id"].iloc[:1].to_numpy(), "message_number": [block[0][0]],
                                "model_epoch": pd.array([block[0][2]], dtype="Int64"), **{c: [None] for c in MODEL_SIGNALS}, "refits": [job]})


def fit_blocks(every: int, buffer_rows: int, rounds: dict | None, n_bins: int):
    """The labelled messages in the place of every row with a block of refits, by NumPy: the plain
    form of ``refits.messages``, which the stream runs."""
    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            plain = pdf["refits"].isna()
            yield pdf[plain].drop(columns="refits")
            for symbol, job in zip(pdf["symbol"][~plain], pdf["refits"][~plain]):
                begin, rows, ids, block = unpacked(job)
                last = None
                for lo, hi, epoch in block:
                    if epoch != last:  # else the message between them could not be trained on
                        last, model = epoch, ml.fit_online(*_buffer(rows, begin, epoch * every, buffer_rows), rounds, n_bins)
                    known = ids.iloc[lo - block[0][0]:hi - block[0][0] + 1]
                    yield pd.DataFrame({"symbol": symbol, "ts": known["ts"].to_numpy(), "event_id": known["event_id"].to_numpy(), "message_number": np.arange(lo, hi + 1),
                                        "model_epoch": pd.array([epoch] * len(known), dtype="Int64"), **ml.online_labels(model, rows[lo - begin:hi - begin + 1])})

    return fit


class PriceChanges(RingProcessor):
    def compute(self, symbol, pdf, seen, prices):
        before = len(prices) - len(pdf)
        last = np.concatenate(([prices[0]], prices))[before:-1] if before == 0 else prices[before - 1:-1]
        yield pd.DataFrame({"symbol": symbol, "ts": pdf["ts"], "event_id": pdf["event_id"], "price": pdf["price"], "price_change": prices[before:] - last})


def _stream(ticks: DataFrame, processor: RingProcessor, out: str) -> DataFrame:
    # an idle time is kept by the processing clock
    mode = "None" if processor.idle_ms is None else "ProcessingTime"
    return ticks.select("symbol", "ts", "event_id", "price").groupBy("symbol").transformWithStateInPandas(processor, out, "Append", mode)


def indicator_stream(ticks: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """Feature records (from a symbol's 5th tick on) of a tick stream."""
    return _stream(ticks, Indicators(idle_ms), INDICATORS_OUT)


def label_stream(ticks: DataFrame, idle_ms: int | None = None, **kw) -> DataFrame:
    """(symbol, ts, event_id, message_number, model_epoch, a label of each model): TRAINING, UP or DOWN."""
    labels = Labels(idle_ms, **kw)
    tasks = ml.refit_tasks(ticks.sparkSession, ml.TASKS_PER_CORE // 2)  # every micro-batch starts them
    dealt = _stream(ticks, labels, f"{LABELS_OUT}, refits binary").repartition(tasks, "symbol", "model_epoch")
    told = ["ts", "event_id", "message_number", "model_epoch"]
    fitted = refits.messages(ticks.sparkSession, F.col("refits"), labels.every, labels.buffer_rows, labels.rounds or ml.MODEL_ROUNDS, labels.n_bins)

    def message(m):
        said = refits.label_columns(m["said"])
        return F.struct(*[m[c].alias(c) for c in told], *[said[c].alias(c) for c in MODEL_SIGNALS])

    here = F.array(F.struct(*told, *MODEL_SIGNALS))
    return dealt.select("symbol", F.inline(F.when(F.col("refits").isNull(), here).otherwise(F.transform(fitted, message))))


def price_change_stream(ticks: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """Change against the symbol's tick before; 0.0 for its first."""
    return _stream(ticks, PriceChanges(idle_ms), CHANGES_OUT)
