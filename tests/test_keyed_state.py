"""Keyed state: parity with the batch operator, restart, replay, bounds; the state table likewise."""

import os

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F
from test_streaming import _place, split_events  # noqa: F401

from tickforge.operators import indicators as ind
from tickforge.session import list_folder
from tickforge.sources import tables
from tickforge.streaming import keyed, streams

COLS = ["symbol", "event_id", "tick_number", "current_price", *ind.FEATURE_COLUMNS]


@pytest.fixture()
def source(split_events, tmp_path):  # noqa: F811
    root, schema = split_events
    src = tmp_path / "in"
    src.mkdir()
    return root, schema, src


def opened(spark, schema, src):
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    return tables.clean_ticks(tables.ticks_from_events(s))


def same(got, want):
    a, b = sorted(got.select(*COLS).collect()), sorted(want.select(*COLS).collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for c in COLS:
            assert x[c] == (pytest.approx(y[c], rel=1e-9, abs=1e-9) if isinstance(y[c], float) else y[c]), (c, x, y)


def batch(spark):
    return ind.with_indicators(tables.clean_ticks(tables.ticks(spark, SF001)), chunked=False)


@pytest.mark.parametrize("form", ["keyed", "table"])
def test_restart_and_replay(spark, source, tmp_path, form):
    root, schema, src = source
    table, ckpt, state = (str(tmp_path / x) for x in ("table", "ckpt", "state"))

    def run():
        ticks = opened(spark, schema, src)
        if form == "keyed":
            q, _ = streams.run_to_table(keyed.indicator_stream(ticks), "x", checkpoint=ckpt, table=table)
        else:
            q, _ = streams.indicator_table(ticks, "x", checkpoint=ckpt, table=table, state=state)
        q.awaitTermination()

    _place(root, src, range(2))
    run()
    _place(root, src, range(2, 4))
    run()  # goes on from the checkpoint
    same(spark.read.parquet(table), batch(spark))
    before = {b: spark.read.parquet(f"{table}/batch_id={b}").select(*COLS).collect() for b in range(4)}
    # as if the last batch had been written, but not committed: it runs again and replaces its own rows
    for name in ("3", ".3.crc"):
        os.remove(f"{ckpt}/commits/{name}")
    run()
    assert sorted(before[3]) == sorted(spark.read.parquet(f"{table}/batch_id=3").select(*COLS).collect())
    same(spark.read.parquet(table), batch(spark))
    if form == "table":
        assert sorted(list_folder(spark, state)) == ["batch_id=2", "batch_id=3"]


def test_trigger_by_time(spark, source):
    root, schema, src = source
    _place(root, src, range(4))
    for start in (lambda t: streams.run_to_table(keyed.indicator_stream(t), "timed", processing_time="100 milliseconds"),
                  lambda t: streams.indicator_table(t, "timed", processing_time="100 milliseconds")):
        q, table = start(opened(spark, schema, src))
        q.processAllAvailable()
        q.stop()
        same(spark.read.parquet(table), batch(spark))


def test_price_changes(spark, source):
    root, schema, src = source
    _place(root, src, range(4))
    got = streams.drain(keyed.price_change_stream(opened(spark, schema, src)), "changes")
    want = streams.drain(streams.price_change_stream(opened(spark, schema, src)), "changes-old")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 1000


def test_state_is_a_ring_per_symbol(spark, source, tmp_path):
    root, schema, src = source
    _place(root, src, range(4))
    ckpt = str(tmp_path / "ckpt")
    q, _ = streams.run_to_table(keyed.indicator_stream(opened(spark, schema, src)), "ring", checkpoint=ckpt)
    q.awaitTermination()
    held = spark.read.format("statestore").option("stateVarName", "ring").load(ckpt)
    per = {r.s: (r.seen, r.n) for r in held.select(F.col("key.symbol").alias("s"), "value.seen", F.size("value.prices").alias("n")).collect()}
    ticks = {r.symbol: r["count"] for r in tables.ticks(spark, SF001).groupBy("symbol").count().collect()}
    assert per == {s: (n, min(n, ind.HISTORY)) for s, n in ticks.items()}


def test_idle_state_expires(spark, source, tmp_path):
    import time
    root, schema, src = source
    _place(root, src, range(1))
    q, table = streams.run_to_table(keyed.price_change_stream(opened(spark, schema, src), idle_ms=1000), "idle",
                                    checkpoint=str(tmp_path / "ckpt"), processing_time="100 milliseconds")
    try:
        def wait(n):
            until = time.time() + 60
            while time.time() < until and sum(p["numInputRows"] for p in q.recentProgress) < n:
                time.sleep(0.2)

        first = spark.read.parquet(str(src)).count()
        wait(first)
        time.sleep(1.5)
        _place(root, src, range(1, 2))
        wait(spark.read.parquet(str(src)).count())
    finally:
        q.stop()
    later = spark.read.parquet(table)
    later = later.filter(F.col("batch_id") > later.filter("price_change = 0").agg(F.min("batch_id")).first()[0])
    firsts = later.groupBy("symbol").agg(F.min_by("price_change", F.struct("ts", "event_id")).alias("c")).collect()
    assert firsts and all(r.c == 0.0 for r in firsts)  # nothing is remembered of the first file


def test_arrays_on_odd_prices():
    prices = np.array([0.0, 0.0, 5.0, 5.0, 0.0, 3.0] + [7.0] * 30)
    padded = np.concatenate((np.full(ind.HISTORY - 1, np.nan), prices))
    windows = np.lib.stride_tricks.sliding_window_view(padded, ind.HISTORY)
    with np.errstate(invalid="ignore"):
        out = keyed.indicator_arrays(windows, np.arange(1, len(prices) + 1))
    assert np.isnan(out["price_change_pct"][[0, 1, 2, 5]]).tolist() == [True, True, True, True] and out["price_change_pct"][3] == 0.0
    assert out["rsi_14"][-1] == 100.0 and out["volatility_20"][-1] == 0.0 and np.isnan(out["momentum_10"][13])
    assert np.isnan(out["sma_20"][18]) and out["sma_20"][-1] == 7.0


def test_labels_equal_the_batch_refits(spark, source, tmp_path):
    """Four micro-batches with a restart, against walk_forward_labels."""
    from tickforge.functions.signals import MODEL_SIGNALS
    from tickforge.operators import learning as ml
    rounds = {"XGBoost": 3, "RandomForest": 4, "AdaBoost": 3}
    root, schema, src = source
    table, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    for parts in (range(2), range(2, 4)):
        _place(root, src, parts)
        s = keyed.label_stream(opened(spark, schema, src), every=10, buffer_rows=55, rounds=rounds)
        streams.run_to_table(s, "labels", checkpoint=ckpt, table=table)[0].awaitTermination()
    path = str(tmp_path / "features")
    ind.with_indicators(tables.clean_ticks(tables.ticks(spark, SF001)), with_next=True).write.parquet(path)
    want = ml.walk_forward_labels(spark.read.parquet(path), every=10, buffer_rows=55, rounds=rounds)
    cols = ["symbol", "message_number", "event_id", "model_epoch", *MODEL_SIGNALS]
    a, b = (sorted(map(str, map(tuple, x.select(*cols).collect()))) for x in (spark.read.parquet(table), want))
    assert a == b and sum("TRAINING" not in r for r in a) > 100


class Held:
    """A state variable in memory."""

    def __init__(self):
        self.value, self.slots = None, {}

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def containsKey(self, key):
        return key in self.slots

    def getValue(self, key):
        return self.slots[key]

    def updateValue(self, key, value):
        self.slots[key] = value


def test_one_refit_per_symbol_and_batch_stays_in_its_task(monkeypatch):
    """A batch with dozens of refits hands all but the newest on; the labels are those of batches of one message."""
    import pandas as pd

    from tickforge.functions.signals import MODEL_SIGNALS
    from tickforge.operators import learning as ml
    rng = np.random.default_rng(3)
    price = 50 + rng.normal(size=330).cumsum()
    price[120:200] = 50 + np.arange(80)  # a stretch of one class: refits that cannot be trained
    ticks = pd.DataFrame({"symbol": "A", "price": price, "ts": pd.date_range("2024-01-01", periods=330, freq="min"), "event_id": np.arange(330)})
    fits, plain = [], ml.fit_online
    monkeypatch.setattr(ml, "fit_online", lambda *a: fits.append(1) or plain(*a))
    kw = {"every": 5, "buffer_rows": 55, "rounds": {"XGBoost": 2, "RandomForest": 2, "AdaBoost": 2}, "n_bins": 8}

    def run(cuts):
        p = keyed.Labels(**kw)
        p.ring, p.messages, p.models = Held(), Held(), Held()
        out, most = [], 0
        for lo, hi in zip([0, *cuts], [*cuts, 330]):
            fits.clear()
            out += list(p.handleInputRows(("A",), iter([ticks.iloc[lo:hi]]), None))
            most = max(most, len(fits))
        got = pd.concat(keyed.fit_blocks(kw["every"], kw["buffer_rows"], kw["rounds"], kw["n_bins"])(iter(out)), ignore_index=True).sort_values("message_number")
        return [tuple(map(str, r)) for r in got.assign(model_epoch=got["model_epoch"].astype("Int64"))[["event_id", "message_number", "model_epoch", *MODEL_SIGNALS]].itertuples(index=False)], most

    (whole, once), (some, _), (each, _) = run([]), run([90, 91, 260]), run(range(1, 330))
    assert once == 1 and len(whole) == 326 and len({r[2] for r in whole}) > 30 and whole == some == each
