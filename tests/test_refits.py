"""Compiled refits against the NumPy ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.functions.signals import MODEL_SIGNALS, TRAINING
from tickforge.operators import learning as ml
from tickforge.operators import refits
from tickforge.operators import trees as T
from tickforge.streaming import keyed

FEATURES = ", ".join(f"{c} double" for c in ml.ONLINE_FEATURES)


def series(n, seed, step=None):
    """Feature rows of a random walk; with ``step`` values come again and again."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)) * [20, 1, 0.3, 0.1, 2, 1]
    x[:, 5] = 50 + x[:, 5].cumsum()
    if step:
        x = np.round(x / step) * step
    x[:26, 1] = np.nan
    x[rng.random((n, 6)) < 0.01] = np.nan
    x[:, 5] = np.where(np.isnan(x[:, 5]), 50.0, x[:, 5])
    return x


def numpy_said(x, y, number, every, buffer, first, last, rounds, n_bins):
    out = {}
    for epoch in range(first, last + 1):
        a, b = np.searchsorted(number, [epoch * every - buffer + 1, epoch * every + 1])
        yy = y[a:b].astype(float)
        yy[number[a:b] == epoch * every] = 0.0
        model = ml.fit_online(x[a:b], yy, rounds, n_bins)
        at = np.flatnonzero(number // every == epoch)
        said = ml.online_labels(model, x[at])
        out |= {int(number[k]): tuple(said[c][i] for c in MODEL_SIGNALS) for i, k in enumerate(at)}
    return out


@pytest.mark.parametrize("step, every, buffer, rounds, n_bins", [
    (None, 100, 1500, {"XGBoost": 30, "RandomForest": 30, "AdaBoost": 30}, 32),
    (0.5, 50, 420, {"XGBoost": 12, "RandomForest": 20, "AdaBoost": 12}, 16),
    (5.0, 40, 100, {"XGBoost": 5, "RandomForest": 7, "AdaBoost": 20}, 10),
])
def test_compiled_refits_equal_numpy(spark, step, every, buffer, rounds, n_bins):
    """Of all four models, on whole and partly filled buffers with missing, repeated and tied values."""
    n, last = 2000, 2000 // every - 1
    x, number = series(n, 7, step), np.arange(1, n + 1)
    y = np.append(x[1:, 5] > x[:-1, 5], False).astype(int)
    first = max(2, last - 12)
    of = [int(k) // every if first <= k // every <= last else None for k in number]
    rows = [(int(k), int(v), o, *[None if np.isnan(a) else float(a) for a in r]) for k, v, o, r in zip(number, y, of, x)]
    one = spark.createDataFrame(rows, f"_m long, label int, of long, {FEATURES}").groupBy().agg(F.sort_array(F.collect_list(F.struct("*"))).alias("r"))
    got = one.select(F.inline(refits.labelled(spark, F.col("r"), every, buffer, rounds, n_bins)))
    got = {r["_m"]: tuple(r[c] for c in MODEL_SIGNALS) for r in got.select("_m", *[v.alias(c) for c, v in refits.label_columns(F.col("said")).items()]).collect()}
    want = numpy_said(x, y, number, every, buffer, first, last, rounds, n_bins)
    assert len(got) > 500 and got == want and len(set(got.values())) > 4


def test_bootstrap_draws_equal_numpy(spark):
    """Tree after tree from one stream of numbers, also from the draws that are kept."""
    jvm, n = spark._jvm, 700
    cls = refits._classes(spark).loadClass("tickforge.Refit$Draws")
    made = cls.getDeclaredConstructors()[0]
    made.setAccessible(True)
    sample, uniform = (next(m for m in cls.getDeclaredMethods() if m.getName() == k) for k in ("sample", "uniform"))
    for m in (sample, uniform):
        m.setAccessible(True)
    objects = lambda *a: refits._java_array(spark, jvm.java.lang.Object, list(a))
    for _ in range(2):
        rng = np.random.default_rng(T.SEED)
        draws = made.newInstance(objects(refits._java_array(spark, jvm.long, refits.seed_words())))
        for k in range(4):
            drawn = np.frombuffer(sample.invoke(draws, objects(jvm.java.lang.Integer.valueOf(n))), dtype=np.int8)
            assert drawn.tolist() == rng.multinomial(n, np.full(n, 1 / n)).tolist()
            assert [uniform.invoke(draws, objects()) for _ in range(k)] == rng.random(k).tolist()


def messages(spark, symbols):
    """(symbol, tick_number, label, price ..) rows from the 5th tick on."""
    rows = []
    for s, n in symbols.items():
        x = series(n, len(rows) + 1)
        y = np.append(x[1:, 5] > x[:-1, 5], False).astype(int)
        rows += [(s, k + 5, float(x[k + 1, 5]) if k + 1 < n else None, *[None if np.isnan(a) else float(a) for a in x[k]]) for k in range(n)]
    return spark.createDataFrame(rows, f"symbol string, tick_number long, next_price double, {FEATURES}")


def test_refits_run_compiled(spark):
    """No Python worker fits or checks a refit, and the block of a refit does not change its labels."""
    rounds = {"XGBoost": 2, "RandomForest": 2, "AdaBoost": 2}
    f = messages(spark, {"A": 260, "B": 49, "C": 120})
    got = ml.walk_forward_labels(f, every=20, buffer_rows=90, rounds=rounds)
    plan = got._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan
    cols = ["symbol", "message_number", "epoch", "model_epoch", *MODEL_SIGNALS]
    rows = sorted(map(tuple, got.select(*cols).collect()), key=str)
    for block in (1, 3):
        other = ml.walk_forward_labels(f, every=20, buffer_rows=90, rounds=rounds, block=block)
        assert rows == sorted(map(tuple, other.select(*cols).collect()), key=str)
    assert all((r[4] == TRAINING) == (r[3] is None) for r in rows) and {r[0] for r in rows if r[4] != TRAINING} == {"A", "C"}


@pytest.mark.parametrize("every, buffer", [(10, 60), (10, 55), (20, 200), (7, 3), (50, 20)])
def test_trainable_refits_equal_a_plain_count(spark, every, buffer, monkeypatch):
    """Gaps in the numbers and stretches of one class, buffers of whole and of broken stretches."""
    monkeypatch.setattr(ml, "MIN_TRAIN_ROWS", min(50, buffer - 1))
    rng = np.random.default_rng(2)
    rows = []
    for s, n in (("A", 400), ("B", 55), ("C", 5)):
        label = (rng.random(n) < 0.5).astype(int)
        label[100:300] = 1
        rows += [(s, k, int(v)) for k, v in zip(range(1, n + 1), label) if not 150 <= k < 190]
    got = {(r.symbol, r.epoch): r.ok for r in ml.trainable_refits(spark.createDataFrame(rows, "symbol string, _m long, label int"), ["symbol"], every, buffer).collect()}
    want = {}
    for s in "ABC":
        own = [(m, v) for k, m, v in rows if k == s]
        for epoch in range(1, own[-1][0] // every + 1):
            y = np.array([0.0 if m == epoch * every else v for m, v in own if epoch * every - buffer < m <= epoch * every])
            want[s, epoch] = bool(ml._trainable(y)) if len(y) else False
    assert got == want and (buffer < 50 or len(set(want.values())) == 2)


def test_a_packed_block_keeps_its_rows():
    import pandas as pd
    rows = series(40, 3)
    ids = pd.DataFrame({"ts": pd.to_datetime(["2024-01-01 00:00:00.123456", None, "1969-12-31 23:59:59.999999"]), "event_id": [7.0, 8.0, np.nan]})
    begin, back, known, block = keyed.unpacked(keyed.packed(11, rows, ids, [(20, 21, 2), (22, 22, 2)]))
    assert begin == 11 and np.array_equal(back, rows, equal_nan=True) and block == [(20, 21, 2), (22, 22, 2)]
    assert known["ts"].astype(str).tolist() == ids["ts"].astype(str).tolist() and known["event_id"].tolist()[:2] == [7, 8] and known["event_id"].isna().tolist() == [False, False, True]


def test_packed_blocks_are_fitted_alike(spark):
    """Of a stream's blocks: compiled code and fit_blocks give the same messages."""
    import datetime as dt

    import pandas as pd
    rounds, every, buffer, n_bins = {"XGBoost": 4, "RandomForest": 4, "AdaBoost": 4}, 10, 80, 16
    rows = series(300, 5)
    block = [(100, 109, 10), (110, 119, 11), (120, 129, 11), (130, 139, 13)]
    ids = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=40, freq="1min") + pd.Timedelta(microseconds=3), "event_id": np.arange(40) + 5})
    ids.loc[3, "ts"] = pd.NaT
    job = keyed.packed(1, rows, ids, block)
    got = spark.createDataFrame([(job,)], "job binary").select(F.inline(refits.messages(spark, F.col("job"), every, buffer, rounds, n_bins)))
    got = got.select("ts", "event_id", "message_number", "model_epoch", *[v.alias(c) for c, v in refits.label_columns(F.col("said")).items()]).collect()
    frame = pd.DataFrame({"symbol": ["A"], "refits": [job]})
    want = pd.concat(list(keyed.fit_blocks(every, buffer, rounds, n_bins)(iter([frame])))[1:], ignore_index=True)
    assert len(got) == len(want) == 40 and got[3].ts is None and got[0].ts == dt.datetime(2024, 1, 1, 0, 0, 0, 3)
    cols = ["event_id", "message_number", "model_epoch", *MODEL_SIGNALS]
    assert [tuple(r[c] for c in cols) for r in got] == [tuple(r) for r in want[cols].itertuples(index=False)]
    assert [r.ts for r in got] == [None if pd.isna(t) else t.to_pydatetime() for t in want["ts"]]
