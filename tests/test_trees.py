"""Binned trees, boosting, stumps and keyed refits against plain forms."""

import math

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tickforge.functions.signals import MODEL_SIGNALS, TRAINING
from tickforge.operators import indicators as ind
from tickforge.operators import learning as ml
from tickforge.operators import trees as T
from tickforge.sources import tables


def plain_tree(bins, g, h, depth, l2, least):
    """Greedy splits one node at a time: a nested (feature, bin, left, right) or a value."""
    G, H = g.sum(), h.sum()
    best = None
    if depth:
        for j in range(bins.shape[1]):
            for k in sorted(set(bins[:, j]))[:-1]:
                left = bins[:, j] <= k
                gl, hl = g[left].sum(), h[left].sum()
                if hl < least or H - hl < least:
                    continue
                gain = gl ** 2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G ** 2 / (H + l2)
                if gain > T.GAIN and (best is None or gain > best[0] * (1 + 1e-11)):
                    best = (gain, j, k, left)
    if best is None:
        return -G / (H + l2)
    _, j, k, left = best
    return j, k, *(plain_tree(bins[m], g[m], h[m], depth - 1, l2, least) for m in (left, ~left))


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def sample(n=1000, seed=1, features=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 20, (n, features))
    y = ((x[:, 0] + rng.normal(0, 4, n) > 9) ^ (x[:, 1] > 15)).astype(float)
    return x, y


def test_trees_equal_a_plain_recursion():
    for seed, depth, l2, least in ((1, 3, 1.0, 1.0), (2, 6, 0.0, 5.0), (3, 1, 1.0, 1.0)):
        x, y = sample(300, seed)
        p = np.full(len(y), 0.4)
        g, h = p - y, p * (1 - p)
        got = T.leaf_values(T.grow(x, g, h, depth, 20, l2, least), x)
        tree = plain_tree(x, g, h, depth, l2, least)
        assert got == pytest.approx([plain_value(tree, r) for r in x], rel=1e-9)


def test_boosting_equals_a_plain_form_on_1000_rows():
    x, y = sample()
    margin = np.full(len(y), 4 * (y.mean() - 0.5))
    start, trees = T.boosted(x, y, np.ones(len(y)), 20, rounds=8)
    assert start == pytest.approx(margin[0])
    for t in trees:
        p = 1 / (1 + np.exp(-margin))
        tree = plain_tree(x, p - y, p * (1 - p), T.BOOST_DEPTH, T.L2, T.MIN_HESSIAN)
        step = np.array([plain_value(tree, r) for r in x]) * T.SHRINKAGE
        assert T.leaf_values(t, x) == pytest.approx(step, rel=1e-7, abs=1e-10)
        margin += step


def test_stumps_equal_a_plain_search():
    x, y = sample(400, 5, 2)
    w = np.full(len(y), 1 / len(y))
    found, alphas = T.stumps(x, y, np.ones(len(y)), 20, 12)
    assert len(found) == len(alphas) > 5
    for (j, k, low, high), alpha in zip(found, alphas):
        best = None
        for f in range(2):
            for c in range(19):
                left = x[:, f] <= c
                parts = [(w[m & (y == 0)].sum(), w[m & (y == 1)].sum()) for m in (left, ~left)]
                if min(sum(p) for p in parts) <= 0:
                    continue
                gini = sum(sum(p) * (1 - sum((v / sum(p)) ** 2 for v in p)) for p in parts)
                if best is None or gini < best[0] - 1e-12:
                    best = (gini, f, c, *(float(p[1] > p[0]) for p in parts))
        assert (j, k, low, high) == best[1:]
        miss = np.where(x[:, j] <= k, low, high) != y
        error = w[miss].sum()
        assert alpha == pytest.approx(math.log((1 - error) / error))
        w = np.where(miss, w * math.exp(alpha), w)
        w /= w.sum()


def test_cells_say_all_that_rows_say(spark):
    x, y = sample(2000, 7)
    rows = [(float(a) if a != 3 else None, float(b), float("nan") if c == 0 else float(c), int(v)) for (a, b, c), v in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, `b x` double, c double, label int").repartition(3)
    names = ["a", "b x", "c"]
    n_bins = T.bins_for(3)
    assert n_bins == 64 and n_bins ** 3 <= T.CELLS and T.bins_for(6) ** 6 <= T.CELLS and T.bins_for(1) == T.MOST_BINS
    model = T.fit_boosting(df, names, rounds=5)
    fill = [np.mean([r[i] for r in rows if r[i] is not None and r[i] == r[i]]) for i in range(3)]
    values = np.array([[fill[i] if r[i] is None or r[i] != r[i] else r[i] for i in range(3)] for r in rows])
    bins = T.cut_bins(values, [np.array(e) for e in model.cuts])
    start, trees = T.boosted(bins, y, np.ones(len(y)), n_bins, 5)
    want = start + sum(T.leaf_values(t, bins) for t in trees)
    got = {(r.a, r["b x"], str(r.c)): r.margin for r in model.transform(df).collect()}
    assert [got[r[0], r[1], str(r[2])] for r in rows] == pytest.approx(want.tolist(), rel=1e-6)
    assert T.cells(df, names, "label", model.cuts, model.fill).count() <= 2 * T.CELLS


def test_empty_training_rows(spark):
    none = spark.createDataFrame([], "a double, b double, label int")
    some = spark.createDataFrame([(1.0, 2.0, 1)], "a double, b double, label int")
    assert T.fit_boosting(none, ["a", "b"]).transform(some).first().prediction == 0.0


def test_adaboost_on_one_class_or_one_value(spark):
    for rows, want in (([(1.0, 2.0, 1)] * 5, 1.0), ([(1.0, 2.0, 0)] * 5, 0.0)):
        df = spark.createDataFrame(rows, "a double, b double, label int")
        assert ml.fit_adaboost(df, ["a", "b"], rounds=3).transform(df).first().prediction == want


ROUNDS = {"XGBoost": 3, "RandomForest": 4, "AdaBoost": 3}


def test_keyed_refits_follow_a_plain_schedule(spark):
    """Refits every 20 messages on the newest 60, over several blocks, with a stretch of one class."""
    ticks = tables.clean_ticks(tables.ticks(spark, SF001))
    features = ind.with_indicators(ticks, with_next=True).filter("symbol < 'CLICK J'")
    flat = F.when((F.col("tick_number") > 30) & (F.col("tick_number") < 64), F.lit(1e6)).otherwise(F.col("current_price"))
    features = features.withColumn("current_price", flat)
    path = ml.scratch_path(spark, "features-of-the-refit-test")
    features.write.mode("overwrite").parquet(path)
    f = spark.read.parquet(path)
    every, buffer = 10, 60
    got = ml.walk_forward_labels(f, every=every, buffer_rows=buffer, block=2, rounds=ROUNDS)
    assert set(f.columns) <= set(got.columns)
    rows = {}
    for r in ml.labels_from_next(f).collect():
        rows.setdefault(r.symbol, {})[r.tick_number - 4] = r
    seen = 0
    for r in got.collect():
        said = [r[c] for c in MODEL_SIGNALS]
        assert (said.count(TRAINING) in (0, 4)) and (said[0] == TRAINING) == (r.model_epoch is None)
        of = rows[r.symbol]
        last = None
        for epoch in range(r.message_number // every, 0, -1):
            held = [of[m] for m in range(max(1, epoch * every - buffer + 1), epoch * every + 1)]
            y = np.array([float(h.label) for h in held[:-1]] + [0.0])
            if len(y) >= 50 and 0 < y.sum() < len(y):
                last = epoch
                break
        assert r.model_epoch == last
        if last is None or r.message_number % 3:
            continue
        x = np.array([[np.nan if h[c] is None else h[c] for c in ml.ONLINE_FEATURES] for h in held], dtype=float)
        own = np.array([[np.nan if of[r.message_number][c] is None else of[r.message_number][c] for c in ml.ONLINE_FEATURES]])
        want = ml.online_labels(ml.fit_online(x, y, ROUNDS), own)
        assert {c: r[c] for c in want} == {c: v[0] for c, v in want.items()}
        seen += 1
    assert seen > 5


def test_all_four_models_leave_the_warm_up_together(spark, monkeypatch):
    from tickforge import catalog as c
    monkeypatch.setattr(ml, "MODEL_ROUNDS", ROUNDS)
    monkeypatch.setattr(ml.walk_forward_labels, "__defaults__", (("symbol",), ("ts", "event_id"), 20, 200, 10, ROUNDS, 16))
    got = c.QUERIES["model_prediction_records"](spark, SF001).cache()
    plain = c.QUERIES["prediction_records"](spark, SF001)
    assert set(got.columns) == set(plain.columns)
    assert sorted(got.select("event_id", "RSI_Rule", "BB_Rule").collect()) == sorted(plain.select("event_id", "RSI_Rule", "BB_Rule").collect())
    said = [tuple(r) for r in got.select(*MODEL_SIGNALS).collect()]
    assert {s.count(TRAINING) for s in said} == {0, 4}
    got.unpersist()
    m = {(r.symbol, r.signal): r.final_value for r in c.QUERIES["backtest_all_signals"](spark, SF001).collect()}
    rules = {(r.symbol, r.signal): r.final_value for r in c.QUERIES["backtest_metrics"](spark, SF001).collect()}
    assert {k[1] for k in m} >= set(MODEL_SIGNALS) and all(m[k] == v for k, v in rules.items())


def test_forest_equals_a_plain_form():
    """Draw after draw: all rows, all features, a split among those drawn for a node (heap order)."""
    x, y = sample(200, 9, 5)
    for tree, got in zip(range(3), T.forest(x, y, 20, 3, 4)):
        if not tree:
            rng = np.random.default_rng(T.SEED)
        w = rng.multinomial(200, np.full(200, 1 / 200)).astype(float)
        feature, cut, value = np.full(31, -1), np.zeros(31, dtype=int), np.zeros(31)
        nodes = {0: np.ones(200, dtype=bool)}
        for level in range(5):
            for k, m in nodes.items():
                value[k] = (w * y)[m].sum() / w[m].sum()
            if level == 4:
                break
            drawn, after = rng.random((len(nodes), 5)).argsort(axis=1) < 2, {}
            for (k, m), may in zip(nodes.items(), drawn):
                best = T.GAIN
                for j in np.flatnonzero(may):
                    for c in range(19):
                        left, right = m & (x[:, j] <= c), m & (x[:, j] > c)
                        if min(w[left].sum(), w[right].sum()) >= 1:
                            gain = sum((w * y)[s].sum() ** 2 / w[s].sum() for s in (left, right)) - (w * y)[m].sum() ** 2 / w[m].sum()
                            if gain > best * (1 + 1e-11):
                                best, feature[k], cut[k] = gain, j, c
                if feature[k] >= 0:
                    after[2 * k + 1], after[2 * k + 2] = m & (x[:, feature[k]] <= cut[k]), m & (x[:, feature[k]] > cut[k])
            nodes = after
        assert got[0].tolist() == feature.tolist() and got[1].tolist() == cut.tolist() and got[2] == pytest.approx(value)


def test_buffers_are_fitted_and_labelled_without_a_walk_per_tree(monkeypatch):
    x, y = sample(300, 4)
    rounds = {"XGBoost": 12, "RandomForest": 9, "AdaBoost": 5}
    walk = T.leaf_values
    monkeypatch.setattr(T, "leaf_values", None)  # margins come from the leaves met while growing
    model = T.fit_buffer(x.astype(float), y, 8, rounds)
    monkeypatch.setattr(T, "WALKED", 70)
    said = T.buffer_labels(model, x.astype(float))
    b = T.cut_bins(x.astype(float), model["cuts"])
    assert said["XGBoost"].tolist() == (model["start"] + sum(walk(t, b) for t in model["trees"]) > 0).tolist()
    assert said["RandomForest"].tolist() == (sum(walk(t, b) for t in model["forest"]) / 9 > 0.5).tolist()
    p = np.full(300, 0.4)
    tree, leaf = T.grown(b, p - y, p * (1 - p), 5, 8)
    assert tree[2][leaf].tolist() == walk(tree, b).tolist()
