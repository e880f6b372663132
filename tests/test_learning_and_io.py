"""Walk-forward refit schedule, sequential split, Kafka option maps, report sink."""

import datetime as dt

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tickforge.operators import backtest as bt
from tickforge.operators import indicators as ind
from tickforge.operators import learning as ml
from tickforge.sources import files, tables


def test_walk_forward_schedule(spark):
    t = tables.clean_ticks(tables.ticks(spark, SF001))
    wf = ml.walk_forward_logreg(ind.with_indicators(t, with_next=True), every=20, buffer_rows=60)
    rows = wf.select("symbol", "message_number", "epoch", "model_epoch", "LogisticReg").collect()
    for r in rows:
        assert r["epoch"] == r["message_number"] // 20           # refit first, then score
        if r["message_number"] < 20:
            assert r["LogisticReg"] == "TRAINING" and r["model_epoch"] is None
        if r["model_epoch"] is not None:
            assert r["model_epoch"] <= r["epoch"] and r["LogisticReg"] in ("UP", "DOWN")
    assert any(r["LogisticReg"] != "TRAINING" for r in rows)


def test_sequential_split_sizes(spark):
    lab = ml.next_tick_labels(tables.clean_ticks(tables.ticks(spark, SF001)))
    s = ml.sequential_split(lab, 0.2)
    n = lab.count()
    test = s.filter(F.col("split") == "test")
    assert test.count() == -(-n * 2 // 10)                           # ceil(0.2 n)
    # the test rows are the last rows of the (symbol, time) order
    first_test = test.agg(F.min("row_index")).first()[0]
    assert first_test == n - test.count()
    assert s.select("row_index").distinct().count() == n


def test_kafka_option_maps():
    src = files.kafka_source_options("broker:9092", "futures-ticks")
    assert src == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "futures-ticks",
                   "startingOffsets": "latest", "failOnDataLoss": "false"}
    sink = files.kafka_sink_options("broker:9092", "features", "/shared/ckpt")
    assert sink["topic"] == "features" and sink["checkpointLocation"] == "/shared/ckpt"


def test_report_text_sink(spark, tmp_path):
    base = dt.datetime(2001, 6, 18, 9, 30)
    rows = [("S", base + dt.timedelta(days=i), i, p, lab)
            for i, (p, lab) in enumerate([(10.0, "UP"), (11.0, "DOWN"), (12.0, "UP")])]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, event_id long, current_price double, sig string")
    out = str(tmp_path / "report")
    bt.write_report(bt.report_lines(bt.backtest_rows(df, ["sig"], chunked=False)), out)
    text = spark.read.text(f"{out}/symbol=S/signal=sig").collect()
    lines = [r["value"] for r in text]
    assert "Total Trades Executed:   3" in lines
    assert any(line.endswith("| SELL  | All units @ $11.00 | PnL: $10,000.00 (10.00%)") for line in lines)


def test_models_fit_and_roundtrip(spark, tmp_path):
    f = ml.offline_frame(tables.clean_ticks(tables.ticks(spark, SF001)))
    train, test = f.filter("split = 'train'"), f.filter("split = 'test'")
    m = ml.fit_pipeline(train, ml.OFFLINE_FEATURES, ml.estimators(train.count())["LogisticReg"])
    path = str(tmp_path / "lr")
    ml.save_model(m, path)
    a = m.transform(test).select("prediction").collect()
    b = ml.load_model(path).transform(test).select("prediction").collect()
    assert a == b and len(a) == test.count()
    ada = ml.fit_adaboost(train, ml.OFFLINE_FEATURES, rounds=3)
    acc = ml.evaluate({"AdaBoost": ada}, test).first()
    assert 0.0 <= acc["accuracy"] <= 1.0


def test_adaboost_saved_and_loaded_votes_alike(spark, tmp_path):
    rows = [(float(i % 17), float(i % 5), int((i % 17 > 8) ^ (i % 5 == 0))) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    model = ml.fit_adaboost(df, ["a", "b"], rounds=8)
    model.save(str(tmp_path / "m"))
    back = ml.AdaBoostModel.load(str(tmp_path / "m"))
    one = [r.prediction for r in model.transform(df).orderBy("a", "b").collect()]
    assert one == [r.prediction for r in back.transform(df).orderBy("a", "b").collect()]
    share = model.transform(df).filter("prediction = label").count() / 300
    assert share >= 0.75 and len(model.stumps) > 1


@pytest.mark.parametrize("name", ["model_adaboost", "model_comparison", "model_classification_report", "model_adaboost_roundtrip"])
def test_offline_model_queries_fit_all_offline_rounds(spark, monkeypatch, name):
    from tickforge import catalog as c
    asked, fit = [], ml.fit_adaboost

    def short(train, features, label="label", rounds=50, **kw):
        asked.append(rounds)
        return fit(train, features, label, 1, **kw)

    monkeypatch.setattr(ml, "fit_adaboost", short)
    monkeypatch.setattr(ml, "estimators", lambda *a: {})
    c.QUERIES[name](spark, SF001)
    assert asked == [ml.ADABOOST_ROUNDS_OFFLINE] == [100]


def test_logistic_regression_equals_newton_on_rows(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2)) * [3.0, 200.0] + [1.0, 900.0]
    y = (x[:, 0] / 3 + (x[:, 1] - 900) / 100 + rng.normal(size=500) > 0.5).astype(int)
    rows = [(float(a) if i % 9 else None, float(b) if i % 11 else float("nan"), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, label int").repartition(3)
    model = ml.fit_logistic(df, ["a", "b"])
    raw = np.array([[np.nan if v is None else v for v in r[:2]] for r in rows], dtype=float)
    want = ml._fit_logreg(raw, y.astype(float))
    assert [*model.weights, model.intercept] == pytest.approx(want.tolist(), rel=1e-6)
    assert model.transform(df).filter("prediction = label").count() > 400
    assert ml.fit_logistic(df.limit(0), ["a", "b"]).transform(df).filter("prediction = 0").count() == 500
    one = df.withColumn("a", F.lit(2.0))  # a constant feature
    assert ml.fit_logistic(one, ["a", "b"]).transform(one).filter("prediction = label").count() > 350
