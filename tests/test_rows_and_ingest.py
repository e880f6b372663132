"""Row features, tiers, cleaning and wire format on small frames."""

import math

import pytest
from pyspark.sql import functions as F

from tickforge.functions import cleaning, rowfeatures as rf, signals as sg
from tickforge.operators import reshape
from tickforge.sources import files


def test_tiers_are_strict(spark):
    prices = [49.99, 50.0, 99.99, 100.0, 199.99, 200.0, 499.99, 500.0, 999.99, 1000.0, 1999.99, 2000.0, 4999.0, 5000.0]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    p = F.col("price")
    r = df.select("price", rf.price_category(p).alias("c"), rf.volatility_estimate(p).alias("v"),
                  rf.price_percentile(p).alias("q"), rf.volatility_10_estimate(p).alias("v10")).collect()
    got = {x["price"]: (x["c"], x["v"], x["q"], x["v10"]) for x in r}
    assert got[49.99][0] == "low" and got[50.0][0] == "medium" and got[1000.0][0] == "very_high"
    assert got[99.99][1] == 0.05 and got[100.0][1] == 0.03 and got[2000.0][1] == 0.01
    assert got[999.99][2] == "medium" and got[1000.0][2] == "high"
    assert got[4999.0][3] == 0.015 and got[5000.0][3] == 0.01


def test_symbols_normalise_and_type(spark):
    df = spark.createDataFrame([(" es1 index ",), ("ES1 Index",), ("CL1 Comdty",), ("XYZ",)], "symbol string")
    s = F.col("symbol")
    r = df.select(cleaning.normalized_symbol(s).alias("n"), rf.symbol_type(s).alias("t"),
                  rf.symbol_signature(s).alias("g")).collect()
    assert [x["n"] for x in r] == ["ES1 INDEX", "ES1 INDEX", "CL1 COMDTY", "XYZ"]
    assert [x["t"] for x in r] == ["other", "index", "commodity", "other"]   # case-sensitive substring
    assert r[1]["g"] == "9_1_0"


def test_dirty_inputs_never_raise(spark):
    wire = spark.createDataFrame([('{"date":"2024-01-02","symbol":"A","price":1.5,"timestamp":"2024-01-02 09:30:00"}',),
                                  ('{"symbol": null, "price": 2}',), ("not json",),
                                  ('{"date":"x","symbol":"B","price":3,"timestamp":"garbage"}',)], "value string")
    t = files.parse_envelope(wire)
    kept = cleaning.not_null(t, "price", "symbol")
    r = kept.select("symbol", cleaning.parse_tick_time(F.col("timestamp")).alias("et")).collect()
    assert [x["symbol"] for x in r] == ["A", "B"] and r[1]["et"] is None
    feats = spark.createDataFrame([(0.0,), (-1.0,), (float("nan"),), (None,)], "price double") \
        .select(*[v.alias(k) for k, v in rf.price_transforms(F.col("price")).items()]).collect()
    assert feats[0]["price_log"] is None and feats[0]["price_reciprocal"] is None


def test_rule_defaults(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, 0.0, None, None), (float("nan"), 0.1, -0.2, 0.0, 10.0, 9.0, 8.0),
         (60.0, 0.0, 0.0, 1.0, 7.0, 9.0, 8.0)],
        "rsi_14 double, macd_line double, momentum_10 double, price_change_pct double, current_price double, "
        "bb_upper double, bb_lower double")
    r = df.select(*[v.alias(k) for k, v in sg.rule_signals().items()]).collect()
    assert [x["RSI_Rule"] for x in r] == ["DOWN", "DOWN", "UP"]
    assert [x["MACD_Rule"] for x in r] == ["DOWN", "UP", "DOWN"]
    assert [x["BB_Rule"] for x in r] == ["NEUTRAL", "DOWN", "UP"]


def test_wide_csv_roundtrip(spark, tmp_path):
    wide = spark.createDataFrame([("2024-01-02", "1.5", "#N/A N/A"), ("2024-01-03", "abc", "2.5"),
                                  ("2024-01-01", "1.0", "2.0")], "Dates string, `ES1 Index` string, `CL1 Comdty` string")
    src = str(tmp_path / "wide")
    wide.coalesce(1).write.option("header", True).csv(src)
    long = reshape.wide_to_long(files.read_wide_csv(spark, src), ["Dates"]).orderBy("date", "symbol")
    out = str(tmp_path / "long")
    files.write_long_csv(long, out)
    back = files.read_long_csv(spark, out).orderBy("date", "symbol").collect()
    assert [(str(x["date"]), x["symbol"], x["price"]) for x in back] == [
        ("2024-01-01", "CL1 Comdty", 2.0), ("2024-01-01", "ES1 Index", 1.0),
        ("2024-01-02", "ES1 Index", 1.5), ("2024-01-03", "CL1 Comdty", 2.5)]


def test_estimates_match_python(spark):
    p, sym = 123.45, "ES1 Index"
    r = spark.createDataFrame([(sym, p)], "symbol string, price double") \
        .select(*[v.alias(k) for k, v in rf.estimate_features().items()]).first()
    assert r["simple_return"] == pytest.approx((int(p * 100) % 100 - 50) / 1000.0)
    assert r["macd_line"] == pytest.approx(math.sin(((p + len(sym)) % 30) * 0.2) * (p * 0.0001))
    assert r["bb_position"] == pytest.approx(max(0.1, min(0.9, (p % 50) / 50.0)))
    assert r["lag_2"] == pytest.approx(p + math.sin(p * 0.01 + 2) * (p * 0.001))
