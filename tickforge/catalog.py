"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the given parquet tables (or what Spark derives from
them) in full; the SQL equivalents live in ``oracle_sql.ORACLES``.
Floating outputs are rounded (6 decimals, equity-sized values 4) so that the
comparison does not depend on summation order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import cleaning, rowfeatures as rf, signals as sg
from .operators import backtest as bt
from .operators import indicators as ind
from .operators import learning as ml
from .operators import reshape, serving
from .plans.sequence import CHUNK, ORD
from .session import scratch_path
from .sources import files, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def double_cols(df: DataFrame) -> list:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]


def round_all(df: DataFrame, digits: int = 6) -> DataFrame:
    return rounded(df, double_cols(df), digits)


# ---------------------------------------------------------------- inputs
def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_ticks(tables.ticks(spark, sf_dir))


def indicator_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.with_indicators(ticks(spark, sf_dir))


PREDICTION_FEATURES = ["rsi_14", "macd_line", "volatility_20", "momentum_10", "price_change_pct",
                       "sma_10", "sma_20", "bb_upper", "bb_lower"]


def prediction_columns(f: DataFrame, *more: str) -> DataFrame:
    """Prediction records of a feature frame: features + model labels
    (TRAINING: no model loaded yet) + rule labels; ``more`` columns are kept."""
    rules = sg.rule_signals()
    models = {m: sg.training_gate(F.lit(False), F.lit(sg.DOWN)) for m in sg.MODEL_SIGNALS}
    return f.select("symbol", "current_price", "ts", "event_id", "tick_number", *more,
                    *PREDICTION_FEATURES, *[v.alias(k) for k, v in models.items()],
                    *[v.alias(k) for k, v in rules.items()])


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_columns(indicator_ticks(spark, sf_dir))


def newest_predictions(spark: SparkSession, sf_dir: str, rows: int) -> DataFrame:
    """Prediction records of (at least) the newest ``rows`` ticks of every
    symbol.  They depend on no more than 99 ticks before them, so the raw ticks
    are cut to these first; older records of the frame lack history and the
    caller's own limit drops them.  ``tick_number`` is not meaningful here."""
    recent = ind.newest(ticks(spark, sf_dir), rows + ind.HISTORY - 1)
    return prediction_columns(ind.with_indicators(recent, chunked=False))


# ------------------------------------------------------- ingest / wire / reshape
@query("ticks_json_roundtrip")
def q_ticks_json_roundtrip(spark, sf_dir):
    wire = files.tick_envelope(tables.ticks(spark, sf_dir))
    t = cleaning.not_null(files.parse_envelope(wire), "price", "symbol")
    et = cleaning.parse_tick_time(F.col("timestamp"))
    return t.select("symbol", "price", "date", "timestamp", et.alias("event_time"),
                    F.unix_timestamp(et).alias("event_time_seconds"))


@query("event_props_json")
def q_event_props_json(spark, sf_dir):
    ev = tables.read_table(spark, sf_dir, "events")
    parsed = F.from_json(F.col("props"), "k INT")
    return ev.select("event_id", parsed["k"].alias("prop_k"))


def lineitem_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem measures as a wide all-string price table with injected
    missing values: the sentinel on line 3 quantities, junk on line 5 discounts."""
    li = tables.read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Dates"), "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 3, F.lit(cleaning.MISSING_SENTINEL))
         .otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.col("l_extendedprice").cast("string").alias("l_extendedprice"),
        F.when(F.col("l_linenumber") == 5, F.lit("abc"))
         .otherwise(F.col("l_discount").cast("string")).alias("l_discount"),
        F.col("l_tax").cast("string").alias("l_tax"))


@query("wide_to_long_clean")
def q_wide_to_long_clean(spark, sf_dir):
    long = reshape.wide_to_long(lineitem_wide(spark, sf_dir), ["Dates", "l_orderkey", "l_linenumber"])
    return long.orderBy("date", "l_orderkey", "l_linenumber", "symbol")


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """The wide table written as CSV with a header, read back, reshaped, and
    the long series written and read as CSV again."""
    folder = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    wide = lineitem_wide(spark, sf_dir)
    wide.write.option("header", True).csv(f"{folder}/wide")
    back = files.read_wide_csv(spark, f"{folder}/wide")
    long = reshape.wide_to_long(back, ["Dates", "l_orderkey", "l_linenumber"])
    files.write_long_csv(long.select("date", "symbol", "price"), f"{folder}/long")
    return files.read_long_csv(spark, f"{folder}/long")


@query("csv_roundtrip_counts")
def q_csv_roundtrip_counts(spark, sf_dir):
    """Row counts of the round trip, observed in the passes that write: no table is scanned for them."""
    from pyspark.sql import Observation
    folder = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    seen = {n: Observation(n) for n in ("wide", "long", "clean")}
    rows = F.count(F.lit(1)).alias("rows")
    lineitem_wide(spark, sf_dir).observe(seen["wide"], rows).write.option("header", True).csv(f"{folder}/wide")
    back = files.read_wide_csv(spark, f"{folder}/wide")
    long = reshape.unpivot_clean(back, ["Dates", "l_orderkey", "l_linenumber"]).observe(seen["long"], rows)
    files.write_long_csv(long.na.drop("any").observe(seen["clean"], rows).select("date", "symbol", "price"), f"{folder}/long")
    n = {k: int(v.get["rows"]) for k, v in seen.items()}
    return spark.createDataFrame([(n["wide"], n["long"], n["clean"], n["long"] - n["clean"])], "wide_rows long, long_rows long, clean_rows long, dropped_rows long")


# ------------------------------------------------------------ row features
@query("price_transforms")
def q_price_transforms(spark, sf_dir):
    t = ticks(spark, sf_dir)
    p = F.col("price")
    cols = {**rf.price_transforms(p), **rf.price_buckets(p)}
    return round_all(t.select("symbol", "ts", "event_id", "price", *[v.alias(k) for k, v in cols.items()]))


@query("symbol_features")
def q_symbol_features(spark, sf_dir):
    t = ticks(spark, sf_dir)
    s = F.col("symbol")
    return t.select("symbol", "ts", "event_id", *[v.alias(k) for k, v in rf.symbol_text(s).items()],
                    rf.symbol_type(s).alias("symbol_type"),
                    rf.symbol_signature(s).alias("symbol_signature"),
                    cleaning.normalized_symbol(s).alias("symbol_norm"))


@query("calendar_features")
def q_calendar_features(spark, sf_dir):
    t = ticks(spark, sf_dir)
    ts = F.col("ts")
    return t.select("symbol", "ts", "event_id", *[v.alias(k) for k, v in rf.calendar(ts).items()],
                    rf.market_session(F.hour(ts)).alias("market_session"),
                    rf.is_weekday(ts).alias("is_weekday"))


@query("price_tiers")
def q_price_tiers(spark, sf_dir):
    t = ticks(spark, sf_dir)
    p = F.col("price")
    v10 = rf.volatility_10_estimate(p)
    return round_all(t.select("symbol", "ts", "event_id", "price",
                              rf.price_category(p).alias("price_category"),
                              rf.volatility_estimate(p).alias("price_volatility_estimate"),
                              rf.price_percentile(p).alias("price_percentile"),
                              v10.alias("volatility_10"),
                              (v10 * F.lit(rf.VOLATILITY_20_FACTOR)).alias("volatility_20")))


@query("indicator_estimates")
def q_indicator_estimates(spark, sf_dir):
    t = ticks(spark, sf_dir)
    est = rf.estimate_features()
    cols = [c for c in rf.ESTIMATE_RECORD if c not in ("symbol", "date", "processing_time")]
    return round_all(t.select("symbol", "ts", "event_id", "date", *[est[c].alias(c) for c in cols]))


@query("symbol_hash_bucket")
def q_symbol_hash_bucket(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.select("symbol", "ts", "event_id", rf.symbol_hash_bucket(F.col("symbol")).alias("symbol_hash"))


def stateless_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("event_time", F.col("ts"))
    feats = rf.stateless_features()
    cols = [c for c in rf.STATELESS_RECORD if c not in ("symbol", "date", "processing_time")]
    return t.select("symbol", "ts", "event_id", "date", *[feats[c].alias(c) for c in cols])


@query("stateless_feature_record")
def q_stateless_feature_record(spark, sf_dir):
    return round_all(stateless_record(spark, sf_dir))


# ------------------------------------------------------------- indicators
@query("indicators_full")
def q_indicators_full(spark, sf_dir):
    df = indicator_ticks(spark, sf_dir)
    df = df.select("symbol", "ts", "event_id", "tick_number", "current_price", *ind.FEATURE_COLUMNS)
    return rounded(df, ["current_price", *ind.FEATURE_COLUMNS])


INDICATOR_GROUPS = {
    "sma": ["sma_5", "sma_10", "sma_20"],
    "ema": ["ema_12", "ema_26"],
    "rsi": ["rsi_14"],
    "macd": ["macd_line", "macd_signal", "macd_histogram"],
    "bollinger": ["bb_upper", "bb_middle", "bb_lower"],
    "volatility": ["volatility_20"],
    "momentum": ["momentum_10"],
    "price_change_lags": ["price_change", "price_change_pct", "lag_1", "lag_2", "lag_5"],
}


def _indicator_group(cols):
    def fn(spark, sf_dir):
        df = indicator_ticks(spark, sf_dir).select("symbol", "ts", "event_id", "current_price", *cols)
        return rounded(df, ["current_price", *cols])
    return fn


for _name, _cols in INDICATOR_GROUPS.items():
    QUERIES[_name] = _indicator_group(_cols)


@query("order_indicators")
def q_order_indicators(spark, sf_dir):
    """Same indicator operator on a second domain: order totals per customer."""
    o = tables.order_series(spark, sf_dir)
    df = ind.with_indicators(o, keys=["custkey"], order=["odate", "orderkey"])
    cols = ["sma_5", "ema_12", "rsi_14", "macd_line", "bb_upper", "momentum_10", "lag_1"]
    return rounded(df.select("custkey", "odate", "orderkey", "current_price", *cols), ["current_price", *cols])


# ---------------------------------------------------------------- signals
@query("rule_signals")
def q_rule_signals(spark, sf_dir):
    f = indicator_ticks(spark, sf_dir)
    used = ["rsi_14", "macd_line", "momentum_10", "price_change_pct", "bb_upper", "bb_lower"]
    out = f.select("symbol", "ts", "event_id", "current_price", *used,
                   *[v.alias(k) for k, v in sg.rule_signals().items()])
    return rounded(out, ["current_price", *used])


@query("stateless_signals")
def q_stateless_signals(spark, sf_dir):
    r = stateless_record(spark, sf_dir)
    out = r.select("symbol", "ts", "event_id", "date", "current_price", "price_log",
                   "price_volatility_estimate", "price_category", "symbol_type", "market_session",
                   "day_of_week", "price_bucket_50", "price_sqrt", "price_squared",
                   *[v.alias(k) for k, v in sg.stateless_signals().items()],
                   sg.class_label(F.when(F.col("price_log") > F.lit(5.0), F.lit(1)).otherwise(F.lit(0)))
                   .alias("price_level_label"))
    return round_all(out)


@query("prediction_records")
def q_prediction_records(spark, sf_dir):
    p = predictions(spark, sf_dir).drop("tick_number")
    return rounded(p, ["current_price", *PREDICTION_FEATURES])


# --------------------------------------------------------------- backtest
def backtest_rows(spark, sf_dir):
    """Signals and backtest state in the partitions of the indicator pass."""
    features, chunked = ind.sequenced_indicators(ticks(spark, sf_dir))
    return bt.backtest_rows(prediction_columns(features, CHUNK, ORD), sg.RULE_SIGNALS, chunked=chunked)


@query("backtest_equity")
def q_backtest_equity(spark, sf_dir):
    r = backtest_rows(spark, sf_dir)
    out = r.select("symbol", "ts", "event_id", "signal", "label", "long",
                   F.round("equity", 4).alias("equity"), F.round("ret", 6).alias("ret"))
    return out


@query("backtest_trades")
def q_backtest_trades(spark, sf_dir):
    t = bt.trades(backtest_rows(spark, sf_dir))
    return t.select("symbol", "ts", "event_id", "signal", "side", F.round("current_price", 6).alias("price"),
                    F.round("units", 4).alias("units"), F.round("entry_price", 6).alias("entry_price"),
                    F.round("pnl", 4).alias("pnl"), F.round("pnl_pct", 6).alias("pnl_pct"))


@query("backtest_metrics")
def q_backtest_metrics(spark, sf_dir):
    m = bt.metrics(backtest_rows(spark, sf_dir))
    return rounded(rounded(m, ["final_value", "net_pnl"], 4), ["return_pct", "sharpe"], 6)


@query("backtest_report_lines")
def q_backtest_report_lines(spark, sf_dir):
    return bt.report_lines(backtest_rows(spark, sf_dir))


# ---------------------------------------------------------------- serving
@query("symbol_directory")
def q_symbol_directory(spark, sf_dir):
    return serving.symbol_directory(ticks(spark, sf_dir))


# A user request (parameter): two spellings of listed symbols and one unknown.
REQUESTED = [" click index ", "VIEW Spot", "purchase comdty", "XYZ"]


@query("requested_symbols")
def q_requested_symbols(spark, sf_dir):
    return serving.requested_symbols(spark, ticks(spark, sf_dir), REQUESTED)


@query("earliest_rows")
def q_earliest_rows(spark, sf_dir):
    return serving.head(ticks(spark, sf_dir).select("symbol", "ts", "event_id", "price"), 5)


@query("latest_100_per_symbol")
def q_latest_100_per_symbol(spark, sf_dir):
    p = newest_predictions(spark, sf_dir, serving.DASHBOARD_ROWS).select("symbol", "ts", "event_id", "current_price", "rsi_14", "macd_line")
    return rounded(serving.latest_per_symbol(p, serving.DASHBOARD_ROWS), ["current_price", "rsi_14", "macd_line"])


@query("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    p = newest_predictions(spark, sf_dir, 1).select("symbol", "ts", "event_id", "current_price", "rsi_14", "macd_line",
                                                    "volatility_20", "RSI_Rule", "BB_Rule")
    return rounded(serving.latest_snapshot(p), ["current_price", "rsi_14", "macd_line", "volatility_20"])


@query("recent_table")
def q_recent_table(spark, sf_dir):
    return serving.recent_table(newest_predictions(spark, sf_dir, serving.RECENT_ROWS), serving.RECENT_ROWS)


@query("chart_series")
def q_chart_series(spark, sf_dir):
    p = serving.latest_per_symbol(newest_predictions(spark, sf_dir, serving.DASHBOARD_ROWS), serving.DASHBOARD_ROWS)
    s = serving.chart_series(p, ["current_price", "sma_10", "sma_20", "bb_upper", "bb_lower"])
    return rounded(s, ["value"])


# One symbol as a dashboard / backtest request would name it (parameters).
DASHBOARD_SYMBOL = "CLICK Index"
BACKTEST_REQUEST = " click index "


@query("symbol_top100")
def q_symbol_top100(spark, sf_dir):
    """Newest 100 rows of one symbol, returned oldest first."""
    one = serving.for_symbol(ticks(spark, sf_dir), DASHBOARD_SYMBOL)
    recent = ind.newest(one, serving.DASHBOARD_ROWS + ind.HISTORY - 1)
    p = prediction_columns(ind.with_indicators(recent, chunked=False))
    top = p.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(serving.DASHBOARD_ROWS)
    return rounded(top.select("symbol", "ts", "event_id", "current_price", "rsi_14", "macd_line")
                   .orderBy("ts", "event_id"), ["current_price", "rsi_14", "macd_line"])


@query("symbol_top100_stored")
def q_symbol_top100_stored(spark, sf_dir):
    """The same from a stored predictions table, laid out so that one symbol's files are read alone."""
    from .sources import store
    path = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    records = prediction_columns(ind.with_indicators(ticks(spark, sf_dir)))
    store.write_store(records.select("symbol", "ts", "event_id", "current_price", "rsi_14", "macd_line"), path)
    top = store.read_symbol(spark, path, DASHBOARD_SYMBOL).orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(serving.DASHBOARD_ROWS)
    return rounded(top.orderBy("ts", "event_id"), ["current_price", "rsi_14", "macd_line"])


@query("normalized_symbol_rows")
def q_normalized_symbol_rows(spark, sf_dir):
    """All rows of a requested symbol matched case/space-insensitively, by time."""
    one = serving.for_symbol(ticks(spark, sf_dir), BACKTEST_REQUEST, normalized=True)
    p = prediction_columns(ind.with_indicators(one))
    return rounded(p.select("symbol", "ts", "event_id", "current_price", *sg.RULE_SIGNALS)
                   .orderBy("ts", "event_id"), ["current_price"])


@query("latest_signal_badges")
def q_latest_signal_badges(spark, sf_dir):
    snap = serving.latest_snapshot(newest_predictions(spark, sf_dir, 1).select(
        "symbol", "ts", "event_id", "rsi_14", "macd_line", *sg.MODEL_SIGNALS, *sg.RULE_SIGNALS))
    return serving.signal_badges(snap, [*sg.MODEL_SIGNALS, *sg.RULE_SIGNALS])


@query("reshape_counts")
def q_reshape_counts(spark, sf_dir):
    """Row counts of the wide table, the unpivoted table and the clean table."""
    wide = lineitem_wide(spark, sf_dir)
    ids = ["Dates", "l_orderkey", "l_linenumber"]
    n_values = len([c for c in wide.columns if c not in ids])
    long = reshape.unpivot_clean(wide, ids)
    complete = F.col("date").isNotNull() & F.col("price").isNotNull() & F.col("symbol").isNotNull() \
        & F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()
    out = long.agg(F.count(F.lit(1)).alias("long_rows"), F.count_if(complete).alias("clean_rows"))
    # the unpivot emits exactly one row per value column of every wide row
    return out.select((F.col("long_rows") / F.lit(n_values)).cast("long").alias("wide_rows"), "long_rows",
                      "clean_rows", (F.col("long_rows") - F.col("clean_rows")).alias("dropped_rows"))


# --------------------------------------------------------------- learning
@query("labels_next_tick")
def q_labels_next_tick(spark, sf_dir):
    lab = ml.next_tick_labels(ticks(spark, sf_dir), price="price")
    return rounded(lab.select("symbol", "ts", "event_id", "price", "next_price", "label"), ["price", "next_price"])


@query("sequential_split")
def q_sequential_split(spark, sf_dir):
    t = ticks(spark, sf_dir)
    lab = ml.next_tick_labels(t, price="price")
    s = ml.sequential_split(lab, test_fraction=0.2, counts=ml.labelled_counts(t))
    return s.select("symbol", "ts", "event_id", "row_index", "split")


@query("training_window")
def q_training_window(spark, sf_dir):
    w = ml.training_window(ticks(spark, sf_dir))
    return rounded(w.select("symbol", "ts", "event_id", "tick_number", "y", "retrain_point", "trainable",
                            *ml.ONLINE_FEATURES), ml.ONLINE_FEATURES)


def _labelled_rules(spark, sf_dir):
    f = ind.with_indicators(ticks(spark, sf_dir), with_next=True)
    lab = ml.labels_from_next(f).filter(F.col("next_price").isNotNull())
    return lab.select("symbol", "ts", "event_id", "label", *[v.alias(k) for k, v in sg.rule_signals().items()])


@query("signal_accuracy")
def q_signal_accuracy(spark, sf_dir):
    return rounded(ml.signal_accuracy(_labelled_rules(spark, sf_dir), sg.RULE_SIGNALS), ["accuracy"])


@query("signal_classification_report")
def q_signal_classification_report(spark, sf_dir):
    rep = ml.classification_report(_labelled_rules(spark, sf_dir), sg.RULE_SIGNALS)
    return rounded(rep, ["precision", "recall", "f1"])


# ------------------------------------------------------------------ models
def _offline(spark, sf_dir):
    """Train and test rows, written once: every fit and evaluation reads them again."""
    path = scratch_path(spark, f"offline-{uuid.uuid4().hex}")
    ml.offline_frame(ticks(spark, sf_dir)).select("symbol", "ts", "event_id", "label", "split", *ml.OFFLINE_FEATURES).write.parquet(path)
    f = spark.read.parquet(path)
    return f.filter(F.col("split") == "train"), f.filter(F.col("split") == "test")


def _scored_test(model, test, name):
    s = ml.scored(model, test, name)
    return s.select("symbol", "ts", "event_id", "label", F.col(name).alias("predicted"))


def _model_query(name):
    def fn(spark, sf_dir):
        train, test = _offline(spark, sf_dir)
        if name == "AdaBoost":
            model = ml.fit_adaboost(train, ml.OFFLINE_FEATURES, rounds=ml.ADABOOST_ROUNDS_OFFLINE)
        elif name == "XGBoost":
            model = ml.trees.fit_boosting(train, ml.OFFLINE_FEATURES)
        elif name == "LogisticReg":
            model = ml.fit_logistic(train, ml.OFFLINE_FEATURES)
        else:
            est = ml.estimators(train.count())[name]
            model = ml.fit_pipeline(train, ml.OFFLINE_FEATURES, est)
        return _scored_test(model, test, name)
    return fn


for _q, _m in {"model_logreg": "LogisticReg", "model_forest": "RandomForest",
               "model_adaboost": "AdaBoost", "model_gbt": "XGBoost"}.items():
    QUERIES[_q] = _model_query(_m)


@query("model_comparison")
def q_model_comparison(spark, sf_dir):
    train, test = _offline(spark, sf_dir)
    models = ml.fit_models(train, ml.OFFLINE_FEATURES, adaboost_rounds=ml.ADABOOST_ROUNDS_OFFLINE)
    return ml.evaluate(models, test)


@query("model_classification_report")
def q_model_classification_report(spark, sf_dir):
    """Precision, recall, F1 and support per model and class on the test split."""
    train, test = _offline(spark, sf_dir)
    models = ml.fit_models(train, ml.OFFLINE_FEATURES, adaboost_rounds=ml.ADABOOST_ROUNDS_OFFLINE)
    return rounded(ml.model_report(models, test), ["precision", "recall", "f1"])


@query("model_adaboost_roundtrip")
def q_model_adaboost_roundtrip(spark, sf_dir):
    """AdaBoost saved to the shared folder, loaded, scoring the test split."""
    train, test = _offline(spark, sf_dir)
    path = scratch_path(spark, f"models/adaboost-{uuid.uuid4().hex}")
    ml.fit_adaboost(train, ml.OFFLINE_FEATURES, rounds=ml.ADABOOST_ROUNDS_OFFLINE).save(path)
    return _scored_test(ml.AdaBoostModel.load(path), test, "AdaBoost")


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Fit, save to the shared checkpoint folder, load, score the test split."""
    train, test = _offline(spark, sf_dir)
    model = ml.fit_pipeline(train, ml.OFFLINE_FEATURES, ml.estimators(train.count())["LogisticReg"])
    path = scratch_path(spark, f"models/logisticreg-{uuid.uuid4().hex}")
    ml.save_model(model, path)
    return _scored_test(ml.load_model(path), test, "LogisticReg")


@query("retrain_per_symbol")
def q_retrain_per_symbol(spark, sf_dir):
    """Walk-forward per-symbol logistic regression (refit every 100 messages
    on the last 5,000) scoring every feature message."""
    wf = ml.walk_forward_logreg(ind.with_indicators(ticks(spark, sf_dir), with_next=True))
    return wf.select("symbol", "ts", "event_id", "message_number", "epoch", "model_epoch", "LogisticReg")


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction records whose model columns hold the models' labels, refitted per symbol and gated together."""
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    ind.with_indicators(ticks(spark, sf_dir), with_next=True).write.parquet(path)  # read by every fit
    f = spark.read.parquet(path)
    labelled = ml.walk_forward_labels(f)
    return labelled.select("symbol", "current_price", "ts", "event_id", *PREDICTION_FEATURES, *sg.MODEL_SIGNALS,
                           *[v.alias(k) for k, v in sg.rule_signals().items()])


@query("model_prediction_records")
def q_model_prediction_records(spark, sf_dir):
    return rounded(model_predictions(spark, sf_dir), ["current_price", *PREDICTION_FEATURES])


@query("backtest_all_signals")
def q_backtest_all_signals(spark, sf_dir):
    """Metrics of every symbol x (model and rule) signal."""
    path = scratch_path(spark, f"labelled-{uuid.uuid4().hex}")
    model_predictions(spark, sf_dir).select("symbol", "ts", "event_id", "current_price", *sg.MODEL_SIGNALS, *sg.RULE_SIGNALS).write.parquet(path)
    m = bt.metrics(bt.backtest_rows(spark.read.parquet(path), [*sg.MODEL_SIGNALS, *sg.RULE_SIGNALS]))
    return rounded(rounded(m, ["final_value", "net_pnl"], 4), ["return_pct", "sharpe"], 6)


# --------------------------------------------------------------- streaming
def _tick_stream(spark, sf_dir):
    from .streaming import streams
    return tables.clean_ticks(tables.ticks_from_events(streams.tick_stream(spark, sf_dir)))


def _finished(started, stream, columns: str) -> DataFrame:
    from .streaming import streams
    q, table = started
    q.awaitTermination()
    from pyspark.sql import types as T
    return streams.read_out(stream, table, T.StructType([*stream.schema.fields, *T.StructType.fromDDL(columns).fields]))


@query("stream_price_change")
def q_stream_price_change(spark, sf_dir):
    from .streaming import streams
    s = _tick_stream(spark, sf_dir)
    out = _finished(streams.price_change_table(s), s, "price_change double")
    return out.select("symbol", "ts", "event_id", F.round("price", 6).alias("price"),
                      F.round("price_change", 6).alias("price_change"))


def _with_rocksdb(spark, run):
    """``run()`` with the RocksDB state store, which keyed state needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return run()
    finally:
        spark.conf.set(key, old)


@query("stream_indicators")
def q_stream_indicators(spark, sf_dir):
    """Indicators from the bounded ring of prices per symbol in the state store."""
    from .streaming import keyed, streams
    cols = ["current_price", *ind.FEATURE_COLUMNS]
    out = _with_rocksdb(spark, lambda: streams.drain(keyed.indicator_stream(_tick_stream(spark, sf_dir)), "indicators"))
    return rounded(out.select("symbol", "ts", "event_id", "tick_number", *cols), cols)


@query("stream_price_change_keyed")
def q_stream_price_change_keyed(spark, sf_dir):
    from .streaming import keyed, streams
    out = _with_rocksdb(spark, lambda: streams.drain(keyed.price_change_stream(_tick_stream(spark, sf_dir)), "price-change"))
    return rounded(out.select("symbol", "ts", "event_id", "price", "price_change"), ["price", "price_change"])


@query("stream_model_labels")
def q_stream_model_labels(spark, sf_dir):
    """Labels of all models, refitted inside the stream every 100 messages of a symbol."""
    from .streaming import keyed, streams
    return _with_rocksdb(spark, lambda: streams.drain(keyed.label_stream(_tick_stream(spark, sf_dir)), "labels"))


VERSION_SHARES = [0.25, 0.5, 0.75]  # of the ticks' time range, where a new model version holds from


def publish_versions(spark, t, registry, shares=VERSION_SHARES) -> list:
    """Boosting models on the ticks up to each time quantile, published from there on; the times."""
    from .plans.sequence import order_number
    from .functions.rowfeatures import cents_return, lag_estimate
    when = order_number(t, "ts")
    cuts = sorted(set(t.agg(F.percentile_approx(when, shares, 10_000)).first()[0] or []))
    p = F.col("price")
    for k, cut in enumerate(cuts, 1):
        known = t.filter(when <= F.lit(cut)).withColumns({"simple_return": cents_return(p), "lag_1": lag_estimate(p, 1)})
        registry.publish(k, cut, ml.trees.fit_boosting(ml.next_tick_labels(known), ml.OFFLINE_FEATURES))
    return cuts


@query("stream_model_predictions")
def q_stream_model_predictions(spark, sf_dir):
    """Ticks of a stream labelled by the newest model version at or before them."""
    from .functions.rowfeatures import cents_return, lag_estimate
    from .streaming import streams, versions
    registry = versions.ModelVersions(spark)
    publish_versions(spark, tables.clean_ticks(ticks(spark, sf_dir)), registry)
    p = F.col("price")
    s = _tick_stream(spark, sf_dir).withColumns({"simple_return": cents_return(p), "lag_1": lag_estimate(p, 1)})
    out = _finished(versions.score_stream(s, registry, ml.OFFLINE_FEATURES, "predictions"), s, "version long, predicted string")
    return out.select("symbol", "ts", "event_id", "version", "predicted")


@query("stream_indicators_chunked")
def q_stream_indicators_chunked(spark, sf_dir):
    """The same through a state table and the batch operator, for symbols too hot for one task."""
    from .streaming import streams
    s = _tick_stream(spark, sf_dir)
    cols = ["current_price", *ind.FEATURE_COLUMNS]
    out = _finished(streams.indicator_table(s), s, "tick_number long, " + ", ".join(f"{c} double" for c in cols))
    return rounded(out.select("symbol", "ts", "event_id", "tick_number", *cols), cols)


STREAM_TABLE_COLUMNS = ["symbol", "ts", "event_id", "date", "current_price", "price_log",
                        "price_volatility_estimate", "price_category", "symbol_type", "market_session",
                        "day_of_week", "price_bucket_50", "price_sqrt", "price_squared"]


@query("stream_predictions_table")
def q_stream_predictions_table(spark, sf_dir):
    """Stateless features + stand-in signals streamed into a parquet table
    (foreachBatch, per-batch folders), then scanned back."""
    from .streaming import streams
    t = _tick_stream(spark, sf_dir).withColumn("event_time", F.col("ts"))
    feats = rf.stateless_features()
    rec = t.select("symbol", "ts", "event_id", "date", *[feats[c].alias(c) for c in STREAM_TABLE_COLUMNS[4:]])
    out = rec.select(*STREAM_TABLE_COLUMNS, *[v.alias(k) for k, v in sg.stateless_signals().items()])
    return round_all(streams.drain(out, "predictions"))
