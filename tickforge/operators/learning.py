"""Labels, splits, training buffers, signal evaluation and pyspark.ml models.

* ``next_tick_labels``: label = next price of the symbol > price (lead 1
  through the chunked sequencing plan, so hot symbols stay split);
* ``sequential_split``: first n - ceil(f n) rows of the (symbol, time) order
  train, the rest test - no shuffle of rows, no single-partition window (key
  offsets come from a range-partitioned count table);
* ``training_window``: the bounded per-symbol training buffer (last 5,000
  feature messages), mean imputation, trainability guards, retrain marks;
* ``signal_accuracy`` / ``classification_report`` from confusion counts;
* ``fit_logistic``: L2 logistic regression by Newton steps, each one aggregation
  of fifteen sums or so;
* ``fit_models``: logistic regression, random forest, second-order boosting and
  SAMME AdaBoost over decision stumps; the last two on binned cells (``trees``);
* ``walk_forward_labels``: all four models refitted per key (compiled fits, module
  ``refits``), their labels gated together.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.signals import MODEL_SIGNALS, UP, training_gate
from ..plans.sequence import AT, ORD, PLACE, REAL, TIE, plain, sequence
from ..session import scratch_path
from . import refits, trees
from .indicators import HISTORY, balanced_sql, newest, with_indicators

# Fixed values of the online learner.
BUFFER_ROWS = 5000          # training rows kept per symbol
RETRAIN_EVERY = 100         # feature messages between refits
MIN_TRAIN_ROWS = 50
REFIT_BLOCK = 100            # refits fitted in one group
WARMUP = 5                  # first feature message is the 5th tick
OFFLINE_FEATURES = ["simple_return", "lag_1", "price"]
ONLINE_FEATURES = ["rsi_14", "macd_line", "volatility_20", "momentum_10", "price_change_pct", "current_price"]
SEED = 42
ADABOOST_ROUNDS_OFFLINE = 100
ADABOOST_ROUNDS_ONLINE = 50


def next_tick_labels(df: DataFrame, keys=("symbol",), order=("ts", "event_id"), price: str = "price",
                     mode: str = "drop", chunked: bool = True) -> DataFrame:
    """Adds next_price, label (1 if next price > price) and tick_index (0-based).

    mode ``drop``: rows without a next price are removed; ``zero_last``:
    they are kept with label 0.
    """
    keys, order = list(keys), list(order)
    s = sequence(df, keys, order, after=1) if chunked else plain(df, keys, order)
    x = s.positioned()
    x = x.withColumn("next_price", F.lead(price, 1).over(s.window)).filter(F.col(REAL))
    x = x.withColumn("label", F.when(F.col("next_price") > F.col(price), F.lit(1)).otherwise(F.lit(0)))
    if mode == "drop":
        x = x.filter(F.col("next_price").isNotNull())
    return x.withColumnRenamed(ORD, "tick_index").drop("_chunk", "_cb", REAL, TIE, PLACE, AT)


def labels_from_next(features: DataFrame, price: str = "current_price") -> DataFrame:
    """label / tick_index from a ``next_price`` column computed in the
    feature pass (``with_indicators(..., with_next=True)``), zero_last mode."""
    return features.withColumns({
        "label": F.when(F.col("next_price") > F.col(price), F.lit(1)).otherwise(F.lit(0)),
        "tick_index": F.col("tick_number") - F.lit(1),
    })


def key_offsets(counts: DataFrame, keys: list, count: str = "_kn") -> tuple[DataFrame, int]:
    """``counts`` (one row per key) with ``_off``, the sum of ``count`` over the
    keys before it, and the total.  The keys are range-partitioned and written
    to the shared folder; each partition runs its own prefix sum, and only one
    sum per partition is carried over."""
    spark = counts.sparkSession
    path = scratch_path(spark, f"offsets-{uuid.uuid4().hex}")
    dealt = counts.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(path)
    kept = spark.read.schema(dealt.schema).parquet(path)
    sums = kept.groupBy("_part").agg(F.sum(count).alias("s")).collect()  # one row per partition
    base, total = [], 0
    for r in sorted(sums, key=lambda r: r["_part"]):
        base.append((r["_part"], total))
        total += r["s"] or 0
    before = spark.createDataFrame(base, "_part int, _base long")
    within = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    out = kept.join(F.broadcast(before), "_part").withColumn("_off", F.col("_base") + F.coalesce(F.sum(count).over(within), F.lit(0)))
    return out.drop("_part", "_base"), total


def sequential_split(df: DataFrame, test_fraction: float = 0.2, keys=("symbol",),
                     index: str = "tick_index", counts: DataFrame | None = None) -> DataFrame:
    """Global (keys, order) row index and train/test split of the first
    n - ceil(f n) rows.  ``index`` is the 0-based position inside the key.
    ``counts`` (keys, ``_kn`` = rows of ``df`` per key) may be supplied from a
    cheaper upstream aggregate; by default it is counted from ``df``."""
    keys = list(keys)
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn"))
    offsets, total = key_offsets(counts, keys)
    n_test = math.ceil(total * test_fraction)
    row_index = (F.col("_off") + F.col(index)).cast("long")
    return (df.join(offsets, keys).withColumn("row_index", row_index)
            .withColumn("split", F.when(F.col("row_index") < F.lit(total - n_test), F.lit("train"))
                        .otherwise(F.lit("test")))
            .drop("_kn", "_off"))


def training_window(ticks: DataFrame, keys=("symbol",), order=("ts", "event_id"), price: str = "price",
                    buffer_rows: int = BUFFER_ROWS, columns=ONLINE_FEATURES) -> DataFrame:
    """Final per-symbol training buffer of the online learner.

    Rows: the last ``buffer_rows`` feature messages of each symbol.  ``y`` =
    next price up (the newest row gets 0), feature nulls imputed with the
    buffer mean of the symbol, ``trainable`` = at least 50 rows and both
    classes, ``retrain_point`` = message number is a multiple of 100.

    Only the newest buffer_rows + 99 ticks of a key are shuffled: they decide
    the buffer's features.  Their number in the key comes from a count per key.
    """
    keys = list(keys)
    recent = newest(ticks, buffer_rows + HISTORY - 1, keys, order)
    features = labels_from_next(with_indicators(recent, keys, order, price, chunked=False, with_next=True))
    whole = Window.partitionBy(*keys)  # at most buffer_rows + 99 rows
    features = features.withColumn("_last", F.max("tick_number").over(whole))
    buf = features.filter(F.col("tick_number") > F.col("_last") - F.lit(buffer_rows))
    buf = buf.withColumns({**{f"_m_{c}": F.avg(c).over(whole) for c in columns},
                           "_bn": F.count(F.lit(1)).over(whole), "_lo": F.min("label").over(whole), "_hi": F.max("label").over(whole)})
    counts = ticks.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn"))
    buf = buf.join(counts, keys).withColumn("tick_number", F.col("tick_number") + F.col("_kn") - F.col("_last"))
    message = F.col("tick_number") - F.lit(WARMUP - 1)
    return buf.select(
        *[c for c in buf.columns if c not in columns and not c.startswith("_") and c != "label"],
        *[F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) for c in columns],
        F.col("label").alias("y"),
        ((F.col("_bn") >= MIN_TRAIN_ROWS) & (F.col("_lo") != F.col("_hi"))).alias("trainable"),
        ((message % F.lit(RETRAIN_EVERY)) == 0).alias("retrain_point"))


def signal_accuracy(df: DataFrame, signals: list, label: str = "label") -> DataFrame:
    """Share of rows where (signal == UP) equals (label == 1), per signal."""
    long = df.unpivot([label], signals, "signal", "value")
    hit = ((F.col("value") == F.lit(UP)).cast("int") == F.col(label)).cast("double")
    return long.groupBy("signal").agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("support"))


def classification_report(df: DataFrame, signals: list, label: str = "label") -> DataFrame:
    """Per signal: precision / recall / F1 / support for classes 0 and 1 and
    their macro and weighted averages (zero when undefined).  One confusion
    row per signal; every report row is derived from it (one pass)."""
    long = df.unpivot([label], signals, "signal", "value")
    conf = long.groupBy("signal").agg(*[
        F.count_if((F.col(label) == y) & ((F.col("value") == F.lit(UP)).cast("int") == p)).alias(f"c{y}{p}")
        for y in (0, 1) for p in (0, 1)])
    per = {}
    for c in (0, 1):
        o = 1 - c
        tp = F.col(f"c{c}{c}").cast("double")
        prec = F.coalesce(F.try_divide(tp, F.col(f"c{c}{c}") + F.col(f"c{o}{c}")), F.lit(0.0))
        rec = F.coalesce(F.try_divide(tp, F.col(f"c{c}{c}") + F.col(f"c{c}{o}")), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(F.lit(2.0) * prec * rec, prec + rec), F.lit(0.0))
        per[c] = (prec, rec, f1, (F.col(f"c{c}{c}") + F.col(f"c{c}{o}")).cast("long"))
    total = per[0][3] + per[1][3]

    def row(name, prec, rec, f1, sup):
        return F.struct(F.lit(name).alias("class"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1"), sup.cast("long").alias("support"))

    def weighted(i):
        return (per[0][i] * per[0][3] + per[1][i] * per[1][3]) / total

    rows = [row(str(c), *per[c]) for c in (0, 1)]
    rows.append(row("macro avg", *[(per[0][i] + per[1][i]) / F.lit(2.0) for i in range(3)], total))
    rows.append(row("weighted avg", weighted(0), weighted(1), weighted(2), total))
    return conf.select("signal", F.inline(F.array(*rows)))


# ------------------------------------------------------------------ models
def assembler(features: list) -> list:
    """Mean imputation then a feature vector; the column list lives in the model."""
    imputed = [f"{c}__imp" for c in features]
    return [Imputer(inputCols=features, outputCols=imputed, strategy="mean"),
            VectorAssembler(inputCols=imputed, outputCol="features")]


def estimators(n_rows: int | None = None, label: str = "label") -> dict:
    # sklearn's C=1 penalises the summed loss; Spark averages it -> regParam = 1/n
    reg = 1.0 / n_rows if n_rows else 0.0
    return {
        "LogisticReg": LogisticRegression(featuresCol="features", labelCol=label, maxIter=1000,
                                          regParam=reg, elasticNetParam=0.0, standardization=False),
        "RandomForest": RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=100, seed=SEED),
    }


def fit_pipeline(train: DataFrame, features: list, estimator, label: str = "label") -> PipelineModel:
    return Pipeline(stages=[*assembler(features), estimator]).fit(train)


class AdaBoostModel:
    """SAMME over depth-1 trees, each the best stump on the binned cells.

    A stump is (feature, threshold, label below or at it, label above it), so
    the vote is one expression, and a model is saved as its preparation
    pipeline and one small JSON file of stumps.
    """

    def __init__(self, prep: PipelineModel, stumps: list, alphas: list):
        self.prep, self.stumps, self.alphas = prep, stumps, alphas

    def transform(self, df: DataFrame) -> DataFrame:
        x = self.prep.transform(df).withColumn("_v", vector_to_array("features"))
        votes = ["0.0D"]
        for (f, cut, low, high), a in zip(self.stumps, self.alphas):
            sign = [1.0 if v == 1.0 else -1.0 for v in (low, high)]
            votes.append(f"CASE WHEN _v[{f}] <= {cut!r}D THEN {a * sign[0]!r}D ELSE {a * sign[1]!r}D END")
        return x.withColumn("prediction", F.when(F.expr(balanced_sql(votes)) > 0, F.lit(1.0)).otherwise(F.lit(0.0))).drop("_v")

    def save(self, path: str) -> None:
        self.prep.write().overwrite().save(f"{path}/prep")
        spark = SparkSession.getActiveSession()
        rows = [(i, int(f), float(c), float(lo), float(hi), float(a)) for i, ((f, c, lo, hi), a) in enumerate(zip(self.stumps, self.alphas))]
        spark.createDataFrame(rows, ADABOOST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/stumps")

    @staticmethod
    def load(path: str) -> AdaBoostModel:
        spark = SparkSession.getActiveSession()
        rows = spark.read.schema(ADABOOST_SCHEMA).json(f"{path}/stumps").orderBy("i").collect()
        return AdaBoostModel(PipelineModel.load(f"{path}/prep"), [(r["feature"], r["cut"], r["low"], r["high"]) for r in rows], [r["alpha"] for r in rows])


ADABOOST_SCHEMA = "i int, feature int, cut double, low double, high double, alpha double"


NEWTON_STEPS = 12


class LogisticModel:
    """Weights on the raw features, missing ones filled with the training means."""

    def __init__(self, features: list, fill: list, weights: list, intercept: float):
        self.features, self.fill, self.weights, self.intercept = features, fill, weights, intercept

    def transform(self, df: DataFrame) -> DataFrame:
        z = F.lit(self.intercept)
        for c, m, w in zip(self.features, self.fill, self.weights):
            z = z + F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(m)) * F.lit(w)
        return df.withColumn("margin", z).withColumn("prediction", (F.col("margin") > 0).cast("double"))


def fit_logistic(train: DataFrame, features: list, label: str = "label", steps: int = NEWTON_STEPS) -> LogisticModel:
    """Summed log loss + |w|^2 / 2 on the raw features, intercept free, from zero by a
    fixed number of Newton steps.

    The steps run on standardised features (the penalty is scaled along), so the
    small linear system is well conditioned.  A step is one aggregation over the
    rows: gradient and Hessian sums, combined before they leave a task.
    """
    import numpy as np
    k = len(features)
    value = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in features]
    fill = trees.means(train, features)
    x = [F.coalesce(v, F.lit(m)) for v, m in zip(value, fill)]
    row = train.agg(*[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x], F.count(F.lit(1))).first()
    if not row[-1]:
        return LogisticModel(list(features), fill, [0.0] * k, 0.0)
    mean, spread = [float(v) for v in row[:k]], [float(v) if v else 1.0 for v in row[k:2 * k]]
    z = [(c - F.lit(m)) / F.lit(s) for c, m, s in zip(x, mean, spread)]
    rows = train.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], F.lit(1.0).alias(f"z{k}"), F.col(label).cast("double").alias("y"))
    penalty, w = np.append(1.0 / np.array(spread) ** 2, 0.0), np.zeros(k + 1)
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    for _ in range(steps):
        margin = F.expr(balanced_sql([f"z{i} * {float(v)!r}D" for i, v in enumerate(w)]))
        p = rows.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
        sums = p.agg(*[F.sum(F.col(f"z{i}") * (F.col("p") - F.col("y"))) for i in range(k + 1)],
                     *[F.sum(F.col(f"z{i}") * F.col(f"z{j}") * F.col("p") * (1 - F.col("p"))) for i, j in pairs]).first()
        gradient, hessian = np.array(sums[:k + 1]) + penalty * w, np.diag(penalty)
        for (i, j), v in zip(pairs, sums[k + 1:]):
            hessian[i, j] += v
            hessian[j, i] = hessian[i, j]
        w = w - np.linalg.solve(hessian + 1e-12 * np.eye(k + 1), gradient)
    raw = [float(v / s) for v, s in zip(w, spread)]
    return LogisticModel(list(features), fill, raw, float(w[-1] - sum(a * m for a, m in zip(raw, mean))))


NO_CUT = 1.7976931348623157e308  # everything lies below it


def fit_adaboost(train: DataFrame, features: list, label: str = "label", rounds: int = 50) -> AdaBoostModel:
    prep = Pipeline(stages=assembler(features)).fit(train)
    n_bins = trees.bins_for(len(features))
    cuts, fill = trees.edges(train, features, n_bins), trees.means(train, features)
    model = trees.fit_cells(trees.cells(train, features, label, cuts, fill), n_bins, {"adaboost": rounds}).get("adaboost", {"stumps": [], "alphas": []})
    found = [(int(f), cuts[int(f)][int(k)] if int(k) < len(cuts[int(f)]) else NO_CUT, low, high) for f, k, low, high in model["stumps"]]
    return AdaBoostModel(prep, found, model["alphas"])


def fit_models(train: DataFrame, features: list, label: str = "label", adaboost_rounds: int = 50) -> dict:
    n = train.count()
    models = {name: fit_pipeline(train, features, est, label) for name, est in estimators(n, label).items() if name != "LogisticReg"}
    models["LogisticReg"] = fit_logistic(train, features, label)
    models["XGBoost"] = trees.fit_boosting(train, features, label)
    models["AdaBoost"] = fit_adaboost(train, features, label, adaboost_rounds)
    return models


def evaluate(models: dict, test: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy per model (one distributed aggregate each), unioned."""
    out = None
    for name, m in models.items():
        pred = m.transform(test)
        acc = pred.agg(F.avg((F.col("prediction") == F.col(label).cast("double")).cast("double")).alias("accuracy"),
                       F.count(F.lit(1)).alias("support")).withColumn("model", F.lit(name))
        out = acc if out is None else out.unionByName(acc)
    return out.select("model", "accuracy", "support")


def model_report(models: dict, test: DataFrame, label: str = "label") -> DataFrame:
    """``classification_report`` of every model's UP/DOWN labels on the test rows."""
    out = None
    for name, m in models.items():
        one = classification_report(scored(m, test, name).select(label, name), [name], label).withColumnRenamed("signal", "model")
        out = one if out is None else out.unionByName(one)
    return out


def scored(model, df: DataFrame, name: str) -> DataFrame:
    """Model output as an UP/DOWN label column named ``name``."""
    pred = model.transform(df)
    return pred.withColumn(name, F.when(F.col("prediction") == 1.0, F.lit("UP")).otherwise(F.lit("DOWN")))


def offline_frame(ticks: DataFrame, keys=("symbol",), order=("ts", "event_id"), price: str = "price") -> DataFrame:
    """Offline training rows: (simple_return, lag_1 estimate, price) -> label,
    last tick of each symbol dropped, with the sequential train/test split."""
    from ..functions.rowfeatures import cents_return, lag_estimate
    p = F.col(price)
    x = ticks.withColumns({"simple_return": cents_return(p), "lag_1": lag_estimate(p, 1)})
    lab = next_tick_labels(x, keys, order, price=price, mode="drop")
    return sequential_split(lab, 0.2, keys, counts=labelled_counts(ticks, keys))


def labelled_counts(ticks: DataFrame, keys=("symbol",)) -> DataFrame:
    """Rows per key after ``next_tick_labels(mode='drop')``: all but the last
    tick of each key - a pruned scan with partial aggregation."""
    return ticks.groupBy(*list(keys)).agg((F.count(F.lit(1)) - F.lit(1)).alias("_kn"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ------------------------------------------------------- walk-forward refits
def _fit_logreg(X, y):
    """L2 logistic regression (C = 1, intercept unpenalised) by Newton steps;
    nulls imputed with the buffer mean.  None without 50 rows of both classes."""
    import numpy as np
    if len(y) < MIN_TRAIN_ROWS or len(np.unique(y)) < 2:
        return None
    seen = ~np.isnan(X)
    means = np.where(seen, X, 0.0).sum(axis=0) / np.maximum(seen.sum(axis=0), 1)
    A = np.hstack([np.where(seen, X, means), np.ones((len(X), 1))])
    w = np.zeros(A.shape[1])
    reg = np.ones(A.shape[1])
    reg[-1] = 0.0
    for _ in range(100):
        z = np.clip(A @ w, -35, 35)
        p = 1.0 / (1.0 + np.exp(-z))
        grad = A.T @ (p - y) + reg * w
        hess = (A * (p * (1 - p))[:, None]).T @ A + np.diag(reg + 1e-10)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.max(np.abs(step)) < 1e-10:
            break
    return w


def _block_fitter(keys: list, every: int, buffer_rows: int):
    """All refits of one (key, block): each on the block rows of its buffer."""
    def fit(pdf):
        import numpy as np
        import pandas as pd
        pdf = pdf.sort_values("_m", kind="stable")
        m, label = pdf["_m"].to_numpy(), pdf["label"].to_numpy(dtype=float)
        X = pdf[ONLINE_FEATURES].to_numpy(dtype=float)
        lo, hi = int(pdf["_first"].iloc[0]), int(pdf["_until"].iloc[0])
        out = []
        for epoch in range(lo, hi + 1):
            a, b = np.searchsorted(m, [epoch * every - buffer_rows + 1, epoch * every + 1])
            y = label[a:b].copy()
            y[m[a:b] == epoch * every] = 0.0  # the newest buffered message has no next price yet
            w = _fit_logreg(X[a:b], y)
            out.append((epoch, w is not None, None if w is None else w[:-1].tolist(), None if w is None else float(w[-1])))
        got = pd.DataFrame(out, columns=["epoch", "ok", "coef", "intercept"])
        for k in keys:
            got[k] = pdf[k].iloc[0]
        return got[[*keys, "epoch", "ok", "coef", "intercept"]]

    return fit


def walk_forward_logreg(features: DataFrame, keys=("symbol",), order=("ts", "event_id"),
                        every: int = RETRAIN_EVERY, buffer_rows: int = BUFFER_ROWS,
                        block: int = REFIT_BLOCK) -> DataFrame:
    """Per-key logistic regression refitted every ``every`` feature messages
    on the last ``buffer_rows`` of them; each message is scored by the newest
    successful refit at or before it (refit first, then score), ``TRAINING``
    before the first one.

    Refits are grouped in blocks of ``block``; a row goes to every block with a
    refit whose buffer holds it, which is 1 + buffer_rows / (every * block)
    copies or so.  Each (key, block) is one pandas group of at most
    every * block + buffer_rows rows.  Coefficients are forward filled over
    refits and joined back on (key, refit) - no driver loop.
    """
    keys = list(keys)
    lab = labels_from_next(features) if "next_price" in features.columns else \
        next_tick_labels(features, keys, order, price="current_price", mode="zero_last")
    x = lab.withColumn("_m", F.col("tick_number") - F.lit(WARMUP - 1))
    first_epoch = F.ceil(F.col("_m") / F.lit(every))
    last_epoch = F.floor((F.col("_m") + F.lit(buffer_rows - 1)) / F.lit(every))
    of = lambda epoch: F.floor((epoch - F.lit(1)) / F.lit(block)).cast("long")
    train = (x.filter(first_epoch <= last_epoch)
             .withColumn("_block", F.explode(F.sequence(of(first_epoch), of(last_epoch))))
             .select(*keys, "_block", "_m", "label", *ONLINE_FEATURES))
    # a block's refits end with the key's messages
    ends = x.groupBy(*keys).agg(F.floor(F.max("_m") / F.lit(every)).cast("long").alias("_epochs"))
    train = (train.join(ends, keys).withColumn("_first", F.col("_block") * F.lit(block) + F.lit(1))
             .withColumn("_until", F.least((F.col("_block") + F.lit(1)) * F.lit(block), F.col("_epochs"))).drop("_epochs")
             .filter(F.col("_first") <= F.col("_until")))
    schema = ", ".join(f"{k} {features.schema[k].dataType.simpleString()}" for k in keys) + ", epoch long, ok boolean, coef array<double>, intercept double"
    fits = train.groupBy(*keys, "_block").applyInPandas(_block_fitter(keys, every, buffer_rows), schema)
    we = Window.partitionBy(*keys).orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    fits = fits.select(*keys, "epoch",
                       F.last(F.when(F.col("ok"), F.col("epoch")), ignorenulls=True).over(we).alias("model_epoch"),
                       F.last(F.when(F.col("ok"), F.col("coef")), ignorenulls=True).over(we).alias("coef"),
                       F.last(F.when(F.col("ok"), F.col("intercept")), ignorenulls=True).over(we).alias("intercept"))
    scored = x.withColumn("epoch", F.floor(F.col("_m") / F.lit(every)).cast("long")).join(fits, keys + ["epoch"], "left")
    # serving uses the raw feature with missing -> 0 (no imputation)
    z = F.col("intercept")
    for i, c in enumerate(ONLINE_FEATURES):
        z = z + F.col("coef")[i] * F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0))
    label = training_gate(F.col("coef").isNotNull(), F.when(z > 0, F.lit("UP")).otherwise(F.lit("DOWN")))
    return scored.withColumn("LogisticReg", label).withColumn("message_number", F.col("_m")) \
        .drop("_m", "coef", "intercept")


# ------------------------------------------- walk-forward refits of all models
MODEL_ROUNDS = {"XGBoost": trees.BOOST_ROUNDS, "RandomForest": trees.FOREST_TREES, "AdaBoost": ADABOOST_ROUNDS_ONLINE}
MODEL_BINS = 32
MODEL_BLOCK = 50             # refits fitted in one group: a row goes to two of them or so
TASKS_PER_CORE = 16          # of a pass of refits: a block is seconds of work, so tasks of a block or so even out


def _trainable(y) -> bool:
    return len(y) >= MIN_TRAIN_ROWS and 0 < y.sum() < len(y)


def trainable_refits(x: DataFrame, keys: list, every: int, buffer_rows: int) -> DataFrame:
    """(keys, epoch, ok): which refits of message rows (``_m``, ``label``) have buffers with
    rows enough, of both classes.

    Messages are counted in stretches of ``every``; a buffer is some whole stretches, up to the
    refit's own, and the end of the one before them.  No more than a row per refit is sorted.
    """
    whole, rest = divmod(buffer_rows, every)
    at, label = F.col("epoch") * F.lit(every), F.col("label").cast("long")
    end = F.col("_m") > at - F.lit(rest)
    counts = (x.select(*keys, "_m", "label", F.ceil(F.col("_m") / F.lit(every)).cast("long").alias("epoch")).groupBy(*keys, "epoch")
              .agg(F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_up"), F.count_if(end).alias("_end_n"),
                   F.sum(F.when(end, label)).alias("_end_up"), F.sum(F.when(F.col("_m") == at, label)).alias("_newest")))
    ends = x.groupBy(*keys).agg(F.floor(F.max("_m") / F.lit(every)).cast("long").alias("_epochs")).filter(F.col("_epochs") >= 1)
    refit = ends.select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_epochs"))).alias("epoch")).join(counts, [*keys, "epoch"], "left")
    by = Window.partitionBy(*keys).orderBy("epoch")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    refit = refit.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("_n", "_up", "_end_n", "_end_up", "_newest")})
    refit = refit.withColumns({"_all": F.sum("_n").over(so_far), "_all_up": F.sum("_up").over(so_far)})

    def held(total: str, end: str):
        before = [F.coalesce(F.lag(c, whole).over(by), F.lit(0)) for c in (total, end)]
        return F.col(total) - before[0] + before[1]

    n, up = held("_all", "_end_n"), held("_all_up", "_end_up") - F.col("_newest")  # the newest buffered message has no next price yet
    return refit.select(*keys, "epoch", ((n >= MIN_TRAIN_ROWS) & (up > 0) & (up < n)).alias("ok"))


def fit_online(X, y, rounds: dict | None = None, n_bins: int = MODEL_BINS) -> dict:
    """All four models of one buffer (feature rows with NaN for missing, labels), nulls imputed with its means."""
    import numpy as np
    seen = ~np.isnan(X)
    mean = np.where(seen, X, 0.0).sum(axis=0) / np.maximum(seen.sum(axis=0), 1)
    return {**trees.fit_buffer(np.where(seen, X, mean), y, n_bins, rounds or MODEL_ROUNDS), "logreg": _fit_logreg(X, y)}


def online_labels(model: dict, rows) -> dict:
    """{name: UP or DOWN} of feature rows by a model of ``fit_online``; a missing feature is served as 0."""
    import numpy as np
    served = np.where(np.isnan(rows), 0.0, rows)
    w = model["logreg"]
    said = {**trees.buffer_labels(model, served), "LogisticReg": w[-1] + served @ w[:-1] > 0}
    return {c: np.where(said[c], "UP", "DOWN") for c in MODEL_SIGNALS}


def refit_tasks(spark: SparkSession, per_core: int = TASKS_PER_CORE) -> int:
    """Fits are heavy and rows few: a fixed number of partitions, which is not coalesced by size."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), per_core * spark.sparkContext.defaultParallelism)


def walk_forward_labels(features: DataFrame, keys=("symbol",), order=("ts", "event_id"), every: int = RETRAIN_EVERY,
                        buffer_rows: int = BUFFER_ROWS, block: int = MODEL_BLOCK, rounds: dict | None = None, n_bins: int = MODEL_BINS) -> DataFrame:
    """The feature rows with ``message_number``, ``epoch``, ``model_epoch`` and the label of
    every model, all refitted per key at each ``every``-th message on the last
    ``buffer_rows`` ones.  A message is labelled by the newest refit at or before it that
    had rows of both classes; before the first one all four labels are TRAINING.

    The refits that can be trained come from counts.  Rows are gathered per
    (key, block of refits), at most (block + 1) * every + buffer_rows of them, where compiled
    code fits the models and labels the messages; labels are joined back on the key and
    message number.  ``features`` is read in each pass: pass a written table.
    """
    keys, spark = list(keys), features.sparkSession
    lab = labels_from_next(features) if "next_price" in features.columns else \
        next_tick_labels(features, keys, order, price="current_price", mode="zero_last")
    x = lab.withColumn("_m", F.col("tick_number") - F.lit(WARMUP - 1))
    first_epoch = F.ceil(F.col("_m") / F.lit(every))
    last_epoch = F.floor((F.col("_m") + F.lit(buffer_rows - 1)) / F.lit(every))
    of = lambda epoch: F.floor((epoch - F.lit(1)) / F.lit(block)).cast("long")
    holds = F.when(first_epoch <= last_epoch, F.sequence(of(first_epoch), of(last_epoch))).otherwise(F.array().cast("array<bigint>"))
    so_far = Window.partitionBy(*keys).orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    newest_ok = trainable_refits(x, keys, every, buffer_rows).select(*keys, "epoch", F.last(F.when(F.col("ok"), F.col("epoch")), ignorenulls=True).over(so_far).alias("model_epoch"))

    known = x.withColumn("epoch", F.floor(F.col("_m") / F.lit(every)).cast("long")).join(newest_ok, [*keys, "epoch"], "left")
    own = of(F.col("model_epoch"))
    blocks = F.when(F.col("model_epoch").isNull(), holds).otherwise(F.array_union(holds, F.array(own)))
    dealt = known.select(*keys, F.col("_m").cast("long").alias("_m"), F.col("label").cast("int").alias("label"), "model_epoch",
                         *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in ONLINE_FEATURES], F.explode(blocks).alias("_block"))
    row = F.struct("_m", "label", F.when(F.col("_block") == own, F.col("model_epoch")).alias("of"), *ONLINE_FEATURES)
    gathered = dealt.repartition(refit_tasks(spark), *keys, "_block").groupBy(*keys, "_block").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    fitted = refits.labelled(spark, F.col("_rows"), every, buffer_rows, rounds or MODEL_ROUNDS, n_bins)
    out = known.join(gathered.select(*keys, F.inline(fitted)), [*keys, "_m"], "left")
    said = refits.label_columns(F.col("said"))
    return out.withColumns({c: training_gate(F.col("said").isNotNull(), said[c]) for c in MODEL_SIGNALS}).drop("said").withColumnRenamed("_m", "message_number")
