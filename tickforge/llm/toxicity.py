"""Toxicity categories by a classifier chain of linear models.

The categories are predicted one after the other; each logistic model sees a
text's hashed words and word beginnings and the probabilities of the categories
before it.  Later models are trained on out-of-fold probabilities: a training
row's earlier probabilities come from models that did not see the row.

Training uses a bounded, hash-drawn sample of the labelled rows (about
``TRAIN_ROWS``); every (category, fold) model is one task on that sample.
Scoring covers every whole text.

The last category is the label column ``toxic``; the finer ones before it are
weak labels: labelled toxic and holding a word of the category's list.

Defined results: null and empty texts score as a text without words; rows with
null ids are scored and never used for training; a document labelled more than
once counts as toxic if any label says so; labels without a document teach
nothing; without positive or without negative training rows a category's
probability is the share of positives; repeated rows each get their row; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import WordHasher, byte_slices, distinct, run_folder, written

BITS = 18
PREFIX = 4  # bytes of a word's beginning
FOLDS = 3
TRAIN_ROWS = 12_000
ROW_FEATURES = 8192  # of a training row; a longer one gives a hash-drawn choice of them (scoring uses all)
STEPS = 60
RATE = 0.3
L1 = 5e-4  # leaves a few hundred words and beginnings with a weight
LEAST_DF = 3
CUT = 0.25  # toxic documents are few: a fourth is well above their share
PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"


class Category(NamedTuple):
    name: str
    words: tuple[str, ...]  # empty: the label itself


# Word lists of the weak categories, in chain order; the label comes last.
CATEGORIES = (
    Category("insult", ("idiot", "moron", "stupid", "clown")),
    Category("demeaning", ("worthless", "loser", "pathetic")),
    Category("dehumanising", ("scum", "trash", "disgusting")),
    Category("toxic", ()),
)


def text_features(texts: list[bytes | None], words: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """(features of all texts in a row, each once per text; where each text's features end)."""
    mask, turn = np.uint64((1 << BITS) - 1), np.uint64(20)
    found, counts = [], []
    for lo, hi, word, begin, ends in words.groups(texts, PREFIX):
        at = np.repeat(np.arange(hi - lo, dtype=np.uint32) << np.uint32(BITS), np.diff(ends, prepend=0))
        keys = distinct(np.concatenate((at | (word >> turn & mask).astype(np.uint32),
                                        at | ((begin ^ np.uint64(0x5851F42D4C957F2D)) >> turn & mask).astype(np.uint32))))
        found.append((keys & ((1 << BITS) - 1)).astype(np.int64))
        counts.append(np.bincount(keys >> BITS, minlength=hi - lo))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(found), np.cumsum(np.concatenate(counts))


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
    return total[ends] - total[np.concatenate(([0], ends[:-1]))]


class Model(NamedTuple):
    """Weights of the hashed features, of the earlier categories' log odds, and the intercept."""

    features: np.ndarray
    chain: np.ndarray
    intercept: float

    def probability(self, idx: np.ndarray, ends: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        z = _row_sums(self.features[idx], ends) + _odds(earlier) @ self.chain + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_logistic(idx: np.ndarray, ends: np.ndarray, earlier: np.ndarray, y: np.ndarray, steps: int = STEPS, l1: float = L1) -> Model:
    """Sparse logistic regression: adaptive gradient steps over all rows, each
    followed by a soft threshold on the features' weights."""
    n, k = len(y), earlier.shape[1]
    if not n or y.min() == y.max():
        share = float(y.mean()) if n else 0.0
        return Model(np.zeros(1 << BITS, dtype=np.float32), np.zeros(k), float(_odds(np.array([share]))[0]))
    df = np.bincount(idx, minlength=1 << BITS)
    known = np.flatnonzero(df >= LEAST_DF)
    place = np.full(1 << BITS, -1)
    place[known] = np.arange(len(known))
    use = place[idx] >= 0
    col, row = place[idx][use], np.repeat(np.arange(n), np.diff(ends, prepend=0))[use]
    dense = np.column_stack((_odds(earlier), np.ones(n)))
    w, v = np.zeros(len(known)), np.zeros(k + 1)
    v[-1] = _odds(np.array([y.mean()]))[0]
    w_sum, v_sum = np.full(len(known), 1e-8), np.full(k + 1, 1e-8)
    for _ in range(steps):
        z = np.bincount(row, weights=w[col], minlength=n) + dense @ v
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g, gv = np.bincount(col, weights=r[row], minlength=len(known)), dense.T @ r
        w_sum += g * g
        v_sum += gv * gv
        step = RATE / np.sqrt(w_sum)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        v -= 0.1 * gv / np.sqrt(v_sum)
    features = np.zeros(1 << BITS, dtype=np.float32)
    features[known] = w
    return Model(features, v[:-1], float(v[-1]))


def _chain(models: list[Model], idx: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Probabilities of the categories, in order, by one model each."""
    p = np.zeros((len(ends), 0))
    for m in models:
        p = np.column_stack((p, m.probability(idx, ends, p)))
    return p


def _take(idx: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate(([0], ends[:-1]))[rows]
    size = ends[rows] - starts
    last = np.cumsum(size)
    return idx[np.arange(int(size.sum())) + np.repeat(starts - (last - size), size)] if len(rows) else idx[:0], last


def training_sample(docs: DataFrame, labels: DataFrame, folder: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Written table (fold, idx, y): hashed features and category labels of the drawn rows.

    About ``train_rows`` ids are drawn, and of the different texts that these ids
    have again about ``train_rows``: repeated rows count once, and an id that many
    rows share adds no more than that.
    """
    one = (labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").alias("toxic")))
    n = one.count()
    place = F.pmod(F.xxhash64(F.lit("draw"), "l_id"), F.lit(1 << 32))
    drawn = one.filter(place < int(min(1.0, train_rows / max(n, 1)) * (1 << 32)) + 1)
    near = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), F.col("doc_id") == F.col("l_id"))
            .withColumn("name", F.xxhash64("doc_id", F.coalesce("text", F.lit("")))))
    m = near.select("name").distinct().count()
    own = F.pmod(F.xxhash64(F.lit("row"), "name"), F.lit(1 << 32))
    some = near.filter(own < int(min(1.0, train_rows / max(m, 1)) * (1 << 32)) + 1).dropDuplicates(["name"])
    rows = some.select(F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"), "toxic", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher(PUNCTUATION)
        lists = [set(words.hashes(" ".join(c.words).encode()).tolist()) for c in CATEGORIES]
        for b in batches:
            idx, y = [], []
            for t, toxic in zip(b.column("text").cast(pa.binary()), b.column("toxic").to_pylist()):
                t = t.as_py() or b""
                feats, _ = text_features([t], words)
                if len(feats) > ROW_FEATURES:
                    feats = np.sort(feats[np.argsort(feats * 0x9E3779B1 % (1 << 32), kind="stable")[:ROW_FEATURES]])
                idx.append(feats.astype("<i4").tobytes())
                has = set(words.hashes(t).tolist())
                y.append([int(toxic > 0 and (not c.words or bool(has & s))) for c, s in zip(CATEGORIES, lists)])
            yield pa.RecordBatch.from_arrays([b.column("fold"), pa.array(idx, pa.binary()), pa.array(y, pa.list_(pa.int32()))], names=["fold", "idx", "y"])

    return written(rows.mapInArrow(work, "fold int, idx binary, y array<int>"), folder)


def _trainer(c: int, before):
    """Trains category ``c`` on all folds but the group's; ``before``: the broadcast models of the earlier categories."""
    def train(table: pa.Table) -> pa.Table:
        m = table.column("model")[0].as_py()
        order = sorted(zip(table.column("fold").to_pylist(), table.column("idx").to_pylist(), table.column("y").to_pylist()))
        fold = np.array([r[0] for r in order])
        idx = np.frombuffer(b"".join(r[1] for r in order), dtype="<i4").astype(np.int64)
        ends = np.cumsum([len(r[1]) // 4 for r in order])
        y = np.array([r[2][c] for r in order], dtype=float)
        p = np.zeros((len(y), c))
        for f in range(FOLDS):  # a row's earlier probabilities come from the models without its fold
            rows = np.flatnonzero(fold == f)
            if len(rows):
                p[rows] = _chain([models[f] for models in before.value], *_take(idx, ends, rows))
        rows = np.flatnonzero(fold != m)
        got = fit_logistic(*_take(idx, ends, rows), p[rows], y[rows])
        return pa.table({"model": pa.array([m], pa.int32()), "features": pa.array([got.features.tobytes()], pa.binary()),
                         "chain": pa.array([got.chain.tolist()], pa.list_(pa.float64())), "intercept": pa.array([got.intercept], pa.float64())})

    return train


def fit_chain(sample: DataFrame) -> list[Model]:
    """One model per category, trained on out-of-fold probabilities of the categories before it."""
    spark = sample.sparkSession
    by_fold: list[list[Model]] = []  # category -> models without fold 0, 1, ...; the last has seen all rows
    copies = sample.withColumn("model", F.explode(F.array(*[F.lit(m) for m in range(FOLDS + 1)])))
    for c in range(len(CATEGORIES)):
        train = _trainer(c, spark.sparkContext.broadcast(by_fold))
        # a range for each model, so that no two meet in one task
        rows = copies.repartitionByRange(FOLDS + 1, "model").groupBy("model").applyInArrow(train, "model int, features binary, chain array<double>, intercept double").collect()
        found = {r["model"]: Model(np.frombuffer(r["features"], dtype=np.float32), np.array(r["chain"], dtype=float), r["intercept"]) for r in rows}
        none = Model(np.zeros(1 << BITS, dtype=np.float32), np.zeros(c), float(_odds(np.zeros(1))[0]))
        by_fold.append([found.get(m, none) for m in range(FOLDS + 1)])
    return [models[FOLDS] for models in by_fold]


def score(docs: DataFrame, models: list[Model], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a probability ``p_<category>`` each, and ``toxic`` for every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(models)
    names = [f"p_{c.name}" for c in CATEGORIES]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher(PUNCTUATION)
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for lo, hi in byte_slices(texts):
                p = _chain(shared.value, *text_features(texts.slice(lo, hi - lo).to_pylist(), words))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *(pa.array(p[:, k]) for k in range(len(names))), pa.array(p[:, -1] >= CUT)],
                                                 names=["doc_id", *names, "toxic"])

    fields = ", ".join(f"{x} double" for x in names)
    return source.mapInArrow(work, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {fields}, toxic boolean")


def judge(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Train the chain on the labelled sample, score every document."""
    folder = run_folder(docs.sparkSession, "toxicity")
    return score(docs, fit_chain(training_sample(docs, labels, f"{folder}/sample", train_rows)))
