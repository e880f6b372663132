"""Binned tree models: second-order boosting, AdaBoost stumps, random forest.

Features are cut into bins at quantiles.  A model that sees only bins cannot
tell rows of one cell (bins and label) apart, so the cells with their counts say
all it can learn.  ``cells`` counts them in one distributed pass; with at most
``CELLS`` combinations of bins (the bins per feature follow from that) they are
a small table at any input size, and every boosting round, tree level and stump
search runs on them in one task instead of in a job over all rows.

Trees grow level by level from histograms of gradient and hessian sums per node,
feature and bin; a split's worth is the regularised gain.  With gradients -w*y
and hessians w the same growth is a Gini tree, which the forest uses.

``fit_buffer`` fits the same models on one bounded buffer, for the refits per
key (module ``learning`` has their schedule).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 18
MOST_BINS = 256
# The defaults of the boosted and bagged trees.
BOOST_ROUNDS, BOOST_DEPTH, SHRINKAGE, L2, MIN_HESSIAN = 100, 6, 0.3, 1.0, 1.0
FOREST_TREES = 100
FOREST_DEPTH = 8
SEED = 42
GAIN = 1e-6  # a split must gain more than this
WALKED = 4096  # rows that walk down all trees together


def bins_for(n_features: int, cells: int = CELLS) -> int:
    """Bins per feature such that all combinations are at most ``cells``."""
    return max(2, min(MOST_BINS, int(round(cells ** (1 / n_features) - 0.5 + 1e-9))))


def laid_out(bins: np.ndarray, n_bins: int) -> np.ndarray:
    """The bins feature by feature, each feature's numbers after those of the one before."""
    return np.ascontiguousarray((bins + np.arange(bins.shape[1]) * n_bins).T, dtype=np.intp)


def grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, n_bins: int, l2: float = L2, least: float = MIN_HESSIAN,
         pick=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree as arrays by heap number (children of k: 2k+1, 2k+2): split feature (-1: a
    leaf), last bin that goes left, value -G / (H + l2).  ``pick(nodes)`` gives each node
    the features it may split by (numbers ascending, nodes x some)."""
    return grown(bins, g, h, depth, n_bins, l2, least, pick)[0]


def grown(bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, n_bins: int, l2: float = L2, least: float = MIN_HESSIAN,
          pick=None, laid: np.ndarray | None = None, rows: np.ndarray | None = None) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """(the tree of ``grow``, the leaf of every row, which a tree with ``pick`` leaves at 0).
    ``laid`` is ``laid_out(bins)``; ``rows`` says which rows ``g`` and ``h`` are of, if not of all."""
    n, f = bins.shape
    size = 2 ** (depth + 1) - 1
    feature, cut, value = np.full(size, -1), np.zeros(size, dtype=np.int64), np.zeros(size)
    flat, begin, leaf = np.ascontiguousarray(bins).ravel(), (np.arange(n) if rows is None else rows) * f, np.zeros(n, dtype=np.int64)
    # nodes that may split by heap number, and each row's place among them (their number: it has come to a leaf)
    names, at = np.zeros(min(1, len(g)), dtype=np.int64), np.zeros(len(g), dtype=np.intp)
    if pick is None:
        laid = laid_out(bins, n_bins) if laid is None else laid
        gs, hs, place = np.tile(g, f), np.tile(h, f), np.empty(laid.shape, dtype=np.intp)
    few = max(least, 1e-12)
    for level in range(depth + 1):
        k = len(names)
        if not k:
            break
        G, H = np.bincount(at, g, k + 1)[:k], np.bincount(at, h, k + 1)[:k]
        value[names] = np.where(H > 0, -G / (H + l2 + (H <= 0)), 0.0)
        if level == depth:
            break
        # sums per (node, feature, bin), then what lies up to each bin, bins first
        if pick is None:
            some, s = None, f
            where = np.add(laid, at * (f * n_bins), out=place).ravel()
        else:
            some = pick(k)
            s = some.shape[1]
            of = np.append(some, some[:1], axis=0)
            where = np.concatenate([flat.take(begin + of[:, t].take(at)) + (at * s + t) * n_bins for t in range(s)])
            gs, hs = np.tile(g, s), np.tile(h, s)
        upto = [np.bincount(where, x, (k + 1) * s * n_bins)[:k * s * n_bins].reshape(k * s, n_bins).T.copy().cumsum(axis=0)[:-1].reshape(n_bins - 1, k, s) for x in (gs, hs)]
        (gl, hl), nodes = upto, np.arange(k)
        gr, hr = G[:, None] - gl, H[:, None] - hl
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - (G ** 2 / (H + l2))[:, None]
        gain[(hl < few) | (hr < few)] = -np.inf
        # of gains equal up to rounding the first feature and bin counts
        best = gain.max(axis=0)
        near = best.max(axis=1) * (1 - 1e-12)
        slot = (best >= near[:, None]).argmax(axis=1)
        own = gain[:, nodes, slot]
        last = (own >= near).argmax(axis=0)
        split = own[last, nodes] > GAIN
        by = slot if some is None else some[nodes, slot]
        feature[names] = np.where(split, by, -1)
        cut[names] = np.where(split, last, 0)
        n_next = 2 * int(split.sum())
        child = np.append(np.where(split, 2 * (np.cumsum(split) - split), n_next), n_next)
        right = flat.take(begin + np.append(by, 0).take(at)) > np.append(np.where(split, last, n_bins), n_bins).take(at)
        before, at = at, child.take(at) + right
        if not split.all():
            if pick is None:
                ended = np.flatnonzero((at == n_next) & (before < k))
                leaf[ended] = names[before[ended]]
            else:  # their rows are left out
                keep = np.flatnonzero(at < n_next)
                at, begin, g, h = at[keep], begin[keep], g[keep], h[keep]
        names = (2 * names[split][:, None] + np.array([1, 2])).ravel()
    if pick is None:
        inner = np.flatnonzero(at < len(names))
        leaf[inner] = names[at[inner]]
    return (feature, cut, value), leaf


def leaf_values(tree: tuple[np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray) -> np.ndarray:
    feature, cut, value = tree
    at = np.zeros(len(bins), dtype=np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return value[at]
        k = at[inner]
        at[inner] = 2 * k + 1 + (bins[inner, feature[k].astype(np.int64)] > cut[k])


def summed_values(trees: list, bins: np.ndarray) -> np.ndarray:
    """Sum of ``leaf_values`` of many trees, walked together."""
    n, f = bins.shape
    total = np.zeros(n)
    if not trees or not n:
        return total
    flat = np.ascontiguousarray(bins).ravel()
    for lo in range(0, n, WALKED):
        feature, cut, value = (np.concatenate([t[i] for t in trees]) for i in range(3))
        size = len(trees[0][0])
        begin = np.arange(lo, min(n, lo + WALKED)) * f
        root = np.repeat(np.arange(len(trees)) * size, len(begin))
        begin, at = np.tile(begin, len(trees)), np.zeros(len(root), dtype=np.int64)
        where = np.arange(len(root))  # still above a leaf
        while len(where):
            k = root[where] + at[where]
            by = feature[k]
            inner = by >= 0
            where, k, by = where[inner], k[inner], by[inner].astype(np.int64)
            at[where] = 2 * at[where] + 1 + (flat[begin[where] + by] > cut[k])
        part = total[lo:lo + WALKED]
        for v in value[root + at].reshape(len(trees), -1):  # tree after tree
            part += v
    return total


def boosted(bins: np.ndarray, y: np.ndarray, count: np.ndarray, n_bins: int, rounds: int = BOOST_ROUNDS, depth: int = BOOST_DEPTH,
            rate: float = SHRINKAGE) -> tuple[float, list]:
    """(start margin, trees with values times ``rate``) of logistic second-order boosting;
    it starts one Newton step away from zero."""
    start = float((count * (y - 0.5)).sum() / max(0.25 * count.sum(), 1e-300))
    margin, trees, laid = np.full(len(y), start), [], laid_out(bins, n_bins)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-margin))
        (feature, cut, value), leaf = grown(bins, count * (p - y), count * p * (1 - p), depth, n_bins, laid=laid)
        trees.append((feature, cut, value * rate))
        margin = margin + trees[-1][2].take(leaf)
    return start, trees


def forest(bins: np.ndarray, y: np.ndarray, n_bins: int, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED) -> list:
    """Gini trees over bootstrap draws, each split among sqrt(features) drawn ones; values are shares of class 1."""
    rng, (n, f) = np.random.default_rng(seed), bins.shape
    some, out = max(1, int(math.sqrt(f))), []
    for _ in range(trees):
        w = rng.multinomial(n, np.full(n, 1.0 / n)).astype(float)
        rows = np.flatnonzero(w)  # sums of whole numbers: rows not drawn add nothing
        draw = lambda k: np.nonzero(rng.random((k, f)).argsort(axis=1) < some)[1].reshape(k, some)
        out.append(grown(bins, -w[rows] * y[rows], w[rows], depth, n_bins, 0.0, 1.0, draw, rows=rows)[0])
    return out


def stumps(bins: np.ndarray, y: np.ndarray, count: np.ndarray, n_bins: int, rounds: int) -> tuple[list, list]:
    """SAMME: ([(feature, last bin left, label left, label right)], alphas).  Each round takes the
    exact best Gini stump over all (feature, bin) from prefix sums of the class weights."""
    w = count / max(count.sum(), 1e-300)
    found, alphas, f = [], [], bins.shape[1]
    laid = laid_out(bins, n_bins)
    of = [np.flatnonzero(y == c) for c in (0, 1)]
    places = [np.ascontiguousarray(laid[:, rows]).ravel() for rows in of]
    for _ in range(rounds):
        own = [w[rows] for rows in of]
        total = np.array([x.sum() for x in own])
        best, stump = GAIN * 1e-6, (0, n_bins - 1, float(total[1] > total[0]), float(total[1] > total[0]))
        l0, l1 = (np.bincount(place, np.tile(x, f), f * n_bins).reshape(f, n_bins).cumsum(axis=1)[:, :-1] for place, x in zip(places, own))
        r0, r1 = total[0] - l0, total[1] - l1
        nl, nr = l0 + l1, r0 + r1
        with np.errstate(invalid="ignore", divide="ignore"):
            pure = (l0 ** 2 + l1 ** 2) / nl + (r0 ** 2 + r1 ** 2) / nr - (total ** 2).sum() / total.sum()
        pure = np.where((nl > 0) & (nr > 0), pure, -np.inf)
        if pure.size and pure.max() > best:
            j, k = (int(v) for v in np.unravel_index(pure.argmax(), pure.shape))
            stump = (j, k, float(l1[j, k] > l0[j, k]), float(r1[j, k] > r0[j, k]))
        said = np.where(bins[:, stump[0]] <= stump[1], stump[2], stump[3])
        miss = said != y
        error = float(w[miss].sum() / w.sum()) if w.sum() else None
        if error is None or error <= 0:
            found.append(stump)
            alphas.append(1.0)
            break
        if error >= 0.5:
            break
        alpha = math.log((1 - error) / error)
        found.append(stump)
        alphas.append(alpha)
        w = np.where(miss, w * math.exp(alpha), w)
        w = w / w.sum()
    return found, alphas


def votes(model: tuple[list, list], bins: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bins))
    for (j, k, low, high), a in zip(*model):
        out += np.where(bins[:, j] <= k, 2 * low - 1, 2 * high - 1) * a
    return out


# ------------------------------------------------------------ pooled models
def edges(df: DataFrame, features: list, n_bins: int) -> list[list[float]]:
    """Upper edges of all bins but the last, ascending and distinct; values up to an edge lie below it."""
    shares = [k / n_bins for k in range(1, n_bins)]
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, 100 * n_bins).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(q or [])) for q in row]


def means(df: DataFrame, features: list) -> list[float]:
    """Feature means without missing values, which take their place."""
    return [0.0 if m is None else m for m in df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))) for c in features]).first()]


def bin_columns(features: list, cuts: list[list[float]], fill: list[float]) -> list:
    """Bin numbers as column expressions (compiled comparisons, no Python)."""
    out = []
    for c, e, m in zip(features, cuts, fill):
        x = f"coalesce(nanvl(cast(`{c}` as double), null), {float(m)!r}D)"
        out.append(F.expr(" + ".join(f"cast({x} > {float(v)!r}D as int)" for v in e) if e else "0"))
    return out


def cells(df: DataFrame, features: list, label: str, cuts: list[list[float]], fill: list[float]) -> DataFrame:
    """(b0.., y, n): how many rows each combination of bins and label has; at most 2 x CELLS rows."""
    names = [f"b{i}" for i in range(len(features))]
    # the values first, once, under their own names: the comparisons read them many times
    rows = df.select(*[b.alias(n) for b, n in zip(bin_columns(features, cuts, fill), names)], F.col(label).cast("int").alias("y"))
    return rows.groupBy(*names, "y").agg(F.count(F.lit(1)).alias("n"))


TREE_MODEL = "kind string, model string"


def fit_cells(counted: DataFrame, n_bins: int, kinds: dict[str, int]) -> dict[str, dict]:
    """Fitted models of the cells by kind (``boosting`` or ``adaboost`` -> rounds), each in a task of its own."""
    names = [c for c in counted.columns if c.startswith("b")]

    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*names, "y"])
        bins, y, n = pdf[names].to_numpy(dtype=np.int64), pdf["y"].to_numpy(dtype=float), pdf["n"].to_numpy(dtype=float)
        kind, rounds = key[0], kinds[key[0]]
        if kind == "boosting":
            start, trees = boosted(bins, y, n, n_bins, rounds)
            model = {"start": start, "trees": [[f.tolist(), c.tolist(), v.tolist()] for f, c, v in trees]}
        else:
            found, alphas = stumps(bins, y, n, n_bins, rounds)
            model = {"stumps": found, "alphas": alphas}
        return pd.DataFrame({"kind": [kind], "model": [json.dumps(model)]})

    each = counted.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    return {r.kind: json.loads(r.model) for r in each.groupBy("kind").applyInPandas(work, TREE_MODEL).collect()}  # a few models


@dataclass
class BoostedModel:
    """Boosted trees over binned features; ``transform`` adds ``margin`` and ``prediction``."""

    features: list
    cuts: list
    fill: list
    start: float
    trees: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        trees = [tuple(np.array(x) for x in t) for t in self.trees]
        start = self.start

        @F.pandas_udf("double")
        def margin(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in parts:
                bins = np.stack([c.to_numpy(dtype=np.int64) for c in columns], axis=1)
                total = np.full(len(bins), start)
                for t in trees:
                    total += leaf_values(t, bins)
                yield pd.Series(total)

        scored = df.withColumn("margin", margin(*bin_columns(self.features, self.cuts, self.fill)))
        return scored.withColumn("prediction", (F.col("margin") > 0).cast("double"))


def fit_boosting(train: DataFrame, features: list, label: str = "label", rounds: int = BOOST_ROUNDS) -> BoostedModel:
    n_bins = bins_for(len(features))
    cuts, fill = edges(train, features, n_bins), means(train, features)
    model = fit_cells(cells(train, features, label, cuts, fill), n_bins, {"boosting": rounds}).get("boosting", {"start": 0.0, "trees": []})
    return BoostedModel(list(features), cuts, fill, model["start"], model["trees"])


# ------------------------------------------------------------- keyed models
def local_bins(x: np.ndarray, n_bins: int) -> list[np.ndarray]:
    """Quantile edges of a buffer's features."""
    return [np.unique(np.quantile(c, np.arange(1, n_bins) / n_bins, method="lower")) for c in x.T]


def cut_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(cuts, x.T)], axis=1)


def fit_buffer(x: np.ndarray, y: np.ndarray, n_bins: int, rounds: dict[str, int]) -> dict:
    """Boosting, forest and AdaBoost of one imputed buffer, as plain arrays."""
    cuts = local_bins(x, n_bins)
    bins, ones = cut_bins(x, cuts), np.ones(len(y))
    start, trees = boosted(bins, y, ones, n_bins, rounds["XGBoost"])
    small = lambda some: [(f.astype(np.int16), c.astype(np.int16), v) for f, c, v in some]
    return {"cuts": cuts, "start": start, "trees": small(trees), "forest": small(forest(bins, y, n_bins, rounds["RandomForest"])),
            "stumps": stumps(bins, y, ones, n_bins, rounds["AdaBoost"])}


def buffer_labels(model: dict, rows: np.ndarray) -> dict[str, np.ndarray]:
    """{name: class 1 or not} of rows by a model of ``fit_buffer``."""
    b = cut_bins(rows, model["cuts"])
    return {"XGBoost": model["start"] + summed_values(model["trees"], b) > 0,
            "RandomForest": summed_values(model["forest"], b) / max(1, len(model["forest"])) > 0.5,
            "AdaBoost": votes(model["stumps"], b) > 0}
