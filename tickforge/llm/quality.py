"""Quality rules with an isolation forest over the rule statistics.

Every text is measured by a few counts.  The isolation forest separates rows
by random splits of the derived ratios: rows that few splits isolate are
anomalies.  One forest sees the ratios of shape, one those of repetition
(``GROUPS``), each with its own threshold; a row over either is rejected.  (In
one forest over all ratios, repeats, which good texts hold too, push the good
texts' scores above those of bad texts without repeats.)  Each tree grows on its own subsample (the method's own bound:
``TREES`` x ``SUBSAMPLE`` rows, taken by hash over the whole corpus); scores
and the thresholds cover all rows.  A threshold comes from the labelled rows'
score histogram: of the scores that still keep ``KEEP_GOOD`` of the good
documents, the one with the best balance of rejected bad and good ones
(``GOOD_WEIGHT``), in the middle of equals.

Defined results: null text counts as empty (no words, fails the base rules);
repeated rows each get their row; null ids are measured and never labelled;
without labelled good and bad rows the method rejects nothing; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import run_folder, written

TREES = 100
SUBSAMPLE = 256
SEED = 7
KEEP_GOOD = 0.998  # share of labelled good documents that the threshold keeps
GOOD_WEIGHT = 20  # a rejected share of good documents counts so many times one of bad documents
BINS = 10_000  # score histogram
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
GROUPS = {"shape": ("r_symbols", "r_upper", "r_marks", "word_length"), "repeats": ("r_dup_lines", "r_repeat")}
RATIOS = tuple(r for some in GROUPS.values() for r in some)
SCORES = tuple(f"anomaly_{g}" for g in GROUPS)

_SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_MANY = 50_000


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    if n > _MANY:  # by numbers instead of tuples
        number: dict[bytes, int] = {}
        w = np.fromiter((number.setdefault(x, len(number)) for x in words), dtype=np.int64, count=n)
        _, pair = np.unique(w[:-1] * len(number) + w[1:], return_inverse=True)
        _, which, times = np.unique(pair[:-1] * len(number) + w[2:], return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[which] > 1)
    else:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        times = Counter(windows)
        again = np.flatnonzero(np.fromiter((times[x] > 1 for x in windows), dtype=bool, count=n - 2))
    inside = np.zeros(n, dtype=bool)
    for k in range(3):
        inside[again + k] = True
    return int(inside.sum())


def measure(text: str | None) -> tuple:
    """COUNTS, then RATIOS."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - (len(raw) - sum(map(len, words)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeat_words(words)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    letters = upper + len(raw) - len(raw.translate(None, _LOWER))
    return (n, chars, symbols, dup_lines, repeats,
            symbols / max(chars, 1), upper / max(letters, 1), raw.count(b"!") / max(chars, 1), min(chars / max(n, 1), 30.0),
            dup_lines / max(len(lines), 1), repeats / max(n, 1))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id with COUNTS and RATIOS of every whole text."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t.as_py()) for t in b.column("text")]
            cols = list(zip(*rows)) if rows else [()] * (len(COUNTS) + len(RATIOS))
            arrays = [pa.array(c, pa.int64()) for c in cols[:len(COUNTS)]] + [pa.array(c, pa.float64()) for c in cols[len(COUNTS):]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *arrays], names=["doc_id", *COUNTS, *RATIOS])

    fields = ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in RATIOS])
    return source.mapInArrow(work, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {fields}")


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    return np.where(big, 2 * (np.log(np.maximum(n, 3) - 1) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), out)


@dataclass
class Forest:
    """Flat trees: feature (-1 at a leaf), threshold, children, path length at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    subsample: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores in (0, 1): 2 ** (-mean path / mean path of the subsample)."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while True:
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                below = x[rows, np.maximum(f, 0)] < self.threshold[node]
                node = np.where(inner, np.where(below, self.left[node], self.right[node]), node)
            total += self.length[node]
        mean = total / max(len(self.roots), 1)
        return 2.0 ** (-mean / max(float(_mean_path(self.subsample)), 1e-9))


def grow(rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    """Trees of random splits, each on its own subsample of ``rows``."""
    rng = np.random.default_rng(seed)
    feature, threshold, left, right, length, roots = [], [], [], [], [], []
    size = min(subsample, len(rows))
    depth_limit = max(1, int(np.ceil(np.log2(max(size, 2)))))

    def node(x: np.ndarray, depth: int) -> int:
        at = len(feature)
        for column, value in zip((feature, threshold, left, right, length), (-1, 0.0, -1, -1, depth + float(_mean_path(len(x))))):
            column.append(value)
        low, high = (x.min(axis=0), x.max(axis=0)) if len(x) else (np.zeros(0), np.zeros(0))
        open_features = np.flatnonzero(high > low)
        if depth >= depth_limit or len(x) <= 1 or not len(open_features):
            return at
        f = int(rng.choice(open_features))
        cut = rng.uniform(low[f], high[f])
        below = x[:, f] < cut
        if not below.any() or below.all():
            return at
        feature[at], threshold[at] = f, cut
        left[at] = node(x[below], depth + 1)
        right[at] = node(x[~below], depth + 1)
        return at

    for _ in range(trees if size else 0):
        roots.append(node(rows[rng.choice(len(rows), size, replace=False)], 0))
    return Forest(*(np.array(c) for c in (feature, threshold, left, right, length)), np.array(roots, dtype=int), size)


def fit(stats: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> dict[str, Forest]:
    """A forest per group of ratios on hash-drawn rows of the measured corpus: about trees x subsample of them."""
    want = trees * subsample
    n = stats.count()
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", *COUNTS), F.lit(1 << 32))
    picked = stats.withColumn("place", place)
    if n > want:
        picked = picked.filter(F.col("place") < int(1.1 * want / n * (1 << 32)) + 1)
    # repeated rows share a place: the least places, whatever order the rows come in
    rows = picked.orderBy("place", *RATIOS).select(*RATIOS).limit(2 * want).collect()
    x = np.array([tuple(r) for r in rows], dtype=float).reshape(len(rows), len(RATIOS))
    x = x[np.lexsort(x.T)] if len(x) else x
    return {g: grow(x[:, [RATIOS.index(r) for r in some]], trees, subsample, seed + k) for k, (g, some) in enumerate(GROUPS.items())}


def scored(stats: DataFrame, forests: dict[str, Forest]) -> DataFrame:
    """The measured rows with SCORES."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [pa.array(forests[g].scores(np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in some]))) for g, some in GROUPS.items()]
            yield pa.RecordBatch.from_arrays([*b.columns, *scores], names=[*b.schema.names, *SCORES])

    fields = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields] + [f"{x} double" for x in SCORES])
    return stats.mapInArrow(work, fields)


def thresholds(rows: DataFrame, labels: DataFrame, keep_good: float = KEEP_GOOD) -> dict[str, float]:
    """Scores from which documents are rejected, from all labelled rows; of several labels of a document the worst counts."""
    marked = (labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("l_id"))
              .agg(F.min((F.col("quality") > 0).cast("int")).alias("good")))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("score"), F.floor(F.col(c) * BINS).cast("int").alias("bin")) for c in SCORES]))
    hist = (rows.join(marked, F.col("doc_id") == F.col("l_id")).select("good", each.alias("s"))
            .groupBy("s.score", "s.bin").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).collect())
    return {c: _cut([(r["bin"], r["good"], r["bad"]) for r in hist if r["score"] == c], keep_good) for c in SCORES}


def _cut(hist: list[tuple[int, int, int]], keep_good: float) -> float:
    """Best threshold of a histogram (bin, good, bad); none without good and bad rows or without a gain."""
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for at, g, b in hist:
        good[at] += g
        bad[at] += b
    if not good.sum() or not bad.sum():
        return float("inf")
    above_good, above_bad = good[::-1].cumsum()[::-1] / good.sum(), bad[::-1].cumsum()[::-1] / bad.sum()
    gain = np.where(above_good <= 1 - keep_good, above_bad - GOOD_WEIGHT * above_good, 0)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(best[len(best) // 2] / BINS) if gain.max() > 0 else float("inf")


def base_failed():
    """The fixed rules: too few words, or mostly repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, COUNTS, base_failed, kept, SCORES of every document."""
    folder = run_folder(docs.sparkSession, "quality")
    stats = written(measured(docs, id_col, text_col), f"{folder}/stats")
    rows = written(scored(stats, fit(stats)), f"{folder}/scored")
    limits = thresholds(rows.filter(~base_failed()), labels)
    kept = ~base_failed()
    for c in SCORES:
        kept = kept & (F.col(c) < F.lit(limits[c]))
    return rows.select("doc_id", *COUNTS, base_failed().alias("base_failed"), kept.alias("kept"), *SCORES)
