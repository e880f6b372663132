"""Language identification with hyperdimensional profiles.

Every letter has a random bipolar vector.  A letter trigram is bound into one
vector by multiplying its letters' vectors, each rotated by its place; a text
is the bundle (sum) of its trigrams' vectors, a language's prototype the
bundle of its training texts.  A text gets the language whose prototype has
the greatest cosine.

Letters are lower-cased, runs of other characters count as one word border,
and a trigram's middle is always a letter.  Every letter of every script has a
vector of its own, a hash of its code point, so every task derives the same
ones.  Training sums one vector per language and task; up to ``MAX_LANGUAGES``
prototypes reach the driver and travel to every task.  More of them stay a
table and are taken block by block, each block one pass over the documents
that keeps the better of its own and the earlier blocks' answers.

Defined results: null text and text without a letter give ``und`` with score
0, and so does every text when no language was learned; ties go to the first
language in sorted order; rows with null text or null language teach nothing;
further columns are kept by ``accepted`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import mix, run_folder, written

UNDETERMINED = "und"
DIMENSIONS = 512
FOLDS = 5
MAX_LANGUAGES = 4096  # of a block: languages x dimensions floats travel to every task
SEED = 20_031
_PIECE = 1 << 20  # characters handled at once
_GROUP = 1 << 20  # bytes of small texts handled at once
_ROWS = 1024  # texts handled at once: rows x letters ** 3 (under 142,000 letters) fit 63 bits
_BOUND = 1 << 15  # trigram vectors held at once

Prototypes = dict[str, np.ndarray] | DataFrame

_letter_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Lower-cased code point of every letter, 0 for what is no letter."""
    global _letter_table
    if _letter_table is None:
        table = np.zeros(0x110000, dtype=np.uint32)
        for cp in range(0x110000):
            ch = chr(cp)
            if ch.isalpha():
                table[cp] = ord(ch.lower()[0])
        _letter_table = table
    return _letter_table


def letter_vectors(codes: np.ndarray, dimensions: int, seed: int = SEED) -> np.ndarray:
    """Random vectors of 1 and -1, one per code (0: the word border)."""
    words = -(-dimensions // 64)
    place = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(1, words + 1, dtype=np.uint64)
    bits = np.unpackbits(mix(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)).view(np.uint8), axis=1)
    return bits[:, :dimensions].astype(np.int8) * 2 - 1


def bind(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Vectors of trigrams given as (a * n + b) * n + c, the places of their letters among the n ``letters``."""
    n = len(letters)
    return np.roll(letters[grams // (n * n)], 2, axis=1) * np.roll(letters[grams // n % n], 1, axis=1) * letters[grams % n]


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts with a border at both ends, in groups of bounded size.

    A longer text comes in several pieces, cut at a character that is no letter
    or, inside a long run of letters, so that the next piece repeats two of
    them; neither changes a trigram."""
    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        lo, t = 0, f" {t or ''} "
        while lo < len(t):
            hi = min(lo + _PIECE, len(t))
            if hi < len(t):
                cut = hi
                while cut > lo and t[cut - 1].isalpha():
                    cut -= 1
                hi = cut if cut > lo + 1 else hi
            rows.append(i)
            parts.append(t[lo:hi])
            size += hi - lo
            if size >= _GROUP:
                yield rows, parts
                rows, parts, size = [], [], 0
            if hi == len(t):
                break
            lo = hi - 2 if t[hi - 1].isalpha() else hi - 1  # the border before a word stays with it
    if parts:
        yield rows, parts


def count_trigrams(rows: np.ndarray, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, trigram, count) of texts and the codes whose places make the trigrams; equal ``rows`` are counted together."""
    lens = np.fromiter((len(p) for p in parts), dtype=np.int64, count=len(parts))
    code = _letters()[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    part = np.repeat(np.arange(len(parts)), lens)
    letter = code > 0
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (part[1:] != part[:-1])
    code, part = code[keep], part[keep]
    used = np.zeros(0x110000, dtype=bool)
    used[0] = used[code] = True
    codes = np.flatnonzero(used)
    place = np.zeros(0x110000, dtype=np.int64)
    place[codes] = np.arange(len(codes))
    sym, n = place[code], len(codes)
    whole = (part[2:] == part[:-2]) & (sym[1:-1] > 0)
    gram = ((sym[:-2] * n + sym[1:-1]) * n + sym[2:])[whole]
    keys, counts = np.unique(rows[part[:-2][whole]] * n ** 3 + gram, return_counts=True)
    return keys // n ** 3, keys % n ** 3, counts, codes


def bundles(texts: list[str | None], dimensions: int, rows: list[int] | None = None, n_rows: int | None = None) -> np.ndarray:
    """Bundled vector of every text (or of every row that texts are counted to)."""
    n = len(texts) if n_rows is None else n_rows
    out = np.zeros((n, dimensions), dtype=np.float32)
    for at, parts in _pieces(texts):
        of = np.array(at, dtype=np.int64) if rows is None else np.array([rows[i] for i in at], dtype=np.int64)
        every_row, every_gram, every_count, codes = count_trigrams(of, parts)
        letters = letter_vectors(codes, dimensions)
        for begin in range(0, len(every_row), _BOUND):
            row, gram, count = (x[begin:begin + _BOUND] for x in (every_row, every_gram, every_count))
            distinct, place = np.unique(gram, return_inverse=True)
            vectors = bind(distinct, letters).astype(np.float32)
            weight = count.astype(np.float32)
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            for lo, hi in zip(starts, np.concatenate((starts[1:], [len(row)]))):
                out[row[lo]] += weight[lo:hi] @ vectors[place[lo:hi]]
    return out


def held_out(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    """True for the rows kept out of training: crc32 of the id's text mod ``folds`` is 0 (null id: false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def learn(training: DataFrame, lang_col: str = "lang", text_col: str = "text", dimensions: int = DIMENSIONS,
          max_languages: int = MAX_LANGUAGES) -> Prototypes:
    """Prototype of every language of the training rows; more than ``max_languages`` as a table (lang, bundle)."""
    rows = (training.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            names = sorted(sums)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[x].tolist() for x in names], pa.list_(pa.float64()))],
                                              names=["lang", "bundle"])

        for whole in batches:
            for lo in range(0, len(whole), _ROWS):
                b = whole.slice(lo, _ROWS)
                langs = b.column("lang").to_pylist()
                names = sorted(set(langs))
                number = {x: i for i, x in enumerate(names)}
                got = bundles(b.column("text").to_pylist(), dimensions, [number[x] for x in langs], len(names))
                for x, v in zip(names, got.astype(np.float64)):
                    sums[x] = sums.get(x, 0) + v
                if len(sums) > max_languages:
                    yield told()
                    sums.clear()
        yield told()

    partial = rows.mapInArrow(work, "lang string, bundle array<double>")
    total = (partial.select("lang", F.posexplode("bundle").alias("place", "x"))
             .groupBy("lang", "place").agg(F.sum("x").alias("x"))
             .groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("bundle")))
    found = total.limit(max_languages + 1).collect()
    if len(found) > max_languages:
        return written(total, f"{run_folder(training.sparkSession, 'langid')}/prototypes")
    return {r["lang"]: np.array(r["bundle"]) for r in found}


def _pass(source: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int, keep_text: bool) -> DataFrame:
    """``source`` (any columns, then __text and from a second pass on __pred and __cos)
    with the language of the greatest cosine so far and that cosine; null without one."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[x] for x in names], dtype=np.float64).reshape(len(names), dimensions)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = (matrix / np.where(norms > 0, norms, 1)).astype(np.float32)
    text_at = source.columns.index("__text")
    later = len(source.columns) > text_at + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred: list[str | None] = []
            cosine: list[float | None] = []
            texts = b.column(text_at)
            for lo in range(0, len(b), _ROWS):
                h = bundles(texts.slice(lo, _ROWS).to_pylist(), dimensions)
                size = np.linalg.norm(h, axis=1)
                cos = (h @ matrix.T) / np.where(size > 0, size, 1)[:, None] if names else np.zeros((len(h), 1))
                best = cos.argmax(axis=1)
                known = size > 0 if names else np.zeros(len(h), dtype=bool)
                pred += [names[k] if s else None for k, s in zip(best, known)]
                cosine += [float(x) if s else None for x, s in zip(cos[np.arange(len(h)), best], known)]
            if later:
                before = zip(b.column(text_at + 1).to_pylist(), b.column(text_at + 2).to_pylist(), pred, cosine)
                pairs = [(p, c) if q is None or p is not None and (-c, p) <= (-d, q) else (q, d) for p, c, q, d in before]
                pred, cosine = [p for p, _ in pairs], [c for _, c in pairs]
            kept = text_at + keep_text
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(kept)), pa.array(pred, pa.string()), pa.array(cosine, pa.float64())],
                                             names=[*b.schema.names[:kept], "__pred", "__cos"])

    fields = source.schema.fields[:text_at + keep_text]
    return source.mapInArrow(work, T.StructType([*fields, T.StructField("__pred", T.StringType()), T.StructField("__cos", T.DoubleType())]))


def identify(docs: DataFrame, prototypes: Prototypes, text_col: str = "text",
             dimensions: int = DIMENSIONS, columns: tuple[str, ...] = (), max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """``columns`` of the rows with ``lang_pred`` and ``score`` (cosine, clipped to 0-1)."""
    source = docs.select(*[f"`{c}`" for c in columns], F.col(text_col).cast("string").alias("__text"))
    if isinstance(prototypes, dict):
        judged = _pass(source, prototypes, dimensions, False)
    else:
        folder, blocks = run_folder(docs.sparkSession, "langid"), -(-prototypes.count() // max_languages)
        judged = source
        for k in range(blocks):
            some = prototypes.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k).collect()
            judged = written(_pass(judged, {r["lang"]: np.array(r["bundle"]) for r in some}, dimensions, True), f"{folder}/{k}")
    return judged.select(*[f"`{c}`" for c in columns], F.coalesce("__pred", F.lit(UNDETERMINED)).alias("lang_pred"),
                         F.greatest(F.least(F.coalesce("__cos", F.lit(0.0)), F.lit(1.0)), F.lit(0.0)).alias("score"))


def learn_held_out(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
                   dimensions: int = DIMENSIONS) -> Prototypes:
    """Prototypes from the rows outside the held-out fold (null ids teach nothing)."""
    teach = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col))
    return learn(teach, lang_col, text_col, dimensions)


def accepted(docs: DataFrame, prototypes: Prototypes, text_col: str = "text",
             dimensions: int = DIMENSIONS) -> DataFrame:
    """The rows whose language can be told: all but ``und`` (short clean texts have low cosines too)."""
    plain = [f"__c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*plain)
    text = plain[docs.columns.index(text_col)]
    judged = identify(named, prototypes, text, dimensions, tuple(plain))
    return judged.filter(F.col("lang_pred") != UNDETERMINED).select(*plain).toDF(*docs.columns)
