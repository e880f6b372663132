"""Benchmark decontamination by latent semantic retrieval.

1. Every whole text becomes its word hashes (A-Z folded, ASCII punctuation
   dropped), written once to the shared folder; the same pass counts in how
   many 32-word passages each term bucket occurs.
2. The passages' TF-IDF rows form a matrix A.  One further pass gathers
   A^T (A X) for a random test matrix X: a randomised SVD by the Nystrom
   formula, with the small factorisation (rank x rank) on the driver.  Tasks
   add up their part before the shuffle; its size is terms x rank a task.
3. An item counts as found only with ``MIN_LCS`` of its words, so of any set of
   its words all but the share that may be missing stand in the surroundings.
   Its rarest words, looked up in every document, leave the places where enough
   of them stand together; this bound loses no place that step 5 accepts.
4. All 12-word windows around these places (of the item's own length where that
   is less) are projected to the whitened latent space and compared by cosine
   with the item's windows, so a verbatim copy has its exact window.
5. Each candidate's surroundings are compared with the whole item: the longest
   common subsequence must cover ``MIN_LCS`` of the item's words, and that of
   the answer (column ``answer_col``, else the item's last sentence) ``MIN_ANSWER``
   of the answer's words.  An answer that is no part of the item's text is
   looked for as many words further on both sides as it has.

Items are taken in blocks of a bounded number, one search per block, so the
broadcast tables stay bounded however large the benchmark is.

Defined results: null text has no words; items under ``MIN_ITEM_WORDS`` words
identify no document and are left out; the null-safe pair (doc_id, text) names
a document, so repeated rows give one result row; repeated item ids count once
with their best match; empty documents or an empty benchmark give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import WordHasher, byte_slices, distinct, numbered, run_folder, written

TERMS = 1 << 16
RANK = 32
PASSAGE = 32
WINDOW = 12
MIN_COSINE = 0.5
MIN_LCS = 0.7
MIN_ANSWER = 0.6
SURROUND = 0.125  # of an item's length, before and after it
MIN_ITEM_WORDS = 8
MIN_ANSWER_WORDS = 4
RARE = 0.25  # of an item's words, looked up besides those that may be missing
BLOCK_ITEMS = 2_000
SEED = 11
_Z_BLOCK = 1024
_Z_WAVES = 3  # tasks of the sketch per core
_BATCH = 1 << 18  # words handled at once
_KNOWN_BITS = 20

PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _ids(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype("<u4")


def word_ids(text: bytes | None, hasher: WordHasher) -> np.ndarray:
    return _ids(hasher.hashes(text or b""))


def _passages(lens: np.ndarray) -> np.ndarray:
    """Passage number of every word of texts of these lengths."""
    place = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    per = -(-lens // PASSAGE)
    return np.repeat(np.cumsum(per) - per, lens) + place // PASSAGE


def tokenised(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (doc_id, text_hash, words, df, passages): a row per document
    with its words' ids, and a row per task with passage counts per term."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["doc_id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, df, passages, schema = WordHasher(PUNCTUATION), np.zeros(TERMS, dtype=np.int64), 0, None
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for lo, hi in byte_slices(texts):
                n, raw = hi - lo, []
                for _, _, hashes, _, ends in hasher.groups(texts.slice(lo, n).to_pylist()):
                    ids, lens = _ids(hashes), np.diff(ends, prepend=0)
                    if len(ids):
                        at = _passages(lens)
                        df += np.bincount(distinct(at << 16 | ids & (TERMS - 1)) & (TERMS - 1), minlength=TERMS)
                        passages += int(at[-1]) + 1
                    whole, cuts = ids.tobytes(), (4 * ends).tolist()
                    raw += [whole[a:z] for a, z in zip([0, *cuts], cuts)]
                out = pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, n), b.column("text_hash").slice(lo, n), pa.array(raw, pa.binary()),
                                                  pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names=["doc_id", "text_hash", "words", "df", "passages"])
                schema = out.schema
                yield out
        if schema is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, schema.field(0).type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([df.astype("<i8").tobytes()], pa.binary()), pa.array([passages], pa.int64())], schema=schema)

    return written(source.mapInArrow(work, f"doc_id {id_type.simpleString()}, text_hash long, words binary, df binary, passages long"), folder)


def inverse_frequencies(tokens: DataFrame) -> np.ndarray:
    """idf of every term bucket over all passages."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(TERMS, dtype=np.int64), 0
        for b in batches:
            for x, p in zip(b.column("df"), b.column("passages")):
                df += np.frombuffer(x.as_py(), dtype="<i8")
                n += p.as_py()
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(df[used], n))], names=["term", "n"])

    rows = tokens.filter("df is not null").select("df", "passages").mapInArrow(add, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(TERMS)
    total = sum(r["n"] for r in rows if r["term"] < 0)
    for r in rows:
        if r["term"] >= 0:
            df[r["term"]] = r["n"]
    return np.log((1 + total) / (1 + df)).astype(np.float32)


def _word_batches(batches: Iterator[pa.RecordBatch], limit: int = _BATCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, lengths) of several documents at a time."""
    held, size = [], 0
    for b in batches:
        for x in b.column("words"):
            w = np.frombuffer(x.as_py(), dtype="<u4")
            for lo in range(0, len(w), limit):  # cut at whole passages
                held.append(w[lo:lo + limit])
                size += len(held[-1])
                if size >= limit:
                    yield np.concatenate(held), np.array([len(h) for h in held], dtype=np.int64)
                    held, size = [], 0
    if size:
        yield np.concatenate(held), np.array([len(h) for h in held], dtype=np.int64)


def test_matrix(rank: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TERMS, rank), dtype=np.float32)


def partial_sketches(tokens: DataFrame, idf: np.ndarray, rank: int, tasks: int) -> DataFrame:
    """(block, z): what each of at most ``tasks`` tasks adds to a block of rows of the sketch."""
    weights = tokens.sparkSession.sparkContext.broadcast(idf)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # column by column: every step runs along one column of X, Y or Z
        x, w_term, z = test_matrix(rank).T.copy(), weights.value, None
        for words, lens in _word_batches(batches):
            keys, tf = np.unique(_passages(lens) << 16 | words & (TERMS - 1), return_counts=True)
            row, term = keys >> 16, keys & (TERMS - 1)
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            w = tf.astype(np.float32) * w_term[term]
            size = np.sqrt(np.add.reduceat(w * w, starts))
            per_row = np.diff(np.append(starts, len(row)))
            w /= np.repeat(np.where(size > 0, size, 1), per_row)
            z = np.zeros((rank, TERMS)) if z is None else z
            for j in range(rank):
                y = np.add.reduceat(x[j][term] * w, starts)
                z[j] += np.bincount(term, weights=np.repeat(y, per_row) * w, minlength=TERMS)
        if z is not None:
            z = z.T
            for k in range(0, TERMS, _Z_BLOCK):
                if z[k:k + _Z_BLOCK].any():
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([z[k:k + _Z_BLOCK].astype("<f4").tobytes()], pa.binary())], names=["block", "z"])

    return tokens.filter("words is not null").select("words").coalesce(tasks).mapInArrow(partial, "block long, z binary")


def sketch(tokens: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """A^T (A X) for the TF-IDF matrix A of all passages (rows of unit length)."""
    def adder(kind: str):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for k, z in zip(b.column("block").to_pylist(), b.column("z")):
                    part = np.frombuffer(z.as_py(), dtype=kind).astype(np.float64)
                    sums[k] = sums[k] + part if k in sums else part
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["block", "z"])

        return add

    # each task sends up to terms x rank numbers: as many tasks as the cores need, not as the input has parts
    tasks = _Z_WAVES * tokens.sparkSession.sparkContext.defaultParallelism
    parts = partial_sketches(tokens, idf, rank, tasks)
    # in two steps: no task reads what all tasks have gathered of a block
    share = F.spark_partition_id() % math.ceil(math.sqrt(tasks))
    some = parts.withColumn("share", share).repartition("block", "share").select("block", "z").mapInArrow(adder("<f4"), "block long, z binary")
    rows = some.repartition("block").mapInArrow(adder("<f8"), "block long, z binary").collect()
    z = np.zeros((TERMS, rank))
    for r in rows:  # TERMS x rank numbers in all
        z[r["block"]:r["block"] + _Z_BLOCK] += np.frombuffer(r["z"], dtype="<f8").reshape(-1, rank)
    return z


def latent_space(z: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Term projections: idf-weighted right singular vectors over singular values (TERMS x rank)."""
    x = test_matrix(z.shape[1]).astype(np.float64)
    q, r = np.linalg.qr(z)
    core = r @ np.linalg.pinv((x.T @ z + z.T @ x) / 2) @ r.T
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-9
    if not good.any():
        return np.zeros((TERMS, 1), dtype=np.float32)
    return (idf[:, None] * ((q @ vectors[:, good]) / np.sqrt(values[good]))).astype(np.float32)


def lcs_length(a: np.ndarray, places: dict[int, int], bits: int) -> int:
    """Longest common subsequence of ``a`` with a sequence given by the bit set
    of each word's places (bit-parallel dynamic programme)."""
    full = (1 << bits) - 1
    v = full
    for w in a.tolist():
        m = places.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return bits - v.bit_count()


def _places(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _spans(words: np.ndarray, size: int) -> set[bytes]:
    """All runs of ``size`` words."""
    return {words[k:k + size].tobytes() for k in range(len(words) - size + 1)}


@dataclass
class Item:
    item_id: object
    words: np.ndarray
    order: list[int]  # the same words
    places: dict[int, int]
    answer: dict[int, int]
    answer_words: int
    pad: int  # words before and after it that its surroundings hold
    apart: int  # further words there for an answer that is no part of the item's text


def read_item(item_id, text: str, answer: str | None, hasher: WordHasher) -> Item | None:
    words = word_ids(text.encode("utf-8", "replace"), hasher)
    if len(words) < MIN_ITEM_WORDS:
        return None
    last = word_ids(answer.encode("utf-8", "replace"), hasher) if answer else np.empty(0, dtype="<u4")
    apart = 0 if last.tobytes() in _spans(words, len(last)) else len(last)
    if not len(last):
        sentences = [s for s in (word_ids(s.encode("utf-8", "replace"), hasher) for s in re.split(r"[.?!\n]+", text)) if len(s)]
        last = sentences[-1]
        if len(last) < MIN_ANSWER_WORDS:
            last = words[-MIN_ITEM_WORDS:]
    return Item(item_id, words, words.tolist(), _places(words), _places(last), len(last), math.ceil(SURROUND * len(words)), apart)


class Searcher:
    """Cosine search of document windows against one block of benchmark items."""

    def __init__(self, items: list[Item], projection: np.ndarray, idf: np.ndarray, min_cosine: float = MIN_COSINE):
        self.items, self.projection, self.min_cosine = items, projection, min_cosine
        self.queries, words, of, self.need, self.span = [], [], [], [], []
        for i, item in enumerate(items):
            n = len(item.words)
            self.queries.append(self._unit(self._sums(item.words, np.arange(max(1, n - WINDOW + 1)), WINDOW)).T.copy())
            # at most ``missing`` words may fail, so of the rarest ones all but that many stand in the surroundings
            missing = n - math.ceil(MIN_LCS * n)
            rarest = item.words[np.argsort(-idf[item.words & (TERMS - 1)], kind="stable")[:missing + math.ceil(RARE * n)]]
            self.need.append(int(np.isin(item.words, rarest).sum()) - missing)
            self.span.append(n + 2 * item.pad)
            words.append(np.unique(rarest))
            of.append(np.full(len(words[-1]), i))
        words, of = np.concatenate(words), np.concatenate(of)
        order = np.argsort(words, kind="stable")
        self.of, (self.rare, self.first, self.n_of) = of[order], np.unique(words[order], return_index=True, return_counts=True)
        self.known = np.zeros(1 << _KNOWN_BITS, dtype=bool)
        self.known[self.rare >> (32 - _KNOWN_BITS)] = True
        self.need, self.span = np.array(self.need, dtype=np.int64), np.array(self.span, dtype=np.int64)
        self.pad = np.array([item.pad for item in items], dtype=np.int64)

    def _sums(self, words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """Latent vectors of the windows of ``size`` words (fewer at the end) from ``starts`` on."""
        c = np.zeros((len(words) + 1, self.projection.shape[1]))
        np.cumsum(self.projection[words & (TERMS - 1)], axis=0, dtype=np.float64, out=c[1:])
        return c[np.minimum(starts + size, len(words))] - c[starts]

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        """Rows of unit length; those without a place in the latent space are alike."""
        size = np.linalg.norm(x, axis=1, keepdims=True)
        none = size <= 1e-9
        return np.hstack([np.where(none, 0, x / np.where(none, 1, size)), none])

    def places(self, words: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """(text, item, first, last): all places of an item in texts laid end to end
        whose surroundings hold as many of its rarest words as ``MIN_LCS`` implies."""
        at = np.flatnonzero(self.known[words >> (32 - _KNOWN_BITS)])
        k = np.minimum(np.searchsorted(self.rare, words[at]), len(self.rare) - 1)
        same = self.rare[k] == words[at]
        at, k = at[same], k[same]
        n = self.n_of[k]
        item = self.of[np.repeat(self.first[k], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
        at = np.repeat(at, n)
        order = np.argsort(item, kind="stable")
        item, at = item[order], at[order]
        text = np.searchsorted(np.cumsum(lens), at, side="right")
        here = np.arange(len(at))
        there = here + self.need[item] - 1
        here, there = here[there < len(at)], there[there < len(at)]
        full = (item[here] == item[there]) & (text[here] == text[there]) & (at[there] - at[here] < self.span[item[here]])
        here, there = here[full], there[full]
        item, text = item[here], text[here]
        pad = self.pad[item]
        lo, hi = at[there] - self.span[item] + 1 + pad, at[here] + pad
        new = np.ones(len(here), dtype=bool)
        new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (lo[1:] > hi[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(here))[:len(first)] - 1
        return np.column_stack([text[first], item[first], lo[first], hi[last]])

    def _latent(self, words: np.ndarray, i: int, lo: int, hi: int, begin: int, end: int) -> np.ndarray:
        """The places from ``lo`` to ``hi`` with a window above the cosine, the best first."""
        n, query = len(self.items[i].words), self.queries[i]
        size = min(WINDOW, n)
        s = np.arange(max(begin, lo), max(begin, min(hi + n - size, end - size)) + 1)
        if not len(s):
            return np.empty(0, dtype=np.int64)
        base = int(s[0])
        p = self._unit(self._sums(words[base:min(int(s[-1]) + size, end)], s - base, size))
        best = np.full(hi - lo + 1, -2.0)
        for k in range(0, len(s), 512):
            cosine = p[k:k + 512] @ query
            row, q = np.nonzero(cosine >= self.min_cosine)
            place = s[k + row] - q - lo
            inside = (place >= 0) & (place < len(best))
            np.maximum.at(best, place[inside], cosine[row[inside], q[inside]])
        order = np.argsort(-best, kind="stable")
        return lo + order[best[order] > -2]

    def search(self, words: np.ndarray, lens: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(text number, item number) -> (common words, answer words found, place) of the best accepted match."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        ends_of = np.cumsum(lens)
        for t, i, lo, hi in self.places(words, lens).tolist():
            item = self.items[i]
            n, pad = len(item.words), item.pad
            begin, end = int(ends_of[t] - lens[t]), int(ends_of[t])
            for at0 in self._latent(words, i, lo, hi, begin, end).tolist():
                have = best.get((t, i))
                if have and have[0] == n and have[1] == item.answer_words:
                    break
                near = words[max(begin, at0 - pad):max(begin, min(end, at0 + n + pad))]
                there = set(near.tolist())
                if sum(w in there for w in item.order) < MIN_LCS * n:  # no more words in common than this
                    continue
                common = lcs_length(near, item.places, n)
                if common < MIN_LCS * n:
                    continue
                if item.apart:
                    near = words[max(begin, at0 - pad - item.apart):min(end, at0 + n + pad + item.apart)]
                told = lcs_length(near, item.answer, item.answer_words)
                if told >= MIN_ANSWER * item.answer_words and (not have or (common, told) > have[:2]):
                    best[t, i] = (common, told, max(at0 - begin, 0))
        return best


def _in_blocks(bench: DataFrame, id_col: str, text_col: str, answer_col: str | None, blocks: int, path: str) -> DataFrame:
    """The distinct items with their block, written once, a folder a block."""
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    part = bench.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"), answer.alias("answer")).distinct()
    part = part.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    part.repartition("block").write.partitionBy("block").parquet(path)
    return bench.sparkSession.read.schema(part.schema).parquet(path)


def _read_block(items: DataFrame, block: int) -> list[Item]:
    rows = items.filter(F.col("block") == block).select("item_id", "text", "answer").collect()
    hasher = WordHasher(PUNCTUATION)
    found = [read_item(r["item_id"], r["text"], r["answer"], hasher) for r in sorted(rows, key=str)]
    return [x for x in found if x is not None]


def leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", min_cosine: float = MIN_COSINE, block_items: int = BLOCK_ITEMS, answer_col: str | None = None) -> DataFrame:
    """(doc_id, text_hash, item_id, common_words, item_words, answer_found, answer_words, word_offset)
    of every document and benchmark item that it contains or paraphrases.

    One block of items at a time is read, broadcast, searched for in all
    documents and forgotten; what it found is written to the shared folder.
    ``answer_col`` names a column with the items' answers, if there is one."""
    spark = docs.sparkSession
    folder = run_folder(spark, "decontaminate")
    tokens = tokenised(docs, f"{folder}/words", id_col, text_col)
    idf = inverse_frequencies(tokens)
    projection = latent_space(sketch(tokens, idf), idf)  # terms x rank
    shared = spark.sparkContext.broadcast((projection, idf))
    blocks = max(1, -(-bench.count() // block_items))
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), bench.schema[item_id_col].dataType.simpleString()
    schema = (f"doc_id {id_type}, text_hash long, item_id {item_type}, common_words int, item_words int, "
              "answer_found int, answer_words int, word_offset long")
    from pyspark.sql.pandas.types import to_arrow_type
    item_arrow = to_arrow_type(bench.schema[item_id_col].dataType)
    rows = tokens.filter("words is not null").select("doc_id", "text_hash", "words")
    benchmark = _in_blocks(bench, item_id_col, item_text_col, answer_col, blocks, f"{folder}/items")
    paths: list[str] = []
    for k in range(blocks):
        block = _read_block(benchmark, k)
        if not block:
            continue
        items = spark.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(items.value, *shared.value, min_cosine)
            for b in batches:
                words = [np.frombuffer(x.as_py(), dtype="<u4") for x in b.column("words")]
                lo = 0
                while lo < len(words):
                    hi, size = lo, 0
                    while hi < len(words) and (hi == lo or size + len(words[hi]) <= _BATCH):
                        size += len(words[hi])
                        hi += 1
                    got = searcher.search(np.concatenate(words[lo:hi]), np.array([len(w) for w in words[lo:hi]], dtype=np.int64))
                    if got:
                        at = pa.array([lo + t for t, _ in got])
                        of = [items.value[i] for _, i in got]
                        yield pa.RecordBatch.from_arrays(
                            [b.column("doc_id").take(at), b.column("text_hash").take(at), pa.array([x.item_id for x in of], item_arrow),
                             pa.array([v[0] for v in got.values()], pa.int32()), pa.array([len(x.words) for x in of], pa.int32()),
                             pa.array([v[1] for v in got.values()], pa.int32()), pa.array([x.answer_words for x in of], pa.int32()),
                             pa.array([v[2] for v in got.values()], pa.int64())],
                            names=["doc_id", "text_hash", "item_id", "common_words", "item_words", "answer_found", "answer_words", "word_offset"])
                    lo = hi

        paths.append(f"{folder}/found/{k}")
        rows.mapInArrow(work, schema).write.parquet(paths[-1])
        items.destroy()
    if not paths:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).parquet(*paths)
    best = F.max(F.struct((F.col("common_words") / F.col("item_words")).alias("share"), "common_words", "item_words", "answer_found", "answer_words",
                          (-F.col("word_offset")).alias("back")))
    return (found.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("b"))
            .select("doc_id", "text_hash", "item_id", "b.common_words", "b.item_words", "b.answer_found", "b.answer_words", (-F.col("b.back")).alias("word_offset")))


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents without a leaked benchmark item."""
    bad = leaks(docs, bench, id_col, text_col, **kw).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    plain, name = numbered(docs)
    own = F.col(name[id_col])
    rest = plain.withColumn("own_hash", F.xxhash64(name[text_col])).join(bad, own.eqNullSafe(F.col("bad_id")) & (F.col("own_hash") == F.col("bad_hash")), "left_anti")
    return rest.select(*[F.col(name[c]).alias(c) for c in docs.columns])
