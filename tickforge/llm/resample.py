"""Target-distribution importance resampling of documents.

Documents and a target corpus are described by hashed n-grams of words.  A
bucket's gain is the scaled log ratio of its smoothed shares in the target and
in the corpus; a document's weight is the mean gain of its n-grams.  Adding
Gumbel noise derived from the id and taking the highest scores draws documents
without replacement in proportion to their importance.

Features by batch concatenation.  The texts of a slice of about 2 MB are joined
with separator sentinels, one regular-expression pass finds all words of the
slice, and ``searchsorted`` over the texts' offsets says whose each word is; an
n-gram whose words are not all of one text is masked before ``bincount``.  A
longer text is cut at separators into pieces that hand their last words on, so
memory is bounded by a slice however long a text is (a single word without a
break is held whole).  CRC-32 is linear, so an n-gram's checksum comes from its
words' checksums by table lookups; no n-gram is built as a string.

Distribution.  One pass counts buckets (a task sends its ``buckets`` sums), one
pass weighs documents; the gains in between are ``buckets`` integers, whatever
the input, and travel with the tasks.  Ranks need no global sort: scores are
integers of a bounded range (at most about 100,000 values: |gain| < 64,000 and
noise between -3,200 and 23,000), so their histogram is small, and places within
one score come from a window over distinct rows of that score.  Rows that agree
in every column are one row with a count there, and are dealt out again in
blocks.

Defined results: null or empty texts have no words, no features and weight 0;
the noise of a null id is that of an empty id; repeated rows each get their row
and, if drawn, their rank; ties go to the smaller id (null last), then to fewer
features and smaller weight; an empty target has T = 0; empty documents give an
empty result; further columns are ignored by ``ranked`` and kept by ``drawn``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import byte_slices, run_folder, written

BUCKETS = 10_000
WORDS = 2  # n-grams of 1 to this many words
MIN_WORDS = 20
PERCENT = 25
SEED = 7
SCALE = 1000.0
PIECE = 1 << 20
BLOCK = 100_000  # equal rows dealt out together
SENTINEL = b"\x00"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_BREAKS = np.array([_WORD.match(_LOWER[c:c + 1]) is None for c in range(256)])
_LONG = 48  # bytes up to which a word's checksum is taken together with others

WEIGHTS = "id long, t1 long, t2 long, n_words long, n_features long, weight long"


class _Crc:
    """CRC-32 of many byte strings at once, and of joined strings from their parts' checksums."""

    def __init__(self):
        c = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
        self.table = c
        # shift[n][k][b]: what byte k with value b of a checksum becomes when n bytes follow
        self.shift = np.empty((_LONG + 1, 4, 256), dtype=np.uint32)
        at = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        for n in range(_LONG + 1):
            self.shift[n] = at
            at = self.table[at & 0xFF] ^ (at >> 8)
        self.matrices: dict[int, np.ndarray] = {}

    def words(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint32)
        order = np.argsort(-size, kind="stable")
        n_long = int(np.searchsorted(-size[order], -_LONG, side="left"))
        for i in order[:n_long]:
            out[i] = zlib.crc32(data[starts[i]:starts[i] + size[i]])
        order = order[n_long:]
        at, left = starts[order], size[order]
        crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
        live = len(order)
        for k in range(int(left[0]) if live else 0):
            live = int(np.searchsorted(-left, -k, side="left"))  # words longer than k bytes
            crc[:live] = self.table[(crc[:live] ^ data[at[:live] + k]) & 0xFF] ^ (crc[:live] >> 8)
        out[order] = ~crc
        return out

    def _after(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Checksums as they count when n more bytes follow."""
        t = self.shift
        return t[n, 0, crc & 0xFF] ^ t[n, 1, (crc >> 8) & 0xFF] ^ t[n, 2, (crc >> 16) & 0xFF] ^ t[n, 3, crc >> 24]

    def joined(self, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Of left + right, from both checksums and the sizes of right."""
        out = np.empty(len(left), dtype=np.uint32)
        short = size <= _LONG
        out[short] = self._after(left[short], size[short]) ^ right[short]
        for n in np.unique(size[~short]):
            of = size == n
            out[of] = _times(self._matrix(int(n)), left[of]) ^ right[of]
        return out

    def _matrix(self, n: int) -> np.ndarray:
        """The bit matrix (by columns) of n following bytes, by squares of the one-byte step."""
        if n not in self.matrices:
            if len(self.matrices) > 4096:
                self.matrices.clear()
            columns = np.uint32(1) << np.arange(32, dtype=np.uint32)
            step, left = self._after(columns, np.ones(32, dtype=np.int64)), n
            while left:
                if left & 1:
                    columns = _times(step, columns)
                step, left = _times(step, step), left >> 1
            self.matrices[n] = columns
        return self.matrices[n]


def _times(columns: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Product of a 32 x 32 bit matrix (by columns) with bit vectors."""
    bits = (vectors[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
    return np.bitwise_xor.reduce(np.where(bits, columns[None, :], np.uint32(0)), axis=1)


class Featurizer:
    """Buckets of all n-grams of texts, slice by slice."""

    def __init__(self, buckets: int = BUCKETS, words: int = WORDS):
        self.buckets, self.n, self.crc = buckets, words, _Crc()
        self.space = np.uint32(zlib.crc32(b" "))

    def _grams(self, crc: np.ndarray, size: np.ndarray, owner: np.ndarray, held: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(owner, bucket) of all n-grams of one text each, the ones that end in the first ``held`` words left out."""
        gram = crc
        for n in range(1, self.n + 1):
            if n > 1:  # longer by the word after it
                a, b = gram[:-1], crc[n - 1:]
                one = self.crc.joined(a, np.full(len(a), self.space), np.ones(len(a), dtype=np.int64))
                gram = self.crc.joined(one, b, size[n - 1:])
            if not len(gram):
                return
            own = owner[:len(gram)] == owner[n - 1:]
            own[:max(0, held - n + 1)] = False
            yield owner[n - 1:][own], (gram[own] % np.uint32(self.buckets)).astype(np.int64)

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, sizes and checksums of a lower-cased slice's words: the one regular-expression pass."""
        spans = np.array([m.span() for m in _WORD.finditer(data)], dtype=np.int64).reshape(-1, 2)
        starts, size = spans[:, 0], spans[:, 1] - spans[:, 0]
        return starts, size, self.crc.words(np.frombuffer(data, dtype=np.uint8), starts, size)

    def together(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(words of each text, (owner, bucket) arrays) of a slice of texts, joined with sentinels."""
        data = SENTINEL.join(texts).translate(_LOWER)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        starts, size, crc = self._words(data)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        return np.bincount(owner, minlength=len(texts)), list(self._grams(crc, size, owner))

    def alone(self, text: bytes) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
        """(words, (owner 0, bucket) arrays) of one long text, piece by piece."""
        crc, size = np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        raw, lo = np.frombuffer(text, dtype=np.uint8), 0
        while lo < len(text):
            hi, seen = min(lo + PIECE, len(text)), lo
            while hi < len(text):  # back to the last separator, or on if one word fills the piece
                cut = np.flatnonzero(_BREAKS[raw[seen:hi]])
                if len(cut):
                    hi = seen + int(cut[-1]) + 1
                    break
                seen, hi = hi, min(hi + PIECE, len(text))
            _, s, c = self._words(text[lo:hi].translate(_LOWER))
            keep = min(len(crc), self.n - 1)
            crc, size = np.concatenate((crc[len(crc) - keep:], c)), np.concatenate((size[len(size) - keep:], s))
            yield len(s), list(self._grams(crc, size, np.zeros(len(crc), dtype=np.int64), keep))
            lo = hi

    def slices(self, column: pa.Array) -> Iterator[tuple[int, int, Iterator]]:
        """(first row, row after the last, [(words, grams), ..]) over a string column; nulls are empty."""
        for lo, hi in byte_slices(column, PIECE):
            texts = [(t.as_py() or "").encode() for t in column.slice(lo, hi - lo)]
            if hi - lo == 1 and len(texts[0]) > PIECE:
                yield lo, hi, ((np.array([n]), grams) for n, grams in self.alone(texts[0]))
            else:
                yield lo, hi, iter([self.together(texts)])


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, words: int = WORDS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, total = Featurizer(buckets, words), np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, _, parts in made.slices(b.column(0)):
                for _, grams in parts:
                    for _, bucket in grams:
                        total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    one = texts.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    return one.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """A bucket's gain from the counts of corpus and target (``buckets`` rows each at most)."""
    both = []
    for counts in (corpus, target):
        n = np.zeros(buckets, dtype=np.int64)
        for r in counts.collect():
            n[r.bucket] = r.n
        both.append([int(x) for x in n])
    s, t = both
    a, b = sum(s) + buckets, sum(t) + buckets
    return [math.floor(SCALE * math.log((float(y + 1) * float(a)) / (float(x + 1) * float(b)))) for x, y in zip(s, t)]


def text_hashes(text: Column) -> tuple[Column, Column]:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return F.xxhash64(whole), F.xxhash64(F.lit("second"), whole)


def weights(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, t1, t2, n_words, n_features, weight) of every row; t1 and t2 name its text."""
    of = np.array(gain, dtype=np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Featurizer(len(of), words)
        for b in batches:
            n, k, total = (np.zeros(len(b), dtype=np.int64) for _ in range(3))
            for lo, hi, parts in made.slices(b.column("text")):
                for found, grams in parts:
                    n[lo:hi] += found
                    for owner, bucket in grams:
                        k[lo:hi] += np.bincount(owner, minlength=hi - lo)
                        total[lo:hi] += np.bincount(owner, of[bucket], hi - lo).astype(np.int64)  # whole numbers below 2^53
            mean = np.floor_divide(total, np.maximum(k, 1))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "t1", "t2")), pa.array(n), pa.array(k), pa.array(mean)],
                                             names=["id", "t1", "t2", "n_words", "n_features", "weight"])

    t1, t2 = text_hashes(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(weigh, WEIGHTS.replace("id long", f"id {rows.schema['id'].dataType.simpleString()}"))


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise from the first 32 bits of sha256(``seed:id``), scaled and floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(F.lit(-SCALE) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranks(weighed: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``weighed`` rows with (score, rank): 1, 2, 3.. over the floor(percent * N / 100)
    highest scores of the N rows with at least ``min_words`` words, else null."""
    cols = weighed.columns
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    able = F.col("n_words") >= min_words
    alike = scored.groupBy(*cols, "score").agg(F.count("*").alias("copies"))
    # at most as many rows as there are scores: a bounded range of integers
    hist = scored.filter(able).groupBy("score").agg(F.count("*").alias("n"))
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hist = hist.select(F.col("score").alias("s"), above.alias("above"), F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).alias("drawn"))
    near = alike.join(F.broadcast(hist.filter(F.col("above") < F.col("drawn"))), able & (F.col("score") == F.col("s")), "left")
    order = Window.partitionBy("s", F.when(F.col("s").isNull(), F.xxhash64(*cols))).orderBy(F.col("id").asc_nulls_last(), "n_features", "weight", "n_words", "t1", "t2")
    first = F.col("above") + F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    placed = near.withColumn("first", F.when(F.col("s").isNotNull(), first))
    # equal rows are dealt out again in blocks, so no array holds more than a block of them
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK)))
    dealt = placed.withColumn("block", block)
    in_block = F.sequence(F.col("block") * BLOCK + 1, F.least(F.col("copies"), (F.col("block") + 1) * BLOCK))
    each = dealt.withColumn("nth", F.explode(in_block)).withColumn("rank", F.col("first") + F.col("nth"))
    return each.select(*cols, "score", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")).cast("long").alias("rank"))


def ranked(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
           min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS, words: int = WORDS) -> DataFrame:
    """(id, t1, t2, n_words, n_features, weight, score, rank) of every document."""
    gain = gains(bucket_counts(docs, text_col, buckets, words), bucket_counts(target, text_col, buckets, words), buckets)
    weighed = written(weights(docs, gain, id_col, text_col, words), f"{run_folder(docs.sparkSession, 'resample')}/weights")
    return ranks(weighed, percent, min_words, seed)


def drawn(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, text) was drawn; of equal rows as many as were drawn."""
    t1, t2 = text_hashes(F.col(f"c{docs.columns.index(text_col)}"))
    own = F.col(f"c{docs.columns.index(id_col)}")
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).withColumns({"own1": t1, "own2": t2})
    some = found.filter(F.col("rank").isNotNull()).groupBy("id", "t1", "t2").agg(F.count("*").alias("wanted"))
    all_of = found.groupBy("id", "t1", "t2").agg(F.count("*").alias("there"))
    some = some.join(all_of, some["id"].eqNullSafe(all_of["id"]) & (some["t1"] == all_of["t1"]) & (some["t2"] == all_of["t2"])).select(
        some["id"], some["t1"], some["t2"], "wanted", "there")
    near = rows.join(some, own.eqNullSafe(F.col("id")) & (F.col("own1") == F.col("t1")) & (F.col("own2") == F.col("t2")))
    whole = near.filter(F.col("wanted") == F.col("there"))
    # only the one group of equal rows that the cut goes through needs counting
    part = near.filter(F.col("wanted") < F.col("there")).withColumn("nth", F.row_number().over(Window.partitionBy("id", "t1", "t2").orderBy("id")))
    both = whole.withColumn("nth", F.lit(0)).unionByName(part.filter(F.col("nth") <= F.col("wanted")))
    return both.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


# CRC-32 by its table of 256 entries, made by the rule; then bucket sums, gains and ranks.
ORACLE = f"""
WITH crc AS (
  SELECT list(list_reduce([CAST(b AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) AS r(b)),
texts AS (
  SELECT row_number() OVER () AS k, doc_id, "text" AS txt, true AS corpus FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, "text", false FROM benchmark),
w AS (SELECT k, corpus, regexp_extract_all(translate(coalesce(txt, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM texts),
f AS (SELECT k, corpus, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g FROM w),
fc AS (SELECT k, corpus, g, count(*) AS n FROM f GROUP BY ALL),
g AS (SELECT g, xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], list_transform(range(0, CAST(len(hex(encode(g))) / 2 AS BIGINT)),
                lambda i: CAST('0x' || substr(hex(encode(g)), 2 * i + 1, 2) AS UBIGINT))),
              lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % {BUCKETS} AS bucket
      FROM (SELECT DISTINCT g FROM fc), crc),
b AS (SELECT bucket, coalesce(sum(n) FILTER (corpus), 0) AS s, coalesce(sum(n) FILTER (NOT corpus), 0) AS t FROM fc JOIN g USING (g) GROUP BY bucket),
a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM b),
gain AS (SELECT bucket, CAST(floor({SCALE}::DOUBLE * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + {BUCKETS} AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain FROM b, a),
d AS (SELECT k, sum(n) AS n, sum(n * gain) AS total FROM fc JOIN g USING (g) JOIN gain USING (bucket) WHERE corpus GROUP BY k),
r AS (SELECT k, doc_id, len(ws) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(floor(total / n), 0) AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM texts JOIN w USING (k) LEFT JOIN d USING (k) WHERE texts.corpus),
s AS (SELECT *, weight + CAST(floor(-{SCALE}::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS nth,
             count(*) OVER (PARTITION BY n_words >= {MIN_WORDS}) AS able FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS} AND nth <= {PERCENT} * able // 100 THEN nth END AS rank FROM p
"""
