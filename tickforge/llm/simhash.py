"""SimHash near-duplicates by a binary-trie self-join.

Every text gets a 64-bit fingerprint (majority vote over the XXH64 hashes of
its word shingles).  Distinct fingerprints are joined with themselves under a
Hamming budget: the sorted fingerprints of a cell are an implicit binary trie
(a node is a range that shares a bit prefix), node pairs are walked together
from the root, differing bits add up, and a pair of nodes is dropped as soon
as the sum exceeds the budget.

Distribution.  The 64 bits are cut into ``max_bits + 2`` blocks.  Two
fingerprints within the budget agree on at least two whole blocks, so each
distinct fingerprint goes to one cell per pair of blocks and no link is lost.
A cell is one trie; cells with more than ``cell_rows`` fingerprints are cut
into chunks and every pair of chunks becomes a task of its own.  Copies are
collapsed before the join (partial aggregation), so a text that makes up a
third of the corpus is one trie leaf.  Cells emit spanning-forest edges, never
all pairs; the components come from alternating star contractions on Spark.

Defined results: null text counts as a text without words; texts without
words have fingerprint zero and are linked like any other; null doc_ids are
fingerprinted and never chosen as a component id (a component of null ids only
has a null id); repeated rows give repeated results; an empty table gives an
empty result; further columns are ignored by ``near_duplicates`` and kept by
``keep_one_per_group``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import numbered, run_folder, written

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
CELL_ROWS = 4096
_BLOCK = 65_280  # shingles counted at once: 256 * 255


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: folds A-Z, splits at ASCII white space
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n < shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = list(accumulate((len(w) + 1 for w in words)))
        starts = [0, *ends]
        digest = xxhash.xxh64_intdigest
        m = n - shingle_words + 1
        hashes = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle_words - 1:])),
                             dtype=np.uint64, count=m)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[lo:lo + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:  # sums of 255 bits fit in a byte
            ones += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += np.add.reduce(bits[whole:], axis=0, dtype=np.uint8)
    major = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(major, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document row; ``fp`` as a signed long."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                         F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), dtype=np.uint64, count=len(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    return narrow.mapInArrow(work, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


# --- the trie join within a task -------------------------------------------------------------------------------


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the classes of a[i] and b[i]; labels[i] is the least member's position."""
    while len(a):
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:  # pointer jumping
            nxt = labels[labels]
            if np.array_equal(nxt, labels):
                break
            labels = nxt
    return labels


def _run_ends(labels: np.ndarray) -> np.ndarray:
    """For every position the end of its run of equal labels."""
    cuts = np.flatnonzero(labels[1:] != labels[:-1]) + 1
    return np.append(cuts, len(labels))[np.searchsorted(cuts, np.arange(len(labels)), side="right")]


def trie_links(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, budget: int,
               wave: int = 1 << 13) -> np.ndarray:
    """Class labels of sorted fingerprints under links of at most ``budget``
    differing bits, joined within each range [starts, ends) (one trie each).

    Depth-first over waves of node pairs: a wave holds (lo1, hi1, lo2, hi2,
    differing bits) at one depth and is cut beyond ``wave`` pairs, so memory
    stays bounded in dense tries.  Node pairs whose fingerprints are all in one
    class already are dropped: no link between them can change a class.
    """
    labels = np.arange(len(fps), dtype=np.int64)
    big = ends - starts > 1
    s, e = starts[big].astype(np.int32), ends[big].astype(np.int32)
    stack = [(63, s, e, s, e, np.zeros(len(s), dtype=np.int8))]
    ones: dict[int, np.ndarray] = {}

    def count_ones(bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1)))).astype(np.int32)
        return ones[bit]

    while stack:
        bit, l1, h1, l2, h2, d = stack.pop()
        if not len(l1):
            continue
        if len(l1) > wave:
            for lo in range(0, len(l1), wave):
                cut = slice(lo, lo + wave)
                stack.append((bit, l1[cut], h1[cut], l2[cut], h2[cut], d[cut]))
            continue
        leaf = (h1 - l1 == 1) & (h2 - l2 == 1)
        if leaf.any():  # two leaves: the rest of the path at once
            a, b = l1[leaf], l2[leaf]
            near = np.bitwise_count(fps[a] ^ fps[b]) <= budget
            labels = _merge(labels, a[near], b[near])
            rest = ~leaf
            l1, h1, l2, h2, d = l1[rest], h1[rest], l2[rest], h2[rest], d[rest]
        if len(l1) > wave // 4:  # a dense trie
            run = _run_ends(labels)
            rest = ~((labels[l1] == labels[l2]) & (run[l1] >= h1) & (run[l2] >= h2))
            l1, h1, l2, h2, d = l1[rest], h1[rest], l2[rest], h2[rest], d[rest]
        if bit < 0 or not len(l1):
            continue
        c = count_ones(bit)
        m1, m2 = h1 - (c[h1] - c[l1]), h2 - (c[h2] - c[l2])
        own = (l1 == l2) & (h1 == h2)
        # children with equal bits keep the sum, children with unlike bits add one; of a node with itself one unlike pair is enough
        parts = [(l1, m1, l2, m2, d), (m1, h1, m2, h2, d), (l1, m1, m2, h2, d + 1),
                 tuple(x[~own] for x in (m1, h1, l2, m2, d + 1))]
        n1, n2, n3, n4, nd = (np.concatenate([p[i] for p in parts]) for i in range(5))
        keep = (n2 > n1) & (n4 > n3) & (nd <= budget) & ~((n1 == n3) & (n2 - n1 == 1) & (n4 - n3 == 1))
        stack.append((bit - 1, n1[keep], n2[keep], n3[keep], n4[keep], nd[keep]))
    return labels


def _cells(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, key, a, b, fp) -> spanning edges (u, v), u > v, of every cell's classes."""
    held: list[np.ndarray] = []

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((rows[:, 4].view(np.uint64), rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))
        rows = rows[order]
        new = np.concatenate(([True], (rows[1:, :4] != rows[:-1, :4]).any(axis=1)))
        starts = np.flatnonzero(new)
        ends = np.concatenate((starts[1:], [len(rows)]))
        fps = rows[:, 4].copy().view(np.uint64)
        labels = trie_links(fps, starts, ends, budget)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        u, v = rows[linked, 4], rows[labels[linked], 4]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    size = 0
    for b in batches:
        if not len(b):
            continue
        held.append(np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]))
        size += len(b)
        if size >= 100_000:
            rows = np.concatenate(held)
            last = (rows[:, :4] == rows[-1, :4]).all(axis=1)
            cut = len(rows) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield edges(rows[:cut])
            held, size = [rows[cut:]], len(rows) - cut
    if held and size:
        yield edges(np.concatenate(held))


def block_masks(budget: int) -> list[int]:
    """Masks of all pairs of the ``budget + 2`` blocks of the 64 bits."""
    blocks = budget + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(masks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(distinct_fps: DataFrame, budget: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose closure is the closure
    of all links of at most ``budget`` differing bits."""
    keyed = distinct_fps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in block_masks(budget)])).alias("cell", "key"))
    hot = (keyed.groupBy("cell", "key").agg(F.count("*").alias("n")).filter(F.col("n") > cell_rows)
           .select("cell", "key", F.ceil(F.col("n") / cell_rows).cast("int").alias("chunks")))
    # a chunk meets every chunk: (least, greatest) names the task of a pair
    cut = (keyed.join(hot, ["cell", "key"], "left")
           .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
           .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks").cast("long")).cast("int"))
           .select("cell", "key", "own", "fp", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
           .select("cell", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp"))
    dealt = cut.repartition("cell", "key", "a", "b").sortWithinPartitions("cell", "key", "a", "b", "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cells(batches, budget)

    return dealt.mapInArrow(work, "u long, v long").distinct()


# --- components ------------------------------------------------------------------------------------------------


def components(edges: DataFrame, folder: str, max_rounds: int = 100) -> DataFrame:
    """(u, root): the least member of the component of every node that has an
    edge and is not itself the least (alternating large-star and small-star).

    Each round is written to the shared folder; nothing is collected but two
    numbers that tell whether the edges changed.
    """
    state = None
    cur = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                  f"{folder}/star0")
    for i in range(1, max_rounds + 1):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        cur = written(small, f"{folder}/star{i}")
        now = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == (now["n"], now["s"]):
            return cur.select("u", F.col("v").alias("root"))
        state = (now["n"], now["s"])
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per document row.

    ``root`` is the component's least fingerprint, ``component_id`` the least
    non-null doc_id among the documents reachable over links.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "simhash")
    table = written(fingerprints(docs, id_col, text_col, shingle_words), f"{folder}/fingerprints")
    classes = written(table.groupBy("fp").agg(F.min("doc_id").alias("first_id")), f"{folder}/classes")
    roots = components(links(classes.select("fp"), max_bits), folder)
    labelled = (classes.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
                .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    of_root = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = labelled.select("fp", "root").join(of_root, "root")
    return table.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex_fingerprint(col):
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with one row left of each component: the one with the
    least doc_id (null ids last), ties by the least text hash."""
    found = near_duplicates(docs, id_col, text_col, shingle_words, max_bits)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k"))
    kept = best.select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash"))
    plain, name = numbered(docs)
    own, text = F.col(name[id_col]), F.col(name[text_col])
    joined = plain.withColumn("own_hash", F.xxhash64(text)).join(kept, own.eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash")))
    return joined.dropDuplicates([name[id_col], "own_hash"]).select(*[F.col(name[c]).alias(c) for c in docs.columns])
