"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickforge.session import checkpoint_dir
from tickforge.sources.tables import read_table

__all__ = ["read_table", "run_folder", "written", "numbered", "byte_slices", "distinct", "WordHasher", "mix", "SPACES"]

MOST_TEXTS = 4096  # hashed together
# The white space of the word pattern [^\x20\x09-\x0D]+.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this run below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files that every
    executor sees, never a recomputation of the Python stages above.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named c0, c1, .. (no other name can clash with them), and the new name of each."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def byte_slices(col: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about ``limit`` bytes each (a longer
    single text makes a range of its own), which bounds the numpy temporaries."""
    n = len(col)
    if n == 0:
        return
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift, odd multiplications)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: faster on these sizes than a hash table)."""
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


class WordHasher:
    """64-bit hashes of all words of texts, vectorised over their bytes.

    A word is a run of bytes outside the separator set.  The hash is a
    polynomial over the word's bytes; equal words have equal hashes in every
    task.  Small texts are hashed together, longer ones piece by piece, cut at
    separators, so temporaries stay bounded however long a text is.
    """

    def __init__(self, extra_separators: bytes = b"", lower: bool = True, piece: int = 1 << 18):
        self.value = np.arange(1, 257, dtype=np.uint64)
        if lower:
            self.value[0x41:0x5B] += np.uint64(0x20)
        self.value[[*SPACES, *extra_separators]] = 0
        self.inside = self.value > 0
        self.piece = piece
        self._powers = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> np.ndarray:
        if len(self._powers) < n:
            p = np.full(max(256, 1 << (n - 1).bit_length()), 0x9E3779B97F4A7C15, dtype=np.uint64)
            p[0] = 1
            self._powers = np.multiply.accumulate(p)
        return self._powers

    def groups(self, texts: list[bytes | None], prefix: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None, np.ndarray]]:
        """(first text, text after the last, word hashes of these texts in a row,
        hashes of the words' first ``prefix`` bytes if asked for, where each text's words end)."""
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and hi - lo < MOST_TEXTS and (hi == lo or size + len(texts[hi] or b"") <= self.piece):
                size += len(texts[hi] or b"") + 1
                hi += 1
            if size > 2 * self.piece:  # one long text
                parts = [self._hash(x, prefix) for x in self._pieces(np.frombuffer(texts[lo], dtype=np.uint8))]
                h = np.concatenate([p[1] for p in parts])
                yield lo, hi, h, np.concatenate([p[2] for p in parts]) if prefix else None, np.array([len(h)])
            else:
                part = [t or b"" for t in texts[lo:hi]]
                starts, h, begin = self._hash(np.frombuffer(b" ".join(part), dtype=np.uint8), prefix)
                yield lo, hi, h, begin, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in part]))
            lo = hi

    def hashes(self, text: bytes) -> np.ndarray:
        """Hashes of one text's words, in order."""
        return next(self.groups([text]))[2]

    def _pieces(self, data: np.ndarray) -> Iterator[np.ndarray]:
        lo = 0
        while lo < len(data):
            hi = min(lo + self.piece, len(data))
            while hi < len(data):  # back to a separator, or on if one word fills the piece
                cut = np.flatnonzero(~self.inside[data[lo:hi]])
                if len(cut):
                    hi = lo + int(cut[-1]) + 1
                    break
                hi = min(hi + self.piece, len(data))
            yield data[lo:hi]
            lo = hi

    def _hash(self, data: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        inside = self.inside[data]
        before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
        starts = np.flatnonzero(inside & ~before)
        if not len(starts):
            none = np.empty(0, dtype=np.uint64)
            return starts, none, none if prefix else None
        ends = np.flatnonzero(before & ~inside)
        size = (ends if len(ends) == len(starts) else np.append(ends, len(data))) - starts
        longest, first = int(size.max()), starts[0]
        place = np.arange(first, len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
        np.minimum(place, longest, out=place)  # separators count nothing, wherever they are
        term = self.value[data[first:]] * self.powers(longest + 1)[place]
        h = mix(np.add.reduceat(term, starts - first) + size.astype(np.uint64))
        if not prefix:
            return starts, h, None
        term[place >= prefix] = 0
        return starts, h, mix(np.add.reduceat(term, starts - first) + np.minimum(size, prefix).astype(np.uint64))
