"""Byte-level BPE encoding and decoding with a pair-occurrence index.

The words of a batch that no earlier batch of the task has met are encoded
together: their bytes' symbols stand in one array, an index maps every merge
rank to all positions where its pair occurs, and the active ranks are applied
in ascending order.  A merge updates only the lists of the pairs beside it.
A merged symbol never takes part in a pair of a lower rank (a merge is learned
after its parts), so the ascending order gives each word's usual result.

Decoding maps ids back to their bytes and the bytes to text.

Defined results: null text counts as empty; the empty text has no tokens;
strings of added tokens in a text become those tokens, as the vocabulary file
asks; invalid UTF-8 from a foreign id sequence decodes to U+FFFD; an id
outside the vocabulary adds nothing.  A text may be of any length: a long word
is cut between two bytes that no token holds side by side, which no merge can
cross, and encoded in parts.  Only a long word without such a place (one letter
over and over) is held whole, with some 70 bytes of memory per byte.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the pre-tokenisation pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_CHUNKS = 400_000  # encoded chunks a task remembers; beyond it starts anew
CACHE_BYTES = 64 << 20  # of those chunks and their ids
LONG = 1 << 16  # bytes from which on a word is cut where no token reaches across
_ROUND = 60_000  # new chunks encoded together,
_ROUND_CHARS = 16 << 20  # of texts of so many characters,
_ROUND_BYTES = 1 << 20  # words of so many bytes at a time


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: the
    byte's own character where that is printable, else the next one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of a byte-level BPE vocabulary file (JSON form)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *self.added.values()]) + 1
        spelled: list[bytes] = [b""] * size
        for token, i in ids.items():
            spelled[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.added.items():
            spelled[i] = token.encode()
        self.of_byte = np.zeros(256, dtype=np.int64)
        for ch, b in letters.items():
            self.of_byte[b] = ids[ch]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.result = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        codes = self.left << 32 | self.right
        self.code_order = np.argsort(codes, kind="stable")
        self.codes = codes[self.code_order]
        self.size = np.array([len(s) for s in spelled], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.spelling = np.frombuffer(b"".join(spelled) or b"\0", dtype=np.uint8)
        self.joined = np.zeros(1 << 16, dtype=bool)  # byte pairs inside some token
        inner = np.ones(len(self.spelling), dtype=bool)
        inner[(self.start + self.size - 1)[self.size > 0]] = False
        at = np.flatnonzero(inner[:-1])
        self.joined[self.spelling[at].astype(np.int64) << 8 | self.spelling[at + 1]] = True
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True))) if self.added else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where the pair merges to nothing."""
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_order[at], -1) if len(self.codes) else np.full(len(code), -1)

    def parts(self, word: bytes, size: int = LONG) -> list[bytes]:
        """The word, cut into parts of at least ``size`` bytes between bytes that no token holds side by side."""
        out, data, begin, lo = [], np.frombuffer(word, dtype=np.uint8), 0, size
        while lo < len(word):
            hi = min(lo + size, len(word))
            free = np.flatnonzero(~self.joined[data[lo - 1:hi - 1].astype(np.int64) << 8 | data[lo:hi]])
            if len(free):
                cut = lo + int(free[0])
                out.append(word[begin:cut])
                begin, lo = cut, cut + size
            else:
                lo = hi
        return [*out, word[begin:]]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's ids end."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        sym = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(sym)
        if not n:
            return sym, np.zeros(len(words), dtype=np.int64)
        ends = np.cumsum(sizes)
        after = np.arange(1, n + 1)  # the next symbol's position in the word, or n
        after[ends[sizes > 0] - 1] = n
        before = np.arange(-1, n)  # one more place, which takes writes beyond a word's end
        before[(ends - sizes)[sizes > 0]] = -1
        after = np.append(after, n)
        sym = np.append(sym, -1)
        alive = np.ones(n + 1, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Add the pairs that begin at these positions to the index."""
            at = at[after[at] < n]
            rank = self.ranks(sym[at], sym[after[at]])
            good = rank >= 0
            at, rank = at[good], rank[good]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, group in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(group)

        enter(np.arange(n))
        while active:
            r = heapq.heappop(active)
            at = index.pop(r)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else np.sort(at[0])
            a, b = int(self.left[r]), int(self.right[r])
            at = at[alive[at] & (sym[at] == a)]
            at = at[sym[after[at]] == b]
            if a == b and len(at) > 1:  # runs of one symbol: from the left, without overlap
                chosen, last = [], -1
                for p, q in zip(at.tolist(), after[at].tolist()):
                    if p != last:
                        chosen.append(p)
                        last = q
                at = np.array(chosen)
            if not len(at):
                continue
            gone = after[at]
            sym[at] = self.result[r]
            alive[gone] = False
            after[at] = after[gone]
            before[after[at]] = at
            left = before[at]
            enter(np.unique(np.concatenate((left[left >= 0], at))))
        count = np.add.reduceat(np.append(alive[:n], False).astype(np.int64), np.minimum(ends - sizes, n)) * (sizes > 0)
        return sym[:n][alive[:n]], np.cumsum(count)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < len(self.size))]
        out = []
        for lo in range(0, len(ids), 1 << 18):
            part = ids[lo:lo + (1 << 18)]
            size = self.size[part]
            ends = np.cumsum(size)
            at = np.arange(int(ends[-1])) + np.repeat(self.start[part] - (ends - size), size)
            out.append(self.spelling[at].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class Encoder:
    """Encodes texts of one task; remembers the chunks it has met."""

    def __init__(self, vocabulary: Vocabulary, cache_chunks: int = CACHE_CHUNKS):
        self.v = vocabulary
        self.limit = cache_chunks
        self.held = 0
        self.known: dict[str, bytes] = {}
        self.find = regex.compile(PATTERN).findall
        self.runs = regex.compile(r"\s*\S+|\s+").findall
        self.odd = regex.compile(r"\s ").search

    def chunks(self, text: str) -> list[str]:
        """Parts of a text whose words are the text's words: cut before the
        white space that follows a non-space character."""
        if self.odd(text):
            return self.runs(text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + x for x in rest]

    def _learn(self, new: list[str]) -> None:
        words: dict[bytes, int] = {}
        spans = []
        for c in new:
            if len(c) * 4 <= LONG:
                spans.append([words.setdefault(w.encode("utf-8", "replace"), len(words)) for w in self.find(c)])
            else:
                spans.append([words.setdefault(p, len(words)) for w in self.find(c) for p in self.v.parts(w.encode("utf-8", "replace"))])
        coded: list[bytes] = []
        group: list[bytes] = []
        size = 0
        for i, w in enumerate(words, 1):
            group.append(w)
            size += len(w)
            if size >= _ROUND_BYTES or i == len(words):
                ids, ends = self.v.encode_words(group)
                raw, lo = ids.astype("<u4").tobytes(), 0
                for hi in (ends * 4).tolist():
                    coded.append(raw[lo:hi])
                    lo = hi
                group, size = [], 0
        for c, s in zip(new, spans):
            self.known[c] = ids = coded[s[0]] if len(s) == 1 else b"".join([coded[k] for k in s])
            self.held += len(c) + len(ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        lo = 0
        while lo < len(texts):
            # as many texts as bring about _ROUND new chunks
            split: list[list[str | int]] = []
            new: set[str] = set()
            if len(self.known) > self.limit or self.held > CACHE_BYTES:
                self.known.clear()
                self.held = 0
            chars = 0
            while lo < len(texts) and len(new) < _ROUND and chars < _ROUND_CHARS:
                parts: list[str | int] = []
                text, at = texts[lo] or "", 0
                chars += len(text)
                if self.v.special is not None:
                    for m in self.v.special.finditer(text):
                        parts += self.chunks(text[at:m.start()]) if m.start() > at else []
                        parts.append(self.v.added[m.group()])
                        at = m.end()
                parts += self.chunks(text[at:]) if at < len(text) else []
                split.append(parts)
                new.update(set(parts).difference(self.known))
                lo += 1
            self._learn([c for c in new if isinstance(c, str)])
            for c in new:
                if not isinstance(c, str):
                    self.known[c] = int(c).to_bytes(4, "little")
            known = self.known.__getitem__
            out += [b"".join(map(known, parts)) for parts in split]
        return out


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The file's tables, read once per Python process."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _per_text(docs: DataFrame, text_col: str, columns: tuple[str, ...], fields: list[T.StructField], make) -> DataFrame:
    source = docs.select(*[f"`{c}`" for c in columns], F.col(text_col).alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = make()
        for b in batches:
            for lo in range(0, len(b), 512):
                part = b.slice(lo, 512)
                arrays = run(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(part.num_columns - 1)), *arrays],
                                                 names=[*part.schema.names[:-1], *(f.name for f in fields)])

    return source.mapInArrow(work, T.StructType([*source.schema.fields[:-1], *fields]))


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with ``ids`` (binary: little-endian unsigned 32-bit) of every whole text."""
    def make():
        encoder = Encoder(vocabulary(vocabulary_path))
        return lambda texts: [pa.array(encoder.encode(texts.to_pylist()), pa.binary())]

    return _per_text(docs, text_col, columns, [T.StructField("ids", T.BinaryType())], make)


def decode(encoded: DataFrame, vocabulary_path: str, ids_col: str = "ids", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with the ``text`` of every id sequence."""
    def make():
        v = vocabulary(vocabulary_path)
        return lambda ids: [pa.array([v.decode(np.frombuffer(x or b"", dtype="<u4").astype(np.int64)) for x in ids.to_pylist()], pa.string())]

    return _per_text(encoded, ids_col, columns, [T.StructField("text", T.StringType())], make)


def round_trip_digests(docs: DataFrame, vocabulary_path: str, text_col: str = "text",
                       columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with n_tokens, ids_sha256 and decoded_sha256: encode, decode and digest in one pass."""
    def make():
        v = vocabulary(vocabulary_path)
        encoder = Encoder(v)

        def run(texts: pa.Array) -> list[pa.Array]:
            n, ids_sha, text_sha = [], [], []
            for raw in encoder.encode(texts.to_pylist()):
                ids = np.frombuffer(raw, dtype="<u4").astype(np.int64)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(v.decode(ids).encode("utf-8")).hexdigest())
            return [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]

        return run

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _per_text(docs, text_col, columns, fields, make)
