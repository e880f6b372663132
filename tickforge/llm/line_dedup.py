"""Line dedup over a whole corpus (DataFrame functions only).

Texts are split at newlines and exploded; a line's key is the line stripped of
white space at both ends with A-Z lower-cased.  Keys of at least ``min_chars``
code points are hashed to 128 bits, the distinct documents of each hash are
counted, and the lines of a hash found in ``min_docs`` documents or more are
dropped everywhere but in the document with the smallest id.  What stays is
put together again by position.

Shuffles.  Only hashes travel until the end.  The distinct count is Spark's
two-step one: partial sums per (hash, document), dealt by both, so a line that
a third of all rows hold is spread before its hash gathers one row per task.
The repeated hashes (one row each) and the dropped positions are written to the
shared folder.  Both later joins so read plain exchanges on both sides, whose
large partitions the adaptive plan splits, and a lost executor costs a re-read.
A text travels once, with the positions that it loses.

Defined results: a null or empty text is one empty line; a null id is a document
of its own (all rows with it together), after all others in order; rows of one
id are one document, so lines they share are not repeated by that, and in the
first document all its lines stay; repeated rows each get their row; an empty
table gives an empty result; columns of any name are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import SPACES, run_folder, written

MIN_CHARS = 10
MIN_DOCS = 2
# The letters that a key lower-cases.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRIPPED = "".join(map(chr, SPACES))


def _hashes(what: Column) -> tuple[Column, Column]:
    return F.xxhash64(what), F.xxhash64(F.lit("second"), what)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t1, t2, lines): a row's id, the hashes that name its text, its lines."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    t1, t2 = _hashes(text)
    return docs.select(F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2"), F.split(text, "\n", -1).alias("lines"))


def _keyed(rows: DataFrame, columns: list[str], min_chars: int) -> DataFrame:
    """``columns`` and (pos, h1, h2) of every line whose key is long enough."""
    lines = rows.select(*columns, F.posexplode("lines").alias("pos", "line"))
    # lower-casing keeps the length, so short lines go before it
    long = lines.withColumn("bare", F.btrim("line", F.lit(STRIPPED))).filter(F.char_length("bare") >= min_chars)
    h1, h2 = _hashes(F.translate("bare", UPPER, LOWER))
    return long.select(*columns, "pos", h1.alias("h1"), h2.alias("h2"))


def repeated(rows: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, first): the keys found in at least ``min_docs`` documents, with the smallest id."""
    found = _keyed(rows, ["id"], min_chars).groupBy("h1", "h2").agg(F.count_distinct(F.struct("id")).alias("n_docs"), F.min("id").alias("first"))
    return found.filter(F.col("n_docs") >= min_docs).select("h1", "h2", "first")


def dropped(rows: DataFrame, over: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, t1, t2, gone): the 0-based positions that a text of a document loses."""
    lines = _keyed(rows, ["id", "t1", "t2"], min_chars).join(over, ["h1", "h2"])
    return lines.filter(~F.col("id").eqNullSafe(F.col("first"))).groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("gone"))


def _joined(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> tuple[DataFrame, Column, Column, Column]:
    """The rows as columns c0, c1, .. beside the positions they lose, and (lines, number of dropped, kept text)."""
    folder = run_folder(docs.sparkSession, "line-dedup")
    rows = _rows(docs, id_col, text_col)
    over = written(repeated(rows, min_chars, min_docs), f"{folder}/repeated")
    gone = written(dropped(rows, over, min_chars), f"{folder}/dropped")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = F.coalesce(F.col(f"c{docs.columns.index(text_col)}").cast("string"), F.lit(""))
    t1, t2 = _hashes(text)
    plain = plain.withColumns({"own1": t1, "own2": t2})
    same = (F.col("own1") == F.col("t1")) & (F.col("own2") == F.col("t2")) & F.col(f"c{docs.columns.index(id_col)}").eqNullSafe(F.col("id"))
    lines = F.split(text, "\n", -1)
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")))
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n"))
    return plain.join(gone, same, "left"), lines, F.coalesce(F.size("gone"), F.lit(0)), kept


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, n_lines, n_dropped, kept) of every row: lines before dropping, dropped ones, the text that stays."""
    joined, lines, n, kept = _joined(docs, id_col, text_col, min_chars, min_docs)
    return joined.select(F.col(f"c{docs.columns.index(id_col)}").alias(id_col), F.size(lines).cast("long").alias("n_lines"),
                         n.cast("long").alias("n_dropped"), kept.alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All rows and columns, the text without its repeated lines (a null text stays null)."""
    joined, _, _, kept = _joined(docs, id_col, text_col, min_chars, min_docs)
    own = docs.columns.index(text_col)
    return joined.select(*[(F.when(F.col("gone").isNull(), F.col(f"c{i}").cast("string")).otherwise(kept) if i == own else F.col(f"c{i}")).alias(c)
                           for i, c in enumerate(docs.columns)])


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce("text", ''), chr(10)) AS parts FROM documents),
l AS (SELECT k, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM d),
c AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS first FROM c WHERE length(key) >= {MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'none')) >= {MIN_DOCS}),
m AS (SELECT c.*, o.key IS NOT NULL AND c.doc_id IS DISTINCT FROM o.first AS gone FROM c LEFT JOIN o ON c.key = o.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY k
"""
