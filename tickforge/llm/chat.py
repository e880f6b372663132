"""Chat formatting with cumulative-snapshot collapse (DataFrame functions only).

Logs often hold a conversation once per turn, each snapshot a prefix of the
next.  Every turn has the MD5 of its number, role and text (128 bits); the XOR
of the turns up to k is the rolling prefix hash.  A conversation whose whole
hash is another's prefix hash at the same length is dropped by an anti-join;
of equal conversations the one with the least id stays.  What remains is
rendered with a chat template, in parts of ``PART_TURNS`` turns by their place
in the conversation.

The running XOR is taken in three levels: over a conversation's blocks of
``BLOCK_TURNS`` turn numbers, over a block's cells (a turn number and the first
three digits of the hash), and over the texts of a cell.  So no task needs a
whole conversation, however long it is and however many texts share one turn
number (null turns, or all rows with a null conversation id); a rendered part
gathers ``PART_TURNS`` texts at most.  Prefix hashes are written once to the
shared folder and made distinct by partial aggregation before they are joined:
a first turn shared by a third of all conversations is one row per map task.

Defined results: a null role is rendered as ``unknown``, a null text as empty,
a null turn number comes before all others; repeated rows count once; several
texts of one turn number are ordered by their hashes (the SQL twin takes the
same MD5); turn numbers count, so a log whose turns are numbered from another
start is another conversation; rows with a null conversation id make one
conversation of their own; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import run_folder, written

BLOCK_TURNS = 1024
PART_TURNS = 1024
# The turn marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

_ID = "conv_id"
_KEYS = [_ID, "block", "cell"]


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns with their hash as two numbers, their block (by turn number) and cell (by turn number and hash)."""
    plain = conversations.select(
        F.col(id_col).alias(_ID), F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    hashed = plain.withColumn("hash", F.md5(F.concat(F.col("turn").cast("string"), F.lit(":"), "role", F.lit("\n"), "text").cast("binary")))
    half = [F.conv(F.substring("hash", at, 16), 16, -10).cast("long") for at in (1, 17)]
    return (hashed.withColumn("h1", half[0]).withColumn("h2", half[1])
            .withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS).cast("long"))
            .withColumn("cell", F.struct("turn", F.substring("hash", 1, 3).alias("begin"))).drop("hash"))


def _unsigned(h: str) -> Column:
    """Sort key of a signed long in the order of its hexadecimal digits."""
    return F.col(h).bitwiseXOR(F.lit(-(1 << 63)))


def _distinct_hashes(t: DataFrame) -> DataFrame:
    """(conv_id, block, cell, h1, h2) once each."""
    return t.groupBy(*_KEYS, "h1", "h2").agg(F.lit(1).alias("one")).drop("one")


def _bases(sums: DataFrame, keys: list[str]) -> DataFrame:
    """(s_ of ``keys``, n_before, before1, before2, n_all): turns and XORs before each
    group of ``sums`` (keys, n, b1, b2) in its conversation, and the turns of all."""
    outer, zero = keys[:-1], F.lit(0).cast("long")
    earlier = Window.partitionBy(*outer).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    n, x1, x2 = (F.coalesce(f(c).over(earlier), zero) for f, c in ((F.sum, "n"), (F.bit_xor, "b1"), (F.bit_xor, "b2")))
    own = [F.col(k).alias(f"s_{k}") for k in keys]
    if len(outer) == 1:
        later = Window.partitionBy(*outer).orderBy(F.desc(keys[-1])).rowsBetween(Window.unboundedPreceding, 0)
        return sums.select(*own, n.alias("n_before"), x1.alias("before1"), x2.alias("before2"), (n + F.sum("n").over(later)).alias("n_all"))
    above = _bases(sums.groupBy(*outer).agg(F.sum("n").alias("n"), F.bit_xor("b1").alias("b1"), F.bit_xor("b2").alias("b2")), outer)
    here = sums.select(*keys, n.alias("n"), x1.alias("x1"), x2.alias("x2"))
    return here.join(above, _same(outer)).select(*own, (F.col("n_before") + F.col("n")).alias("n_before"), F.col("before1").bitwiseXOR(F.col("x1")).alias("before1"),
                                                 F.col("before2").bitwiseXOR(F.col("x2")).alias("before2"), "n_all")


def _same(keys: list[str]) -> Column:
    """Join condition of ``keys`` and their ``s_`` twins; only the conversation may be null."""
    on = F.col(_ID).eqNullSafe(F.col(f"s_{_ID}"))
    for k in keys[1:]:
        on = on & (F.col(k) == F.col(f"s_{k}"))
    return on


def prefixes(t: DataFrame) -> DataFrame:
    """(conv_id, n, h1, h2, p1, p2, last): the rolling hash after each of a conversation's n-th turns."""
    one = _distinct_hashes(t)
    within = Window.partitionBy(*_KEYS).orderBy(_unsigned("h1"), _unsigned("h2")).rowsBetween(Window.unboundedPreceding, 0)
    local = one.select(*_KEYS, "h1", "h2", F.count("*").over(within).alias("n_in"), F.bit_xor("h1").over(within).alias("x1"), F.bit_xor("h2").over(within).alias("x2"))
    sums = one.groupBy(*_KEYS).agg(F.count("*").alias("n"), F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    joined = local.join(_bases(sums, _KEYS), _same(_KEYS))
    return joined.select(_ID, (F.col("n_before") + F.col("n_in")).alias("n"), "h1", "h2", F.col("before1").bitwiseXOR(F.col("x1")).alias("p1"),
                         F.col("before2").bitwiseXOR(F.col("x2")).alias("p2"), (F.col("n_before") + F.col("n_in") == F.col("n_all")).alias("last"))


def maximal(p: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): the conversations that prefix no longer one, one of equal ones."""
    whole = p.filter("last").groupBy("n", "p1", "p2").agg(F.min(F.struct(F.col(_ID).isNull().alias("none"), _ID)).alias("first"), F.count("*").alias("n_copies"))
    inner = p.filter(~F.col("last")).select("n", "p1", "p2").distinct()
    return whole.join(inner, ["n", "p1", "p2"], "left_anti").select(F.col(f"first.{_ID}").alias(_ID), F.col("n").alias("n_turns"), "n_copies")


def formatted(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, n_turns, n_copies, rendered) of the maximal conversations; parts count from 0."""
    t = turns(conversations, id_col, turn_col, role_col, text_col)
    p = written(prefixes(t), f"{run_folder(conversations.sparkSession, 'chat')}/prefixes")
    kept = maximal(p).withColumnRenamed(_ID, "k_id")
    places = (p.select(F.col(_ID).alias("p_id"), "n", F.col("h1").alias("g1"), F.col("h2").alias("g2"))
              .join(kept, F.col("p_id").eqNullSafe(F.col("k_id"))).drop("k_id"))
    rows = t.select(_ID, "h1", "h2", "role", "text").join(places, F.col(_ID).eqNullSafe(F.col("p_id")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    part = F.floor((F.col("n") - 1) / PART_TURNS).cast("long").alias("part")
    parts = rows.groupBy(_ID, part).agg(F.sort_array(F.collect_set(F.struct("n", "role", "text"))).alias("said"),
                                        F.min("n_turns").alias("n_turns"), F.min("n_copies").alias("n_copies"))
    marked = F.transform("said", lambda s: F.concat(F.lit(OPEN), s["role"], F.lit("\n"), s["text"], F.lit(CLOSE)))
    return parts.select(_ID, "part", "n_turns", "n_copies", F.array_join(marked, "").alias("rendered"))


ORACLE = f"""
WITH d AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce("text", '') AS txt FROM conversations),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, md5(turn || ':' || role || chr(10) || txt)) AS nth FROM d),
c AS (SELECT conv_id, list((turn, role, txt) ORDER BY nth) AS said, count(*) AS n FROM t GROUP BY conv_id),
u AS (SELECT said, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY said, n),
k AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM u AS b WHERE b.n > u.n AND b.said[1] = u.said[1] AND b.said[1:u.n] = u.said))
SELECT t.conv_id, CAST(floor((nth - 1) / {PART_TURNS}.0) AS BIGINT) AS part, any_value(k.n) AS n_turns, any_value(k.n_copies) AS n_copies,
       string_agg('{OPEN}' || role || chr(10) || txt || '<|im_end|>' || chr(10), '' ORDER BY nth) AS rendered
FROM t JOIN k ON t.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY 1, 2
"""
