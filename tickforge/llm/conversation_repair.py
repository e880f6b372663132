"""Repair of conversations whose turns are missing, empty, repeated, cut off or mislabelled.

Rows are put in order (conversation, turn with null first, role, text), faults
are found, and each conversation's role sequence is repaired by the generalised
LR parser of ``role_grammar``: cheapest edits, ties by the ASCII-least audit.

Distribution.  Equal rows become one row with a count.  One range shuffle puts
the rest in order and is written to the shared folder, each row with its place
in the whole order; 2^``piece_bits`` consecutive places are a piece, so the rows
of a conversation in one piece are bounded however long it is.  Only narrow
columns travel from there: a row is its conversation's first earlier holder of a
text if its place is the least one of the text's hashes (partial aggregation,
then a join on unique places: no hot key).  Most conversations lie in one piece
and are repaired there.  For the others each piece gives its transfer between
stack tops; ``2^fan_bits`` neighbouring transfers are joined level by level until
a conversation has few enough, the best tops are chosen there and handed down
again, and the pieces are repaired between their own two tops.  So one
conversation may hold any share of all rows.  The digest of a repaired
conversation is one SHA-256 over its text in order: there, by its nature, one
task reads a conversation as a sorted stream and holds one row at a time.

Defined results: null roles and texts are one space, null turns come first and
count no gaps, all rows with a null id are one conversation; rows of one turn
are ordered by role, then text; a role counts by its first letter; of equal rows
the first is kept and the others are duplicates (or all are blank); a
conversation without rows has zeros, an empty audit and the digest of nothing;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tickforge.llm import role_grammar as G
from tickforge.llm.common import SPACES, run_folder, written

PIECE_BITS = 12
FAN_BITS = 10
# Role names that an edit gives, marks that end a text.
ROLE = {"u": "user", "a": "assistant"}
STOPS = ".!?"
STRIPPED = "".join(map(chr, SPACES))
LEGAL = ("su", "ua", "au")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows dropped, emptied, unpunctuated, repeated
    or relabelled by the checksum of ``conv_id:turn``; null is one space."""
    c = {x: F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn", "role", "text")}
    way = F.crc32(F.concat(c["conv_id"], F.lit(":"), c["turn"])) % 20
    text = F.when(way == 1, "").when(way == 2, F.translate(c["text"], STOPS, "")).otherwise(c["text"])
    return conversations.filter(way != 0).select(
        "conv_id", "turn", F.when(way == 4, "user").otherwise(c["role"]).alias("role"), text.alias("text"),
        F.when(way == 3, 2).otherwise(1).cast("long").alias("copies"))


def ordered(rows: DataFrame, folder: str, copies: Column | None = None) -> DataFrame:
    """(conv_id, turn, role, text, copies, pos): distinct rows with their place in the whole order, written."""
    space = F.lit(" ")
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                        F.coalesce(F.col("text").cast("string"), space).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
    once = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    # bounded sort keys, as the range partitioner samples them; the full order follows inside a range
    cut = once.repartitionByRange("conv_id", "turn", F.substring("role", 1, 16), F.substring("text", 1, 128))
    return written(cut.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("pos", F.monotonically_increasing_id()), f"{folder}/ordered")


def faults(table: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, kind, fault, blank, copies) of the ordered rows: the role's kind
    (s, u, a or o) and its fault (``.``, ``t`` truncated, ``x`` blank or said before)."""
    bare = F.btrim("text", F.lit(STRIPPED))
    first = F.substring("role", 1, 1)
    narrow = table.select("conv_id", "pos", "turn", "copies", F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("kind"),
                          (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(*STOPS)).alias("cut"),
                          F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "text", "role").alias("h2"))
    said = narrow.groupBy("conv_id", "h1", "h2").agg(F.min("pos").alias("said"))
    seen = narrow.join(said.select("said"), F.col("pos") == F.col("said"), "left")
    fault = F.when(F.col("blank") | F.col("said").isNull(), "x").when(F.col("cut"), "t").otherwise(".")
    return seen.select("conv_id", "pos", "turn", "kind", fault.alias("fault"), "blank", "copies")


def counts(found: DataFrame) -> DataFrame:
    """A row per conversation: its first and last place and its counted faults."""
    again = F.when(F.col("blank"), 0).when(F.col("fault") == "x", F.col("copies")).otherwise(F.col("copies") - 1)
    return found.groupBy("conv_id").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"), F.sum(again).alias("duplicate"), F.count_if(F.col("fault") == "t").alias("truncated"))


def pieces(found: DataFrame, counted: DataFrame, piece_bits: int) -> DataFrame:
    """(conv, piece, pos, kinds, faults, extras, single) of each conversation's rows in a
    piece; ``conv`` is the conversation's first place, ``pos`` the first one here."""
    row = F.struct("pos", "kind", "fault", "copies")
    some = found.groupBy("conv_id", F.shiftright("pos", piece_bits).alias("piece")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    text = lambda f: F.array_join(F.transform("rows", lambda r: r[f]), "")
    some = some.select(F.col("conv_id").alias("of"), "piece", F.element_at("rows", 1)["pos"].alias("pos"), text("kind").alias("kinds"), text("fault").alias("faults"),
                       F.transform("rows", lambda r: r["copies"] - 1).alias("extras"))
    own = counted.select("conv_id", F.col("first").alias("conv"), F.shiftright("first", piece_bits).alias("low"), F.shiftright("last", piece_bits).alias("high"))
    return some.join(own, F.col("of").eqNullSafe(F.col("conv_id"))).select("conv", "piece", "pos", "kinds", "faults", "extras", (F.col("low") == F.col("high")).alias("single"))


def _illegal(kinds: str, extras: list[int]) -> int:
    return sum(kinds[i:i + 2] not in LEGAL for i in range(len(kinds) - 1)) + sum(extras)


REPAIRED = "conv long, piece long, pos long, cost long, audit string, illegal long, before array<string>, own array<string>, at_end string"


def _edits(audit: str, roles: str, extras: list[int]) -> tuple[list[str], list[str], str]:
    """Per row the roles inserted before it and what becomes of it (empty: goes, K: stays, else
    its new role); the roles inserted after the last row."""
    before, own, at, given = [], [], 0, iter(roles)
    for extra in extras:
        upto = at
        while audit[upto] == "I":
            upto += 1
        before.append("".join(next(given) for _ in range(upto - at)))
        role = "" if audit[upto] == "D" else next(given)
        own.append("K" if audit[upto] == "K" else role)
        at = upto + 1 + extra
    return before, own, "".join(given)


def repaired_pieces(some: DataFrame) -> DataFrame:
    """``REPAIRED`` of pieces with (start, end, last): the tops to go between; at the last
    piece of a conversation an end of -1 means the best way to a whole one."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            out = []
            for row in b.to_pylist():
                key = (row["kinds"], row["faults"], tuple(row["extras"]), row["start"], row["end"], row["last"])
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    tops = G.repair(row["kinds"], row["faults"], row["extras"], row["start"])
                    if row["end"] < 0:
                        cost, audit, roles, _, _ = G.finished(tops)
                    else:
                        cost, audit, roles = tops[row["end"]]
                        if row["last"]:
                            cost, audit, roles = (x + y for x, y in zip((cost, audit, roles), G.stacks().ends[row["end"]]))
                    known[key] = (cost, audit, _illegal(row["kinds"], row["extras"]), *_edits(audit, roles, row["extras"]))
                out.append((row["conv"], row["piece"], row["pos"], *known[key]))
            names = [x.split()[0] for x in REPAIRED.split(", ")]
            types = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=names)

    return some.select("conv", "piece", "pos", "kinds", "faults", "extras", "start", "end", "last").mapInArrow(work, REPAIRED)


# A part is a piece or neighbouring pieces joined: least costs and order of audits between tops, row by row.
PARTS = "conv long, part long, cost array<long>, audit_order array<long>, first string, last string, illegal long"


def _square(values: list[int]) -> np.ndarray:
    n = len(G.stacks().tops)
    return np.array(values, dtype=np.int64).reshape(n, n)


def transfers(some: DataFrame) -> DataFrame:
    """``PARTS`` of pieces."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            made = [G.transfer(r["kinds"], r["faults"], r["extras"]) for r in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array([r["conv"] for r in rows], pa.int64()), pa.array([r["piece"] for r in rows], pa.int64()),
                pa.array([c.ravel() for c, _ in made], pa.list_(pa.int64())), pa.array([o.ravel() for _, o in made], pa.list_(pa.int64())),
                pa.array([r["kinds"][0] for r in rows]), pa.array([r["kinds"][-1] for r in rows]),
                pa.array([_illegal(r["kinds"], r["extras"]) for r in rows], pa.int64())], names=[x.split()[0] for x in PARTS.split(", ")])

    return some.select("conv", "piece", "kinds", "faults", "extras").mapInArrow(work, PARTS)


def _in_order(pdf):
    pdf = pdf.sort_values("part")
    return pdf, [(_square(c), _square(o)) for c, o in zip(pdf["cost"], pdf["audit_order"])]


def _joined_illegal(pdf) -> int:
    kinds = list(zip(pdf["last"][:-1], pdf["first"][1:]))
    return int(pdf["illegal"].sum()) + sum(a + b not in LEGAL for a, b in kinds)


def joined(parts: DataFrame, fan_bits: int) -> DataFrame:
    """``PARTS`` with 2^fan_bits neighbouring numbers joined to one."""
    def work(key, pdf):
        pdf, matrices = _in_order(pdf)
        cost, order = G.combined(matrices)
        return pdf.head(1).assign(part=key[1], cost=[cost.ravel()], audit_order=[order.ravel()], last=pdf["last"].iloc[-1], illegal=_joined_illegal(pdf))

    return parts.groupBy("conv", F.shiftright("part", fan_bits).alias("up")).applyInPandas(work, PARTS)


CHOSEN = "conv long, part long, start int, end int, last boolean, illegal long"


def choose(parts: DataFrame, above: DataFrame | None, fan_bits: int) -> DataFrame:
    """``CHOSEN``: the tops at both sides of each part in the best repair; ``above`` has
    those of the joined parts, None where the parts are a whole conversation.  The
    illegal neighbours of a whole conversation stand at its last part."""
    whole = above is None

    def work(pdf):
        pdf, matrices = _in_order(pdf)
        start, end, last = (G.stacks().root, None, True) if whole else (int(pdf["start"].iloc[0]), int(pdf["end"].iloc[0]), bool(pdf["at_last"].iloc[0]))
        ends = G.chosen(matrices, start, end)
        out = pdf[["conv", "part"]].assign(start=[a for a, _ in ends], end=[b for _, b in ends], last=False, illegal=0)
        if last:
            out.iloc[-1, out.columns.get_loc("last")] = True
            out.iloc[-1, out.columns.get_loc("illegal")] = _joined_illegal(pdf) if whole else int(pdf["all_illegal"].iloc[0])
        return out

    if above is None:
        return parts.groupBy("conv").applyInPandas(work, CHOSEN)
    high = above.select("conv", F.col("part").alias("up"), "start", "end", F.col("last").alias("at_last"), F.col("illegal").alias("all_illegal"))
    return parts.withColumn("up", F.shiftright("part", fan_bits)).join(high, ["conv", "up"]).groupBy("conv", "up").applyInPandas(work, CHOSEN)


def across(some: DataFrame, folder: str, fan_bits: int) -> DataFrame:
    """``CHOSEN`` of the pieces of conversations that lie in several."""
    levels = [written(transfers(some), f"{folder}/parts0")]
    while (levels[-1].groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > 1 << fan_bits:
        levels.append(written(joined(levels[-1], fan_bits), f"{folder}/parts{len(levels)}"))
    above = None
    for k in reversed(range(len(levels))):
        above = written(choose(levels[k], above, fan_bits), f"{folder}/chosen{k}")
    return above


class Repair:
    """The repair of a table of turns (conv_id, turn, role, text; ``copies`` counts equal rows)."""

    def __init__(self, rows: DataFrame, copies: Column | None = None, piece_bits: int = PIECE_BITS, fan_bits: int = FAN_BITS):
        folder = run_folder(rows.sparkSession, "repair")
        self.table = ordered(rows, folder, copies)
        found = written(faults(self.table), f"{folder}/faults")
        self.counted = written(counts(found), f"{folder}/counts")
        all_pieces = written(pieces(found, self.counted, piece_bits), f"{folder}/pieces")
        alone = all_pieces.filter("single").withColumns({"start": F.lit(G.stacks().root), "end": F.lit(-1), "last": F.lit(True)})
        several = all_pieces.filter("NOT single")
        tops = across(several, folder, fan_bits)
        own = several.join(tops.select("conv", F.col("part").alias("piece"), "start", "end", "last"), ["conv", "piece"])
        self.edits = written(repaired_pieces(alone.unionByName(own)), f"{folder}/edits")
        self.tops = tops

    def report(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation that has rows."""
        audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "")
        whole = self.edits.groupBy("conv").agg(F.sum("cost").alias("cost"), audit.alias("audit"), F.sum("illegal").alias("own"))
        # over several pieces the illegal neighbours are counted with the borders
        over = self.tops.filter("last").select(F.col("conv").alias("c"), F.col("illegal").alias("all"))
        return (self.counted.join(whole, F.col("first") == F.col("conv")).join(over, F.col("conv") == F.col("c"), "left")
                .select("conv_id", "gaps", "blank", "duplicate", "truncated", F.coalesce("all", "own").alias("illegal"), "cost", "audit"))

    def turns(self) -> DataFrame:
        """(conv_id, pos, nth, role, text): the repaired turns, in the order of pos and nth."""
        ends = F.size("own") - 1
        edit = self.edits.select("pos", "at_end", ends.alias("n"), F.posexplode(F.arrays_zip("before", "own")).alias("i", "e"))
        edit = edit.select((F.col("pos") + F.col("i")).alias("at"), F.col("e.before").alias("before"), F.col("e.own").alias("own"),
                           F.when(F.col("i") == F.col("n"), F.col("at_end")).otherwise("").alias("after"))
        name = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])
        added = lambda roles: F.transform(F.filter(F.split(roles, ""), lambda x: x != ""), lambda x: F.struct(name[x].alias("role"), F.lit("").alias("text")))
        kept = F.struct(F.when(F.col("own") == "K", F.col("role")).otherwise(name[F.col("own")]).alias("role"), F.col("text").alias("text"))
        mine = F.when(F.col("own") != "", F.array(kept)).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
        rows = self.table.join(edit, F.col("pos") == F.col("at"))
        return rows.select("conv_id", "pos", F.posexplode(F.concat(added("before"), mine, added("after"))).alias("nth", "t")).select("conv_id", "pos", "nth", "t.role", "t.text")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) over ``role:text`` of a conversation's turns, joined by newlines; a sorted stream."""
    id_type = to_arrow_type(turns.schema["conv_id"].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], id_type), pa.array([h for _, h in rows], pa.string())], names=["conv_id", "sha256"])

        for b in batches:
            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if state is None or c != conv:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(role.encode())
                state.update(b":")
                state.update(text.encode())
            if out:
                yield flush(out)
                out = []
        if state is not None:
            yield flush([(conv, state.hexdigest())])

    by = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "nth").select("conv_id", "role", "text")
    return by.mapInArrow(work, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, sha256 string")


# The same by a finite automaton and a recursive query, a row of every conversation at a time.
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([CAST(b AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) AS r(b)),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce("text", ' ') AS txt,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT k.*, xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS UBIGINT))),
                 lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 20 AS way FROM k, crc),
d AS (SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
             CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(txt, '[.!?]', '', 'g') ELSE txt END AS txt, unnest(range(CASE WHEN way = 3 THEN 2 ELSE 1 END)) AS copy
      FROM h WHERE way <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt) AS n,
             trim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d),
f AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY n) > 1 THEN 'd'
                     WHEN right(bare, 1) IN ('.', '!', '?') THEN 'o' ELSE 't' END AS fault,
             left(role, 1) AS kind, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS after FROM o),
go(q, x, p) AS (VALUES ('0', 's', '1'), ('0', 'u', '2'), ('1', 'u', '2'), ('2', 'a', '3'), ('3', 'u', '2')),
i0 AS (SELECT DISTINCT q, q AS p, 0 AS cost, '' AS audit, '' AS roles FROM go),
i1 AS (SELECT i0.q, go.p, {G.INSERT} AS cost, 'I' AS audit, x AS roles FROM i0 JOIN go ON i0.p = go.q WHERE x <> 's'),
ins AS (FROM i0 UNION ALL FROM i1 UNION ALL
        SELECT i1.q, go.p, {2 * G.INSERT}, 'II', roles || x FROM i1 JOIN go ON i1.p = go.q WHERE x <> 's'),
every AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '0' AS q, {{'c': 0, 'a': '', 'r': ''}} AS w FROM every
  UNION ALL
  SELECT walk.conv_id, walk.n + 1, e.p, min({{'c': w.c + e.cost, 'a': w.a || e.audit, 'r': w.r || e.roles}})
  FROM walk JOIN f ON walk.conv_id IS NOT DISTINCT FROM f.conv_id AND f.n = walk.n + 1
  JOIN (SELECT q, p, cost + {G.DELETE} AS cost, audit || 'D' AS audit, roles, NULL AS kind, 0 AS stays FROM ins
        UNION ALL SELECT ins.q, go.p, cost + {G.KEEP}, audit || 'K', roles || x, x, 1 FROM ins JOIN go ON ins.p = go.q
        UNION ALL SELECT ins.q, go.p, cost + {G.REROLE}, audit || 'R', roles || x, NULL, 1 FROM ins JOIN go ON ins.p = go.q WHERE x <> 's') AS way ON way.q = walk.q
       AND (way.kind IS NULL OR way.kind = f.kind) AND (way.stays = 0 OR f.fault IN ('o', 't')),
       LATERAL (SELECT way.p AS p, way.cost + CASE WHEN way.stays = 1 AND f.fault = 't' THEN {G.TRUNCATED} ELSE 0 END AS cost, way.audit AS audit, way.roles AS roles) AS e
  GROUP BY walk.conv_id, walk.n, e.p),
z AS (SELECT every.conv_id, count(n) AS rows FROM every LEFT JOIN f ON every.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY every.conv_id),
best AS (SELECT walk.conv_id, min({{'c': w.c + ins.cost, 'a': w.a || ins.audit, 'r': w.r || ins.roles}}) AS w
         FROM walk JOIN z ON walk.conv_id IS NOT DISTINCT FROM z.conv_id AND walk.n = z.rows JOIN ins ON walk.q = ins.q AND ins.p IN ('0', '3') GROUP BY walk.conv_id),
e AS (SELECT conv_id, w.a AS a, w.r AS r, unnest(range(1, length(w.a) + 1)) AS i FROM best),
l AS (SELECT e.conv_id, i, CASE WHEN substr(a, i, 1) = 'K' THEN f.role ELSE CASE substr(r, length(replace(substr(a, 1, i), 'D', '')), 1) WHEN 'u' THEN 'user' ELSE 'assistant' END END
             || ':' || CASE WHEN substr(a, i, 1) = 'I' THEN '' ELSE f.txt END AS line
      FROM e LEFT JOIN f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND f.n = length(replace(substr(a, 1, i), 'I', '')) WHERE substr(a, i, 1) <> 'D'),
s AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY i)) AS h FROM l GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
             count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (after IS NOT NULL AND kind || after NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(w.c AS BIGINT) AS cost, w.a AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM best LEFT JOIN c ON best.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN s ON best.conv_id IS NOT DISTINCT FROM s.conv_id
"""
