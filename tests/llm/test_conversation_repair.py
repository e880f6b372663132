"""Conversation repair against a plain form over whole conversations."""

import hashlib
import random
import re
import zlib

from llm_data import SF01
from pyspark.sql import functions as F
from test_role_grammar import slow as best

from tickforge.llm import conversation_repair as C
from tickforge.llm import queries as Q

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d:
            row = (conv, turn, "user" if d == 4 else role, "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text)
            out += [row, row] if d == 3 else [row]
    return out


def slow(rows, every):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of each conversation."""
    out = {}
    for conv in every:
        said = sorted(((t, r, x) for c, t, r, x in rows if c == conv), key=lambda s: (s[0] is not None, s[0] or 0, s[1], s[2]))
        faults, seen = "", set()
        for _, role, text in said:
            bare = text.strip(SPACE)
            faults += "b" if not bare else "d" if (role, text) in seen else "." if bare[-1] in ".!?" else "t"
            seen.add((role, text))
        kinds = [r[:1] for _, r, _ in said]
        turns = [t for t, _, _ in said if t is not None]
        cost, audit, roles = best([(k if k in ("s", "u", "a") else "o", "x" if f in "bd" else f, 0) for k, f in zip(kinds, faults)])
        lines, todo, given = [], iter(said), iter(roles)
        for letter in audit:
            if letter == "I":
                lines.append({"u": "user:", "a": "assistant:"}[next(given)])
                continue
            _, role, text = next(todo)
            if letter != "D":
                new = next(given)
                lines.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[new]}:{text}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def sample(n=60):
    rnd = random.Random(3)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 9)):
            rows.append((c, rnd.choice([t, t, t, None, t + 20]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Szar"]),
                         rnd.choice(["Yes.", "yes", " \t\n", "", None, "What? ", " ", "é!\v", f"own {c} {t}."])))
    rows += rows[:4] + [(None, t % 3, "user" if t % 2 else "assistant", f"text {t}.") for t in range(12)] + [(None, None, None, None)]
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"{t}." + "x " * 20_000 + ".") for t in range(8)]
    return rows


TURNS = "conv_id long, turn long, role string, text string"


def found(repair):
    said = {r.conv_id: r.sha256 for r in C.digests(repair.turns()).collect()}
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, said.get(r.conv_id, hashlib.sha256(b"").hexdigest())) for r in repair.report().collect()}


def plain(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


def test_equals_a_plain_form(spark):
    rows = sample()
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], TURNS + ", pos long, own string").repartition(3)
    assert found(C.Repair(df)) == slow(plain(rows), {r[0] for r in rows})


def test_conversations_over_many_pieces(spark):
    rnd = random.Random(8)
    rows = [(None, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", "no", "", f"own {t}."])) for t in range(40)]
    rows += [(1, t, "user" if t % 2 else "assistant", f"text {t}.") for t in range(37)] + [(2, 0, "user", "same.")] * 30 + sample(12)
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    want = slow(plain(rows), {r[0] for r in rows})
    for piece_bits, fan_bits in ((2, 1), (1, 2), (3, 10)):
        assert found(C.Repair(df, piece_bits=piece_bits, fan_bits=fan_bits)) == want


def test_damage(spark):
    rows = sample(40)
    got = C.damaged(spark.createDataFrame(rows, TURNS)).withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got.select("conv_id", "turn", "role", "text").collect())) == sorted(map(key, damage(rows)))


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = slow(damage(rows), {r[0] for r in rows})
    got = Q.op13_conversation_repair(spark, SF01).collect()
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want


def test_nothing_left_and_nothing_given(spark, tmp_path):
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(7, gone, "user", "x.")], TURNS).write.parquet(str(tmp_path / "a/conversations.parquet"))
    assert [tuple(r) for r in Q.op13_conversation_repair(spark, str(tmp_path / "a")).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    spark.createDataFrame([], TURNS).write.parquet(str(tmp_path / "b/conversations.parquet"))
    assert Q.op13_conversation_repair(spark, str(tmp_path / "b")).count() == 0
