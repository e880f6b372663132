"""Generalised LR repair against a best-first search over all edit sequences."""

import heapq
import random
import re

import pytest

from tickforge.llm import role_grammar as G


def slow(rows):
    """(cost, audit, roles) of the cheapest, then ASCII-least edits of (role, fault, further copies) rows."""
    flat = [x for r, f, e in rows for x in [(r, f)] + [(r, "x")] * e]
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        c, a, i, t = heapq.heappop(heap)
        if (i, t) in seen or not re.fullmatch("s?(ua)*u?", t):
            continue
        seen.add((i, t))
        if i == len(flat) and re.fullmatch("(s?(ua)+)?", t):
            return c, a, t
        for x in "ua":
            heapq.heappush(heap, (c + 2, a + "I", i, t + x))
        if i < len(flat):
            role, fault = flat[i]
            heapq.heappush(heap, (c + 3, a + "D", i + 1, t))
            if fault != "x":
                if role in "sua":
                    heapq.heappush(heap, (c + (fault == "t"), a + "K", i + 1, t + role))
                for x in "ua":
                    heapq.heappush(heap, (c + 2 + (fault == "t"), a + "R", i + 1, t + x))


def rows_of(rnd, most=7):
    return [(rnd.choice("suauao"), rnd.choice("....ttx"), rnd.choice([0, 0, 0, 1, 2])) for _ in range(rnd.randint(0, most))]


def columns(rows):
    return "".join(r for r, _, _ in rows), "".join(f for _, f, _ in rows), [e for *_, e in rows]


def test_stacks_are_few_and_shared():
    s = G.stacks()
    assert len(s.tops) == 8 and len(set(s.nodes)) == len(s.nodes)
    language = lambda t, k=0: not t and s.accepts(s.tops[k]) or bool(t) and any(language(t[1:], m) for m in s.ways[k, t[0]])
    for n in range(7):
        for t in ("".join("sua"[i // 3 ** j % 3] for j in range(n)) for i in range(3 ** n)):
            assert language(t) == bool(re.fullmatch("(s?(ua)+)?", t))


def test_repairs_equal_a_best_first_search():
    rnd = random.Random(0)
    for _ in range(1500):
        rows = rows_of(rnd)
        assert G.finished(G.repair(*columns(rows), G.stacks().root))[:3] == slow(rows)


def test_pieces_give_the_same_repair():
    rnd = random.Random(1)
    for _ in range(600):
        rows = rows_of(rnd, 9)
        if not rows:
            continue
        n = len(rows)
        cuts = [0, *sorted(rnd.sample(range(1, n), rnd.randint(0, n - 1))), n]
        pieces = [columns(rows[i:j]) for i, j in zip(cuts, cuts[1:])]
        parts = [G.transfer(*p) for p in pieces]
        tops = G.chosen(parts, G.stacks().root, None)
        cost, audit, roles = 0, "", ""
        for p, (first, last) in zip(pieces, tops):
            c, a, t = G.repair(*p, first)[last]
            cost, audit, roles = cost + c, audit + a, roles + t
        c, a, t = G.stacks().ends[tops[-1][1]]
        assert (cost + c, audit + a, roles + t) == slow(rows)
        k = rnd.randint(1, len(parts))  # two joined transfers, taken apart again
        two = [x for x in (parts[:k], parts[k:]) if x]
        high = G.chosen([G.combined(x) for x in two], G.stacks().root, None)
        assert [t for x, ends in zip(two, high) for t in G.chosen(x, *ends)] == tops


def test_a_grammar_without_bounded_stacks_is_refused():
    with pytest.raises(ValueError):
        G.Stacks((("S", ("C",)), ("C", ()), ("C", ("u", "a", "C"))))
