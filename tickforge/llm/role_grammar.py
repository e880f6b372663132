"""Generalised LR repair of role sequences.

The role grammar (an optional system turn, then user and assistant in turn, at
least once; or nothing at all) is compiled to SLR item sets.  Stacks share
their prefixes: a stack is a node (state, node below), kept once however often
it arises, so equal stacks are the same node and the graph of all stacks that
any input can build is finite (the grammar is left-recursive).

``repair`` reads a conversation's rows against all live stack tops at once.  At
each row a top may insert roles, then keep, rerole or delete the row, each with
its cost; tops that become equal are merged by the least (cost, audit).  The
audit is the string of the edits' initials.  Merging is exact: after the same
number of rows every audit ends in the letter of the last of them, so of two
different audits neither begins the other, and their order stays whatever
follows.

For a conversation cut into pieces, ``transfer`` gives a piece's least cost
between any two tops and the order of the audits as small whole numbers;
``combined`` joins the transfers of neighbours, ``chosen`` finds the tops at
all borders of the best repair.  Neither needs the audits themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# The grammar (s? (ua)+)? by its productions, and the costs of the edits.
PRODUCTIONS = (("S", ("C",)), ("C", ()), ("C", ("s", "P")), ("C", ("P",)), ("P", ("P", "u", "a")), ("P", ("u", "a")))
INSERTABLE = "ua"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
END = "$"
FAR = 1 << 40  # more than any cost: no way


@dataclass
class Tables:
    """SLR tables: shifts and gotos by (state, symbol), productions to reduce by (state, next terminal)."""

    productions: tuple
    step: dict = field(default_factory=dict)
    reduce: dict = field(default_factory=dict)

    def __post_init__(self):
        heads = {h for h, _ in self.productions}
        follow = self._follow(heads)
        numbers, todo = {}, [self._closure({(0, 0)}, heads)]
        numbers[todo[0]] = 0
        while todo:
            items = todo.pop()
            state = numbers[items]
            for p, dot in items:
                head, body = self.productions[p]
                if dot == len(body):
                    for t in follow[head]:
                        self.reduce.setdefault((state, t), set()).add(p)
            for symbol in {self.productions[p][1][dot] for p, dot in items if dot < len(self.productions[p][1])}:
                after = self._closure({(p, dot + 1) for p, dot in items if self.productions[p][1][dot:dot + 1] == (symbol,)}, heads)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    todo.append(after)
                self.step[state, symbol] = numbers[after]

    def _closure(self, items: set, heads: set) -> frozenset:
        items, size = set(items), -1
        while size != len(items):
            size = len(items)
            for p, dot in list(items):
                nxt = self.productions[p][1][dot:dot + 1]
                items |= {(q, 0) for q, (h, _) in enumerate(self.productions) if nxt == (h,)}
        return frozenset(items)

    def _follow(self, heads: set) -> dict:
        empty, first = set(), {h: set() for h in heads}
        follow = {h: set() for h in heads} | {self.productions[0][0]: {END}}
        for _ in range(len(self.productions) * 4):  # to the fixed point of a small grammar
            for h, body in self.productions:
                if all(x in empty for x in body):
                    empty.add(h)
                for k, x in enumerate(body):
                    first[h] |= first.get(x, {x})
                    if x not in empty:
                        break
                for k, x in enumerate(body):
                    if x in heads:
                        rest = body[k + 1:]
                        for y in rest:
                            follow[x] |= first.get(y, {y})
                            if y not in empty:
                                break
                        else:
                            follow[x] |= follow[h]
        return follow


class Stacks:
    """All stacks of a grammar as shared nodes, and the weighted edits between them."""

    def __init__(self, productions: tuple = PRODUCTIONS, insertable: str = INSERTABLE):
        self.tables, self.nodes, self.numbers = Tables(productions), [], {}
        self.terminals = sorted({x for _, body in productions for x in body} - {h for h, _ in productions})
        # the tops that terminals can lead to, by number; other nodes arise only between two reductions
        self.tops = [self._node(0, -1)]
        self.root = 0
        for top in self.tops:
            for t in self.terminals:
                self.tops += sorted(self.after(top, t) - set(self.tops))
            if len(self.tops) > 256:
                raise ValueError("the grammar has no bounded stacks: make it left-recursive")
        number = {top: k for k, top in enumerate(self.tops)}
        n = len(self.tops)
        self.ways = {(k, t): {number[m] for m in self.after(self.tops[k], t)} for k in range(n) for t in self.terminals}
        self.inserts = [self._inserts(k, insertable) for k in range(n)]
        whole = {k for k in range(n) if self.accepts(self.tops[k])}
        self.ends = [min((way for m, way in self.inserts[k].items() if m in whole), default=(FAR, "", "")) for k in range(n)]
        self.edges = {(k, r, f): self._edges(k, r, f, insertable) for k in range(n) for r in [*self.terminals, "o"] for f in ".tx"}

    def _node(self, state: int, below: int) -> int:
        key = (state, below)
        if key not in self.numbers:
            self.numbers[key] = len(self.nodes)
            self.nodes.append(key)
        return self.numbers[key]

    def _reduced(self, node: int, production: int) -> int | None:
        head, body = self.tables.productions[production]
        for _ in body:
            node = self.nodes[node][1]
        to = self.tables.step.get((self.nodes[node][0], head))
        return None if to is None else self._node(to, node)

    def _settled(self, node: int) -> int:
        """Reduced as far as it must be, whatever follows (then stacks that differ only in this are one)."""
        while True:
            state = self.nodes[node][0]
            ways = set().union(*(v for (s, _), v in self.tables.reduce.items() if s == state), set())
            if len(ways) != 1 or any(s == state for s, _ in self.tables.step):
                return node
            below = self._reduced(node, next(iter(ways)))
            if below is None:
                return node
            node = below

    def after(self, node: int, terminal: str) -> set[int]:
        """The stacks after a terminal, by every reduction and shift that the tables allow."""
        out, todo, seen = set(), [node], set()
        while todo:
            k = todo.pop()
            if k in seen:
                continue
            seen.add(k)
            to = self.tables.step.get((self.nodes[k][0], terminal))
            if to is not None:
                out.add(self._settled(self._node(to, k)))
            for p in self.tables.reduce.get((self.nodes[k][0], terminal), ()):
                low = self._reduced(k, p)
                if low is not None:
                    todo.append(low)
        return out

    def accepts(self, node: int) -> bool:
        todo, seen = [node], set()
        while todo:
            k = todo.pop()
            if k in seen:
                continue
            seen.add(k)
            for p in self.tables.reduce.get((self.nodes[k][0], END), ()):
                if p == 0:
                    return True
                low = self._reduced(k, p)
                if low is not None:
                    todo.append(low)
        return False

    def _inserts(self, top: int, insertable: str) -> dict[int, tuple[int, str, str]]:
        """Least (cost, audit, roles) to every stack that inserted roles alone lead to."""
        best, todo = {top: (0, "", "")}, [top]
        while todo:
            k = todo.pop(0)
            c, a, t = best[k]
            for x in insertable:
                for m in self.ways[k, x]:
                    way = (c + INSERT, a + "I", t + x)
                    if m not in best or way < best[m]:
                        best[m] = way
                        todo.append(m)
        return best

    def _edges(self, top: int, role: str, fault: str, insertable: str) -> list[tuple[int, int, str, str]]:
        """(stack, cost, audit, roles) of the best ways over one row: inserts, then one edit of the row."""
        best: dict[int, tuple[int, str, str]] = {}

        def way(to: int, cost: int, audit: str, roles: str) -> None:
            if to not in best or (cost, audit, roles) < best[to]:
                best[to] = (cost, audit, roles)

        for k, (c, a, t) in self.inserts[top].items():
            way(k, c + DELETE, a + "D", t)
            if fault == "x":  # blank or repeated: must go
                continue
            more = TRUNCATED if fault == "t" else 0
            if role in self.terminals:
                for m in self.ways[k, role]:
                    way(m, c + KEEP + more, a + "K", t + role)
            for x in insertable:
                for m in self.ways[k, x]:
                    way(m, c + REROLE + more, a + "R", t + x)
        return [(m, *w) for m, w in best.items()]


@lru_cache(maxsize=1)
def stacks() -> Stacks:
    return Stacks()


def repair(roles: str, faults: str, extras: list[int], start: int) -> dict[int, tuple[int, str, str]]:
    """Least (cost, audit, roles) from one stack to every other over rows: ``roles`` by
    their initials (``o``: another), ``faults`` (``.`` none, ``t`` truncated, ``x`` must
    go), ``extras`` the further copies of each row, which must go."""
    edges, tops = stacks().edges, {start: (0, "", "")}
    for role, fault, extra in zip(roles, faults, extras):
        found: dict[int, tuple[int, str, str]] = {}
        for k, (c, a, t) in tops.items():
            for m, w, b, u in edges[k, role, fault]:
                old = found.get(m)
                if old is None or c + w < old[0] or (c + w == old[0] and a + b < old[1]):
                    found[m] = (c + w, a + b, t + u)
        if extra:
            found = {m: (c + DELETE * extra, a + "D" * extra, t) for m, (c, a, t) in found.items()}
        tops = found
    return tops


def finished(tops: dict[int, tuple[int, str, str]]) -> tuple[int, str, str, int, int]:
    """(cost, audit, roles, last stack, roles added at the end) of the best whole repair."""
    ends = stacks().ends
    return min((c + ends[k][0], a + ends[k][1], t + ends[k][2], k, len(ends[k][1])) for k, (c, a, t) in tops.items() if ends[k][0] < FAR)


def _dense(order: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Places of the audits among the ways that exist."""
    order = np.where(cost < FAR, order, np.iinfo(np.int64).max)
    return np.unique(order, return_inverse=True)[1].reshape(order.shape)


def transfer(roles: str, faults: str, extras: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(cost, order) between all stacks: equal order means equal audits."""
    n = len(stacks().tops)
    cost, audit = np.full((n, n), FAR, dtype=np.int64), {}
    for k in range(n):
        for m, (c, a, _) in repair(roles, faults, extras, k).items():
            cost[k, m], audit[k, m] = c, a
    place = {a: i for i, a in enumerate(sorted(set(audit.values())))}
    order = np.zeros((n, n), dtype=np.int64)
    for at, a in audit.items():
        order[at] = place[a]
    return cost, _dense(order, cost)


def _through(c: np.ndarray, r: np.ndarray, cost: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ways (.., k) continued by (k, m): (cost, order of the audits, best k)."""
    n = cost.shape[0]
    total = np.minimum(c[..., :, None] + cost, FAR)
    pair = r[..., :, None] * (n * n + 1) + order
    least = total.min(axis=-2, keepdims=True)
    pair = np.where(total == least, pair, np.iinfo(np.int64).max)
    return least.squeeze(-2), pair.min(axis=-2), pair.argmin(axis=-2)


def combined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The transfer of neighbouring pieces as one."""
    c, r = parts[0]
    for cost, order in parts[1:]:
        c, pair, _ = _through(c, r, cost, order)
        r = _dense(pair, c)
    return c, r


def chosen(parts: list[tuple[np.ndarray, np.ndarray]], start: int, end: int | None) -> list[tuple[int, int]]:
    """(first, last stack) of every piece in the best way from ``start`` to ``end`` (None: to a whole conversation)."""
    n = parts[0][0].shape[0]
    c, r = np.full(n, FAR, dtype=np.int64), np.zeros(n, dtype=np.int64)
    c[start] = 0
    back = []
    for cost, order in parts:
        c, pair, best = _through(c, r, cost, order)
        r = _dense(pair, c)
        back.append(best)
    if end is None:
        ends = stacks().ends
        end = min((int(c[k]) + ends[k][0], int(r[k]), ends[k][1], k) for k in range(n) if c[k] < FAR and ends[k][0] < FAR)[-1]
    out = []
    for best in reversed(back):
        first = int(best[end])
        out.append((first, end))
        end = first
    return out[::-1]
