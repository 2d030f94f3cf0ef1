"""The role grammar, its LR automaton and a generalised LR parse with repairs.

A conversation is nothing, or an optional system turn and then user / assistant pairs.
The automaton is built from the productions (items, closure, goto). The parser
keeps a graph-structured stack: all stacks that are alive after a row, with their
cost and audit. Before a row it may insert turns; then the row is kept, given another
role or deleted. After each shift all reductions are made. Stacks with equal tops are
merged into the one with the smallest (cost, audit): in this grammar what can follow
depends on the top alone, which ``test_equal_tops_have_equal_futures`` checks.

Audits are compared without building them. All audits after a row hold as many
letters for rows and end with one, so none is a proper prefix of another and the order
of two audits is the order of (rank of the audit before, letters added).
The alive stacks with relative costs and ranks are finitely many, so a step is looked up
by them and the row's kind once it has been made.
"""

from __future__ import annotations

from functools import lru_cache

#: Productions over role initials, costs and letters of the edits.
GRAMMAR = (("S", ""), ("S", "T"), ("S", "sT"), ("T", "P"), ("T", "TP"), ("P", "ua"))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
START, GOAL = "S'", "S"

Stack = tuple[int, ...]


def _closure(items: frozenset) -> frozenset:
    items, todo = set(items), list(items)
    while todo:
        p, dot = todo.pop()
        body = GOAL if p is None else GRAMMAR[p][1]
        if dot < len(body):
            for q, (head, _) in enumerate(GRAMMAR):
                if head == body[dot] and (q, 0) not in items:
                    items.add((q, 0))
                    todo.append((q, 0))
    return frozenset(items)


def _automaton():
    """Goto function over state numbers, and the productions complete in each state."""
    states, goto = [_closure(frozenset([(None, 0)]))], {}
    for k, items in enumerate(states):
        symbols = sorted({(GOAL if p is None else GRAMMAR[p][1])[d:d + 1] for p, d in items} - {""})
        for x in symbols:
            moved = _closure(frozenset((p, d + 1) for p, d in items if (GOAL if p is None else GRAMMAR[p][1])[d:d + 1] == x))
            if moved not in states:
                states.append(moved)
            goto[k, x] = states.index(moved)
    complete = [[p for p, d in sorted(i for i in items if i[0] is not None) if d == len(GRAMMAR[p][1])] for items in states]
    return goto, complete


GOTO, COMPLETE = _automaton()


def _reduced(stack: Stack) -> set[Stack]:
    """The stack and all that reductions make of it."""
    out, todo = {stack}, [stack]
    while todo:
        s = todo.pop()
        for p in COMPLETE[s[-1]]:
            head, body = GRAMMAR[p]
            below = s[:len(s) - len(body)]
            new = (*below, GOTO[below[-1], head])
            if new not in out:
                out.add(new)
                todo.append(new)
    return out


@lru_cache(None)
def shifted(stack: Stack, initial: str) -> tuple[Stack, ...]:
    """Stacks after one turn, reduced, that can take another turn."""
    if (stack[-1], initial) not in GOTO:
        return ()
    return tuple(sorted(s for s in _reduced((*stack, GOTO[stack[-1], initial])) if any((s[-1], t) in GOTO for t in "sua")))


@lru_cache(None)
def accepted(stack: Stack) -> bool:
    return (0, GOTO[0, GOAL]) in _reduced(stack)


@lru_cache(None)
def inserted(stack: Stack) -> tuple[tuple[Stack, str, str], ...]:
    """(stack, letters, initials) after the fewest inserted turns that lead to each top, none included."""
    out, edge = {stack[-1]: (stack, "", "")}, [(stack, "", "")]
    while edge:
        grown = []
        for s, letters, roles in edge:
            for t in sorted(ROLES):
                for new in shifted(s, t):
                    if new[-1] not in out:
                        out[new[-1]] = (new, letters + "I", roles + t)
                        grown.append(out[new[-1]])
        edge = grown
    return tuple(out.values())


#: A stack alive after a row: (stack, cost above the cheapest, rank of its audit).
Tops = tuple[tuple[Stack, int, int], ...]
ORIGIN: Tops = (((0,), 0, 0),)


@lru_cache(1 << 16)
def step(tops: Tops, initial: str, must_go: bool, truncated: bool):
    """(tops after the row, cost of the cheapest, for each its (index before, letters, initials put out))."""
    best: dict[int, tuple] = {}
    for i, (stack, cost, rank) in enumerate(tops):
        for s, letters, roles in inserted(stack):
            base = cost + INSERT * len(letters)
            ways = [(base + DELETE, letters + "D", s, roles)]
            if not must_go:
                for t, c, letter in ((initial, KEEP, "K"), *((r, REROLE, "R") for r in ROLES)):
                    if t:
                        ways += [(base + c + TRUNCATED * truncated, letters + letter, new, roles + t) for new in shifted(s, t)]
            for c, added, new, out in ways:
                way = (c, rank, added, new, i, out)
                if new[-1] not in best or way < best[new[-1]]:
                    best[new[-1]] = way
    ways = sorted(best.values(), key=lambda w: w[3])
    low = min(w[0] for w in ways)
    ranks = {a: k for k, a in enumerate(sorted({w[1:3] for w in ways}))}
    return tuple((w[3], w[0] - low, ranks[w[1:3]]) for w in ways), low, tuple((w[4], w[2], w[5]) for w in ways)


def closing(tops: Tops) -> tuple[int, int, str, str]:
    """(cost, index, letters, initials) of the cheapest end."""
    ends = [(cost + INSERT * len(letters), rank, letters, i, roles) for i, (stack, cost, rank) in enumerate(tops)
            for s, letters, roles in inserted(stack) if accepted(s)]
    cost, _, letters, i, roles = min(ends)
    return cost, i, letters, roles


@lru_cache(None)
def tops_of_all_prefixes() -> tuple[Stack, ...]:
    """One stack for each top that any conversation can lead to."""
    seen, edge = {(0,)}, [(0,)]
    while edge:
        edge = sorted({n for s in edge for t in "sua" for n in shifted(s, t)} - seen)
        seen.update(edge)
    return tuple({s[-1]: s for s in sorted(seen, reverse=True)}.values())


class Parse:
    """A parse row by row from one stack on. Memory is a few small numbers per row."""

    def __init__(self, start: Stack = (0,)):
        self.tops, self.cost, self.back = ((start, 0, 0),), 0, []

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.tops, low, back = step(self.tops, initial if initial in ("s", "u", "a") else "", must_go, truncated)
        self.cost += low
        self.back.append(back)

    def audit(self, index: int) -> tuple[str, str]:
        """Letters and initials put out on the way to the stack of that index."""
        letters, roles = [], []
        for back in reversed(self.back):
            index, more, out = back[index]
            letters.append(more)
            roles.append(out)
        return "".join(reversed(letters)), "".join(reversed(roles))

    def ends(self) -> list[tuple[int, int, str, str]]:
        """(top, cost, letters, initials) of every stack alive."""
        return [(stack[-1], self.cost + cost, *self.audit(i)) for i, (stack, cost, _) in enumerate(self.tops)]

    def finish(self) -> tuple[int, str, str]:
        cost, i, letters, roles = closing(self.tops)
        audit, out = self.audit(i)
        return self.cost + cost, audit + letters, out + roles
