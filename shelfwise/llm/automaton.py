"""Regular expressions compiled together into one minimal deterministic automaton over bytes.

Rules go through Thompson's construction, subset construction over classes of equivalent bytes and partition
refinement, and end as a flat array of transitions. The combined automaton reads a text once from its end to its
start and knows, at each byte, which rules have a match starting there; the longest match of a rule is then read
forwards with the rule's own automaton.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "d": "0123456789"}


class _Parser:
    """Literals, classes, groups, alternation and ``* + ? {m} {m,} {m,n}``, all over ASCII."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self):
        parts = [self.row()]
        while self.peek() == "|":
            self.take()
            parts.append(self.row())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def row(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeat())
        return ("row", parts)

    def repeat(self):
        node = self.atom()
        while (c := self.peek()) and c in "*+?{":
            self.take()
            if c == "{":
                end = self.text.index("}", self.at)
                low, comma, high = self.text[self.at:end].partition(",")
                self.at = end + 1
                lo, hi = int(low), (int(high) if high else None) if comma else int(low)
            else:
                lo, hi = {"*": (0, None), "+": (1, None), "?": (0, 1)}[c]
            node = ("times", node, lo, hi)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            node = self.choice()
            self.take()
            return node
        if c == "[":
            return ("set", self.members())
        if c == "\\":
            return ("set", self.escape())
        return ("set", frozenset(c.encode()))

    def escape(self) -> frozenset:
        c = self.take()
        if c == "x":
            self.at += 2
            return frozenset([int(self.text[self.at - 2:self.at], 16)])
        return frozenset(_ESCAPES.get(c, c).encode())

    def members(self) -> frozenset:
        found: set[int] = set()
        while (c := self.take()) != "]":
            if c == "\\":
                found |= self.escape()
            elif self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                found |= set(range(ord(c), ord(self.take()) + 1))
            else:
                found.add(ord(c))
        return frozenset(found)


class _Graph:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def node(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, tree, start: int, backwards: bool) -> int:
        """Append ``tree`` after ``start``; the node where it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.node()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "row":
            for part in reversed(tree[1]) if backwards else tree[1]:
                start = self.add(part, start, backwards)
            return start
        if kind == "or":
            end = self.node()
            for part in tree[1]:
                begin = self.node()
                self.free[start].append(begin)
                self.free[self.add(part, begin, backwards)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.add(part, start, backwards)
        if high is None:
            loop, end = self.node(), self.node()
            self.free[start] += [loop, end]
            self.free[self.add(part, loop, backwards)] += [loop, end]
            return end
        end = self.node()
        for _ in range(high - low):
            self.free[start].append(end)
            start = self.add(part, start, backwards)
        self.free[start].append(end)
        return end

    def closed(self, nodes) -> frozenset:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for n in self.free[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state + class]`` is the next state; states from ``accepting`` on have the rules in ``rules``."""

    classes: bytes
    table: tuple[int, ...]
    start: int
    accepting: int
    rules: dict[int, tuple[int, ...]]
    dead: int


def compile_rules(patterns: list[str], backwards: bool = False, anywhere: bool = False) -> Automaton:
    """One automaton for all ``patterns``; ``anywhere`` lets a match begin at every byte."""
    graph = _Graph()
    begin = graph.node()
    ends = {}
    for k, pattern in enumerate(patterns):
        own = graph.node()
        graph.free[begin].append(own)
        ends[graph.add(_Parser(pattern).choice(), own, backwards)] = k
    sets = list({s for moves in graph.moves for s, _ in moves})
    signs = {tuple(b in s for s in sets): b for b in range(256)}
    number = {sign: i for i, sign in enumerate(signs)}
    classes = bytes(number[tuple(b in s for s in sets)] for b in range(256))
    example = list(signs.values())
    first = graph.closed([begin])
    states, todo, moves = {first: 0}, [first], []
    while todo:
        state = todo.pop(0)
        row = []
        for b in example:
            to = {n for s in state for chars, n in graph.moves[s] if b in chars}
            target = graph.closed(to | ({begin} if anywhere else set()))
            if target not in states:
                states[target] = len(states)
                todo.append(target)
            row.append(states[target])
        moves.append(row)
    accepts = [tuple(sorted(ends[n] for n in s if n in ends)) for s in states]
    table = np.array(moves)
    # Moore's refinement: states stay together while they accept alike and lead to the same groups.
    group = np.unique([hash(a) for a in accepts], return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    of_group = {int(g): accepts[i] for i, g in reversed(list(enumerate(group)))}
    order = sorted(of_group, key=lambda g: (bool(of_group[g]), g))
    place = {g: i * len(example) for i, g in enumerate(order)}
    flat: list[int] = []
    for g in order:
        flat += [place[int(group[to])] for to in table[int(np.argmax(group == g))]]
    accepting = next((place[g] for g in order if of_group[g]), len(flat))
    dead = next((place[g] for g in order if not of_group[g] and all(to == place[g] for to in flat[place[g]:place[g] + len(example)])), -1)
    return Automaton(classes, tuple(flat), place[int(group[0])], accepting, {place[g]: of_group[g] for g in order if of_group[g]}, dead)


def starts(automaton: Automaton, data: bytes) -> list[tuple[int, int]]:
    """Positions, from the last to the first, where some rule's match begins, with the state reached there."""
    table, state, accepting, found = automaton.table, automaton.start, automaton.accepting, []
    for left, c in enumerate(data[::-1].translate(automaton.classes)):
        state = table[state + c]
        if state >= accepting:
            found.append((len(data) - 1 - left, state))
    return found


def longest(automaton: Automaton, data: bytes, start: int) -> tuple[int, int]:
    """End of the longest match from ``start`` and of the shortest one; -1 if there is none."""
    table, state, accepting, classes, dead = automaton.table, automaton.start, automaton.accepting, automaton.classes, automaton.dead
    shortest = last = -1
    for at in range(start, len(data)):
        state = table[state + classes[data[at]]]
        if state == dead:
            break
        if state >= accepting:
            last = at + 1
            if shortest < 0:
                shortest = last
    return last, shortest
