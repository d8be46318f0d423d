"""Regexes of bytes compiled into one minimal deterministic automaton.

A rule is a regex of literals, classes, groups, alternatives and repeats; its
parse comes from Python's own regex parser. Thompson's construction gives an
automaton with choices for all rules together, subset construction removes the
choices, and partition refinement merges states that no input tells apart. The
result is a transition array over classes of bytes that behave alike.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser as parser
from typing import NamedTuple

import numpy as np


class Automaton(NamedTuple):
    """State 0 is the start. ``step[state, classes[byte]]`` is the next state;
    ``accepts[state]`` has a bit for each rule that ends there."""

    step: np.ndarray
    classes: np.ndarray
    accepts: np.ndarray

    def by_byte(self) -> np.ndarray:
        return self.step[:, self.classes]


class _Choices:
    """An automaton with choices: empty moves and moves on sets of bytes."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def add(self, tree: list, start: int, backwards: bool) -> int:
        """Adds what a parse tree matches from ``start``; the state it ends in."""
        for kind, value in reversed(tree) if backwards else tree:
            start = self._add(kind, value, start, backwards)
        return start

    def _add(self, kind, value, start: int, backwards: bool) -> int:
        if kind in (op.LITERAL, op.NOT_LITERAL, op.IN, op.ANY):
            end = self.state()
            self.moves[start] = (_bytes(kind, value), end)
            return end
        if kind is op.SUBPATTERN:
            return self.add(value[3], start, backwards)
        if kind is op.BRANCH:
            end = self.state()
            for branch in value[1]:
                self.empty[start].append(self.state())
                self.empty[self.add(branch, self.empty[start][-1], backwards)].append(end)
            return end
        if kind is op.MAX_REPEAT:
            least, most, tree = value
            for _ in range(least):
                start = self._after(tree, start, backwards)
            if most is op.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[start].append(loop)
                self.empty[loop].append(end)
                self.empty[self._after(tree, loop, backwards)].append(loop)
                return end
            for _ in range(most - least):
                end = self.state()
                self.empty[start].append(end)
                self.empty[self._after(tree, start, backwards)].append(end)
                start = end
            return start
        raise ValueError(f"not supported in a rule: {kind}")

    def _after(self, tree: list, start: int, backwards: bool) -> int:
        entry = self.state()
        self.empty[start].append(entry)
        return self.add(tree, entry, backwards)

    def closure(self, states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for other in self.empty[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)


def _bytes(kind, value) -> frozenset[int]:
    if kind is op.ANY:
        return frozenset(range(256)) - {10}
    if kind is op.LITERAL:
        return frozenset([value])
    if kind is op.NOT_LITERAL:
        return frozenset(range(256)) - {value}
    found: set[int] = set()
    for part, what in value:
        if part is op.LITERAL:
            found.add(what)
        elif part is op.RANGE:
            found.update(range(what[0], what[1] + 1))
        elif part is not op.NEGATE:
            raise ValueError(f"not supported in a class: {part}")
    return frozenset(range(256)) - found if value[0][0] is op.NEGATE else frozenset(found)


def compile_rules(rules: list[str], anywhere: bool, backwards: bool = False) -> Automaton:
    """The automaton of all ``rules``. With ``anywhere`` a match may start at
    any byte, else only at the first; ``backwards`` reads texts from the end."""
    choices = _Choices()
    start = choices.state()
    ends = {}
    for number, rule in enumerate(rules):
        entry = choices.state()
        choices.empty[start].append(entry)
        ends[choices.add(list(parser.parse(rule.encode())), entry, backwards)] = 1 << number
    sets = {move[0] for move in choices.moves if move}
    signatures = [tuple(byte in x for x in sets) for byte in range(256)]
    order = {signature: i for i, signature in enumerate(dict.fromkeys(signatures))}
    classes = np.array([order[s] for s in signatures], np.uint8)
    samples = [signatures.index(s) for s in order]

    restart = choices.closure({start})
    known, todo, step = {restart: 0}, [restart], []
    while todo:
        here = todo.pop(0)
        row = []
        for byte in samples:
            after = {m[1] for m in (choices.moves[s] for s in here) if m and byte in m[0]}
            after = choices.closure(after) | (restart if anywhere else frozenset())
            if after not in known:
                known[after] = len(known)
                todo.append(after)
            row.append(known[after])
        step.append(row)
    accepts = [sum(ends.get(s, 0) for s in states) for states in known]
    return _minimal(np.array(step, np.int32), np.array(accepts, np.int64), classes)


def _minimal(step: np.ndarray, accepts: np.ndarray, classes: np.ndarray) -> Automaton:
    """States apart only by what they accept at first, then by where they lead."""
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        keys = np.column_stack((group, group[step]))
        finer = np.unique(keys, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    first = {}
    for state, g in enumerate(group):
        first.setdefault(int(g), state)
    number = {g: i for i, g in enumerate(first)}  # the start's group comes first
    renamed = np.array([number[int(g)] for g in group], np.int32)
    kept = list(first.values())
    return Automaton(renamed[step[kept]], classes, accepts[kept])


def either_case(word: str) -> str:
    """``word`` with each ASCII letter in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else re.escape(c) for c in word)
