"""Rules as one deterministic automaton over bytes.

A rule is a regular expression over ASCII: literals, ``\\xHH`` and other escapes,
classes, groups, ``(?i:...)``, ``|``, ``?``, ``*``, ``+`` and ``{m,n}``. Expressions
become states with byte sets, subset construction makes them deterministic, and
states that no continuation tells apart are merged. The result is two arrays: the
next state for each state and byte, and for each state the rules it accepts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALL = (1 << 256) - 1


def _set_of(chars) -> int:
    out = 0
    for c in chars:
        out |= 1 << c
    return out


def _either_case(bits: int) -> int:
    for upper in range(0x41, 0x5B):
        pair = (1 << upper) | (1 << (upper + 0x20))
        if bits & pair:
            bits |= pair
    return bits


def parse(pattern: str):
    """A nested tuple: ("set", bits), ("cat", parts), ("or", parts) or ("rep", part, least, most or None)."""
    at = 0

    def peek():
        return pattern[at] if at < len(pattern) else ""

    def take():
        nonlocal at
        at += 1
        return pattern[at - 1]

    def escaped() -> int:
        c = take()
        if c == "x":
            return int(take() + take(), 16)
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def klass(fold: bool) -> int:
        negated = peek() == "^" and bool(take())
        bits, members = 0, []
        while peek() != "]":
            c = take()
            members.append(escaped() if c == "\\" else ord(c))
            if peek() == "-" and pattern[at + 1] != "]":
                take()
                c = take()
                bits |= _set_of(range(members.pop(), (escaped() if c == "\\" else ord(c)) + 1))
        take()
        bits |= _set_of(members)
        bits = _either_case(bits) if fold else bits
        return ALL & ~bits if negated else bits

    def atom(fold: bool):
        c = take()
        if c == "(":
            inner = fold
            if pattern.startswith("?i:", at) or pattern.startswith("?:", at):
                inner = fold or pattern[at + 1] == "i"
                while take() != ":":
                    pass
            out = choice(inner)
            take()
            return out
        if c == "[":
            return ("set", klass(fold))
        bits = 1 << (escaped() if c == "\\" else ord(c))
        return ("set", _either_case(bits) if fold else bits)

    def piece(fold: bool):
        out = atom(fold)
        while peek() and peek() in "?*+{":
            c = take()
            if c == "{":
                spec = ""
                while peek() != "}":
                    spec += take()
                take()
                least, comma, most = spec.partition(",")
                out = ("rep", out, int(least), (int(most) if most else None) if comma else int(least))
            else:
                out = ("rep", out, int(c == "+"), 1 if c == "?" else None)
        return out

    def choice(fold: bool):
        options, parts = [], []
        while peek() and peek() != ")":
            if peek() == "|":
                take()
                options.append(("cat", parts))
                parts = []
            else:
                parts.append(piece(fold))
        options.append(("cat", parts))
        return options[0] if len(options) == 1 else ("or", options)

    tree = choice(False)
    if at < len(pattern):
        raise ValueError(f"unbalanced group in {pattern!r}")
    return tree


def reverse(tree):
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", reverse(tree[1]), *tree[2:])
    parts = [reverse(p) for p in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _States:
    def __init__(self):
        self.free: list[list[int]] = []  # next states without a byte
        self.steps: list[tuple[int, int] | None] = []  # (bytes, next state)

    def new(self) -> int:
        self.free.append([])
        self.steps.append(None)
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """States for the tree from ``start``; returns the state behind it."""
        kind = tree[0]
        if kind == "set":
            inner, end = self.new(), self.new()
            self.free[start].append(inner)
            self.steps[inner] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        end = self.new()
        if kind == "or":
            for part in tree[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.new()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
            return end
        for _ in range(most - least):
            self.free[start].append(end)
            start = self.add(part, start)
        self.free[start].append(end)
        return end


@dataclass
class Automaton:
    """``step[state, byte]`` is the next state; ``accepts[state]`` indexes ``rules``; 0 is the start."""

    step: np.ndarray
    accepts: np.ndarray
    rules: list[tuple[int, ...]]


def compile_rules(trees: list, search: bool) -> Automaton:
    """One minimal automaton for all rules; with ``search`` a match may begin anywhere."""
    states = _States()
    start = states.new()
    ends = {}
    for k, tree in enumerate(trees):
        ends.setdefault(states.add(tree, start), []).append(k)

    def closure(found: set[int]) -> frozenset[int]:
        todo = list(found)
        while todo:
            for nxt in states.free[todo.pop()]:
                if nxt not in found:
                    found.add(nxt)
                    todo.append(nxt)
        return frozenset(found)

    # bytes that no state tells apart share a column
    of_byte = np.zeros(256, dtype=np.int64)
    for step in states.steps:
        if step is not None:
            member = np.array([step[0] >> b & 1 for b in range(256)])
            of_byte = np.unique(of_byte * 2 + member, return_inverse=True)[1]
    columns = [int(np.flatnonzero(of_byte == c)[0]) for c in range(of_byte.max() + 1)]

    first = closure({start})
    number, rows, accepted = {first: 0}, [], []
    todo = [first]
    for subset in todo:
        accepted.append(tuple(sorted(k for s in subset for k in ends.get(s, ()))))
        row = []
        for byte in columns:
            hit = {states.steps[s][1] for s in subset if states.steps[s] and states.steps[s][0] >> byte & 1}
            target = closure(hit | {start} if search else hit)
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    step = np.array(rows, dtype=np.int64)
    kinds = sorted(set(accepted), key=lambda a: (len(a), a))
    if kinds[0] != ():
        kinds.insert(0, ())
    accepts = np.array([kinds.index(a) for a in accepted])

    # minimise: split classes of states until all members of a class lead to the same classes
    group = accepts.copy()
    while True:
        signature = np.column_stack([group, group[step]])
        finer = np.unique(signature, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    order = np.unique(group, return_index=True)[1]  # a member of each class
    rename = np.arange(len(order))
    rename[group[0]], rename[0] = 0, group[0]  # the start comes first
    merged = np.empty((len(order), 256), dtype=np.int32)
    kept = np.empty(len(order), dtype=np.int32)
    merged[rename] = rename[group[step[order]]][:, of_byte]
    kept[rename] = accepts[order]
    return Automaton(merged, kept, kinds)
