"""Regular expressions to one minimal deterministic byte automaton.

A small subset is enough for scanning rules: literals, classes, groups, ``|``, ``? * + {m} {m,} {m,n}``
and ``(?i:...)`` for ASCII letters. Thompson construction, subset construction with an implied ``.*``
in front, then minimisation by partition refinement; the result is one transition array over byte
classes and, per state, the set of rules (a bit mask) that have a match ending there.
"""

from __future__ import annotations

import numpy as np


class _Nfa:
    def __init__(self):
        self.eps: list[list[int]] = []
        self.arc: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.arc.append(None)
        return len(self.eps) - 1


#: With so few segments left, stepping them together costs more than one after the other.
_FEW = 12
_ESCAPES = {"n": 10, "t": 9, "r": 13}


class _Parser:
    """Builds fragments (start, end) of an automaton straight from the pattern."""

    def __init__(self, nfa: _Nfa, pattern: str):
        self.n, self.p, self.at = nfa, pattern, 0

    def peek(self) -> str:
        return self.p[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.p[self.at - 1]

    def alternatives(self, fold: bool):
        parts = [self.sequence(fold)]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence(fold))
        if len(parts) == 1:
            return parts[0]

        def build():
            s, e = self.n.state(), self.n.state()
            for f in parts:
                a, b = f()
                self.n.eps[s].append(a)
                self.n.eps[b].append(e)
            return s, e

        return build

    def sequence(self, fold: bool):
        items = []
        while self.peek() and self.peek() not in "|)":
            items.append(self.repeated(fold))

        def build():
            s = e = self.n.state()
            for f in items:
                a, b = f()
                self.n.eps[e].append(a)
                e = b
            return s, e

        return build

    def repeated(self, fold: bool):
        atom = self.atom(fold)
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                end = self.p.index("}", self.at)
                low, _, high = self.p[self.at : end].partition(",")
                bounds = (int(low), int(high) if high else None if "," in self.p[self.at : end] else int(low))
                self.at = end + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            atom = self.times(atom, *bounds)
        return atom

    def times(self, atom, low: int, high: int | None):
        def build():
            s = e = self.n.state()
            for _ in range(low):
                a, b = atom()
                self.n.eps[e].append(a)
                e = b
            if high is None:
                a, b = atom()
                loop = self.n.state()
                self.n.eps[e].append(loop)
                self.n.eps[loop].append(a)
                self.n.eps[b].append(loop)
                return s, loop
            last = self.n.state()
            for _ in range(high - low):
                self.n.eps[e].append(last)
                a, b = atom()
                self.n.eps[e].append(a)
                e = b
            self.n.eps[e].append(last)
            return s, last

        return build

    def atom(self, fold: bool):
        c = self.take()
        if c == "(":
            if self.p.startswith("?i:", self.at):
                self.at, fold = self.at + 3, True
            elif self.p.startswith("?:", self.at):
                self.at += 2
            inner = self.alternatives(fold)
            assert self.take() == ")", self.p
            return inner
        chars = self.char_class() if c == "[" else frozenset([self.escaped() if c == "\\" else ord(c)])
        if fold:
            chars |= frozenset(x ^ 32 for x in chars if chr(x).isascii() and chr(x).isalpha())

        def build():
            s, e = self.n.state(), self.n.state()
            self.n.arc[s] = (chars, e)
            return s, e

        return build

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.p[self.at - 2 : self.at], 16)
        return _ESCAPES.get(c, ord(c))

    def char_class(self) -> frozenset:
        out, no = set(), self.peek() == "^"
        self.at += no
        while self.peek() != "]":
            c = self.take()
            low = self.escaped() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.p[self.at + 1] != "]":
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else ord(c)
            out.update(range(low, high + 1))
        self.take()
        return frozenset(range(256)) - out if no else frozenset(out)


class Automaton:
    """``step[state * 256 + byte]`` is the next state, ``rules[state]`` the mask of rules ending there.

    State 0 is the start. ``resets[byte]``: every state goes to the start on that byte, so that no match
    of any rule contains it and text may be cut there.
    """

    def __init__(self, patterns: list[str]):
        nfa, starts, ends = _Nfa(), [], {}
        for k, p in enumerate(patterns):
            parser = _Parser(nfa, p)
            s, e = parser.alternatives(False)()
            assert parser.at == len(p), p
            starts.append(s)
            ends[e] = k
        classes, width = self._byte_classes(nfa)
        table, masks = self._subsets(nfa, starts, ends, classes, width)
        table, masks = self._minimal(table, masks)
        self.n_states = len(masks)
        self.step = table[:, classes].astype(np.int32).ravel()
        self.rules = np.array(masks, np.int64)
        full = self.step.reshape(-1, 256)
        self.resets = (full == 0).all(0) & (self.rules[0] == 0)

    @staticmethod
    def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, int]:
        seen: dict = {}
        sets = sorted({a[0] for a in nfa.arc if a}, key=sorted)
        out = np.array([seen.setdefault(tuple(b in s for s in sets), len(seen)) for b in range(256)])
        return out, len(seen)

    @staticmethod
    def _subsets(nfa, starts, ends, classes, width):
        sample = [int(np.flatnonzero(classes == c)[0]) for c in range(width)]

        def close(states):
            todo, out = list(states), set(states)
            while todo:
                for x in nfa.eps[todo.pop()]:
                    if x not in out:
                        out.add(x)
                        todo.append(x)
            return out

        begin = close(starts)
        keep = lambda s: frozenset(x for x in s if nfa.arc[x] or x in ends)
        start = keep(begin)
        ids, order, table = {start: 0}, [start], []
        for now in order:
            row = []
            for b in sample:
                to = keep(close({nfa.arc[x][1] for x in now if nfa.arc[x] and b in nfa.arc[x][0]}) | begin)
                if to not in ids:
                    ids[to] = len(order)
                    order.append(to)
                row.append(ids[to])
            table.append(row)
        return np.array(table), [sum(1 << ends[x] for x in s if x in ends) for s in order]

    @staticmethod
    def _minimal(table: np.ndarray, masks: list[int]):
        block = np.unique(masks, return_inverse=True)[1].ravel()
        while True:
            rows = np.column_stack((block, block[table]))
            new = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
            if new.max() == block.max():
                break
            block = new
        first = np.unique(block, return_index=True)[1]
        order = np.argsort(first, kind="stable")  # the block of the old start comes first
        name = np.empty_like(order)
        name[order] = np.arange(len(order))
        return name[block[table[first[order]]]], [masks[x] for x in first[order]]

    def scan(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, rules) of every byte of the segments data[start:stop] on which some rule's match ends, in
        order; all segments step together, each byte once."""
        size = stops - starts
        order = np.argsort(-size, kind="stable")
        at, left = starts[order].copy(), size[order]
        state = np.zeros(len(at), np.int32)
        spots, masks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        alive = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        for n in alive.tolist():  # n segments are longer than the number of steps so far
            if n <= _FEW:
                break
            s = self.step[(state[:n] << 8) | data[at[:n]]]
            state[:n] = s
            met = self.rules[s]
            if met.any():
                hit = np.flatnonzero(met)
                spots.append(at[hit])
                masks.append(met[hit])
            at[:n] += 1
        for k in np.flatnonzero(at < stops[order]).tolist():  # few long ones: byte by byte
            found = self._walk(int(state[k]), data[at[k] : stops[order[k]]])
            spots.append(np.array([x for x, _ in found], np.int64) + at[k])
            masks.append(np.array([x for _, x in found], np.int64))
        spot, mask = np.concatenate(spots), np.concatenate(masks)
        order = np.argsort(spot)
        return spot[order], mask[order]

    def _walk(self, state: int, data: np.ndarray) -> list[tuple[int, int]]:
        (step, rules), found, s = self._lists(), [], state
        for k, b in enumerate(data.tobytes()):
            s = step[s][b]
            if rules[s]:
                found.append((k, rules[s]))
        return found

    def _lists(self):
        if not hasattr(self, "_as_lists"):
            self._as_lists = self.step.reshape(-1, 256).tolist(), self.rules.tolist()
        return self._as_lists
