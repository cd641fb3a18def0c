"""Rule regexes compiled into one minimal byte automaton.

``compile_rules`` parses each rule (literals, ``\\xHH``, classes, groups, ``|``, ``? * + {m,n}``),
joins all of them in one Thompson automaton, determinises it by subset construction over byte
classes, and minimises it by partition refinement. The result is a transition array
``step[state, byte class]`` whose accepting states carry a bit per rule.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``head`` then ``body``; ``least`` bytes of the body (or of the match)."""

    kind: str
    head: str
    body: str
    least: int
    whole: bool = True  # the length that counts is that of the match, else of the body
    fold: bool = False  # ASCII letters of the head in either case


class _Nfa:
    def __init__(self):
        self.eps: list[list[int]] = []
        self.edges: list[list[tuple[int, int]]] = []  # (byte mask, target)

    def state(self) -> int:
        self.eps.append([])
        self.edges.append([])
        return len(self.eps) - 1


class _Parser:
    """Recursive descent over one regex; fragments are (start, end) pairs of ``nfa``."""

    def __init__(self, nfa: _Nfa, pattern: str, fold: bool):
        self.nfa, self.p, self.i, self.fold = nfa, pattern, 0, fold

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def alternatives(self):
        start, end = self.nfa.state(), self.nfa.state()
        while True:
            a, b = self.sequence()
            self.nfa.eps[start].append(a)
            self.nfa.eps[b].append(end)
            if self.peek() != "|":
                return start, end
            self.take()

    def sequence(self):
        start = end = self.nfa.state()
        while self.peek() not in ("", "|", ")"):
            a, b = self.repeated()
            self.nfa.eps[end].append(a)
            end = b
        return start, end

    def repeated(self):
        begin = self.i
        frag = self.atom()
        stop = self.i
        low, high = 1, 1
        if self.peek() == "?":
            self.take()
            low, high = 0, 1
        elif self.peek() in ("*", "+"):
            low, high = int(self.take() == "+"), None
        elif self.peek() == "{":
            close = self.p.index("}", self.i)
            a, _, b = self.p[self.i + 1:close].partition(",")
            low, high = int(a), (int(b) if b else None if "," in self.p[self.i:close] else int(a))
            self.i = close + 1
        resume = self.i
        if (low, high) == (1, 1):
            return frag

        def again():
            self.i = begin
            out = self.atom()
            assert self.i == stop
            self.i = resume
            return out

        start = end = self.nfa.state()
        frags = [frag]
        while len(frags) < max(low, high or 1):
            frags.append(again())
        done = self.nfa.state()
        for k, (a, b) in enumerate(frags):
            if k >= low:
                self.nfa.eps[end].append(done)
            self.nfa.eps[end].append(a)
            end = b
        if high is None:
            self.nfa.eps[end].append(frags[-1][0])
            if low == 0:
                self.nfa.eps[start].append(done)
        self.nfa.eps[end].append(done)
        return start, done

    def atom(self):
        c = self.take()
        if c == "(":
            if self.p.startswith("?:", self.i):
                self.i += 2
            frag = self.alternatives()
            assert self.take() == ")"
            return frag
        mask = self.char_class() if c == "[" else 1 << self.escaped(c)
        if self.fold:
            for up in range(65, 91):
                if mask >> up & 1 or mask >> (up + 32) & 1:
                    mask |= 1 << up | 1 << (up + 32)
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.edges[a].append((mask, b))
        return a, b

    def escaped(self, c: str) -> int:
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def char_class(self) -> int:
        mask, first = 0, True
        while self.peek() != "]" or first:
            first = False
            low = self.escaped(self.take())
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                for x in range(low, self.escaped(self.take()) + 1):
                    mask |= 1 << x
            else:
                mask |= 1 << low
        self.take()
        return mask


@dataclass
class Dfa:
    """``step[state * n_classes + classes[byte]]`` is the next state; state 0 starts.

    States from ``first_accepting`` on accept; ``accepts[state]`` has a bit for each pattern.
    ``resets``: bytes after which every state is state 0. State -1 never occurs; a dead state
    of an anchored automaton is ``dead``.
    """

    step: np.ndarray
    classes: np.ndarray
    n_classes: int
    accepts: np.ndarray
    first_accepting: int
    resets: np.ndarray
    dead: int

    def __post_init__(self):
        self.rows = self.step.reshape(-1, self.n_classes)[:, self.classes].tolist() \
            if len(self.accepts) <= 512 else None


def build(patterns: list[list[tuple[str, bool]]], anchored: bool, reverse: bool = False) -> Dfa:
    """The minimal DFA of patterns, each a list of (regex, fold case) pieces in sequence."""
    nfa = _Nfa()
    starts, accepts = [], []
    for pieces in patterns:
        start = end = nfa.state()
        for text, fold in pieces:
            parser = _Parser(nfa, text, fold)
            a, b = parser.alternatives()
            assert parser.i == len(text), text
            nfa.eps[end].append(a)
            end = b
        starts.append(start)
        accepts.append(end)
    if reverse:
        eps: list = [[] for _ in nfa.eps]
        edges: list = [[] for _ in nfa.edges]
        for s, ts in enumerate(nfa.eps):
            for t in ts:
                eps[t].append(s)
        for s, es in enumerate(nfa.edges):
            for m, t in es:
                edges[t].append((m, s))
        nfa.eps, nfa.edges, starts, accepts = eps, edges, accepts, starts

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    # byte classes: bytes that every edge treats alike
    masks = sorted({m for es in nfa.edges for m, _ in es})
    key = [tuple(m >> b & 1 for m in masks) for b in range(256)]
    names = {k: i for i, k in enumerate(dict.fromkeys(key))}
    classes = np.array([names[k] for k in key], np.uint8)
    example = [key.index(k) for k in names]
    after = [[0] * len(names) for _ in nfa.edges]  # bit set of states reached, closed
    closed = [sum(1 << t for t in closure([s])) for s in range(len(nfa.eps))]
    for s, es in enumerate(nfa.edges):
        for m, t in es:
            for c, byte in enumerate(example):
                if m >> byte & 1:
                    after[s][c] |= closed[t]
    moving = sum(1 << s for s, es in enumerate(nfa.edges) if es)
    begin = 0
    for s in starts:
        begin |= closed[s]
    ends = [1 << a for a in accepts]
    keep = moving | sum(set(ends))
    found = {begin & keep: 0}
    order = [begin & keep]
    table = []
    for bits in order:
        row = [0 if anchored else begin] * len(names)
        rest = bits & moving
        while rest:
            low = rest & -rest
            rest ^= low
            row = [x | y for x, y in zip(row, after[low.bit_length() - 1])]
        out = []
        for x in row:
            x &= keep
            if x not in found:
                found[x] = len(order)
                order.append(x)
            out.append(found[x])
        table.append(out)
    step = np.array(table, np.int32)
    bit = np.array([sum(1 << r for r, e in enumerate(ends) if x & e) for x in order], np.int64)
    # minimise: split blocks until all states of a block go to the same blocks
    block = np.unique(bit, return_inverse=True)[1].ravel()
    while True:
        sig = np.column_stack([block, block[step]])
        new = np.unique(sig, axis=0, return_inverse=True)[1].ravel()
        if new.max() == block.max():
            break
        block = new
    one = np.unique(block, return_index=True)[1]
    step, bit, start = block[step[one]], bit[one], block[0]
    rank = np.argsort(np.lexsort((np.arange(len(one)) != start, bit != 0)))
    back = np.argsort(rank)
    step, bit = rank[step[back]], bit[back]
    resets = np.flatnonzero((step == 0).all(axis=0)[classes])
    dead = next((s for s in range(len(bit)) if not bit[s] and (step[s] == s).all()), -1)
    return Dfa(step.ravel().astype(np.int32), classes, len(names), bit,
               int((bit == 0).sum()), resets, dead)


class Scanner:
    """All rules in one automaton, and small ones per rule that place each match."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        pieces = [[(r.head, r.fold), (r.body, False)] for r in rules]
        self.search = build(pieces, anchored=False)
        self.forward = [build([p], anchored=True) for p in pieces]
        self.backward = [build([p], anchored=False, reverse=True) for p in pieces]
        self.heads = [build([[(r.head, r.fold)]], anchored=True) for r in rules]
        self.bodies = [build([[(r.body, False)]], anchored=True) for r in rules]
        if 10 not in self.search.resets:
            raise ValueError("no rule may match across a line end")
        if self.search.first_accepting == 0:
            raise ValueError("a rule matches the empty string")
        self.search.rows = None

    def hits(self, text: np.ndarray, lane: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """(last byte, state) wherever some rule has a match end; ``text`` ends with a reset.

        The text is cut into lanes behind reset bytes, where the state is known to be 0, and
        all lanes advance together by one gather a byte.
        """
        d = self.search
        code = d.classes[text]
        reset = np.zeros(256, bool)
        reset[d.resets] = True
        cuts = np.flatnonzero(reset[text]) + 1
        begin = np.arange(0, len(text), lane)
        at = np.unique(np.append(0, cuts[np.minimum(np.searchsorted(cuts, begin), len(cuts) - 1)]))
        at = at[at < len(text)]
        sizes = np.diff(np.append(at, len(text)))
        by_size = np.argsort(-sizes, kind="stable")
        at, sizes = at[by_size], sizes[by_size]
        live = len(at) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0]) if len(at) else 0), "right")
        state = np.zeros(len(at), np.int32)
        pos = at.copy()
        where, what = [], []
        for n in live.tolist():
            s = d.step[state[:n] * d.n_classes + code[pos[:n]]]
            state[:n] = s
            if s.max() >= d.first_accepting:
                found = np.flatnonzero(s >= d.first_accepting)
                where.append(pos[found])
                what.append(s[found])
            pos[:n] += 1
        if not where:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        where, what = np.concatenate(where), np.concatenate(what)
        o = np.argsort(where)
        return where[o], what[o]

    def place(self, rule: int, text: bytes) -> list[tuple[int, int]]:
        """Leftmost-longest non-overlapping matches of one rule in a short text, long enough."""
        back, ahead, r = self.backward[rule], self.forward[rule], self.rules[rule]
        state, starts = 0, []
        for i in range(len(text) - 1, -1, -1):
            state = back.rows[state][text[i]]
            if state >= back.first_accepting:
                starts.append(i)
        found, after = [], 0
        for s in reversed(starts):
            if s < after:
                continue
            state, end = 0, s
            for i in range(s, len(text)):
                state = ahead.rows[state][text[i]]
                if state == ahead.dead:
                    break
                if state >= ahead.first_accepting:
                    end = i + 1
            after = end
            if (end - s if r.whole else self._body(rule, text[s:end])) >= r.least:
                found.append((s, end))
        return found

    def _body(self, rule: int, match: bytes) -> int:
        """Length of the body behind the shortest head that leaves a body."""
        head, body, state = self.heads[rule], self.bodies[rule], 0
        for i, byte in enumerate(match):
            state = head.rows[state][byte]
            if state >= head.first_accepting:
                s = 0
                for b in match[i + 1:]:
                    s = body.rows[s][b]
                if s >= body.first_accepting:
                    return len(match) - i - 1
        return 0
