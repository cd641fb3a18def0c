"""Runs of repeated words by a suffix automaton with link-cut access.

The words of a stretch are put into a suffix automaton. Its suffix links are a tree; the path from
a prefix's state to the root holds all suffixes of that prefix, longest first. Every state is
coloured with the place where its strings ended last. The words are then taken one after another
on the finished tree: word ``i`` accesses the path of prefix ``i``, and a link-cut tree (splay
trees over paths of one colour) hands out the path's segments and recolours the whole path to
``i``. A segment of colour ``j`` whose longest string has ``m`` words says that the longest common
suffix of the prefixes ``i`` and ``j`` has ``m`` words; with ``d = i - j <= m`` that is a square of
period ``d`` whose left end is ``j - m + 1``. The most recent place of a root of smallest period
``d`` is exactly ``d`` words back, so every run is met and no multiple of its period is. A square
long enough is extended to the right by comparing words ``d`` apart.

Only stretches that can hold a run go through the automaton: a run of period q and at least
``max(6, 4q)`` words is covered by five-word sequences that occur again q words later, and q is at
most a quarter of the stretch. Positions without such a recurrence split a text; splitting is
repeated until nothing changes. This loses no run.

Every text is one unit of work inside a task and nothing is shuffled; memory is bounded by the
longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quotalens.llm.common import id_text, steps

SHORTEST = 6   # words of a run, at least
TIMES = 4      # periods of a run, at least
GRAM = SHORTEST - 1
EDIT_SHARE = 10

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
    ("collapsed_sha256", pa.string())])


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(link, longest, ends): suffix links and longest lengths by state, the state of each prefix.

    State 1 is the root (the empty string), 0 means none.
    """
    link, longest, step = [0, 0], [0, 0], [{}, {}]
    ends, last = [], 1
    for w in words:
        state = len(link)
        longest.append(longest[last] + 1)
        step.append({})
        link.append(1)
        p = last
        while p and w not in step[p]:
            step[p][w] = state
            p = link[p]
        if p:
            q = step[p][w]
            if longest[q] == longest[p] + 1:
                link[state] = q
            else:
                clone = len(link)
                longest.append(longest[p] + 1)
                step.append(step[q].copy())
                link.append(link[q])
                while p and step[p].get(w) == q:
                    step[p][w] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
        ends.append(state)
    return link, longest, ends


class Paths:
    """Link-cut paths over the suffix links: each splay tree is a path of one colour.

    Nodes of a splay tree are ordered by depth. Its root holds the colour (0: no place yet) and,
    as father, the state above the path's top.
    """

    def __init__(self, link: list[int]):
        n = len(link)
        self.father = list(link)
        self.upper = [0] * n
        self.lower = [0] * n
        self.colour = [0] * n

    def _lift(self, x: int) -> None:
        """Rotate ``x`` above its father, which stays in the same splay tree."""
        father, upper, lower = self.father, self.upper, self.lower
        y = father[x]
        z = father[y]
        if upper[y] == x:
            inner = lower[x]
            upper[y], lower[x] = inner, y
        else:
            inner = upper[x]
            lower[y], upper[x] = inner, y
        if inner:
            father[inner] = y
        father[y], father[x] = x, z
        if upper[z] == y:
            upper[z] = x
        elif lower[z] == y:
            lower[z] = x
        else:  # y was the root
            self.colour[x] = self.colour[y]

    def _splay(self, x: int) -> None:
        father, upper, lower = self.father, self.upper, self.lower
        while True:
            y = father[x]
            if not y or (upper[y] != x and lower[y] != x):
                return
            z = father[y]
            if z and (upper[z] == y or lower[z] == y):
                self._lift(y if (upper[y] == x) == (upper[z] == y) else x)
            self._lift(x)

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """(colour, deepest state) of the segments from ``x`` to the root; the path takes ``colour``."""
        father, lower = self.father, self.lower
        found, below = [], 0
        while x:
            self._splay(x)
            c = self.colour[x]
            if c:
                found.append((c, x))
            if lower[x]:  # what lies deeper leaves the path and keeps its colour
                self.colour[lower[x]] = c
            lower[x] = below
            below, x = x, father[x]
        self.colour[below] = colour
        return found


def stretch_runs(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one stretch of word numbers."""
    link, longest, ends = suffix_automaton(words)
    paths = Paths(link)
    out, done = [], {}
    n = len(words)
    for i, state in enumerate(ends, 1):  # places are counted from 1: 0 means none
        for j, deepest in paths.access(state, i):
            d, m = i - j, longest[deepest]
            if m < (TIMES - 1) * d or m + d < SHORTEST or done.get(d, 0) >= i:
                continue
            end = i
            while end < n and words[end] == words[end - d]:
                end += 1
            done[d] = end
            out.append((j - m, end - j + m, d))
    return out


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches [a, b) outside which no run has a word."""
    todo, out = [(0, len(words))], []
    if len(words) < SHORTEST:
        return out
    gram = words[:len(words) - GRAM + 1].astype(np.uint64)
    for k in range(1, GRAM):  # equal sequences have equal numbers; others may
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + words[k:len(words) - GRAM + 1 + k].astype(np.uint64)
    while todo:
        a, b = todo.pop()
        if b - a < SHORTEST:
            continue
        own = gram[a:b - GRAM + 1]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        same &= order[1:] - order[:-1] <= (b - a) // TIMES
        hit = np.zeros(len(own) + 1, bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        hit[-1] = False
        if not hit.any():
            continue
        at = np.flatnonzero(hit)
        new = np.flatnonzero(np.diff(at) > GRAM)  # words that no hit covers lie between
        begins = at[np.append(0, new + 1)]
        stops = at[np.append(new, len(at) - 1)] + GRAM
        if len(begins) == 1 and begins[0] == 0 and stops[0] == b - a:
            out.append((a, b))
        else:
            todo += [(a + x, a + y) for x, y in zip(begins.tolist(), stops.tolist())]
    return out


def runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text's words, by start, then period."""
    if len(words) < SHORTEST:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return []
    return sorted((a + s, n, d) for a, b in stretches(ids)
                  for s, n, d in stretch_runs(ids[a:b].tolist()))


def edited(words: list, doc_id: int | None) -> list:
    """The contract's planted repeats: by the id's checksum a tail becomes a repeated phrase."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % EDIT_SHARE:
        return words
    g, n = h // EDIT_SHARE, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    phrase = words[a:a + p]
    return words[:a] + (phrase * (-(-(n - a) // len(phrase))))[:n - a]


def collapse(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not found:
        return words
    level = np.zeros(len(words) + 1, np.int64)
    for s, n, d in found:
        level[s + d] += 1
        level[s + n] -= 1
    keep = np.cumsum(level[:-1]) == 0
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def _row(doc_id: int | None, text: str) -> tuple:
    words = edited(text.encode().split(), doc_id)  # ASCII white space only
    found = runs(words)
    listed = "".join(f"{s},{n},{d}\n" for s, n, d in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapse(words, found))).hexdigest())


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its number of runs, the longest one, digests of all runs and of
    the text without repeats.

    Null and empty texts have no words and no run; a null id is never edited. Repeated rows get
    equal results, an empty table gives no rows, other columns are ignored. Of equally long runs
    the first counts, then the smaller period.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            made = [_row(i, t) for i, t in zip(b.column("doc_id").to_pylist(),
                                              b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*made), SCHEMA)], schema=SCHEMA)

    return id_text(docs).mapInArrow(run, (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"))


def op12(docs: DataFrame) -> DataFrame:
    return periodic_runs(docs)
