"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all passages (``SPAN`` words) of all documents.
2. A randomised SVD of the TF-IDF passage matrix A: every partition adds up its rows of
   A'(A Omega), Spark sums them by feature, and the driver's Nystroem step on this features x rank
   matrix (a fixed size) gives the leading right singular vectors and values.
3. Every document window is folded into the latent space and compared with all benchmark windows;
   cosines above ``COSINE`` are candidates. Items of fewer than ``SHORT`` words would be lost among
   the words of a full window, so they are compared with windows of ``SHORT`` words.
4. A candidate's neighbourhood is aligned with the item: longest common subsequence of words
   against the item's length, and against its answer (its last sentence). Neighbourhoods that
   share fewer words with the item than any accepted subsequence has are not aligned; these numbers
   are counted for all candidates of an item at once.

The benchmark is the stated query set: it is read in blocks of ``BLOCK`` items, each of them
against all documents. Documents are read three times and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import flat, id_text, ragged_arange, steps, words_of

FEATURE_BITS = 13
FEATURES = 1 << FEATURE_BITS
RANK = 48
SPAN = 32          # words of a window
STRIDE = 16        # of document windows; benchmark windows start every ITEM_STRIDE words
ITEM_STRIDE = 4
SHORT = 10         # items of fewer words, and the words of the windows they are compared with
SHORT_STRIDE = 3
COSINE = 0.5
SHARE = 0.6        # of an item's words, in order, that make a leak
ANSWERED = 0.45    # enough if the answer is there too
ANSWER = 0.8
BLOCK = 4096
PIECE = 16
LOOKUP = 4         # cost of looking up one word's places in one range, against that of passing one place
_SEED = 11


def _feature(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _entries(passage: np.ndarray, feature: np.ndarray):
    """Distinct (passage, feature) pairs in passage order, and their counts."""
    key = (passage << FEATURE_BITS) + feature
    if len(key) and key.max() < 1 << 31:
        key = key.astype(np.int32)  # sorts in half the time
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.append(first, len(key)))
    key = key[first].astype(np.int64)
    return key >> FEATURE_BITS, key & (FEATURES - 1), tf


def _passages(at: np.ndarray) -> np.ndarray:
    """Passage number of each word: texts cut every SPAN words."""
    counts = np.diff(at)
    per = -(-counts // SPAN)
    first = np.cumsum(per) - per
    return np.repeat(first, counts) + ragged_arange(counts) // SPAN


_LOG = 1 + np.log(np.maximum(1, np.arange(SPAN + 1)))  # by a word's occurrences in a passage


def _weights(p: np.ndarray, f: np.ndarray, tf: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """TF-IDF weights, every passage of length one."""
    w = _LOG[tf] * idf[f]
    norm = np.sqrt(np.bincount(p, weights=w * w, minlength=n))
    return (w / np.maximum(norm[p], 1e-12)).astype(np.float32)


def _dense(group: np.ndarray, index: np.ndarray, w: np.ndarray, table: np.ndarray, n: int,
           width: int) -> np.ndarray:
    """Weighted sums of table rows by group (sorted, at most ``width`` entries each)."""
    first = np.searchsorted(group, np.arange(n))
    pos = np.arange(len(group)) - first[group]
    at, weight = np.zeros((n, width), np.int64), np.zeros((n, width), np.float32)
    at[group, pos], weight[group, pos] = index, w
    out = np.empty((n, table.shape[1]), np.float32)
    for i in range(0, n, 1024):
        out[i:i + 1024] = np.matmul(weight[i:i + 1024, None], table[at[i:i + 1024]])[:, 0]
    return out


def _omega() -> np.ndarray:
    return np.random.default_rng(_SEED).normal(size=(FEATURES, RANK)).astype(np.float32)


def _spread(docs: DataFrame) -> DataFrame:
    """Fewer, larger partitions for passes whose result has a fixed size per partition."""
    return docs.coalesce(max(1, 4 * docs.sparkSession.sparkContext.defaultParallelism))


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each feature, and all passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(FEATURES, np.int64), 0
        for b in steps(batches):
            h, _, _, at = words_of(*flat(b.column("text")))
            if len(h):
                p = _passages(at)
                total += int(p[-1]) + 1
                df += np.bincount(_entries(p, _feature(h))[1], minlength=FEATURES)
        f = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"f": np.append(f, -1), "n": np.append(df[f], total)})

    rows = _spread(docs).mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    f, n = rows["f"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(FEATURES, np.int64)
    out[f[f >= 0]] = n[f >= 0]
    return out, int(n[f < 0].sum())


@dataclass
class Space:
    idf: np.ndarray    # [FEATURES]
    fold: np.ndarray   # [FEATURES, RANK] right singular vectors over singular values
    df: np.ndarray
    passages: int

    def rows(self, p: np.ndarray, f: np.ndarray, tf: np.ndarray, n: int) -> np.ndarray:
        """Unit latent vectors of n passages given by sorted (passage, feature, tf) entries."""
        out = np.zeros((n, RANK), np.float32)
        if len(p):
            out = _dense(p, f, _weights(p, f, tf, self.idf, n), self.fold, n, SPAN)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.maximum(norm, 1e-12)


def fit(docs: DataFrame) -> Space:
    """Latent space of all passages of ``docs`` (doc_id, text)."""
    df, total = frequencies(docs)
    idf = np.log((total + 1) / (df + 1)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, y = _omega(), np.zeros((FEATURES, RANK), np.float64)
        for b in steps(batches, max_bytes=1 << 20):
            h, _, _, at = words_of(*flat(b.column("text")))
            if not len(h):
                continue
            p, f, tf = _entries(_passages(at), _feature(h))
            n = int(p[-1]) + 1
            w = _weights(p, f, tf, idf, n)
            z = _dense(p, f, w, omega, n, SPAN)
            # by feature: sums of up to PIECE entries, then of those sums
            order = np.argsort(f.astype(np.uint16), kind="stable")
            fs = f[order]
            nth = np.arange(len(fs)) - np.searchsorted(fs, fs)
            piece = np.cumsum((nth % PIECE == 0)) - 1
            heads = np.flatnonzero(nth % PIECE == 0)
            sums = _dense(piece, p[order], w[order], z, len(heads), PIECE)
            of = fs[heads]
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            y[of[first]] += np.add.reduceat(sums, first, axis=0)
        f = np.flatnonzero(y.any(axis=1))
        yield pa.RecordBatch.from_pydict({"f": f, **{f"y{k}": y[f, k] for k in range(RANK)}})

    cols = [f"y{k}" for k in range(RANK)]
    rows = (_spread(docs).mapInArrow(run, "f long, " + ", ".join(f"{c} double" for c in cols))
            .groupBy("f").agg(*(F.sum(c).alias(c) for c in cols)).toArrow())
    y = np.zeros((FEATURES, RANK))
    y[rows["f"].to_numpy()] = np.column_stack([rows[c].to_numpy() for c in cols])
    return Space(idf, _nystroem(y), df, total)


def _nystroem(y: np.ndarray) -> np.ndarray:
    """V / sigma of A'A from y = A'A Omega: a shifted Nystroem factor and its thin SVD."""
    omega = _omega().astype(np.float64)
    shift = 1e-9 * max(np.linalg.norm(y), 1e-9)
    y = y + shift * omega
    core = omega.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    values = np.maximum(values, 1e-12 * max(values.max(initial=0), 1e-12))
    v, s, _ = np.linalg.svd(y @ (vectors / np.sqrt(values)), full_matrices=False)
    return (v / np.maximum(s, 1e-6 * max(s.max(initial=0), 1e-12))).astype(np.float32)


@dataclass
class Items:
    """A block of benchmark items, with the tables that the search needs."""

    ids: list
    words: list[list[int]]       # word hashes
    answers: list[list[int]]
    parts: list[tuple]           # (words of a document window, stride, latent item windows, their items)
    known: np.ndarray            # distinct words of all items, sorted
    kinds: list[tuple]           # of each item: its distinct words' places in known, their counts


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(raw, np.array([0, len(raw)]))[0]


def prepare(rows: list[tuple[int, str]], space: Space) -> Items:
    ids, words, answers = [], [], []
    full, short = ([], []), ([], [])
    for item, text in rows:
        h = _hashes(text or "")
        if not len(h):
            continue
        sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if len(_hashes(s))]
        k = len(ids)
        ids.append(item)
        words.append(h.tolist())
        answers.append(_hashes(sentences[-1]).tolist())
        wins, of = short if len(h) < SHORT else full
        for s in range(0, max(1, len(h) - SPAN + ITEM_STRIDE), ITEM_STRIDE):
            wins.append(h[s:s + SPAN])
            of.append(k)
    parts = []
    for span, stride, (wins, of) in ((SPAN, STRIDE, full), (SHORT, SHORT_STRIDE, short)):
        if wins:
            p = np.repeat(np.arange(len(wins)), [len(w) for w in wins])
            p, f, tf = _entries(p, _feature(np.concatenate(wins)))
            parts.append((span, stride, space.rows(p, f, tf, len(wins)), np.array(of, np.int64)))
    known = np.unique(np.array([x for w in words for x in w], np.uint64))
    kinds = [np.unique(np.searchsorted(known, np.array(w, np.uint64)), return_counts=True) for w in words]
    return Items(ids, words, answers, parts, known, kinds)


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence (bit-parallel over a)."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = where.get(x)
        if hit:
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


class Places:
    """Where the items' words stand in texts laid end to end."""

    def __init__(self, items: Items, h: np.ndarray):
        code = np.searchsorted(items.known, h)
        code[code == len(items.known)] = 0
        at = np.flatnonzero(items.known[code] == h)
        code = code[at]
        self.all = at                                   # of all items' words, ascending
        self.nth = np.argsort(code, kind="stable")      # by word: which of these
        self.at = at[self.nth]
        self.keyed = (code[self.nth] << 32) + self.at
        self.before = np.empty(len(at), np.int64)
        self.count = np.bincount(code, minlength=len(items.known))
        self.first = np.cumsum(self.count) - self.count

    def overlap(self, kinds: tuple, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Words that an item shares, with their repeats, with each range [low, high) of the texts:
        no common subsequence is longer.

        Few ranges look up the places of each word; many are counted in one pass over all places of
        the item's words.
        """
        which, c = kinds
        n = self.count[which]
        if LOOKUP * len(which) * len(low) < n.sum():
            return self._by_range(which, c, low, high)
        return self._by_place(which, c, n, low, high)

    def _by_range(self, which, c, low, high) -> np.ndarray:
        word = which[:, None] << 32
        inside = np.searchsorted(self.keyed, word + high) - np.searchsorted(self.keyed, word + low)
        return np.minimum(inside, c[:, None]).sum(axis=0)

    def _by_place(self, which, c, n, low, high) -> np.ndarray:
        """Of a word that the item has c times, the places in a range count whose c-th place before
        lies below the range; those are min(c, places in the range).
        """
        nth, c = ragged_arange(n), np.repeat(c, n)
        place = np.repeat(self.first[which], n) + nth
        # put at their place among all words, the item's places come out in ascending order
        own = np.zeros(len(self.all), bool)
        own[self.nth[place]] = True
        self.before[self.nth[place]] = np.where(nth >= c, self.at[place - np.minimum(nth, c)], -1)
        own = np.flatnonzero(own)
        places, before = self.all[own], self.before[own]
        begin = np.searchsorted(places, low)
        inside = np.searchsorted(places, high) - begin
        new = before[np.repeat(begin, inside) + ragged_arange(inside)] < np.repeat(low, inside)
        total = np.append(0, np.cumsum(new))
        end = np.cumsum(inside)
        return total[end] - total[end - inside]


def _verify(items: Items, k: int, near: list[int]) -> tuple[float, float] | None:
    """(share of the item, share of its answer) found in order in a neighbourhood, or None."""
    own, answer = items.words[k], items.answers[k]
    m = len(own)
    size = m + max(2, m // 4)
    if common(own, near) < min(SHARE, ANSWERED) * m:  # no part of it holds more
        return None
    best, place = 0, 0
    for s in range(0, max(1, len(near) - size + 1 + size // 8), max(1, size // 8)):
        found = common(own, near[s:s + size])
        if found > best:
            best, place = found, s
    share = common(answer, near[place:place + size]) / len(answer)
    if best >= SHARE * m or best >= ANSWERED * m and share >= ANSWER:
        return best / m, share
    return None


def _windows(counts: np.ndarray, span: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word in the text) of all windows: span words every stride words."""
    per = np.where(counts > 0, np.maximum(0, -(-(counts - span) // stride)) + 1, 0)
    return np.repeat(np.arange(len(counts)), per), ragged_arange(per) * stride


def leaks(docs: DataFrame, benchmark: DataFrame, space: Space | None = None) -> DataFrame:
    """(doc_id, item_id, cosine, share, answer): benchmark items found in documents.

    Null texts are empty; empty items match nothing; a repeated row gives its own matches; rows
    without an id keep a null id; other columns are ignored. Empty tables give no rows.
    """
    docs = id_text(docs)
    space = space or fit(docs)
    out = None
    for ship in item_blocks(benchmark, space):
        found = _search(docs, ship)
        out = found if out is None else out.union(found)
    return out


def item_blocks(benchmark: DataFrame, space: Space) -> Iterator:
    """The benchmark items with their vectors, a bounded block of the query set at a time (broadcast)."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            F.col("text").cast("string").alias("text"))
    n_blocks = -(-rows.count() // BLOCK) or 1
    for block in range(n_blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).toArrow()
        items = prepare(list(zip(part["item_id"].to_pylist(), part["text"].to_pylist())), space)
        yield benchmark.sparkSession.sparkContext.broadcast((space, items))


def _search(docs: DataFrame, ship) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()),
                        ("share", pa.float64()), ("answer", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, items = ship.value
        if not len(items.ids):
            return
        for b in steps(batches, max_bytes=1 << 20):
            found = search(space, items, *words_of(*flat(b.column("text")))[::3])
            if found:
                ids = b.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_pylist(
                    [{"doc_id": ids[d], "item_id": items.ids[k], "cosine": c, "share": s, "answer": a}
                     for (d, k), (c, s, a) in found.items()], schema=schema)

    return docs.mapInArrow(run, "doc_id long, item_id long, cosine double, share double, answer double")


def _candidates(space: Space, part: tuple, h: np.ndarray, at: np.ndarray):
    """(text, first word, words of the window, item, cosine) of windows near an item."""
    span, stride, vectors, of = part
    counts = np.diff(at)
    doc, begin = _windows(counts, span, stride)
    first = at[doc] + begin
    size = np.minimum(span, counts[doc] - begin)
    found = []
    for i in range(0, len(doc), 2048):
        one = slice(i, i + 2048)
        n = len(doc[one])
        p = np.repeat(np.arange(n), size[one])
        word = np.repeat(first[one], size[one]) + ragged_arange(size[one])
        p, f, tf = _entries(p, _feature(h[word]))
        cos = space.rows(p, f, tf, n) @ vectors.T
        w, j = np.divmod(np.flatnonzero(cos >= COSINE), len(of))
        if not len(w):
            continue
        pair = w * (int(of[-1]) + 1) + of[j]
        best = np.lexsort((-cos[w, j], pair))
        best = best[np.append(True, pair[best][1:] != pair[best][:-1])]
        w, j = w[best], j[best]
        found.append((doc[i + w], first[i + w], np.full(len(w), span), of[j], cos[w, j]))
    return found


def search(space: Space, items: Items, h: np.ndarray, at: np.ndarray) -> dict:
    """(text, item) -> (cosine, share, answer) over texts given by word hashes and offsets."""
    near = [c for part in items.parts for c in _candidates(space, part, h, at)]
    if not near:
        return {}
    doc, first, span, item, cosine = (np.concatenate(x) for x in zip(*near))
    lengths = np.array([len(w) for w in items.words])
    low = np.maximum(at[doc], first - lengths[item])
    high = np.minimum(at[doc + 1], first + span + lengths[item])
    places = Places(items, h)
    by_item = np.argsort(item, kind="stable")
    enough = np.zeros(len(item), bool)
    for group in np.split(by_item, np.flatnonzero(np.diff(item[by_item])) + 1):
        k = int(item[group[0]])
        shared = places.overlap(items.kinds[k], low[group], high[group])
        enough[group] = shared >= min(SHARE, ANSWERED) * lengths[k]
    found: dict = {}
    for x in np.flatnonzero(enough).tolist():
        d, k = int(doc[x]), int(item[x])
        best = found.get((d, k), (0, 0, 0))[1]
        got = _verify(items, k, h[low[x]:high[x]].tolist()) if best < 1 else None
        if got and got[0] > best:
            found[d, k] = (float(cosine[x]), *got)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; every row is judged by itself.

    Rows of one id, or of none, stay or go by their own texts; null and empty texts stay. All columns
    are passed on, nothing is shuffled. Without items every row stays.
    """
    def without(ship):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            space, items = ship.value
            for b in steps(batches, max_bytes=1 << 20):
                if len(items.ids):
                    found = search(space, items, *words_of(*flat(b.column("text")))[::3])
                    keep = np.ones(b.num_rows, bool)
                    keep[[d for d, _ in found]] = False
                    b = b.filter(pa.array(keep))
                yield b
        return run

    space = fit(id_text(docs))
    for ship in item_blocks(benchmark, space):
        docs = docs.mapInArrow(without(ship), docs.schema)
    return docs


def op10(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark)
