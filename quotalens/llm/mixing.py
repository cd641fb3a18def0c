"""LM scoring by online logistic context mixing of bit predictors.

A byte is spelled as bits by a Huffman code that depends on the class of the byte before. Three
predictors look at hashed contexts (the last 2, 4 and 5 bytes) and give each bit the log-odds of
what followed that context in the training corpus. The log-odds are combined by weights gated by
the byte class and the depth of the bit in its code (fitted on a bounded sample of windows), and
every predictor's share is refined online along the text by the gradient of each coded bit. The
sum of the bits' costs is the text's total, so bits per byte follow.

* Training counts of (contexts of all predictors, byte) are gathered over all training documents:
  partial sums in each task, Spark's sum, then the bits of each cell's byte. They meet in hashed
  tables of a fixed size (``TABLES``), so what the driver holds and broadcasts does not
  depend on the corpus.
* Scoring runs batch by batch without a shuffle: a text is coded in segments of ``SEGMENT`` bytes
  that keep the context of the bytes before them, and all segments of a batch advance together.

The word baseline needs the count of every word of the corpus: tasks emit, per word, its training
count and the list of their documents that have it, so a word in every document is one row a
task; counts are summed by word and joined back to those rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import (
    discard, flat, fold, id_text, materialize, ragged_arange, release, steps)

CLASSES = 16
ORDERS = (2, 4, 5)
TABLES = (18, 21, 22)            # bits of each predictor's table
SEGMENT = 256
PAD = 5                          # context symbols before a text
END = 255                        # closes a text; no UTF-8 byte
SCALE = 16.0                     # table entries are log-odds times SCALE
GATES = CLASSES * 4
RATE = 0.02                      # of the online refinement
ODDS_STEPS = 2                   # log-odds are counted in halves for the gated weights,
LEVELS = 33                      # from -8 to 8
WORDS_HELD = 400_000             # words a task gathers before it emits them
CELLS_HELD = 4_000_000           # cells a task gathers before it sums them up
_BASES = np.cumsum([0, *(1 << t for t in TABLES)])


def stream(raw: np.ndarray, offs: np.ndarray):
    """Symbols of texts, each after PAD context symbols and closed by END; where they are coded."""
    n = len(offs) - 1
    lengths = np.diff(offs)
    size = lengths + PAD + 1
    begin = np.cumsum(size) - size
    out = np.full(int(size.sum()), END, np.uint8)
    out[np.repeat(begin + PAD, lengths) + ragged_arange(lengths)] = raw
    coded = np.ones(len(out), bool)
    for k in range(PAD):
        coded[begin + k] = False
    return out, np.flatnonzero(coded), begin + PAD, lengths + 1


def contexts(symbols: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """24 bits of context of every coded position, for each predictor.

    The low byte is the byte before; above it stand 16 bits of hash of the earlier ones.
    """
    out, near = [], symbols[at - 1].astype(np.uint32)
    h = np.zeros(len(at), np.uint32)
    for back in range(2, max(ORDERS) + 1):
        h = h * np.uint32(0x9E3779B1) + symbols[at - back].astype(np.uint32) + np.uint32(1)
        if back in ORDERS:
            out.append(((h * np.uint32(0x85EBCA6B)) >> np.uint32(16) << np.uint32(8)) | near)
    return out


def places(k: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Table index of predictor k for (context, node of the code)."""
    h = (context * np.uint32(0xC2B2AE35)) ^ (node.astype(np.uint32) * np.uint32(0x27D4EB2F))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h >>= np.uint32(32 - TABLES[k])
    h += np.uint32(_BASES[k])
    return h


@dataclass
class Code:
    """Bits of each byte by class: paths of (node, bit) laid end to end."""

    classes: np.ndarray  # class of each byte
    start: np.ndarray    # [CLASSES * 256] first entry of a byte's path
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    depth: np.ndarray


def build_code(pairs: np.ndarray) -> Code:
    """Huffman codes from counts [byte before, byte]; every byte has a code in every class."""
    common = np.argsort(-pairs.sum(axis=1), kind="stable")[:CLASSES - 1]
    classes = np.full(256, CLASSES - 1, np.int32)
    classes[common] = np.arange(len(common))
    start, length, node, bit, depth = [], [], [], [], []
    for c in range(CLASSES):
        weight = pairs[classes == c].sum(axis=0) + 0.02
        heap = [(float(w), b, b) for b, w in enumerate(weight)]
        heapq.heapify(heap)
        kids, nxt = {}, 256
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            kids[nxt] = (b[2], a[2])
            heapq.heappush(heap, (a[0] + b[0], nxt, nxt))
            nxt += 1
        paths: dict[int, list] = {}
        todo = [(nxt - 1, [])]
        while todo:
            x, path = todo.pop()
            if x < 256:
                paths[x] = path
            else:
                todo += [(kids[x][v], [*path, (x - 256, v)]) for v in (0, 1)]
        for b in range(256):
            start.append(len(node))
            length.append(len(paths[b]))
            node += [p[0] for p in paths[b]]
            bit += [p[1] for p in paths[b]]
            depth += [min(3, k) for k in range(len(paths[b]))]
    as_ = lambda x, t: np.array(x, t)
    return Code(classes, as_(start, np.int32), as_(length, np.int32), as_(node, np.int32),
                as_(bit, np.uint8), as_(depth, np.int32))


def events(code: Code, symbols: np.ndarray, at: np.ndarray):
    """Bits of all coded symbols: node and bit of each, class and bits of each symbol."""
    cls = code.classes[symbols[at - 1]]
    key = cls * 256 + symbols[at]
    n = code.length[key]
    entry = np.repeat(code.start[key] - (np.cumsum(n, dtype=np.int32) - n), n)
    entry += np.arange(len(entry), dtype=np.int32)
    return code.node[entry], code.bit[entry], cls, entry, n


@dataclass
class Mixer:
    code: Code
    table: np.ndarray  # int8, weighted log-odds times SCALE of all predictors

    def log10_probs(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log10 probability of each text, closed by END."""
        symbols, at, _, lengths = stream(raw, offs)
        code = self.code
        node, bit, _, _, n = events(code, symbols, at)
        x = np.zeros((len(node), 4), np.int8)  # a row is gathered as one word
        for k, context in enumerate(contexts(symbols, at)):
            x[:, k] = self.table[places(k, np.repeat(context, n), node)]
        packed = x.view(np.uint32).ravel()
        # segments of whole symbols, longest (in bits) first
        head = np.flatnonzero(ragged_arange(lengths) % SEGMENT == 0)
        first = np.append(0, np.cumsum(n))[head]
        size = np.diff(np.append(first, len(node)))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        live = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), "right")
        share = np.full((len(ORDERS), len(size)), 1 / SCALE, np.float32)
        odds_all = np.empty(len(node), np.float32)
        truth = bit.astype(np.float32)
        place = first.copy()
        rate = np.float32(RATE / SCALE / SCALE)
        for k in live.tolist():
            e = place[:k]
            v = packed[e].view(np.int8).reshape(k, 4).T[:len(ORDERS)].astype(np.float32, order="C")
            z = (share[:, :k] * v).sum(axis=0)
            odds_all[e] = z
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
            err = truth[e]
            err -= z
            err *= rate
            v *= err
            share[:, :k] += v
            e += 1
        odds_all *= 1 - 2 * truth
        cost = np.log(1 + np.exp(np.clip(odds_all, -30, 30)))
        bounds = np.append(0, np.cumsum(n))[np.cumsum(lengths) - lengths]
        return -np.add.reduceat(cost, bounds, dtype=np.float64) / np.log(10)


def cells_of(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What all predictors see at every coded position, in one number.

    16 bits of hash for the first, then the byte before, the hashes of the others, the coded byte:
    sorted, the places of the shorter contexts stand together.
    """
    first, second, third = (c.astype(np.uint64) for c in contexts(symbols, at))
    near = first & np.uint64(255)
    cell = first >> np.uint64(8) << np.uint64(48) | near << np.uint64(40)
    cell |= second >> np.uint64(8) << np.uint64(24) | third >> np.uint64(8) << np.uint64(8)
    return (cell | symbols[at].astype(np.uint64)).view(np.int64)


def opened(cell: np.ndarray):
    """(contexts of every predictor, byte before, byte) of cells."""
    cell = cell.view(np.uint64)
    near = cell >> np.uint64(40) & np.uint64(255)
    found = [((cell >> np.uint64(shift) & np.uint64(0xFFFF)) << np.uint64(8) | near).astype(np.uint32)
             for shift in (48, 24, 8)]
    return found, near.astype(np.int64), (cell & np.uint64(255)).astype(np.int64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, n) of a task's texts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def summed():
        cell = np.concatenate([c for c, _ in held])
        order = np.argsort(cell, kind="stable")
        cell, n = cell[order], np.concatenate([n for _, n in held])[order]
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        return cell[first], np.add.reduceat(n, first)

    def emit(cell, n):
        for i in range(0, len(cell), 1 << 18):
            part = slice(i, i + (1 << 18))
            yield pa.RecordBatch.from_pydict({"cell": cell[part], "n": n[part]})

    for b in steps(batches):
        symbols, at, _, _ = stream(*flat(b.column("text")))
        held.append(np.unique(cells_of(symbols, at), return_counts=True))
        if sum(len(c) for c, _ in held) > CELLS_HELD:
            held = [summed()]
            if len(held[0][0]) > CELLS_HELD * 3 // 4:
                yield from emit(*held.pop())
    if held:
        yield from emit(*summed())


def cell_counts(docs: DataFrame) -> DataFrame:
    """(cell, n) of all of ``docs``, written; those that share the first two contexts lie together, in order."""
    few = docs.coalesce(max(1, 4 * docs.sparkSession.sparkContext.defaultParallelism))
    cells = few.mapInArrow(_cells, "cell long, n long").repartition(F.shiftrightunsigned("cell", 24))
    return materialize(cells.groupBy("cell").agg(F.sum("n").alias("n")).sortWithinPartitions("cell"), "cells")


def _bits(code: Code, cell: np.ndarray):
    """Bits of cells: contexts by predictor, node, bit, gate, and the bits of each cell."""
    found, near, byte = opened(cell)
    cls = code.classes[near]
    key = cls * 256 + byte
    n = code.length[key]
    entry = np.repeat(code.start[key] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return found, code.node[entry], code.bit[entry], np.repeat(cls, n) * 4 + code.depth[entry], n


def bit_counts(cells: DataFrame, code: Code) -> DataFrame:
    """(place, one, zero, gate): how often each table place saw a bit set or not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, count = (b.column(c).to_numpy() for c in ("cell", "n"))
            found, node, bit, gate, n = _bits(code, cell)
            count = np.repeat(count, n)
            for k, context in enumerate(found):
                place = places(k, np.repeat(context, n), node)
                order = np.argsort(place, kind="stable")
                own, seen = place[order], count[order]
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                one = np.add.reduceat(seen * bit[order], first)
                yield pa.RecordBatch.from_pydict(
                    {"place": own[first].astype(np.int32), "one": one,
                     "zero": np.add.reduceat(seen, first) - one, "gate": gate[order][first].astype(np.int32)})

    return cells.mapInArrow(run, "place int, one long, zero long, gate int").groupBy("place").agg(
        F.sum("one").cast("float").alias("one"), F.sum("zero").cast("float").alias("zero"),
        F.max("gate").cast("byte").alias("gate"))


def count_pairs(docs: DataFrame) -> np.ndarray:
    """[byte before, byte] counts of all of ``docs``: 65,536 sums."""
    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for b in steps(batches):
            symbols, at, _, _ = stream(*flat(b.column("text")))
            total += np.bincount(symbols[at - 1].astype(np.int32) << 8 | symbols[at], minlength=1 << 16)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pair, "n": total[pair]})

    rows = docs.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << 16)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(256, 256)


def fit(docs: DataFrame) -> Mixer:
    """Mixer of all of ``docs`` (row, text); without rows all bits are even."""
    code = build_code(count_pairs(docs))
    cells = cell_counts(docs)
    rows = bit_counts(cells, code).toArrow()  # at most sum(2**t for t in TABLES) rows
    one, zero = (np.zeros(int(_BASES[-1]), np.float32) for _ in range(2))
    gate = np.zeros(int(_BASES[-1]), np.uint8)
    place = rows["place"].to_numpy()
    one[place], zero[place], gate[place] = (rows[c].to_numpy() for c in ("one", "zero", "gate"))
    del rows, place
    weights = _gates(*gate_counts(cells, code, one, zero))
    discard(cells)
    table = _odds(one, zero)
    for k in range(len(ORDERS)):
        own = slice(_BASES[k], _BASES[k + 1])
        table[own] *= weights[:, k].astype(np.float32)[gate[own]]
    return Mixer(code, np.clip(np.rint(table * SCALE), -127, 127).astype(np.int8))


def gate_counts(cells: DataFrame, code: Code, one: np.ndarray, zero: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, n) over all training bits: gate, the predictors' log-odds in steps of 1 / ODDS_STEPS, bit.

    Each bit is taken out of the counts it is predicted from, so a context that was seen once is not
    trusted. The keys are bounded by GATES, the levels and the bit, whatever the corpus.
    """
    ship = cells.sparkSession.sparkContext.broadcast((one, zero))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, zero = ship.value
        total = np.zeros(GATES * LEVELS ** len(ORDERS) * 2, np.int64)
        for b in batches:
            cell, count = (b.column(c).to_numpy() for c in ("cell", "n"))
            found, node, bit, key, n = _bits(code, cell)
            key = key.astype(np.int64)
            for k, context in enumerate(found):
                place = places(k, np.repeat(context, n), node)
                odds = _odds(np.maximum(one[place] - bit, 0), np.maximum(zero[place] - (1 - bit.astype(np.float32)), 0))
                key = key * LEVELS + np.rint(odds * ODDS_STEPS).astype(np.int64) + LEVELS // 2
            np.add.at(total, key * 2 + bit, np.repeat(count, n))
        key = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"key": key, "n": total[key]})

    few = cells.coalesce(max(1, cells.sparkSession.sparkContext.defaultParallelism))
    rows = few.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    ship.unpersist()
    return rows["key"].to_numpy(), rows["n"].to_numpy()


def _odds(one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    return np.clip(np.log(one + np.float32(0.4)) - np.log(zero + np.float32(0.4)), -7.9, 7.9)


def _gates(key: np.ndarray, n: np.ndarray, rounds: int = 8) -> np.ndarray:
    """[GATES, predictors] weights: a small logistic regression per gate on ``gate_counts``."""
    weights = np.full((GATES, len(ORDERS)), 1 / len(ORDERS))
    order = np.argsort(key)  # the fit does not depend on the order of partitions
    key, n = key[order], n[order].astype(np.float64)
    bit, key = key % 2, key // 2
    x = np.empty((len(key), len(ORDERS)))
    for k in reversed(range(len(ORDERS))):
        x[:, k] = (key % LEVELS - LEVELS // 2) / ODDS_STEPS
        key = key // LEVELS
    for g in np.unique(key):
        at = key == g
        own, y, times = x[at], bit[at], n[at]
        w = weights[g].copy()
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            pull = 5.0 * (w - weights[g])
            h = (own * (times * (p * (1 - p) + 1e-4))[:, None]).T @ own + 5.0 * np.eye(len(w))
            w -= np.clip(np.linalg.solve(h, own.T @ (times * (p - y)) + pull), -0.5, 0.5)
        weights[g] = w
    return weights


_POSTS = pa.schema([("word", pa.binary()), ("trained", pa.int64()), ("docs", pa.list_(pa.int64())),
                    ("times", pa.list_(pa.int32()))])
_LAST = b" "  # the end token; no word holds a space


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    keys: list[np.ndarray] = []
    rows: list[int] = []
    learns: list[bool] = []

    def emit():
        pair, times = np.unique(np.concatenate(keys), return_counts=True)
        word, row = pair >> 32, pair & ((1 << 32) - 1)
        ids = np.array(rows, np.int64)[row]
        trained = np.bincount(word, weights=times * np.array(learns)[row], minlength=len(known))
        bounds = np.searchsorted(word, np.arange(len(known) + 1))
        words = list(known)
        for i in range(0, len(words), 50_000):
            j = min(len(words), i + 50_000)
            part = slice(bounds[i], bounds[j])
            offsets = pa.array((bounds[i:j + 1] - bounds[i]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[i:j], pa.binary()), pa.array(trained[i:j].astype(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(ids[part])),
                 pa.ListArray.from_arrays(offsets, pa.array(times[part].astype(np.int32)))],
                schema=_POSTS)

    held = 0
    for b in steps(batches):
        for row, learn, text in zip(*(b.column(c).to_pylist() for c in ("row", "learn", "text"))):
            words = text.encode().lower().split()
            words.append(_LAST)
            try:
                own = [known[w] for w in words]
            except KeyError:
                own = [known.setdefault(w, len(known)) for w in words]
            keys.append(np.array(own, np.int64) << 32 | len(rows))
            rows.append(row)
            learns.append(bool(learn))
            held += len(words)
        if len(known) > WORDS_HELD or held > 20 * WORDS_HELD:
            yield from emit()
            known.clear()
            keys, rows, learns, held = [], [], [], 0
    if keys:
        yield from emit()


def word_baseline(docs: DataFrame) -> DataFrame:
    """(row, n_tokens, n_known, train_tokens, base_score) of ``docs`` (row, learn, text)."""
    posts = materialize(docs.mapInArrow(
        _postings, "word binary, trained long, docs array<long>, times array<int>"), "postings")
    counts = materialize(posts.groupBy("word").agg(F.sum("trained").alias("c")), "word-counts")
    whole = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    n, v = whole.n or 0, whole.v or 0
    each = F.log10((F.col("c") + 0.5) / F.lit(n + 0.5 * (v + 1)))
    return (posts.join(counts, "word")
            .select("c", each.alias("each"), F.explode(F.arrays_zip("docs", "times")).alias("d"))
            .groupBy(F.col("d.docs").alias("row")).agg(
                F.sum("d.times").alias("n_tokens"),
                F.sum(F.when(F.col("c") > 0, F.col("d.times")).otherwise(0)).cast("long").alias("n_known"),
                F.sum(F.col("each") * F.col("d.times")).alias("base_score"))
            .withColumn("train_tokens", F.lit(n).cast("long")))


def score(docs: DataFrame, mixer: Mixer) -> DataFrame:
    """(row, score) of ``docs`` (row, text): log10 probability of each text."""
    ship = docs.sparkSession.sparkContext.broadcast(mixer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, max_bytes=1 << 20):
            s = ship.value.log10_probs(*flat(b.column("text")))
            yield pa.RecordBatch.from_pydict({"row": b.column("row"), "score": s},
                                             schema=pa.schema([("row", pa.int64()), ("score", pa.float64())]))

    return docs.select("row", "text").mapInArrow(run, "row long, score double")


def score_texts(docs: DataFrame, parts: int = 5, left_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per input row.

    Learns from rows whose fold is not ``left_out`` (a null id has no fold: it learns, held_out is
    null). Null texts are empty: one end token. Repeated ids keep a row each; other columns are
    ignored; an empty table gives no rows.
    """
    plain = id_text(docs)
    repeated = plain.groupBy("doc_id").agg(F.count("*").alias("n")).where(
        (F.col("n") > 1) | F.col("doc_id").isNull()).limit(1).count()
    if repeated:  # rows need numbers of their own: fixed once by a written table
        plain = materialize(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")
    else:
        plain = plain.withColumn("row", F.col("doc_id"))
    out = fold(F.col("doc_id"), parts) == left_out
    plain = plain.withColumn("learn", ~F.coalesce(out, F.lit(False)))
    mixer = fit(plain.where("learn"))
    release(plain.sparkSession)
    base = word_baseline(plain.select("row", "learn", "text"))
    ids = plain.select("row", "doc_id")
    return (score(plain, mixer).join(base, "row").join(ids, "row") if repeated else
            score(plain, mixer).join(base, "row").withColumn("doc_id", F.col("row"))).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9(docs: DataFrame) -> DataFrame:
    return score_texts(docs)
