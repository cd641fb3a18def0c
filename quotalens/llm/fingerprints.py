"""Document fingerprints by locally consistent parsing.

A text (UTF-8 bytes) is parsed level by level. At each level runs of one symbol are joined, the
symbols get small labels by deterministic coin tossing (the lowest bit in which a symbol differs
from its left neighbour, repeated until at most six labels remain), and a phrase starts at every
local maximum of the labels. The phrase's name is a hash of its symbols, so equal substrings get
the same phrases inside, whatever their offset; only a few symbols at either edge can differ.
The fingerprint keeps the ``SKETCH`` smallest names of levels 3 and 4 (about 25 and 80 bytes a
phrase); the likeness of two fingerprints is the bottom-k estimate of their Jaccard similarity.

Spark range-partitions the texts by doc_id, so a text and its successor sit side by side; only
the first and the last text of each partition go through a second, partition-count-sized join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import flat, id_text, materialize, mix64, ragged_arange, steps

SKETCH = 64
LEVELS = (3, 4)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _toss_tables() -> tuple[np.ndarray, np.ndarray]:
    """new label of (label, left label), both below 256: 2 * lowest differing bit + own bit.

    Repeated on its own results it falls 256 -> 16 -> 8 -> 6 -> 6 labels.
    """
    a, b = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    diff = a ^ b
    low = np.zeros_like(diff)
    for bit in range(7, -1, -1):
        low = np.where(diff >> bit & 1, bit, low)
    return (2 * low + (a >> low & 1)).astype(np.uint8), np.arange(256, dtype=np.uint8)


_TOSS = _toss_tables()[0].ravel()


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """At most six labels, neighbours within a text always different."""
    if symbols.dtype == np.uint8:
        lab = symbols
    else:
        diff = np.empty_like(symbols)
        diff[1:] = symbols[1:] ^ symbols[:-1]
        diff[first] = 1
        low = np.bitwise_count((diff & -diff) - np.uint64(1))
        own = (symbols >> low.astype(np.uint64)) & np.uint64(1)
        lab = (2 * low + own.astype(np.uint8)).astype(np.uint8)
    for _ in range(4 if symbols.dtype == np.uint8 else 3):
        at = lab.astype(np.uint16) << np.uint16(8)
        at[1:] |= lab[:-1]
        at[first] = (lab[first].astype(np.uint16) << np.uint16(8)) | (lab[first] ^ np.uint8(1))
        lab = _TOSS[at]
    return lab


def _level(symbols: np.ndarray, offs: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of one more level, and the offsets of each text's phrases."""
    n = len(symbols)
    first = offs[:-1][offs[:-1] < offs[1:]]
    change = np.empty(n, bool)
    change[1:] = symbols[1:] != symbols[:-1]
    change[first] = True
    runs = np.flatnonzero(change)
    if len(runs) < n:  # a run becomes one symbol of its own
        lengths = np.diff(np.append(runs, n))
        kept = symbols[runs].astype(np.uint64)
        long = lengths > 1
        kept[long] = mix64(kept[long] * _ODD + lengths[long].astype(np.uint64))
        symbols = kept
        offs = np.searchsorted(runs, offs)
        first = offs[:-1][offs[:-1] < offs[1:]]
        n = len(symbols)
    lab = _labels(symbols, first)
    start = np.zeros(n, bool)
    if n > 2:
        start[1:-1] = (lab[1:-1] > lab[:-2]) & (lab[1:-1] > lab[2:])
    ends = offs[1:][offs[:-1] < offs[1:]]
    start[ends - 1] = False  # a text's last symbol has no right neighbour
    start[first] = True
    at = np.flatnonzero(start)
    sizes = np.diff(np.append(at, n))
    pos = ragged_arange(sizes)
    powers = _powers(int(sizes.max()) if len(sizes) else 0)
    names = np.add.reduceat((symbols.astype(np.uint64) + np.uint64(1)) * powers[pos], at)
    names = mix64(names ^ mix64(sizes.astype(np.uint64) + np.uint64(level << 32)))
    return names, np.searchsorted(at, offs)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _ODD, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def sketches(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bottom-k sketches of many texts: sorted 32-bit names end to end, and offsets."""
    n = len(offs) - 1
    keys = []
    symbols, at = raw, offs
    for level in range(1, max(LEVELS) + 1):
        if len(symbols) == 0:
            break
        symbols, at = _level(symbols, at, level)
        if level in LEVELS:
            doc = np.repeat(np.arange(n, dtype=np.uint64), np.diff(at))
            keys.append(doc << np.uint64(32) | symbols >> np.uint64(32))
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    doc = (key >> np.uint64(32)).astype(np.int64)
    counts = np.bincount(doc, minlength=n)
    kept = ragged_arange(counts) < SKETCH
    counts = np.minimum(counts, SKETCH)
    return (key[kept] & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.append(0, np.cumsum(counts))


def likeness(a: np.ndarray, a_offs: np.ndarray, b: np.ndarray, b_offs: np.ndarray) -> np.ndarray:
    """Bottom-k Jaccard estimate of paired sketches (two empty sketches: 1)."""
    n = len(a_offs) - 1
    side = [np.repeat(np.arange(n, dtype=np.uint64), np.diff(o)) << np.uint64(32) | v
            for v, o in ((a, a_offs), (b, b_offs))]
    key, count = np.unique(np.concatenate(side), return_counts=True)
    doc = (key >> np.uint64(32)).astype(np.int64)
    sizes = np.bincount(doc, minlength=n)
    kept = ragged_arange(sizes) < SKETCH
    shared = np.bincount(doc[kept & (count == 2)], minlength=n)
    whole = np.minimum(sizes, SKETCH)
    return np.where(whole == 0, 1.0, shared / np.maximum(whole, 1))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _pair_rows(texts: list[str], following: list[str]) -> dict:
    """Digest columns for texts and their successors."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    enc = [[x.encode() for x in xs] for xs in (texts, changed, following)]
    parts = [(np.frombuffer(b"".join(xs), np.uint8),
              np.append(0, np.cumsum([len(x) for x in xs], dtype=np.int64))) for xs in enc[:2]]
    own, new = (sketches(*p) for p in parts)
    if texts[1:] == following[:-1]:  # side by side: only the last successor is new
        last = sketches(np.frombuffer(enc[2][-1], np.uint8), np.array([0, len(enc[2][-1])]))
        cut = own[1][1]
        nxt = (np.concatenate([own[0][cut:], last[0]]),
               np.append(own[1][1:] - cut, len(own[0]) - cut + len(last[0])))
    else:
        nxt = sketches(np.frombuffer(b"".join(enc[2]), np.uint8),
                       np.append(0, np.cumsum([len(x) for x in enc[2]], dtype=np.int64)))

    def blobs(sk):
        big = sk[0].astype(">u4")
        return [big[i:j].tobytes() for i, j in zip(sk[1][:-1], sk[1][1:])]

    return {"n_chars": [len(t) for t in texts],
            "edited_sha": [hashlib.sha256(x).digest() for x in enc[1]],
            "fp": blobs(own), "edited_fp": blobs(new),
            "near_edited": likeness(*own, *new).tolist(),
            "near_next": likeness(*own, *nxt).tolist()}


_OUT = ("kind int, pid int, doc_id long, n_chars long, edited_sha binary, fp binary, "
        "edited_fp binary, near_edited double, near_next double, packed binary")
_OUT_PA = pa.schema([("kind", pa.int32()), ("pid", pa.int32()), ("doc_id", pa.int64()),
                     ("n_chars", pa.int64()), ("edited_sha", pa.binary()), ("fp", pa.binary()),
                     ("edited_fp", pa.binary()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64()), ("packed", pa.binary())])
_DIGEST = ("n_chars", "edited_sha", "fp", "edited_fp", "near_edited", "near_next")
_DONE, _HEAD, _TAIL = 0, 1, 2


def _batch(kind: int, pid: int, ids: list, rows: dict | None = None, packed=None):
    rows = rows or {}
    n = len(ids)
    return pa.RecordBatch.from_pydict(
        {"kind": [kind] * n, "pid": [pid] * n, "doc_id": ids,
         **{k: rows.get(k, [None] * n) for k in _DIGEST},
         "packed": packed or [None] * n}, schema=_OUT_PA)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts for the range exchange, and a tie-break among equal ids."""
    c = zstandard.ZstdCompressor(level=1)
    for b in steps(batches):
        texts = b.column("text").to_pylist()
        raw = [t.encode() for t in texts]
        yield pa.RecordBatch.from_pydict(
            {"doc_id": b.column("doc_id"), "tie": [hashlib.md5(x).digest() for x in raw],
             "packed": [c.compress(x) for x in raw]},
            schema=pa.schema([("doc_id", pa.int64()), ("tie", pa.binary()), ("packed", pa.binary())]))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of every text but the partition's last; the first and last text as they are."""
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    unzip = zstandard.ZstdDecompressor()
    held: tuple | None = None  # (id, text, packed) of the last text seen
    for b in steps(batches, "packed", 1 << 20):
        ids, packed = b.column("doc_id").to_pylist(), b.column("packed").to_pylist()
        texts = [unzip.decompress(x).decode() for x in packed]
        if held is None:
            yield _batch(_HEAD, pid, ids[:1], packed=packed[:1])
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
        if len(ids) > 1:
            yield _batch(_DONE, pid, ids[:-1], _pair_rows(texts[:-1], texts[1:]))
        held = (ids[-1], texts[-1], packed[-1])
    if held is not None:
        yield _batch(_TAIL, pid, [held[0]], packed=[held[2]])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unzip = zstandard.ZstdDecompressor()
    for b in batches:
        for pid, i, own, nxt in zip(*(b.column(c).to_pylist()
                                      for c in ("pid", "doc_id", "packed", "next_packed"))):
            yield _batch(_DONE, pid, [i], _pair_rows([unzip.decompress(own).decode()],
                                                     [unzip.decompress(nxt).decode()]))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited form, and the likeness to both neighbours.

    Input needs doc_id and text; other columns are ignored. Null texts are empty. The order is
    ascending doc_id (null ids first), equal ids by a hash of the text; the last text's
    successor is the first. A single row is its own successor; an empty table gives no rows.
    Returns doc_id, n_chars, edited_sha, fp, edited_fp (binary), near_edited, near_next.
    """
    spark = docs.sparkSession
    packed = id_text(docs).mapInArrow(_pack, "doc_id long, tie binary, packed binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    done = (packed.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "tie")
            .mapInArrow(_neighbours, _OUT))
    done = materialize(done, "fingerprints")
    # partition numbers only: one integer per non-empty partition
    pids = sorted(r.pid for r in done.where(F.col("kind") == _HEAD).select("pid").collect())
    following = {p: pids[(i + 1) % len(pids)] for i, p in enumerate(pids)}
    after = spark.createDataFrame(list(following.items()) or [(-1, -1)], "pid int, head_pid int")
    heads = done.where(F.col("kind") == _HEAD).select(F.col("pid").alias("head_pid"),
                                                      F.col("packed").alias("next_packed"))
    tails = (done.where(F.col("kind") == _TAIL).select("pid", "doc_id", "packed")
             .join(after, "pid").join(heads, "head_pid")
             .select("pid", "doc_id", "packed", "next_packed").mapInArrow(_edges, _OUT))
    cols = ["doc_id", *_DIGEST]
    return done.where(F.col("kind") == _DONE).select(cols).union(tails.select(cols))


def op2(docs: DataFrame) -> DataFrame:
    """The operator's rows with hexadecimal digests."""
    hexed = lambda c: F.lower(F.hex(c))
    return fingerprint_pairs(docs).select(
        "doc_id", "n_chars", hexed("edited_sha").alias("edited_sha256"),
        hexed("fp").alias("fingerprint"), hexed("edited_fp").alias("edited_fingerprint"),
        "near_edited", "near_next")
