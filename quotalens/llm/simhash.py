"""SimHash near-duplicates by vantage-point trees.

Fingerprints are made batch by batch without a shuffle. Random fingerprints lie about 32 +- 4 bits
apart, so a tree over all 64 bits prunes little at a radius of 4. Therefore one tree is grown for
each of ``BLOCKS`` groups of bits: two fingerprints within 4 bits are within ``4 // BLOCKS`` bits in
some group, and there the triangle bound is sharp. Different fingerprints are dealt to shards by
the tree of each group: a point's home is the leaf it falls in, and it also visits each later
leaf whose region may hold a point within the bound at every vantage point. Each shard goes on
with a tree over the points that live there and queries it with those and with the visitors;
candidates are checked on all 64 bits. So every pair in reach is found at least once. A shard
returns a spanning star per group of copies, not all pairs; the groups of all shards are joined
by connected components over the table of links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import id_text, materialize, steps
from quotalens.llm.components import components

SHINGLE = 4
RADIUS = 4
BLOCKS = 3               # groups of bits, one tree each
SHARD_POINTS = 20_000   # different fingerprints a shard is meant to hold
LEAF = 256
SEED = 42


def simhash(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints: a bit is 1 if set in over half of the shingles' XXH64."""
    digest = xxhash.xxh64_digest
    hashes, sizes = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.encode().lower().split()  # ASCII letters and ASCII white space only
        if not words:
            continue
        if len(words) <= shingle:
            made = [digest(b" ".join(words), SEED)]
        else:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            begins = np.append(0, ends[:len(words) - shingle])
            made = [digest(line[a:b], SEED)
                    for a, b in zip(begins.tolist(), (ends[shingle - 1:] - 1).tolist())]
        hashes.append(b"".join(made))
        sizes[i] = len(made)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8)).reshape(-1, 64)
        starts = (np.cumsum(sizes) - sizes)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        over = (2 * ones > sizes[full, None]).astype(np.uint8)
        out[full] = np.packbits(over, axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long): the fingerprint's 64 bits as a signed number."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, max_bytes=1 << 20):
            fp = simhash(b.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))],
                                             schema=schema)

    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def masks(blocks: int = BLOCKS) -> list[np.uint64]:
    """Groups of neighbouring bits that together are all 64."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    return [np.uint64((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]


@dataclass
class Router:
    """A complete vantage-point tree in heap order over the bits of ``mask``; leaves are shards."""

    points: np.ndarray  # uint64 by inner node
    radii: np.ndarray   # int by inner node; within the radius goes left
    depth: int
    mask: np.uint64

    def shards(self, fp: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, home) triples: each row's home and the later shards in reach."""
        row, node, home = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
        for _ in range(self.depth):
            d = np.bitwise_count((fp[row] ^ self.points[node]) & self.mask).astype(np.int64)
            r = self.radii[node]
            left = d <= r
            go_left, go_right = d - reach <= r, d + reach > r
            parts = [(row[go_left], 2 * node[go_left] + 1, (home & left)[go_left]),
                     (row[go_right], 2 * node[go_right] + 2, (home & ~left)[go_right])]
            row, node, home = (np.concatenate(x) for x in zip(*parts))
        shard = node - ((1 << self.depth) - 1)
        own = np.zeros(len(fp), np.int64)
        own[row[home]] = shard[home]
        keep = home | (shard > own[row])
        return row[keep], shard[keep], home[keep]


def plant(sample: np.ndarray, depth: int, mask: np.uint64, seed: int = 3) -> Router:
    """Vantage points and median radii from a sample; it places borders, it drops nothing."""
    rng = np.random.default_rng(seed)
    inner = (1 << depth) - 1
    points, radii = np.zeros(inner, np.uint64), np.full(inner, 32, np.int64)
    held = {0: sample}
    for node in range(inner):
        own = held.pop(node, np.zeros(0, np.uint64))
        points[node] = own[rng.integers(len(own))] if len(own) else rng.integers(1 << 62)
        d = np.bitwise_count((own ^ points[node]) & mask).astype(np.int64)
        if len(own):
            radii[node] = int(np.median(d)) - int((d <= np.median(d)).all())
        held[2 * node + 1], held[2 * node + 2] = own[d <= radii[node]], own[d > radii[node]]
    return Router(points, radii, depth, mask)


class _Groups:
    """Union of local points, minima of vectorised hooks."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def link(fp: np.ndarray, home: np.ndarray, reach: int, mask: np.uint64, bound: int) -> np.ndarray:
    """Root of each point's group: links are pairs within ``reach``, one end at home, whose
    distance on ``mask`` is at most ``bound``."""
    groups, rng = _Groups(len(fp)), np.random.default_rng(5)
    todo = [(np.flatnonzero(home), np.arange(len(fp)))]
    while todo:
        own, asked = todo.pop()
        if not len(own) or not len(asked):
            continue
        if len(own) > LEAF:
            seen = fp[own]
            vantage = seen[rng.integers(len(seen))]
            d = np.bitwise_count((seen ^ vantage) & mask)
            r = int(np.median(d))
            left = d <= r
            if not left.all():
                dq = np.bitwise_count((fp[asked] ^ vantage) & mask).astype(np.int64)
                todo += [(own[left], asked[dq - bound <= r]), (own[~left], asked[dq + bound > r])]
                continue
            near = d < r
            if near.any():  # ties at the median: split just below it
                dq = np.bitwise_count((fp[asked] ^ vantage) & mask).astype(np.int64)
                todo += [(own[near], asked[dq - bound <= r - 1]),
                         (own[~near], asked[dq + bound > r - 1])]
                continue
        for i in range(0, len(asked), 4096):
            part = asked[i:i + 4096]
            for j in range(0, len(own), LEAF):
                other = own[j:j + LEAF]
                near = np.bitwise_count(fp[part][:, None] ^ fp[other][None]) <= reach
                x, y = np.nonzero(near)
                groups.join(part[x], other[y])
    return groups.root


def links(classes: DataFrame, reach: int = RADIUS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(a, b) links between the ids of classes (fp, rep) whose fingerprints are in reach."""
    n = classes.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n) / shard_points))))
    wanted = max(4096, 64 << depth)
    sample = classes.select("fp").orderBy(F.xxhash64("fp")).limit(wanted).toArrow()["fp"]
    sample = sample.to_numpy().view(np.uint64) if n else np.zeros(0, np.uint64)
    routers = [plant(sample, depth, mask) for mask in masks()]
    bound = reach // len(routers)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for k, router in enumerate(routers):
                row, shard, home = router.shards(fp, bound)
                yield pa.RecordBatch.from_pydict(
                    {"tree": np.full(len(row), k), "shard": shard,
                     "fp": b.column("fp").take(pa.array(row)),
                     "rep": b.column("rep").take(pa.array(row)), "home": home})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")  # the least id becomes each star's centre
        mask = routers[int(pdf["tree"].iloc[0])].mask
        root = link(pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy(), reach, mask, bound)
        rep = pdf["rep"].to_numpy()
        leaf = root != np.arange(len(root))
        return pd.DataFrame({"a": rep[leaf], "b": rep[root[leaf]]})

    return (classes.mapInArrow(route, "tree long, shard long, fp long, rep long, home boolean")
            .groupBy("tree", "shard").applyInPandas(search, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, reach: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) per input row; component_id is the least id of the group.

    Null and empty texts have fingerprint 0 and are linked like any other. A null doc_id is
    never a component's id unless all of its group are null. Repeated rows get equal results;
    an empty table gives no rows; other columns are ignored.
    """
    fps = materialize(fingerprints(docs, shingle), "simhash")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    found = components(links(classes.where(F.col("rep").isNotNull()), reach))
    named = classes.join(found, classes["rep"] == found["node"], "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, fps["fp"] == named["class_fp"]).select("doc_id", "fp", "component_id")


def op8(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of the least id.

    Rows are numbered first (in a written table, so the numbers hold), and groups and choices go by
    the number: rows of one id with unlike texts all stay, a row without an id stays only if its
    group has none with one. Of equal ids the first numbered row stays. Null and empty texts are
    copies of each other. All columns are passed on; an empty table gives no rows.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    ids = numbered.select(F.col(row).alias("doc_id"), F.col("doc_id").cast("long").alias("_id"), "text")
    found = near_duplicates(ids.select("doc_id", "text")).select("doc_id", "component_id")
    heads = found.join(ids.select("doc_id", "_id"), "doc_id").groupBy("component_id").agg(
        F.min(F.struct(F.col("_id").isNull(), "_id", "doc_id")).alias("best")) \
        .select(F.col("best.doc_id").alias("_kept"))
    return numbered.join(heads, numbered[row] == heads["_kept"], "left_semi").select(*docs.columns)
