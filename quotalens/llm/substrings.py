"""Exact substring removal: bytes covered by a repeated string of ``MATCH`` bytes.

1. Every window of MATCH bytes has an anchor: the smallest hash among its ``GRAM``-byte grams,
   leftmost of equals. Equal windows have equal anchors at equal places, so only windows whose
   anchor's gram occurs again in the corpus can repeat. Windows with one anchor are a segment; per
   gram the segments are counted with their earliest place (partial results before the shuffle).
2. Segments that are equal as a whole need no sorting: all but the earliest go.
3. Different segments around one gram are cut into pieces of at most ``SPREAD`` windows; pieces
   whose windows' common core occurs in one of them only are done. The rest is sorted: pieces
   with one core meet in a bucket, the bucket's shards get Burrows-Wheeler transforms, and these
   are merged by interleave refinement to MATCH symbols. Windows in one block repeat.
4. Removed intervals go back to their documents, which are cut and hashed in place.

Sizes are bounded: a bucket holds cores of about ``BUCKET_BYTES``; a core with more than
``HOT`` different pieces (a passage that a large part of all documents shares) is grouped window
by window in Spark's own aggregation instead, with partial minima before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotalens.llm.bwt import repeats
from quotalens.llm.common import flat, materialize, mix64, ragged_arange, release, steps

MATCH = 100
GRAM = 32
SPREAD = 17           # windows of a piece
HOT = 2000            # different pieces around one core that still share a bucket
BUCKET_BYTES = 1 << 17
_WIDE = MATCH - GRAM + 1
_POS = 24             # bits of a position in a step; longer texts are cut with overlap
_NULL = -(1 << 63)
_FITS = 1 << 62       # places below this are longs, beyond it decimals


def anchors(raw: np.ndarray, offs: np.ndarray):
    """Segments of texts: (gram hash, text, start in the text, windows, anchor's place in it)."""
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n < MATCH:
        return none.view(np.uint64), none, none, none, none
    x = raw.astype(np.uint64)
    for size in (1, 2, 4):
        x[:-size] |= x[size:] << np.uint64(8 * size)
    h = mix64(x)
    gram = h.copy()
    for k, s in enumerate(range(8, GRAM, 8)):
        gram[:-s] += h[s:] * np.uint64(2 * k + 0x9E3779B97F4A7C15)
    gram = mix64(gram)
    low = (gram >> np.uint64(_POS) << np.uint64(_POS)) | np.arange(n, dtype=np.uint64)
    size = 1
    while size * 2 <= _WIDE:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < _WIDE:
        low = np.minimum(low[:size - _WIDE], low[_WIDE - size:])
    low = low[:n - MATCH + 1]
    lengths = np.diff(offs)
    fits = np.maximum(lengths - MATCH + 1, 0)
    at = np.repeat(offs[:-1], fits) + ragged_arange(fits)
    if not len(at):
        return none.view(np.uint64), none, none, none, none
    pos = (low[at] & np.uint64((1 << _POS) - 1)).astype(np.int64)
    head = np.append(True, (pos[1:] != pos[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(head)
    start, pos = at[first], pos[first]
    text = np.searchsorted(offs, start, "right") - 1
    return gram[pos], text, start - offs[text], np.diff(np.append(first, len(at))), pos - start


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(raw, offs, row of each text, byte place of each text) of bounded steps.

    A text beyond the step size is cut into stretches that overlap by MATCH - 1 bytes; which
    anchor a window has depends on its own bytes alone, so a cut only splits a segment.
    """
    limit = 1 << 20
    for b in steps(batches, max_bytes=limit):
        raw, offs = flat(b.column("text"))
        if len(raw) <= 2 * limit:
            yield b, raw, offs, np.arange(b.num_rows), np.zeros(b.num_rows, np.int64)
            continue
        for a in range(0, max(1, len(raw) - MATCH + 1), limit):  # one row
            part = raw[a:a + limit + MATCH - 1]
            yield b, part, np.array([0, len(part)]), np.zeros(1, np.int64), np.array([a])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_digest
    for b, raw, offs, rows, shift in _cut(batches):
        g, text, start, m, off = anchors(raw, offs)
        view = memoryview(raw.tobytes())
        begin = offs[text] + start
        seg = np.frombuffer(b"".join([digest(view[s:e]) for s, e in zip(
            begin.tolist(), (begin + m + MATCH - 1).tolist())]), np.int64)
        row = pa.array(rows[text])
        yield pa.RecordBatch.from_arrays(
            [pa.array(g.view(np.int64)), pa.array(seg), b.column("doc").take(row),
             pa.array(start + shift[text]), pa.array((m << 8 | off).astype(np.int32))],
            ["gram", "seg", "doc", "start", "meta"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the segments asked for in each text: at most SPREAD windows around a core.

    Cuts lie at fixed distances from the anchor, so equal windows fall into pieces with the
    same core: the bytes that all windows of that distance range have in common.
    """
    for b in steps(batches, max_bytes=1 << 20):
        out = {k: [] for k in ("core", "piece", "start", "n")}
        rows = []
        for row, (text, asked) in enumerate(zip(b.column("text"), b.column("asked").to_pylist())):
            raw = text.as_buffer().to_pybytes()
            for s in asked:
                start, m, off = s["start"], s["meta"] >> 8, s["meta"] & 255
                a, w = start + off, 0
                while w < m:
                    lane = (off - w) // SPREAD  # the anchor is SPREAD * lane bytes in, or more
                    last = min(m - 1, off - lane * SPREAD)
                    core = raw[a - lane * SPREAD:a - lane * SPREAD - SPREAD + 1 + MATCH]
                    rows.append(row)
                    out["core"].append(xxhash.xxh3_64_intdigest(core, lane) - (1 << 63))
                    out["piece"].append(raw[start + w:start + last + MATCH])
                    out["start"].append(start + w)
                    out["n"].append(last - w + 1)
                    w = last + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["core"], pa.int64()), pa.array(out["piece"], pa.binary()),
             b.column("doc").take(pa.array(rows, pa.int64())), pa.array(out["start"], pa.int64()),
             pa.array(out["n"], pa.int32())], ["core", "piece", "doc", "start", "n"])


def _sorted_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Later windows among a bucket's different pieces: (doc, a, b) byte places."""
    docs, kinds = pd.factorize(pdf["doc"], sort=True)
    block, string, offset = repeats(pdf["piece"].tolist(), MATCH)
    doc, a = docs[string], pdf["start"].to_numpy()[string] + offset
    order = np.lexsort((a, doc, block))
    block, doc, a = block[order], doc[order], a[order]
    first = np.append(True, block[1:] != block[:-1]) if len(block) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(first, np.arange(len(block)), 0))
    later = (doc != doc[lead]) | (a != a[lead])
    return pd.DataFrame({"doc": kinds[doc[later]], "a": a[later], "b": a[later] + MATCH})


def _apply(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        *([("kept", pa.binary())] if texts else [])])
    names = schema.names
    for b in steps(batches):
        out = {n: [] for n in names}
        for text, i, froms, tos in zip(b.column("text"), *(b.column(c).to_pylist() for c in (
                "id", "a", "b"))):
            raw = text.as_buffer().to_pybytes()
            spans = []
            if froms:
                a, z = np.array(froms), np.array(tos)
                order = np.argsort(a, kind="stable")
                a, z = a[order], np.maximum.accumulate(z[order])
                head = np.append(True, a[1:] > z[:-1])  # touching runs are one
                ends = np.append(np.flatnonzero(head)[1:] - 1, len(a) - 1)
                spans = list(zip(a[head].tolist(), z[ends].tolist()))
            kept, at = [], 0
            for s, e in spans:
                kept.append(raw[at:s])
                at = e
            kept = b"".join([*kept, raw[at:]])
            for n, v in zip(names, (i, len(raw), len(raw) - len(kept), len(spans),
                                    hashlib.sha256(kept).hexdigest(), kept)):
                out[n].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=schema)


@dataclass
class _Places:
    """Places as one number: document rank times 2**bits plus byte start, in global order.

    A long if ids and lengths allow it, else a decimal; either is a flat aggregation buffer.
    """

    texts: DataFrame  # id, doc, text
    bits: int
    kind: str

    @staticmethod
    def of(docs: DataFrame) -> "_Places":
        out = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("id"),
                          F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        repeated = out.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > 1).limit(1).count()
        if repeated:  # texts of one id stand in the order of a hash
            order = Window.partitionBy("id").orderBy(F.xxhash64("text"))
            out = out.withColumn("part", (F.dense_rank().over(order) - 1).cast("long"))
        else:
            out = out.withColumn("part", F.lit(0).cast("long"))
        low, high, parts, longest = out.agg(F.min("id"), F.max("id"), F.max("part"),
                                            F.max(F.octet_length("text"))).first()
        low, parts, bits = low or 0, (parts or 0) + 1, int(longest or 0).bit_length() + 1
        kind = "long" if (((high or 0) - low + 1) * parts) << bits < _FITS else "decimal(38,0)"
        number = lambda c: F.col(c).cast(kind)
        doc = (number("id") - F.lit(low).cast(kind)) * F.lit(parts).cast(kind) + number("part")
        return _Places(out.select("id", doc.cast(kind).alias("doc"), "text"), bits, kind)

    def key(self):
        step = F.lit(1 << self.bits).cast(self.kind)
        return (F.col("doc") * step + F.col("start").cast(self.kind)).cast(self.kind)

    def split(self, key: str = "key"):
        """(doc, start) columns of a place."""
        if self.kind == "long":
            return (F.shiftright(key, self.bits).alias("doc"),
                    F.col(key).bitwiseAND(F.lit((1 << self.bits) - 1)).alias("start"))
        step = F.lit(1 << self.bits).cast(self.kind)
        return (F.floor(F.col(key) / step).cast(self.kind).alias("doc"),
                F.pmod(F.col(key), step).cast("long").alias("start"))


def removed_intervals(places: _Places) -> DataFrame:
    """(doc, a, b): byte ranges to remove of the texts in ``places``."""
    texts, kind = places.texts, places.kind
    spark = texts.sparkSession
    segments = texts.select("doc", "text").mapInArrow(
        _segments, f"gram long, seg long, doc {kind}, start long, meta int")
    segments = segments.select("gram", "seg", "meta", places.key().alias("key"))
    grams = materialize(segments.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("seg").alias("low"), F.max("seg").alias("high"),
        F.min("key").alias("first")).where(F.col("n") > 1).drop("n"), "grams")
    release(spark)
    mixed = F.col("low") != F.col("high")
    found = materialize(
        segments.join(grams.hint("shuffle_hash"), "gram").where(mixed | (F.col("key") != F.col("first")))
        .select(F.when(mixed, F.col("gram")).alias("gram"), F.when(mixed, F.col("seg")).alias("seg"),
                "key", "meta"), "segments")
    release(spark)

    def whole(rows: DataFrame) -> DataFrame:
        return rows.select(*places.split(), "meta").select(
            "doc", F.col("start").alias("a"),
            (F.col("start") + F.shiftright("meta", 8) + MATCH - 1).alias("b"))

    copies = whole(found.where(F.col("gram").isNull()))
    found = found.where(F.col("gram").isNotNull())
    firsts = materialize(found.groupBy("gram", "seg").agg(
        F.min("key").alias("first"), F.min("meta").alias("meta"), F.count("*").alias("n")),
        "first-segments")
    more = whole(found.join(firsts.where(F.col("n") > 1).select("gram", "seg", "first"), ["gram", "seg"])
                 .where(F.col("key") != F.col("first")))
    asked = (firsts.select(*places.split("first"), "meta").groupBy("doc")
             .agg(F.collect_list(F.struct("start", "meta")).alias("asked")))
    pieces = materialize(
        texts.join(asked, "doc").select("doc", "text", "asked")
        .mapInArrow(_pieces, f"core long, piece binary, doc {kind}, start long, n int")
        .select("core", "piece", "n", places.key().alias("key")), "pieces")
    release(spark)
    cores = pieces.groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("core")
    close = materialize(pieces.join(cores.hint("shuffle_hash"), "core", "left_semi"), "close-pieces")
    kinds = materialize(close.groupBy("core", "piece").agg(
        F.min("key").alias("first"), F.min("n").alias("n"), F.count("*").alias("rows")), "kinds")
    again = close.join(kinds.where(F.col("rows") > 1).select("core", "piece", "first"),
                       ["core", "piece"]).where(F.col("key") != F.col("first")) \
        .select(*places.split(), "n").select(
            "doc", F.col("start").alias("a"), (F.col("start") + F.col("n") + MATCH - 1).alias("b"))
    crowd = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where(F.col("kinds") > 1)
    rest = materialize(kinds.join(crowd, "core").select(
        "core", "piece", *places.split("first"), "n", "kinds"), "pieces-to-sort")
    total = rest.where(F.col("kinds") <= HOT).agg(F.sum(F.length("piece"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    merged = (rest.where(F.col("kinds") <= HOT)
              .withColumn("bucket", F.pmod(F.xxhash64("core"), F.lit(buckets)))
              .groupBy("bucket").applyInPandas(_sorted_bucket, f"doc {kind}, a long, b long"))
    windows = (rest.where(F.col("kinds") > HOT)
               .select("core", "doc", "start", "piece", F.explode(F.sequence(
                   F.lit(0), F.col("n") - 1)).alias("w"))
               .select("core", "doc", (F.col("start") + F.col("w")).alias("start"),
                       F.substring("piece", F.col("w") + 1, F.lit(MATCH)).alias("bytes"))
               .select("core", places.key().alias("key"), F.xxhash64("bytes").alias("h1"),
                       F.xxhash64(F.lit(1), "bytes").alias("h2")))
    least = windows.groupBy("core", "h1", "h2").agg(F.min("key").alias("first"),
                                                    F.count("*").alias("n")).where(F.col("n") > 1)
    hot = windows.join(least, ["core", "h1", "h2"]).where(F.col("key") != F.col("first")) \
        .select(*places.split()).select("doc", F.col("start").alias("a"),
                                        (F.col("start") + MATCH).alias("b"))
    return copies.union(more).union(again).union(merged).union(hot)


def remove_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per input row, with ``texts`` also kept.

    Places are ordered by (doc_id, start); null ids come first and null texts are empty. Rows
    that share id and text get equal results; different texts under one id are ordered by a
    hash of the text. Other columns are ignored; an empty table gives no rows.
    """
    places = _Places.of(docs)
    spans = removed_intervals(places).groupBy("doc").agg(
        F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    return (places.texts.join(spans, "doc", "left").select("id", "text", "a", "b")
            .mapInArrow(lambda batches: _apply(batches, texts),
                        "id long, n_bytes long, n_removed long, n_spans long, "
                        "kept_sha256 string" + (", kept binary" if texts else ""))
            .withColumn("doc_id", F.when(F.col("id") != _NULL, F.col("id"))))


def op6(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, texts=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
