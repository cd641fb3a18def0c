"""Shared helpers: table access, whole-text Arrow batches, folds and shared scratch tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotalens.session import scratch_path
from quotalens.sinks.files import remove

#: Bytes of text that one numpy step works on; a longer single text is its own step.
STEP_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read through Spark only (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string): the two columns operators read; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold(col, parts: int):
    """crc32 of the id's decimal text, modulo ``parts`` (null id: null)."""
    return F.crc32(col.cast("string")) % F.lit(parts)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back (cuts the lineage).

    A lost executor costs a retry of the tasks that wrote, never of the consumers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once all that is derived from them is written too;
    shuffle files of the finished steps go with them."""
    spark = written[0].sparkSession
    for df in written:
        remove(spark, df.scratch)
    release(spark)


def hash_share(total: int, wanted: int, *columns):
    """Condition that keeps about ``wanted`` of ``total`` rows, by a hash of columns.

    Needs no sort and moves no row; at most ``total`` rows are kept, and 5 % of room keeps the
    number below ``wanted`` in practice.
    """
    if total <= wanted:
        return F.lit(True)
    return F.xxhash64(*columns) < F.lit(int(-(1 << 63) + 0.95 * wanted / total * (1 << 64)))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not at some later collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def steps(batches: Iterator[pa.RecordBatch], column: str = "text",
          max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of at most ``max_bytes`` of text (at least one row)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                         .to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to


def flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the offsets (length n + 1) of each text."""
    if strings.null_count:
        strings = pc.fill_null(strings, "")
    strings = strings.cast(pa.large_binary())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:
                                                            strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalising mix (public splitmix constants) of an unsigned array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged_arange(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, end to end."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    starts = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(starts, counts)


_ODD = 0x9E3779B97F4A7C15
#: ASCII letters in lower case and digits keep a value, other ASCII bytes separate words.
_WORD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128
                  else 0 for c in range(256)], np.uint8)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, at least ``n`` of them."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            out = np.full(max(n, STEP_BYTES + (1 << 18)), base, np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"], _POWERS["down"]


def words_of(raw: np.ndarray, offs: np.ndarray):
    """Words of texts laid end to end, without a Python object per word.

    A word is a run of ASCII letters, digits and non-ASCII bytes; ASCII case is folded. Returns
    64-bit hashes that depend on the word alone, byte starts and ends, and word offsets by text.
    """
    code = _WORD[raw]
    n = len(raw)
    inside = code != 0
    edge = np.empty(n + 1, bool)
    if n:
        edge[0], edge[n] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=edge[1:n])
        cut = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < n)]
        cut = cut[inside[cut - 1] & inside[cut]]  # words that touch across two texts
    else:
        edge[0], cut = False, np.zeros(0, np.int64)
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    if len(cut):
        cut = np.unique(cut)
        starts = np.sort(np.concatenate([starts, cut]))
        ends = np.sort(np.concatenate([ends, cut]))
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(code * up[:n], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * down[starts])
    return hashes, starts, ends, np.searchsorted(starts, offs)
