"""Contiguous shards of near-equal byte size by global prefix sums.

Documents are ordered by id. Only (id, size, checksum) move: the narrow rows are range-partitioned
and sorted, every task sums up its own partition and numbers its rows, and the partitions' totals
(one row each) give every partition its base. A row's global start is base + own sum; the shard is
read off the start by cutting the whole at equal targets, so no row needs another one's answer and
no group is gathered. A cut falls at the document border that lies nearest to its target, so a
shard differs from its share by at most half a document at each end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import materialize

SHARDS = 8
#: Rows that equal ids, sizes and checksums may put into one range: they are spread by row number.
ORDER = ("doc_id", "size", "text_crc32", "_row")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32): UTF-8 bytes plus 1 and the unsigned checksum; a null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))


def _own_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sorted row's start and number within its partition."""
    part, size_before, rows_before = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column("size").to_numpy(zero_copy_only=False)
        ends = size_before + np.cumsum(size)
        yield pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"), "size": b.column("size"),
            "text_crc32": b.column("text_crc32"),
            "part": np.full(len(size), part, np.int32), "own_start": ends - size,
            "own_row": rows_before + np.arange(len(size), dtype=np.int64)})
        if len(size):
            size_before, rows_before = int(ends[-1]), rows_before + len(size)


def prefix_sums(rows: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, start, number) in global order, and the total size.

    The partition totals that pass through the driver are one pair of numbers per partition of
    the shuffle, a number that the session sets, not the data.
    """
    ordered = (rows.withColumn("_row", F.monotonically_increasing_id())
               .repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).drop("_row"))
    own = materialize(ordered.mapInArrow(
        _own_sums, "doc_id long, size long, text_crc32 long, part int, own_start long, own_row long"),
        "shard-sums")
    totals = sorted(map(tuple, own.groupBy("part").agg(F.sum("size"), F.count("*")).collect()))
    bases, size_before, rows_before = [], 0, 0
    for part, size, n in totals:
        bases.append((part, size_before, rows_before))
        size_before, rows_before = size_before + size, rows_before + n
    base = rows.sparkSession.createDataFrame(bases, "part int, base_start long, base_row long")
    # one row per partition of the shuffle
    return own.join(F.broadcast(base), "part").select(
        "doc_id", "size", "text_crc32", (F.col("own_start") + F.col("base_start")).alias("start"),
        (F.col("own_row") + F.col("base_row")).alias("number")), size_before


def cut(start: Column, size: Column, total: int, shards: int) -> Column:
    """The shard in whose share the middle of a row's bytes lies, in whole numbers only."""
    middle = (start * 2 + size) * shards
    return F.call_function("div", middle, F.lit(max(1, 2 * total)).cast("long")).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``, contiguous by id.

    Rows are ordered by id (nulls first), size and checksum; rows equal in all three are
    interchangeable, so the result does not depend on their order. Null and empty texts have
    size 1. ``slot`` counts a shard's rows from 0. An empty table gives no rows, a table with fewer
    rows than shards leaves shards empty, and one row larger than a share may do so as well. Other
    columns are ignored, whatever their names.
    """
    rows, total = prefix_sums(sizes(docs))
    rows = rows.withColumn("shard", cut(F.col("start"), F.col("size"), total, shards))
    # one row per shard
    first = rows.groupBy("shard").agg(F.min("number").alias("first"))
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("number") - F.col("first")).alias("slot"))


def op13(docs: DataFrame) -> DataFrame:
    """The contract's columns; the law is ``bytes``, so no grown shard is given."""
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                              "slot", F.lit(None).cast("int").alias("grown_shard"))
