"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most so many keys can be hot, whatever the data: a key needs more than 1 / MOST_HOT of all rows.
MOST_HOT = 1000
SHARE_ROWS = 1_000_000


def hot_keys(rows: DataFrame, keys: Sequence[str], share_rows: int = SHARE_ROWS) -> DataFrame:
    """(keys, shares): keys with more than ``share_rows`` rows and more than a thousandth of all.

    Fewer than ``MOST_HOT`` keys by construction; ``shares`` is into how many parts such a key's
    rows go. Rows with a null key join nothing and are not counted.
    """
    counts = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_all"))
    # one row
    return counts.crossJoin(F.broadcast(total)).where(
        (F.col("_n") > share_rows) & (F.col("_n") * MOST_HOT > F.col("_all"))).select(
        *keys, F.ceil(F.col("_n") / F.greatest(F.lit(share_rows), F.col("_all") / MOST_HOT))
        .cast("int").alias("shares"))


def salted_join(rows: DataFrame, side: DataFrame, on: Sequence[tuple[str, str]], spread_by: str,
                hot: DataFrame) -> DataFrame:
    """Inner equi-join of many ``rows`` with a ``side`` that has few rows per key.

    A hot key's rows are dealt to its shares by a hash of ``spread_by``, and its rows in ``side`` are
    repeated once per share, so no task gets more of it than a share. Other keys join as ever. The
    result is that of the plain join. ``hot`` (keys named as in ``rows``, shares) has fewer than
    ``MOST_HOT`` rows and is broadcast.
    """
    named = [f"_hot_{k}" for k, _ in on]
    few = F.broadcast(hot.select(*[F.col(k).alias(n) for (k, _), n in zip(on, named)],
                                 F.col("shares").alias("_shares")))

    def marked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        same = None
        for c, n in zip(columns, named):
            same = (F.col(c) == F.col(n)) if same is None else same & (F.col(c) == F.col(n))
        return df.join(few, same, "left").drop(*named)

    left = marked(rows, [k for k, _ in on]).withColumn("_share", F.when(
        F.col("_shares").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread_by), F.col("_shares"))).cast("int"))
    right = marked(side, [k for _, k in on]).withColumn("_part", F.explode(
        F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1)))
    same = F.col("_share") == F.col("_part")
    for a, b in on:
        same = same & (F.col(a) == F.col(b))
    return left.drop("_shares").join(right.drop("_shares"), same).drop("_share", "_part")
