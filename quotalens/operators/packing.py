"""Text columns as one for a shuffle: a slot and padding for each text are most of a wide row's bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXTS, LENGTHS = "_texts", "_lengths"


def text_columns(rows: DataFrame) -> list[str]:
    return [name for name, kind in rows.dtypes if kind == "string"]


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with the bytes of all texts in one column and their lengths in another (-1: null).

    Two rows are equal packed if and only if they are equal.
    """
    texts = text_columns(rows)
    return rows.select(
        *[c for c in rows.columns if c not in texts],
        F.concat(*[F.coalesce(F.col(c), F.lit("")).cast("binary") for c in texts]).alias(TEXTS),
        F.array(*[F.coalesce(F.octet_length(c), F.lit(-1)) for c in texts]).alias(LENGTHS))


def unpacked(texts: list[str]) -> dict[str, Column]:
    """The texts of a packed row by name; ``texts`` as ``text_columns`` gave them."""
    length = [F.col(LENGTHS)[k] for k in range(len(texts))]
    return {name: F.when(length[k] >= 0, F.substring(
        TEXTS, reduce(Column.__add__, [F.greatest(n, F.lit(0)) for n in length[:k]], F.lit(1)), length[k])
        .cast("string")).alias(name) for k, name in enumerate(texts)}
