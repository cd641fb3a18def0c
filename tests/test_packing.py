"""Texts packed for a shuffle, and tables that are dealt or read once."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quotalens.operators.packing import packed, text_columns, unpacked
from quotalens.sources import period_paths as paths


def test_packed_texts_come_back_byte_by_byte(spark):
    data = [(1, "a", None, "ü€"), (2, "", "", ""), (3, None, None, None), (4, "ab", "c", ""), (5, "a", "bc", ""),
            (6, "\x00\x01,", "two\nlines", "𝄞"), (7, "x" * 70_000, " ", None)]
    rows = spark.createDataFrame(data, "k int, a string, b string, c string").repartition(3)
    # bytes that are no text
    rows = rows.withColumn("c", F.when(F.col("k") == 4, F.unhex(F.lit("E2")).cast("string")).otherwise(F.col("c")))
    small = packed(rows.union(rows))
    assert small.columns == ["k", "_texts", "_lengths"]
    texts = unpacked(text_columns(rows))
    back = small.distinct().select(*[texts.get(c, F.col(c)) for c in rows.columns])
    hexed = lambda df: sorted(map(str, df.select("k", *[F.hex(F.col(c).cast("binary")) for c in "abc"]).collect()))
    assert hexed(back) == hexed(rows)


def test_packed_rows_are_equal_only_if_the_rows_are(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("abc", ""), ("abc", None), ("", "abc"), (None, "abc")],
                                 "a string, b string")
    assert packed(rows.union(rows)).distinct().count() == 6


def test_the_transaction_path_deals_its_texts_packed(src):
    plan = paths.transaction_path(src)._jdf.queryExecution().executedPlan().toString()
    keys = [k for k in re.findall(r"HashAggregate\(keys=\[([^]]*)\]", plan) if "st_unit" in k]
    assert keys and all("_texts" in k and "st_productdesc" not in k for k in keys)


def test_addresses_read_the_transactions_once(src):
    plan = src["cs_transactionaddress"]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*/transactions-", plan)) == 1
