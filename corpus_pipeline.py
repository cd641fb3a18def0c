"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and is written
as Parquet and read again before the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotalens.llm import decontaminate, pieces, secrets, simhash, toxicity
from quotalens.llm.common import materialize, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on their labelled part, doesn't reject.

    Null and empty texts are scored as empty texts, repeated rows stay or go together; without labels
    of both classes, or with an empty table, nothing is rejected. All columns are passed on.
    """
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of SimHash near-duplicates: that of the least id, numbered first if ids tie.

    Null and empty texts are copies of each other; rows of one id with unlike texts all stay; a row
    without an id stays only if its group has no id. An empty table gives an empty one.
    """
    return simhash.keep_one(docs)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no benchmark item; null and empty texts, and all rows if there are no
    items, stay. Repeated rows stay or go together, whatever their ids. An empty table gives an empty one.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their secrets replaced by a mark; null texts stay null, nothing else changes."""
    return secrets.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether decoding gives the text again, for every row.

    A null text is encoded as an empty one. Other columns are dropped; an empty table gives no rows.
    """
    return pieces.encode(docs, pieces.MODEL_FILE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_out),
    ("near_duplicates", copies_out),
    ("decontamination", leaks_out),
    ("secrets", secrets_masked),
    ("sentencepiece", encoded),
]

#: No stage but the last could be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``, each stage written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
