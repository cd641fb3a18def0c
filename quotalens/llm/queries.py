"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from quotalens.llm import (
    collocations, decontaminate, fingerprints, langid, mixing, oracle, paragraphs, periodic, pieces,
    secrets, sharding, simhash, substrings, toxicity,
)
from quotalens.llm.common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {"op11_phrase_collocations": oracle.COLLOCATIONS,
                          "op13_contiguous_shards": oracle.SHARDS}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_lcp_fingerprints(spark, sf_dir):
    return fingerprints.op2(table(spark, sf_dir, "documents"))


@query
def op3_secret_scan(spark, sf_dir):
    return secrets.op3(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark, sf_dir):
    return toxicity.op4(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_language_id(spark, sf_dir):
    return langid.op5(table(spark, sf_dir, "documents"))


@query
def op8_simhash_neardup(spark, sf_dir):
    return simhash.op8(table(spark, sf_dir, "documents"))


@query
def op7_sentencepiece(spark, sf_dir):
    return pieces.op7(table(spark, sf_dir, "documents"))


@query
def op10_decontamination(spark, sf_dir):
    return decontaminate.op10(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_bwt_substrings(spark, sf_dir):
    return substrings.op6(table(spark, sf_dir, "documents"))


@query
def op1_paragraph_minhash(spark, sf_dir):
    return paragraphs.op1(table(spark, sf_dir, "documents"))


@query
def op9_context_mixing(spark, sf_dir):
    return mixing.op9(table(spark, sf_dir, "documents"))


@query
def op11_phrase_collocations(spark, sf_dir):
    return collocations.op11(table(spark, sf_dir, "documents"))


@query
def op12_periodic_runs(spark, sf_dir):
    return periodic.op12(table(spark, sf_dir, "documents"))


@query
def op13_contiguous_shards(spark, sf_dir):
    return sharding.op13(table(spark, sf_dir, "documents"))
