"""The filter before a join: no row is lost, few others pass, and one month's report shuffles few rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quotalens.operators import presence
from quotalens.operators.params import params
from quotalens.plans import accrual as acc
from tests.helpers import rows


def test_matching_rows_pass_and_few_others(spark):
    keys = spark.range(0, 3000).select((F.col("id") * -977).cast("int").alias("a")).union(
        spark.createDataFrame([(None,), (977,)], "a int"))
    bits = presence.key_bits(keys.union(keys), "a")
    assert 0 < bits.count() <= 3001 < presence.WORDS
    side = spark.range(-3000, 40_000).select((F.col("id") * 977).alias("k"), (F.col("id") % 7).alias("v"))
    side = side.union(side.limit(100)).union(spark.createDataFrame([(None, 1)], "k long, v long"))
    kept = presence.may_match(side, "k", bits)
    assert kept.columns == side.columns and kept.count() < 6200
    join = lambda s: rows(s.join(keys, s.k == F.col("a")))
    assert join(kept) == join(side) and len(join(side)) > 3000
    assert presence.may_match(side, "k", presence.key_bits(keys.where("false"), "a")).count() == 0


def test_every_bit_of_a_word_is_told_apart(spark):
    # among many keys some set the first, the last and the sign bit of a word
    keys = spark.range(0, 200_000)
    bits = presence.key_bits(keys, "id")
    assert presence.may_match(keys, "id", bits).count() == 200_000
    assert bits.where("_bits < 0").count() > 0


def enriched(sources, rules, names=("October 1998",)):
    p = params(sources, "PU1", list(names) if names else None)
    return acc.billto_enrich(sources, acc.accrual_staging(sources, p, rules=rules), p)


@pytest.mark.parametrize("rules", acc.RULES)
def test_one_month_without_paths_reads_its_credits_only(spark, src, tmp_path_factory, rules):
    facts = ["cs_credit", "cs_commission", "cs_salestransaction", "cs_transactionaddress"]
    cat = src.write_parquet(str(tmp_path_factory.mktemp("c")), facts)
    from quotalens.sources.tables import Sources
    s = Sources(src.spark, {n: cat[n] if n in facts else src[n] for n in src})
    found = enriched(s, rules)
    scans = [ln for ln in found._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan parquet" in ln]
    own = [ln for ln in scans if re.search(r"/cs_(credit|commission)\]", ln)]
    assert own and all(re.search(r"PartitionFilters: \[[^]]*periodseq#\d+L? (IN|=)", ln) for ln in own)
    # transactions and addresses meet the bits before they are shuffled
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("getbit(_bits") >= 2


@pytest.mark.parametrize("rules", acc.RULES)
def test_a_run_restricted_to_its_transactions_has_the_rows_of_one_that_is_not(src, monkeypatch, rules):
    got = rows(enriched(src, rules))
    src.__dict__.pop("_memo", None)
    monkeypatch.setattr(acc, "many_periods", lambda *_: True)
    assert len(got) > 5 and rows(enriched(src, rules)) == got
    src.__dict__.pop("_memo", None)
