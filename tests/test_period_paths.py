"""Access paths by period: equal reports, pruned plans, refresh; the salted bridge."""

import os
import re

import pytest
from pyspark.sql import functions as F

from quotalens.operators.params import params
from quotalens.operators.skew import MOST_HOT, hot_keys, salted_join
from quotalens.plans import accrual as acc
from quotalens.sources import period_paths as paths
from tests.helpers import rows

USED = ["cs_processingunit", "cs_calendar", "cs_periodtype", "cs_period", "cs_incentive", "cs_incentiveselftrace",
        "cs_incentivepmtrace", "cs_measurement", "cs_pmcredittrace", "cs_credit", "cs_credittype", "cs_commission",
        "cs_salestransaction", "cs_eventtype", "cs_salesorder", "cs_transactionaddress", "cs_addresstype",
        "rpt_orgdata"]


@pytest.fixture(scope="module")
def plain(src, tmp_path_factory):
    return src.write_parquet(str(tmp_path_factory.mktemp("catalog")), names=USED)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("paths"))


@pytest.fixture(scope="module")
def pathed(plain, root):
    return paths.write_paths(plain, root)


def enriched(sources, names, rules):
    p = params(sources, "PU1", names)
    return acc.billto_enrich(sources, acc.accrual_staging(sources, p, rules=rules), p)


def scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text, [ln for ln in text.split("\n") if "FileScan parquet" in ln]


@pytest.mark.parametrize("rules", ["FY26", "FY25"])
def test_reports_equal_with_and_without_paths(plain, pathed, rules):
    two = ["September 1998", "October 1998"]
    want = rows(enriched(plain, two, rules))
    assert len(want) > 10 and rows(enriched(pathed, two, rules)) == want


@pytest.mark.parametrize("rules", ["FY26", "FY25"])
def test_one_period_reads_no_large_table_whole(pathed, rules):
    text, found = scans(enriched(pathed, ["October 1998"], rules))
    for name in ("cs_salestransaction", "cs_salesorder", "cs_transactionaddress", "cs_incentiveselftrace"):
        assert not [ln for ln in found if f"/{name}]" in ln], name
    large = [ln for ln in found if re.search(r"/(path_\w+|cs_(incentive|credit|measurement|pmcredittrace|"
                                             r"incentivepmtrace|commission)|rpt_orgdata)\]", ln) and "path_hot" not in ln]
    assert len(large) >= 8
    for ln in large:
        assert re.search(r"PartitionFilters: \[[^]]*(periodseq|targetperiodseq)#\d+L? (IN|=)", ln), ln


def test_distinct_is_taken_before_the_wide_columns(spark, plain, pathed):
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")

    def widest(sources):
        p = params(sources, "PU1", ["October 1998"])
        text, _ = scans(acc.arm_regular(sources, p))
        return max(len(re.findall(r"#\d+", e)) for e in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", text))
    # NULL padding is folded away; what is left of the 58 columns were the keys
    try:
        assert widest(plain) > 40 and widest(pathed) < 25
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_refresh_replaces_single_periods(plain, tmp_path):
    period, root = 199904, str(tmp_path)
    pathed = paths.write_paths(plain, root)
    before = rows(pathed["path_transaction"].where(F.col("periodseq") != period))
    old = pathed["path_transaction"].where(F.col("periodseq") == period)
    assert old.count() > 1
    some = [r[0] for r in old.select("st_seq").limit(1).collect()]
    credit = plain["cs_credit"]
    fewer = plain.with_table("cs_credit", credit.where(
        (F.col("periodseq") != period) | F.col("salestransactionseq").isin(some)))
    now = paths.refresh(fewer, root, [period])["path_transaction"]
    assert [r.st_seq for r in now.where(F.col("periodseq") == period).collect()] == some
    none = plain.with_table("cs_credit", credit.where(F.col("periodseq") != period))
    now = paths.refresh(none, root, [period])
    assert now["path_transaction"].where(F.col("periodseq") == period).count() == 0
    assert rows(now["path_transaction"]) == before
    assert not os.path.exists(f"{root}/path_billto/periodseq={period}")


def test_two_billto_rows_raise_only_if_staged(plain, pathed, tmp_path):
    p = params(plain, "PU1", ["October 1998"])
    staged = [r[0] for r in acc.accrual_staging(pathed, p).where("arm <> 'guarantee'")
              .select("salestransactionseq").distinct().collect()]
    addr = plain["cs_transactionaddress"]
    bill = addr.where(F.col("addresstypeseq") == 1)
    other = bill.where(~F.col("salestransactionseq").isin(staged)).limit(3)
    s = plain.with_table("cs_transactionaddress", addr.union(other))
    ok = paths.write_paths(s, str(tmp_path / "a"))
    assert rows(acc.billto_enrich(ok, acc.accrual_staging(ok, p), p)) == rows(enriched(plain, ["October 1998"], "FY26"))
    twice = bill.where(F.col("salestransactionseq").isin(staged)).limit(1)
    bad = paths.write_paths(plain.with_table("cs_transactionaddress", addr.union(twice)), str(tmp_path / "b"))
    with pytest.raises(Exception, match="more than one BILLTO address"):
        acc.billto_enrich(bad, acc.accrual_staging(bad, p), p).collect()


# -- skew -------------------------------------------------------------------------------

def test_hot_keys_are_few_and_need_many_rows(spark):
    df = spark.range(0, 9000).selectExpr("if(id % 3 = 0, 1, id) as k", "id as v")
    hot = hot_keys(df, ["k"], 100).collect()
    assert [(r.k, r.shares) for r in hot] == [(1, 31)]  # 3,001 rows
    assert hot_keys(df, ["k"], 5000).count() == 0
    assert hot_keys(spark.range(0, 100_000).selectExpr("id % 5000 as k"), ["k"], 1).count() == 0 < MOST_HOT
    assert hot_keys(spark.createDataFrame([(None,)] * 9, "k int"), ["k"], 1).count() == 0


def test_salted_join_equals_plain_join_and_splits_the_hot_key(spark):
    left = spark.range(0, 30_000, 1, 6).selectExpr(
        "case when id % 3 = 0 then 7 when id % 11 = 0 then null else id % 400 end as k", "id % 2 as u", "id as v")
    right = spark.range(0, 500).selectExpr("if(id < 5, 7, id) as m", "id % 2 as w", "id as x")
    hot = hot_keys(left, ["k", "u"], 500)
    got = salted_join(left, right, [("k", "m"), ("u", "w")], "v", hot)
    want = left.join(right, (left.k == right.m) & (left.u == right.w))
    assert rows(got.select(want.columns)) == rows(want)
    # the hot key's rows meet in several partitions of the join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, [("k", "m"), ("u", "w")], "v", hot)
        parts = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\([^)]*_share", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_bridge_with_one_measurement_fed_by_a_third_of_all_credits(spark, src):
    m = src["cs_measurement"].where("processingunitseq = 1").orderBy("measurementseq").first()
    extra = spark.range(0, 3000).select(
        (F.col("id") + 10**9).alias("creditseq"), F.lit(m.measurementseq).alias("measurementseq"),
        F.lit(m.periodseq).alias("targetperiodseq"), F.lit(m.processingunitseq).alias("processingunitseq"))
    skewed = src.with_table("cs_pmcredittrace", src["cs_pmcredittrace"].union(extra))
    hot = hot_keys(paths.credit_traces(skewed), paths.MEASUREMENT_KEYS, 200)
    assert [r.b_meas for r in hot.collect()] == [m.measurementseq] and hot.first().shares > 10
    cold = hot.where("false")
    assert rows(acc.bridge(skewed, hot=hot)) == rows(acc.bridge(skewed, hot=cold))
    assert acc.bridge(skewed, hot=hot).where(F.col("b_credit") >= 10**9).count() >= 3000
