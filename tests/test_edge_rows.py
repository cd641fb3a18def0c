"""Hand-made edge rows (FIXTURES.md section 4) grafted onto the sf0.001 fixture tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotalens.operators.params import params
from quotalens.operators.payees import payee_snapshot
from quotalens.operators.periods import period_types
from quotalens.plans import accrual as acc
from quotalens.plans import attainment as att

EOT = dt.date(2200, 1, 1)


def _one_incentive(src, **over):
    """A copy of one reported Monthly incentive of October 1998 whose payee is in the
    snapshot, with fields replaced."""
    snap = payee_snapshot(src, params(src, "PU1", ["October 1998"])).select(
        F.col("positionseq").alias("sp"), F.col("payeeseq").alias("sy"))
    inc = src["cs_incentive"].where(
        (F.col("periodseq") == 199904) & (F.col("processingunitseq") == 1)
        & (F.col("genericattribute16") == "Monthly Target Attainment")
        & (F.col("incentiveseq") < 5000000000))
    base = inc.join(snap, (inc.positionseq == snap.sp) & (inc.payeeseq == snap.sy), "left_semi") \
        .orderBy("incentiveseq").limit(1)
    cols = []
    for c in base.columns:
        cols.append(F.lit(over[c]).cast(dict(base.dtypes)[c]).alias(c) if c in over else F.col(c))
    return base.select(*cols)


def test_both_flags_sum_twice(spark, src):
    row = _one_incentive(src, incentiveseq=900000001, genericboolean1=1, genericboolean3=1,
                         value=Decimal("10"), genericnumber1=Decimal("7"))
    pos = row.select("positionseq", "payeeseq").first()
    # isolate: only this incentive
    s2 = src.with_table("cs_incentive", row)
    p = params(s2, "PU1", ["October 1998"])
    facts = att.incentive_facts(s2, p)
    assert facts.count() == 2  # flag-1 copy and flag-3 copy
    ext = att.attainment_extract(s2, p).collect()
    assert pos is not None and len(ext) == 1
    r = ext[0]
    assert r["Current Month Commission Earned (LOC)"] == Decimal("20")  # summed twice
    assert r["Quota"] == Decimal("7")  # max over the copies: 7 and 1
    assert r["YTD Comm Earned%"] is not None  # the flag-3 copy has quota 1


def test_quota_exactly_one_feeds_earned_percent(spark, src):
    row = _one_incentive(src, incentiveseq=900000002, genericboolean1=1, genericboolean3=None,
                         genericnumber1=Decimal("1"), genericnumber3=Decimal("0.42"))
    s2 = src.with_table("cs_incentive", row)
    p = params(s2, "PU1", ["October 1998"])
    got = att.attainment_extract(s2, p).collect()
    assert len(got) == 1 and got[0]["YTD Comm Earned%"] == Decimal("0.42")


def test_type_name_MONTH_not_recognised(spark, src):
    pt = spark.createDataFrame([(1, "MONTH", EOT), (2, "quarter", EOT), (3, "SEMIANNUAL", EOT),
                                (4, "Year", EOT)], "periodtypeseq bigint, name string, removedate date")
    r = period_types(src.with_table("cs_periodtype", pt)).first()
    assert r["month_type"] is None and r["quarter_type"] == 2 and r["half_type"] == 3 \
        and r["year_type"] == 4


def test_effective_dating_boundaries(spark, src):
    p = params(src, "PU1", ["October 1998"])  # period end 1998-11-01
    snap = payee_snapshot(src, p)
    # key % 8 == 0 participants have versions split at the period end: only the first is in force
    split = snap.where(F.col("payeeseq") % 8 == 0).select("site").collect()
    assert split and all(not r["site"].endswith("(moved)") for r in split)
    # terminated 1998-10-15 (inside the period) is kept; 1998-09-15 (before start) is dropped
    ids = {r["payeeseq"] for r in snap.select("payeeseq").collect()}
    assert not any(k % 13 == 0 for k in ids)


def test_terminated_on_first_day_kept(spark, src):
    pt = src["cs_participant"].withColumn(
        "terminationdate", F.when(F.col("payeeseq") % 13 == 0, F.lit(dt.date(1998, 10, 1)))
        .otherwise(F.col("terminationdate")))
    s2 = src.with_table("cs_participant", pt)
    snap = payee_snapshot(s2, params(s2, "PU1", ["October 1998"]))
    assert snap.where(F.col("payeeseq") % 13 == 0).count() > 0


def test_two_billto_addresses_raise(spark, src, oct_params):
    staged = acc.accrual_staging(src, oct_params)
    txn = staged.where(F.col("salestransactionseq").isNotNull()).select(
        "salestransactionseq").first()[0]
    extra = spark.createDataFrame([(txn, 1, "X", "Y", "P0", "Z")],
                                  "salestransactionseq bigint, addresstypeseq bigint, country string,"
                                  " state string, custid string, company string")
    s2 = src.with_table("cs_transactionaddress", src["cs_transactionaddress"].unionByName(extra))
    with pytest.raises(Exception, match="more than one BILLTO"):
        acc.billto_enrich(s2, staged).collect()


def test_no_address_gives_nulls(spark, src, oct_params):
    staged = acc.accrual_staging(src, oct_params)
    empty = src["cs_transactionaddress"].where(F.lit(False))
    out = acc.billto_enrich(src.with_table("cs_transactionaddress", empty), staged)
    assert out.where(F.col("billto_country").isNotNull()).count() == 0
    assert out.count() == staged.count()


def test_guarantee_rows_never_find_an_address(spark):
    from quotalens.plans.catalog import sources_for
    s = sources_for(spark, "/root/testdata/sf0.01")
    p = params(s, "PU1", ["October 1998"])
    g = acc.billto_enrich(s, acc.arm_guarantee(s, p))
    assert g.count() == 7 and g.where(F.col("billto_country").isNotNull()).count() == 0


def test_plan_element_null_not_in_regular_arm(spark, src, oct_params):
    inc = src["cs_incentive"].withColumn("genericattribute1", F.lit(None).cast("string"))
    s2 = src.with_table("cs_incentive", inc)
    assert acc.arm_regular(s2, oct_params).count() == 0


def test_bad_fx_text_is_null_and_counted(spark, src, oct_params):
    inc = src["cs_incentive"].withColumn("genericattribute4", F.lit("abc"))
    s2 = src.with_table("cs_incentive", inc)
    staged = acc.accrual_staging(s2, oct_params)
    log = {r["arm"]: r for r in acc.step_log(staged).collect()}
    assert log["yoy"]["failed_parses"] == log["yoy"]["rows"] > 0
    assert staged.where((F.col("arm") == "yoy") & F.col("exchange_rate").isNotNull()).count() == 0


def test_fy25_zero_rate_is_null_and_counted(spark, src, oct_params):
    staged = acc.accrual_staging(src, oct_params, rules="FY25")
    reg = staged.where(F.col("arm") == "regular")
    zero = reg.where(F.col("ratevalue") == 0)
    assert zero.count() > 0
    assert zero.where(F.col("trxn_amount").isNotNull()).count() == 0
    assert reg.where(F.col("parse_failed") == 1).count() >= zero.count()


def test_masking_only_in_fy26(spark, src, oct_params):
    s26 = acc.accrual_details(acc.accrual_staging(src, oct_params), "FY26")
    masked = s26.where(F.col("Credit Type").isin("Roll up", "Direct Receiver", "Revenue Adjustment"))
    assert masked.where(F.col("Local Currency").isNotNull()).count() == 0
    s25 = acc.accrual_details(acc.accrual_staging(src, oct_params, rules="FY25"), "FY25")
    shown = s25.where(F.col("Credit Type").isin("Roll up", "Direct Receiver", "Revenue Adjustment"))
    assert shown.count() == 0 or shown.where(F.col("Local Currency").isNotNull()).count() > 0
