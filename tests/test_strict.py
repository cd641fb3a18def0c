"""Strict parsing raises on a staged bad rate; lenient parsing counts it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from quotalens.plans import accrual as acc
from quotalens.plans import attainment as att

RUN = dt.date(2026, 1, 31)


def with_bad_rate(src, where):
    inc = src["cs_incentive"]
    return src.with_table("cs_incentive", inc.withColumn("genericattribute4", F.when(where, F.lit("n/a")).otherwise(
        F.col("genericattribute4"))))


def good(src):
    """The tables with every rate a number (the fixture holds some that are none)."""
    inc = src["cs_incentive"]
    return src.with_table("cs_incentive", inc.withColumn("genericattribute4", F.lit("1,25.5%")))


def test_strict_runs_give_the_same_rows_when_all_parse(src, oct_params):
    ok = good(src)
    assert rows(att.attainment_extract(ok, oct_params, strict=True)) == rows(att.attainment_extract(ok, oct_params))
    strict, plain = (acc.accrual_staging(ok, oct_params, strict=s) for s in (True, False))
    assert strict.dtypes == plain.dtypes and rows(strict) == rows(plain)


def test_one_bad_rate_stops_a_strict_extract_and_is_counted_otherwise(src, oct_params):
    ok = good(src)
    hit = (att.incentive_facts(ok, oct_params).join(
        att.payee_snapshot(ok, oct_params).select("positionseq", "payeeseq"), ["positionseq", "payeeseq"], "left_semi")
        .where(F.col("genericattribute16") == att.MONTHLY).select("positionseq", "payeeseq", "periodseq").first())
    bad = with_bad_rate(ok, (F.col("positionseq") == hit.positionseq) & (F.col("payeeseq") == hit.payeeseq)
                        & (F.col("periodseq") == hit.periodseq))
    with pytest.raises(Exception, match="not a number in an exchange rate: n/a"):
        att.attainment_extract(bad, oct_params, strict=True).collect()
    assert att.attainment_extract(bad, oct_params).count() > 0
    assert att.attainment_log(bad, oct_params).first().failed_parses > 0
    assert att.attainment_log(ok, oct_params).first().failed_parses == 0


def test_bad_rates_off_the_report_do_not_stop_it(src, oct_params):
    ok = good(src)
    staff = att.payee_snapshot(ok, oct_params).select("payeeseq").distinct()
    known = [r[0] for r in staff.collect()]
    bad = with_bad_rate(ok, ~F.col("payeeseq").isin(known))
    assert rows(att.attainment_extract(bad, oct_params, strict=True)) == rows(
        att.attainment_extract(ok, oct_params))


@pytest.mark.parametrize("rules", acc.RULES)
def test_strict_staging_raises_lenient_counts(src, oct_params, rules):
    bad = with_bad_rate(good(src), F.col("genericattribute1") == acc.YOY)
    with pytest.raises(Exception, match="not a number or zero rate in arm yoy"):
        acc.accrual_staging(bad, oct_params, rules, strict=True).collect()
    counts = {r.arm: r.failed_parses for r in acc.step_log(acc.accrual_staging(bad, oct_params, rules)).collect()}
    assert counts["yoy"] > 0


def test_strict_job_logs_its_failure(spark, src, oct_params, tmp_path):
    bad = with_bad_rate(good(src), F.col("genericattribute1") == acc.YOY)
    with pytest.raises(Exception, match="in arm yoy"):
        acc.accrual_job(bad, oct_params, str(tmp_path / "out"), RUN, root=str(tmp_path / "t"), strict=True)
    (entry,) = spark.read.parquet(str(tmp_path / "t/step_log")).collect()
    assert entry.step == "staging" and entry.message.startswith("failed: ")


def test_attainment_report_writes_files_and_counts_bad_rates(spark, src, oct_params, tmp_path):
    log = att.attainment_report(src, oct_params, str(tmp_path / "out"), RUN, root=str(tmp_path / "t")).collect()
    assert [r.step for r in log] == ["report", "file", "facts"]
    assert log[1].message == "YTD_ATTAINMENT_DETAIL_October_1998_20260131.csv"
    assert log[2]["rows"] == att.incentive_facts(src, oct_params).count()
    assert spark.read.parquet(str(tmp_path / "t/step_log")).count() == 3
