"""Report jobs: many targets, order inside files, full scale of money, refresh by name, pruning."""

import datetime as dt
import os
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from quotalens.functions import exprs as X
from quotalens.operators.params import params, period_keys
from quotalens.plans import accrual as acc
from quotalens.plans import attainment as att
from quotalens.session import ensure_checkpoint_dir
from quotalens.sinks.report import full_refresh, read_reports, read_table, write_report, write_reports

TWO = ["September 1998", "October 1998"]


def test_money_products_are_exact_over_the_whole_range(spark):
    pairs = [("12345678901.0123456789", "0.9254376100"), ("-12345678901234.0123456789", "1.0500000001"),
             ("99999999999999.9999999999", "9.9999999999"), ("0.0000000001", "0.5000000000"),
             ("-0.0000000001", "0.5"), ("-0.0000000003", "0.5"), ("14567890123456.5", "0.0000000001"),
             ("3.5", "1234567890.1234567891"), ("0", "1.1"), (None, "1"), ("1", None)]
    rnd = random.Random(4)
    pairs += [(f"{rnd.choice('+-')}{rnd.randrange(10**14)}.{rnd.randrange(10**10):010d}",
               f"{rnd.choice('+-')}{rnd.randrange(9)}.{rnd.randrange(10**10):010d}") for _ in range(300)]
    rows = [(k, a and Decimal(a), b and Decimal(b)) for k, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "k int, a decimal(25,10), b decimal(20,10)")
    got = {r.k: r.p for r in df.select("k", X.exact_product("a", "b").cast("decimal(25,10)").alias("p")).collect()}
    with localcontext(prec=60):
        for k, a, b in rows:
            want = None if a is None or b is None else (a * b).quantize(Decimal("1e-10"), ROUND_HALF_UP)
            assert got[k] == want, (a, b)


def test_bad_weight_text_raises_instead_of_dropping_the_row(spark):
    df = spark.createDataFrame([("5%",), (None,), ("n/a",)], "w string")
    assert df.where("w is null or w <> 'n/a'").where(X.checked_number("w", "w") > 0).count() == 1
    with pytest.raises(Exception, match="not a number in w: n/a"):
        df.where(X.checked_number("w", "w") > 0).collect()


def test_text_rows_of_two_targets_stay_apart(src):
    p = params(src, "PU1", TWO)
    both = att.attainment_extract(src, p)
    out = att.attainment_out(both, params=p)
    single = sum(att.attainment_out(att.attainment_extract(src, params(src, "PU1", [n])).drop(
        "target_periodseq")).count() for n in TWO)
    assert out.count() == single and out.columns[0] == "target_periodseq"


def test_many_periods_equal_single_runs(src):
    rows = lambda df: sorted(map(str, df.collect()))
    many = acc.accrual_details(acc.accrual_staging(src, params(src, "PU1", TWO)), by_period=True)
    one = [acc.accrual_details(acc.accrual_staging(src, params(src, "PU1", [n])), by_period=True) for n in TWO]
    assert rows(many) == rows(one[0].union(one[1]))


def file_rows(folder):
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return [line.rstrip("\n") for f in parts for line in open(os.path.join(folder, f))]


def test_rows_are_in_order_inside_the_files(spark, tmp_path):
    df = spark.range(0, 400).select((F.col("id") % 3).alias("target_periodseq"),
                                    F.format_string("%04d", F.pmod(F.col("id") * 37, F.lit(400))).alias("Name"))
    path = write_report(df.repartition(5), str(tmp_path / "a"), [F.col("Name").asc()], "target_periodseq")
    for k in range(3):
        names = [x for x in file_rows(f"{path}/target_periodseq={k}") if x != "Name"]
        assert names == sorted(names) and len(names) in (133, 134)


def test_report_files_carry_their_name_and_one_header(spark, tmp_path):
    p = spark.createDataFrame([(1, "June 1998"), (2, "July 1998")], "target_periodseq long, periodname string")
    df = spark.createDataFrame([(k % 2 + 1, f"n{k:03d}") for k in range(99, -1, -1)], "target_periodseq long, Name string")
    out = write_reports(df, str(tmp_path / "r"), [F.col("Name").asc()], p, "X_", dt.date(2026, 1, 31))
    for month in ("June", "July"):
        rows = file_rows(f"{out}/report_file=X_{month}_1998_20260131.csv")
        assert rows[0] == "Name" and rows[1:] == sorted(rows[1:]) and len(rows) == 51


def test_accrual_job_writes_reports_and_logs_every_step(spark, src, oct_params, tmp_path):
    inc = src["cs_incentive"]
    bad = src.with_table("cs_incentive", inc.withColumn("genericattribute4", F.when(
        F.col("genericattribute1") == acc.YOY, F.lit("n/a")).otherwise(F.col("genericattribute4"))))
    root = str(tmp_path / "t")
    log = acc.accrual_job(bad, oct_params, str(tmp_path / "out"), dt.date(2026, 1, 31), root=root)
    entries = log.collect()
    arms = {r.step[4:]: r for r in entries if r.step.startswith("arm ")}
    staged = read_table(spark, root, "staging")
    assert set(arms) == set(acc.ARMS)
    counts = {r.arm: (r["rows"], r.failed_parses) for r in acc.step_log(staged).collect()}
    assert {a: (r["rows"], r.failed_parses) for a, r in arms.items()} == counts
    assert arms["yoy"]["rows"] > 0 and arms["yoy"].failed_parses == arms["yoy"]["rows"]
    assert [r.step for r in entries if not r.step.startswith("arm")] == ["staging", "report", "file"]
    assert entries[-1].message == "ACCRUAL_DETAIL_October_1998_20260131.csv"
    assert all(r.started <= r.ended for r in entries)
    lines = file_rows(str(tmp_path / f"out/report_file={entries[-1].message}"))
    assert len(lines) == 1 + sum(r["rows"] for r in arms.values())
    assert spark.read.parquet(f"{root}/step_log").count() == len(entries)


def test_failed_steps_are_logged(spark, src, oct_params, tmp_path):
    addr = src["cs_transactionaddress"]
    twice = src.with_table("cs_transactionaddress", addr.union(addr))
    with pytest.raises(Exception, match="more than one BILLTO"):
        acc.accrual_job(twice, oct_params, str(tmp_path / "out"), dt.date(2026, 1, 31), root=str(tmp_path / "t"))
    entries = spark.read.parquet(str(tmp_path / "t/step_log")).collect()
    assert [r.step for r in entries] == ["staging"] and entries[0].message.startswith("failed: ")


def test_refreshed_table_is_found_by_name(spark, tmp_path):
    full_refresh(spark.range(3), str(tmp_path), "t")
    full_refresh(spark.range(5, 7), str(tmp_path), "t")
    assert sorted(r.id for r in read_table(spark, str(tmp_path), "t").collect()) == [5, 6]


def test_periods_are_literals_in_the_fact_scans(src, oct_params, tmp_path, capsys):
    cat = src.write_parquet(str(tmp_path / "cat"), ["cs_incentive", "rpt_orgdata", "cs_credit", "cs_pmcredittrace",
                                                    "cs_incentivepmtrace", "cs_measurement"])
    from quotalens.sources.tables import Sources
    frames = {n: cat[n] if n in ("cs_incentive", "rpt_orgdata", "cs_credit", "cs_pmcredittrace",
                                 "cs_incentivepmtrace", "cs_measurement") else src[n] for n in src}
    s = Sources(src.spark, frames)
    p = params(s, "PU1", ["October 1998"])
    key = period_keys(s, p)[0]
    att.attainment_extract(s, p).explain("formatted")
    assert "PartitionFilters" in (plan := capsys.readouterr().out) and "periodseq" in plan
    acc.arm_regular(s, p).explain("formatted")
    plan = capsys.readouterr().out
    for column in ("periodseq", "targetperiodseq"):
        assert any(f"{column}#" in line and str(key) in line for line in plan.splitlines()
                   if "PartitionFilters" in line), column


def test_the_folder_set_on_the_context_wins(spark):
    folder = ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir().startswith(folder)


def test_files_read_back_in_order_line_by_line(spark, tmp_path):
    p = spark.createDataFrame([(1, "June 1998"), (2, "July 1998")], "target_periodseq long, periodname string")
    data = [(k % 2 + 1, f"n{k * 37 % 500:03d}", t) for k in range(500)
            for t in (None, "", " blank ", 'say "x", so', "two\nlines")]
    df = spark.createDataFrame(data, "target_periodseq long, Name string, `Odd name` string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = write_reports(df, str(tmp_path / "r"), [F.col("Name").desc()], p, "X_", dt.date(2026, 1, 31))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    titles = df.columns[1:]
    got = sorted(map(tuple, read_reports(spark, folder, titles).collect()))
    want = []
    for key, month in ((1, "June"), (2, "July")):
        body = sorted(((n, t) for k, n, t in data if k == key), key=lambda r: (r[1] is not None, r[1] or ""))
        lines = [tuple(titles), *sorted(body, key=lambda r: r[0], reverse=True)]
        want += [(f"X_{month}_1998_20260131.csv", i, *line) for i, line in enumerate(lines, 1)]
    assert len(os.listdir(f"{folder}/report_file={want[0][0]}")) > 2
    assert got == sorted(want)


@pytest.mark.parametrize("rules", acc.RULES)
def test_accrual_report_has_its_header_first_and_its_rows_in_order(spark, rules):
    # names out of order over several partitions, null keys and equal rows among them
    data = [(n, e, o) for n in ("n3", None, "n1", "n2") for e in ("MBO", "CIP", None) for o in ("O2", "O1", None, "O1")]
    made = {"fullname": "n", "plan_element": "e", "orderid": "o"}
    staging = spark.createDataFrame(data, "n string, e string, o string").repartition(5).select(
        *[F.col(made[c]).alias(c) if c in made else F.lit(None).cast(t).alias(c) for c, t in acc.STAGING_TYPES.items()])
    got = [(r["Name"], r["Plan Element"], r["Order ID"]) for r in acc.accrual_report(staging, rules).collect()]
    want = sorted(data, key=lambda r: [(v is not None, v or "") for v in r])
    assert got == [("Name", "Plan Element", "Order ID"), *want]
    bare = acc.accrual_report(staging, rules, header=False).collect()
    assert [(r["Name"], r["Plan Element"], r["Order ID"]) for r in bare] == want
