"""Physical plan shape: the properties that matter at scale."""

from quotalens.plans import accrual as acc
from quotalens.plans import attainment as att


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_extract_has_no_cartesian_and_one_incentive_scan(spark, tmp_path_factory, src, oct_params):
    root = str(tmp_path_factory.mktemp("catalog"))
    cat = src.write_parquet(root, names=["cs_incentive", "cs_period", "cs_periodtype",
                                         "cs_processingunit", "cs_calendar", "cs_participant",
                                         "cs_payee", "cs_businessunit", "cs_position"])
    from quotalens.operators.params import params
    p = params(cat, "PU1", ["October 1998"])
    ext = att.attainment_extract(cat, p)
    txt = plan_text(ext)
    assert "CartesianProduct" not in txt
    scans = [ln for ln in txt.split("\n") if "FileScan parquet" in ln and "cs_incentive" in ln]
    assert len(scans) == 1, scans
    # pushed filters on the incentive scan (flags / unit)
    assert "PushedFilters" in scans[0]
    # the pre-aggregation runs before the payee join: partial + final aggregate on each side
    # of it (max over strings plans as SortAggregate, sums alone as HashAggregate)
    import re
    head = txt.split("SortMergeJoin")[0] if "SortMergeJoin" in txt else txt
    assert len(re.findall(r"(Hash|Sort|ObjectHash)Aggregate", txt)) >= 4
    assert len(re.findall(r"(Hash|Sort|ObjectHash)Aggregate", head)) >= 1


def test_live_filters_reach_the_scan(spark, tmp_path_factory, src):
    root = str(tmp_path_factory.mktemp("catalog2"))
    cat = src.write_parquet(root, names=["cs_salesorder", "cs_salestransaction", "cs_eventtype"])
    t = acc.transaction_core(cat)
    txt = plan_text(t)
    assert "EqualTo(removedate,2200-01-01)" in txt
    assert "EqualTo(modelseq,0)" in txt


def test_accrual_report_has_no_cartesian(src, oct_params):
    rep = acc.accrual_report(acc.billto_enrich(src, acc.accrual_staging(src, oct_params)))
    assert "CartesianProduct" not in plan_text(rep)


def test_type_tables_are_broadcast_and_deal_no_rows(src, oct_params):
    staged = acc.billto_enrich(src, acc.accrual_staging(src, oct_params))
    assert not [k for k in ("ct_seq", "et_seq", "at_seq", "c_type", "st_event", "addresstypeseq")
                if f"hashpartitioning({k}#" in plan_text(staged)]


def test_many_periods_deal_wide_rows_by_transaction_once(src):
    from quotalens.operators.params import params
    p = params(src, "PU1", None)
    text = plan_text(acc.billto_enrich(src, acc.accrual_staging(src, p)))
    assert "hashpartitioning(st_order#" not in text and "hashpartitioning(salestransactionseq#" in text
    wide = [ln for ln in text.split("\n") if "Exchange hashpartitioning(periodseq" in ln and "dept_code" in ln]
    assert not wide, wide


def test_targets_multiply_sums_and_not_incentives(src):
    from quotalens.operators.params import params
    text = optimized(att.attainment_extract(src, params(src, "PU1", None)))
    keys = [ln for ln in text.split("\n") if "Aggregate [" in ln and "positionseq" in ln and "payeeseq" in ln]
    assert any("processingunitseq" in ln.split("]")[0] for ln in keys)


def test_tables_derived_once_are_parquet(src):
    for name in ("cs_credit", "cs_salestransaction", "cs_measurement"):
        assert "FileScan parquet" in plan_text(src[name]) and "Scan ExistingRDD" not in plan_text(src[name])


def test_partitions_grow_with_the_input(spark):
    from quotalens import session
    old = spark.conf.get(session.INITIAL_PARTITIONS, None)
    try:
        session.bound_tasks(spark, 10 * session.ROWS_A_PARTITION * 4)
        assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == 40
    finally:
        spark.conf.set(session.INITIAL_PARTITIONS, old) if old else spark.conf.unset(session.INITIAL_PARTITIONS)


def test_arms_of_a_many_period_run_share_their_credits_and_deal_texts_packed(src):
    from quotalens.operators.params import params
    src.__dict__.pop("_memo", None)
    p = params(src, "PU1", None)
    assert acc.source_keys(src, p) == sorted(acc.source_keys(src, p)) and set(acc.source_keys(src, p)) <= set(
        acc._credit_keys(src, p))
    text = plan_text(acc.credit_arms(src, p, ["mbo", "yoy", "cip"]))
    # the traces and credits of both kinds of arms are read by the same literals
    reads = [ln for ln in text.split("\n") if "FileScan parquet" in ln and "/transactions-" in ln and "disc#" in ln]
    assert len(reads) == 2 and all(" IN (" in ln or "In(periodseq" in ln for ln in reads), reads
    assert "_texts" in text
