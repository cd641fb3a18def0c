"""Named queries over the fixture tables: one per operator of the survey's inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame computed over the whole derived
tables. Standard run parameters: unit 'PU1', calendar 'Main Fiscal Calendar', period
'October 1998'.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotalens.operators.params import params
from quotalens.operators.payees import payee_snapshot
from quotalens.operators.periods import run_period
from quotalens.plans import accrual as acc
from quotalens.plans import attainment as att
from quotalens.schemas import STAGING_NAMES
from quotalens.sources.fixtures import derive

UNIT = "PU1"
PERIOD = "October 1998"
CALENDAR = "Main Fiscal Calendar"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


_DERIVED: dict = {}


def sources_for(spark: SparkSession, sf_dir: str):
    """Derived tables for ``sf_dir``: derived once per session (shared intermediates are
    checkpointed in the session's checkpoint folder), then lazy projections over them."""
    # Release DataFrame proxies of earlier queries now: each keeps its executed plan (and the
    # broadcast relations in it) reachable in the driver JVM until Python collects it.
    gc.collect()
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DERIVED:
        _DERIVED[key] = derive(spark, sf_dir)
    src = _DERIVED[key]
    src.__dict__.pop("_memo", None)  # frames shared within one report build, not across queries
    return src


def setup(spark: SparkSession, sf_dir: str, periods=(PERIOD,)):
    src = sources_for(spark, sf_dir)
    p = params(src, UNIT, list(periods) if periods is not None else None, CALENDAR)
    return src, p


@query
def param_lookup(spark, sf_dir):
    _, p = setup(spark, sf_dir)
    return p


@query
def run_period_q(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return run_period(src, p)


@query
def payee_snapshot_q(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return payee_snapshot(src, p)


@query
def incentive_facts(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return att.incentive_facts(src, p)


@query
def attainment_branches(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return att.attainment_branches(att.incentive_facts(src, p), payee_snapshot(src, p))


@query
def attainment_extract(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return att.attainment_extract(src, p)


def _staged(df: DataFrame) -> DataFrame:
    return df.select(*STAGING_NAMES, "arm")


@query
def accrual_regular(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.arm_regular(src, p))


@query
def accrual_mbo(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.arm_mbo(src, p))


@query
def accrual_yoy(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.arm_yoy(src, p))


@query
def accrual_cip(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.arm_cip(src, p))


@query
def accrual_guarantee(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.arm_guarantee(src, p))


@query
def accrual_regular_fy25(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.arm_regular_fy25(src, p))


@query
def accrual_staging(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.accrual_staging(src, p))


@query
def billto_enrich(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _staged(acc.billto_enrich(src, acc.accrual_staging(src, p), p))


@query
def step_log(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return acc.step_log(acc.accrual_staging(src, p))


@query
def accrual_report(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return acc.accrual_report(acc.billto_enrich(src, acc.accrual_staging(src, p), p), "FY26")


@query
def accrual_report_fy25(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    staged = acc.accrual_staging(src, p, rules="FY25")
    return acc.accrual_report(acc.billto_enrich(src, staged, p), "FY25")


# ---------------------------------------------------------------------------------------
# operator-level queries (each over whole derived tables)
# ---------------------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from quotalens.functions import exprs as X  # noqa: E402
from quotalens.operators.intervals import in_force_join  # noqa: E402
from quotalens.operators.periods import period_hierarchy, period_types  # noqa: E402
from quotalens.operators.versioning import active_at, live  # noqa: E402
from quotalens.sinks.report import (  # noqa: E402
    ACCRUAL_PREFIX, ATTAINMENT_PREFIX, full_refresh, header_rows, read_reports, report_filename,
    write_reports)
from quotalens.session import scratch_path  # noqa: E402
from quotalens.schemas import ACCRUAL_TITLES  # noqa: E402

RUN_DATE = "2026-01-31"


@query
def scan_current(spark, sf_dir):
    """Live participant versions; the end-of-time date parsed from 'MMddyyyy' text."""
    src = sources_for(spark, sf_dir)
    eot = F.to_date(F.lit("01012200"), "MMddyyyy")
    pt = src["cs_participant"]
    return pt.where(F.col("removedate") == eot).select(
        "payeeseq", "lastname", "genericattribute7", "effectivestartdate", "effectiveenddate")


@query
def effective_dated(spark, sf_dir):
    """Live participant versions in force at the end of every live month (interval join)."""
    src = sources_for(spark, sf_dir)
    months = period_hierarchy(src).select(
        F.col("month_periodseq").alias("periodseq"), F.col("month_enddate").alias("pend"))
    pt = live(src["cs_participant"])
    return in_force_join(pt, months, "pend").select(
        "periodseq", "payeeseq", "genericattribute7")


@query
def active_payees(spark, sf_dir):
    """Live participants terminated on/after the target period start, or never."""
    src, p = setup(spark, sf_dir)
    pt = live(src["cs_participant"])
    t = p.select(F.col("startdate").alias("v_start"), "target_periodseq")
    return pt.join(F.broadcast(t), active_at("terminationdate", F.col("v_start"))).select(
        "target_periodseq", "payeeseq", "terminationdate", "effectivestartdate")


@query
def semi_business_unit(spark, sf_dir):
    """Live payees whose business-unit map matches an existing unit (existence join)."""
    src = sources_for(spark, sf_dir)
    bu = src["cs_businessunit"]
    pe = live(src["cs_payee"])
    return pe.join(bu, pe.businessunitmap == bu.mask, "left_semi").select(
        "payeeseq", "payeeid", "businessunitmap")


@query
def payee_dedup(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return payee_snapshot(src, p, one_payee_per_position=True)


@query
def period_types_q(spark, sf_dir):
    return period_types(sources_for(spark, sf_dir))


@query
def period_hierarchy_q(spark, sf_dir):
    return period_hierarchy(sources_for(spark, sf_dir))


@query
def fiscal_month_order(spark, sf_dir):
    src = sources_for(spark, sf_dir)
    return src["cs_period"].where(F.col("periodtypeseq") == 1).select(
        "periodseq", "name", X.fiscal_month_order("name").alias("month_order"))


@query
def plan_element_in(spark, sf_dir):
    """Incentives of the three attainment kinds whose plan element is MBO (IN + equality)."""
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    return inc.where(F.col("genericattribute16").isin(*att.KINDS)
                     & (F.col("genericattribute1") == "MBO")).select(
        "incentiveseq", "genericattribute1", "genericattribute16")


@query
def plan_element_not_in(spark, sf_dir):
    """Incentives whose plan element has no arm of its own (NULL is not kept)."""
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    return inc.where(~F.col("genericattribute1").isin(*acc.OWN_ARM_PLAN_ELEMENTS)).select(
        "incentiveseq", "genericattribute1")


@query
def flag_default(spark, sf_dir):
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    return inc.where(X.flag_set("genericboolean1") | X.flag_set("genericboolean3")).select(
        "incentiveseq", F.coalesce("genericboolean1", F.lit(0)).alias("flag1"),
        F.coalesce("genericboolean3", F.lit(0)).alias("flag3"))


@query
def weight_threshold(spark, sf_dir):
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    w = X.decorated_number("genericattribute2")
    return inc.where(w > 0).select("incentiveseq", "genericattribute2", w.alias("weight"))


@query
def parse_decorated(spark, sf_dir):
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    return inc.select("incentiveseq", "genericattribute4",
                      X.strip_decorations("genericattribute4").alias("stripped"),
                      X.decorated_number("genericattribute4").alias("parsed"))


@query
def fx_factor(spark, sf_dir):
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    return inc.select("incentiveseq", X.fx_factor("genericattribute4").alias("fx_factor"))


@query
def target_income(spark, sf_dir):
    """TI LOC / TI USD of every incentive against its payee's live position."""
    src = sources_for(spark, sf_dir)
    inc = src["cs_incentive"].select("incentiveseq", "payeeseq", "positionseq",
                                     "genericnumber6", "genericattribute4")
    pn = live(src["cs_position"]).select(
        F.col("payeeseq").alias("pn_payee"), F.col("ruleelementownerseq").alias("pn_position"),
        F.col("targetcompensation").alias("tc"))
    j = inc.join(pn, (inc.payeeseq == pn.pn_payee) & (inc.positionseq == pn.pn_position))
    return j.select("incentiveseq",
                    X.ti_loc("genericnumber6", "tc").cast("decimal(25,10)").alias("ti_loc"),
                    X.ti_usd("genericnumber6", "tc", "genericattribute4").alias("ti_usd"))


@query
def tier_rate_q(spark, sf_dir):
    """FY25 tier rate of each commission against its source incentive."""
    src = sources_for(spark, sf_dir)
    co = src["cs_commission"].select("commissionseq", "incentiveseq", "ratevalue")
    t = src["cs_incentive"].select(F.col("incentiveseq").alias("t_inc"), "genericnumber1",
                                   "genericnumber6")
    j = co.join(t, co.incentiveseq == t.t_inc)
    return j.select("commissionseq",
                    X.tier_rate("ratevalue", "genericnumber1", "genericnumber6").alias("tier_rate"))


@query
def commission_usd(spark, sf_dir):
    c = sources_for(spark, sf_dir)["cs_credit"]
    return c.select("creditseq",
                    X.exact_product("value", "genericnumber3").cast("decimal(25,10)")
                    .alias("commission_usd"))


@query
def credit_type_label(spark, sf_dir):
    src = sources_for(spark, sf_dir)
    c = src["cs_credit"].select("creditseq", "name", "credittypeseq")
    ct = F.broadcast(live(src["cs_credittype"]))
    j = c.join(ct, c.credittypeseq == ct.datatypeseq)
    return j.select("creditseq", "name", "credittypeid",
                    X.credit_type_label("credittypeid", "name").alias("credit_type"))


@query
def accrual_mask(spark, sf_dir):
    """Credit values masked for the three masked credit-type labels."""
    src = sources_for(spark, sf_dir)
    c = src["cs_credit"].select("creditseq", "name", "credittypeseq", "value")
    ct = F.broadcast(live(src["cs_credittype"]))
    j = c.join(ct, c.credittypeseq == ct.datatypeseq)
    label = X.credit_type_label("credittypeid", "name")
    return j.select("creditseq", label.alias("credit_type"),
                    X.mask_by_credit_type(label, F.col("value")).alias("masked_value"))


@query
def event_type_label(spark, sf_dir):
    t = acc.transaction_core(sources_for(spark, sf_dir))
    return t.select(F.col("st_seq").alias("salestransactionseq"),
                    F.col("et_id").alias("eventtypeid"),
                    X.event_type_label("et_id").alias("event_type"))


@query
def order_txn_credit(spark, sf_dir):
    """Credit x credit type x model-0 transaction x live order x event type (all periods)."""
    cc = acc.credit_core(sources_for(spark, sf_dir))
    return cc.select(F.col("c_seq").alias("creditseq"), F.col("so_orderid").alias("orderid"),
                     F.col("et_id").alias("eventtypeid"), F.col("ct_id").alias("credittypeid"),
                     F.col("c_period").alias("periodseq"))


@query
def bridge_join(spark, sf_dir):
    """credit trace x measurement x incentive trace on composite keys (fan-out kept)."""
    src = sources_for(spark, sf_dir)
    pmc = src["cs_pmcredittrace"]
    m = src["cs_measurement"].select(F.col("measurementseq").alias("m_seq"),
                                     F.col("periodseq").alias("m_period"),
                                     F.col("processingunitseq").alias("m_unit"))
    ipm = src["cs_incentivepmtrace"].select(F.col("incentiveseq"),
                                            F.col("measurementseq").alias("i_meas"),
                                            F.col("targetperiodseq").alias("i_period"),
                                            F.col("processingunitseq").alias("i_unit"))
    j = (pmc.join(m, (pmc.measurementseq == m.m_seq) & (pmc.targetperiodseq == m.m_period)
                  & (pmc.processingunitseq == m.m_unit))
         .join(ipm, (ipm.i_meas == m.m_seq) & (ipm.i_period == m.m_period)
               & (ipm.i_unit == m.m_unit)))
    return j.select("creditseq", "measurementseq", "incentiveseq")


@query
def self_trace(spark, sf_dir):
    """Reported incentive <- self trace <- source incentive (same table twice)."""
    src = sources_for(spark, sf_dir)
    s = src["cs_incentive"].select(F.col("incentiveseq").alias("s_inc"),
                                   F.col("periodseq").alias("s_period"),
                                   F.col("genericattribute1").alias("plan_element"))
    ist = src["cs_incentiveselftrace"]
    t = src["cs_incentive"].select(F.col("incentiveseq").alias("t_inc"),
                                   F.col("genericattribute1").alias("source_plan_element"))
    j = (s.join(ist, (s.s_inc == ist.targetincentiveseq) & (ist.sourceperiodseq == s.s_period))
         .join(t, ist.sourceincentiveseq == t.t_inc))
    return j.select(F.col("s_inc").alias("incentiveseq"), F.col("t_inc").alias("source_incentiveseq"),
                    "plan_element", "source_plan_element")


@query
def dept_code(spark, sf_dir):
    h = sources_for(spark, sf_dir)["rpt_orgdata"]
    return h.select("positionseq", "periodseq", X.dept_code("cc_dept").alias("dept_code"))


@query
def full_name(spark, sf_dir):
    pt = live(sources_for(spark, sf_dir)["cs_participant"])
    return pt.select("payeeseq", "effectivestartdate",
                     X.full_name("lastname", "firstname").alias("full_name"))


@query
def substr_from(spark, sf_dir):
    """Text from position 100 on, over whole document texts."""
    import os
    d = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    return d.select("doc_id", X.substr_from("text", 100).alias("tail"))


@query
def money_format(spark, sf_dir):
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    return inc.select("incentiveseq",
                      X.money_text("genericnumber1", dollar=True).alias("quota_text"),
                      X.money_text("value").alias("value_text"))


@query
def percent_format(spark, sf_dir):
    inc = sources_for(spark, sf_dir)["cs_incentive"]
    return inc.select("incentiveseq", X.percent_text("genericnumber3").alias("pct_text"))


@query
def report_filename_q(spark, sf_dir):
    """File names of both reports for every live month of the calendar (fixed run date)."""
    src = sources_for(spark, sf_dir)
    p = params(src, UNIT, None, CALENDAR)
    return p.select("target_periodseq",
                    report_filename(ATTAINMENT_PREFIX, "periodname", RUN_DATE).alias("attainment_file"),
                    report_filename(ACCRUAL_PREFIX, "periodname", RUN_DATE).alias("accrual_file"))


@query
def report_header(spark, sf_dir):
    """The accrual header row for every live month of the calendar (one per report file)."""
    src = sources_for(spark, sf_dir)
    p = params(src, UNIT, None, CALENDAR).select("target_periodseq")
    return header_rows(spark, ACCRUAL_TITLES, p)


@query
def attainment_out(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return att.attainment_out(att.attainment_extract(src, p).drop("target_periodseq"))


@query
def overwrite_roundtrip(spark, sf_dir):
    """Full refresh of the payee-snapshot staging table: September, then October replaces it."""
    src, p = setup(spark, sf_dir)
    _, previous = setup(spark, sf_dir, periods=("September 1998",))
    root = scratch_path(spark, "staging")
    full_refresh(payee_snapshot(src, previous), root, "rpt_ytd_payee_data")
    return full_refresh(payee_snapshot(src, p), root, "rpt_ytd_payee_data")


@query
def attainment_extract_all_periods(spark, sf_dir):
    """Many-period mode: the extract for every live month of the calendar in one job."""
    src, p = setup(spark, sf_dir, periods=None)
    return att.attainment_extract(src, p)


@query
def attainment_out_all_periods(spark, sf_dir):
    """Header and text rows of every live month, kept apart by the target's key."""
    src, p = setup(spark, sf_dir, periods=None)
    return att.attainment_out(att.attainment_extract(src, p), params=p)


@query
def accrual_report_all_periods(spark, sf_dir):
    """Detail rows of every live month, with the target's key."""
    src, p = setup(spark, sf_dir, periods=None)
    staged = acc.billto_enrich(src, acc.accrual_staging(src, p), p)
    return acc.accrual_details(staged, "FY26", by_period=True)


_PATHS: dict = {}


def paths_for(spark: SparkSession, sf_dir: str):
    """The derived tables with access paths by period, written once per session."""
    from quotalens.sources.period_paths import with_paths, write_paths
    src = sources_for(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PATHS:
        _PATHS[key] = scratch_path(spark, f"paths-{uuid.uuid4().hex}")
        return write_paths(src, _PATHS[key])
    return with_paths(src, _PATHS[key])


@query
def period_transactions(spark, sf_dir):
    """The transaction path: live orders' transactions by the periods of their credits."""
    return paths_for(spark, sf_dir)["path_transaction"].select(
        "periodseq", F.col("st_seq").alias("salestransactionseq"),
        F.col("st_unit").alias("processingunitseq"), F.col("st_value").alias("value"),
        F.col("so_orderid").alias("orderid"))


@query
def period_billto(spark, sf_dir):
    """The address path: BILLTO addresses of the transactions credited in a period."""
    return paths_for(spark, sf_dir)["path_billto"].select(
        "periodseq", F.col("a_txn").alias("salestransactionseq"), F.col("a_n").alias("addresses"),
        F.col("a_country").alias("country"), F.col("a_company").alias("company"))


def _report_by_path(spark, sf_dir, rules):
    src = paths_for(spark, sf_dir)
    p = params(src, UNIT, [PERIOD], CALENDAR)
    return acc.accrual_report(acc.billto_enrich(src, acc.accrual_staging(src, p, rules=rules), p), rules)


@query
def accrual_report_by_path(spark, sf_dir):
    """The report over access paths: transactions and addresses of one period only."""
    return _report_by_path(spark, sf_dir, "FY26")


@query
def accrual_report_fy25_by_path(spark, sf_dir):
    return _report_by_path(spark, sf_dir, "FY25")


def _written(details: DataFrame, p: DataFrame, order, prefix: str) -> DataFrame:
    """Report files of ``details`` as a job writes them, read back line by line."""
    spark = details.sparkSession
    folder = scratch_path(spark, f"report-{uuid.uuid4().hex}")
    write_reports(details, folder, order, p, prefix, RUN_DATE)
    return read_reports(spark, folder, [c for c in details.columns if c != "target_periodseq"])


@query
def attainment_report_file(spark, sf_dir):
    """The attainment report's file: header, then its rows in order, with their line numbers."""
    src, p = setup(spark, sf_dir)
    details = att.attainment_out(att.attainment_extract(src, p), header=False)
    return _written(details, p, att.attainment_order(), ATTAINMENT_PREFIX)


@query
def accrual_report_file(spark, sf_dir):
    """The accrual report's file, as ``attainment_report_file``."""
    src, p = setup(spark, sf_dir)
    staged = acc.billto_enrich(src, acc.accrual_staging(src, p), p)
    return _written(acc.accrual_details(staged, by_period=True), p, acc.accrual_order(), ACCRUAL_PREFIX)


# keys whose function name carries a suffix to avoid shadowing library names
for _k in list(QUERIES):
    if _k.endswith("_q"):
        QUERIES[_k[:-2]] = QUERIES.pop(_k)
