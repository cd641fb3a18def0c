"""Per-credit commission accrual report (rules 'FY26' and the previous 'FY25').

Plan shape (Spark-first rewrites of the reference's five INSERT arms):

* every arm starts from the run's org rows and incentives or credits and attaches orders and
  transactions last. A catalogue with access paths (``quotalens.sources.period_paths``) gives
  those by the credits' periods, so one month's report reads its own partitions only; without
  paths the credits meet the transaction table first and orders after it, and of transactions and
  addresses only those are shuffled that a credit of the run's periods may name
  (``quotalens.operators.presence``);
* the regular arm's left-join chain is written as inner joins (its WHERE rejects NULLs) and the
  many-to-many bridge credit -> measurement -> incentive is first reduced to the DISTINCT
  tuples the output can see. With paths the arm's DISTINCT is taken before the transaction's
  columns are attached (they are unique there), otherwise over all columns at the end;
* a measurement that a large share of all credits feeds is salted in the bridge;
* every period predicate is a join with the broadcast parameter rows (one per target
  period), so one job serves many periods, and a list of literals, which prunes partitions;
* the bill-to lookup is a validated left join: one row per transaction and the number of its
  BILLTO addresses, and more than one raises.
"""

from __future__ import annotations

import uuid
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalens.functions.exprs import (
    DEFAULT_INVOICE_LABEL, bad_number, checked_number, credit_type_label, dept_code, event_type_label, exact_product,
    flag_set, format_by_plan_element, fx_rate, mask_by_credit_type, round4_text, tier_rate)
from quotalens.operators.packing import LENGTHS, TEXTS, packed, text_columns, unpacked
from quotalens.operators.params import period_keys
from quotalens.operators.presence import key_bits, may_match
from quotalens.operators.skew import hot_keys, salted_join
from quotalens.operators.versioning import live
from quotalens.schemas import ACCRUAL_TITLES, STAGING_NAMES, STAGING_TYPES
from quotalens.session import scratch_path, written
from quotalens.sinks.report import ACCRUAL_PREFIX, full_refresh, header_rows, log_files, write_reports
from quotalens.sinks.steplog import Counted, StepLog
from quotalens.sources.period_paths import (
    MEASUREMENT_KEYS, billto_addresses, credit_traces, one_address, order_ids, orders, same,
    transactions)

ARMS = ("regular", "mbo", "yoy", "cip", "guarantee")
RULES = ("FY26", "FY25")

# Plan elements that have their own arm, and the guarantee incentive name.
OWN_ARM_PLAN_ELEMENTS = ["MBO", "YOY Growth", "CIP", "Payment Adjustment"]
MBO = "MBO"
YOY = "YOY Growth"
CIP_ELEMENTS = ["CIP", "Payment Adjustment"]
GUARANTEE_NAMES = ["IO Guarantee"]
GUARANTEE_LABEL = "Guarantee"


# ---------------------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------------------

def _params(params: DataFrame) -> DataFrame:
    return params.select(F.col("target_periodseq").alias("v_period"),
                         F.col("periodname").alias("v_periodname"),
                         F.col("processingunitseq").alias("v_unit"),
                         F.col("processingunitname").alias("v_unitname"))


def org_in_run(sources, params: DataFrame) -> DataFrame:
    """Org snapshot rows of the run's unit and target periods (params broadcast)."""
    # the entry keeps the frame alive, so its id can't come to name another one
    return sources.memo(("org", id(params)), lambda: (params, _org_in_run(sources, params)))[1]


def _org_in_run(sources, params: DataFrame) -> DataFrame:
    h = sources["rpt_orgdata"].select(
        F.col("processingunitseq").alias("h_unit"), F.col("periodseq").alias("h_period"),
        F.col("payeeseq").alias("h_payeeseq"), F.col("positionseq").alias("h_positionseq"),
        F.col("payeeid").alias("h_payeeid"), F.col("fullname").alias("h_fullname"),
        F.col("mfullname_l1").alias("h_m1"), F.col("mfullname_l2").alias("h_m2"),
        F.col("division").alias("h_division"), F.col("cc_dept").alias("h_cc_dept"),
        F.col("local_currency").alias("h_currency"))
    h = h.where(F.col("h_period").isin(period_keys(sources, params)))
    p = F.broadcast(_params(params))
    return h.join(p, (h.h_period == p.v_period) & (h.h_unit == p.v_unit))


def event_types(sources) -> DataFrame:
    """Live event types: a list of configuration, broadcast. Dealing rows by so few keys would put
    all of them into as many tasks."""
    return F.broadcast(live(sources["cs_eventtype"]).select(
        F.col("datatypeseq").alias("et_seq"), F.col("eventtypeid").alias("et_id")))


def transaction_core(sources) -> DataFrame:
    """Live order x model-0 transaction x live event type, of every period."""
    st, so, et = transactions(sources), orders(sources), event_types(sources)
    return st.join(so, st.st_order == so.so_seq).join(et, st.st_event == et.et_seq)


def credits(sources) -> DataFrame:
    """Credit x live credit type."""
    return sources.memo("credits", lambda: _credits(sources))


def _credits(sources) -> DataFrame:
    c = sources["cs_credit"].select(
        F.col("creditseq").alias("c_seq"), F.col("name").alias("c_name"),
        F.col("credittypeseq").alias("c_type"), F.col("salestransactionseq").alias("c_txn"),
        F.col("positionseq").alias("c_position"), F.col("periodseq").alias("c_period"),
        F.col("processingunitseq").alias("c_unit"), F.col("value").alias("c_value"),
        F.col("genericnumber2").alias("c_gn2"), F.col("genericnumber3").alias("c_gn3"),
        F.col("genericnumber6").alias("c_gn6"))
    # credit types are few, as event types
    ct = F.broadcast(live(sources["cs_credittype"]).select(
        F.col("datatypeseq").alias("ct_seq"), F.col("credittypeid").alias("ct_id")))
    return c.join(ct, c.c_type == ct.ct_seq)


def many_periods(sources, params: DataFrame) -> bool:
    """A run of more than a year, whose credits name most transactions."""
    return len(period_keys(sources, params)) > 12


def with_transactions(sources, x: DataFrame, keys: list[int], many: bool = False) -> DataFrame:
    """Attach transaction, live order and live event type to credit rows on (transaction, unit).

    ``keys`` are the credits' periods; with a transaction path only those partitions are read.
    Otherwise the periods' credits restrict the transactions before these are shuffled, and the
    orders are joined last; in a run of ``many`` periods they restrict little, and all rows meet by the
    transaction's key instead.
    """
    if "path_transaction" in sources:
        t = sources["path_transaction"].withColumnRenamed("periodseq", "st_period").where(F.col("st_period").isin(keys))
        x = x.join(t, (x.c_txn == t.st_seq) & (x.c_unit == t.st_unit) & (x.c_period == t.st_period))
    elif not many:
        st, so = transactions(sources), orders(sources)
        st = may_match(st, "st_seq", credited_bits(sources, keys))
        x = x.join(st, (x.c_txn == st.st_seq) & (x.c_unit == st.st_unit)).join(
            so, F.col("st_order") == so.so_seq)
    else:
        # by the transaction's key alone: the wide rows are shuffled once, and rows of one
        # transaction stay together for what follows
        wide, ids = transactions(sources), order_ids(sources)
        st, texts = packed(wide), unpacked(text_columns(wide))
        x = x.join(st, (x.c_txn == st.st_seq) & same(x.c_unit, st.st_unit)).join(
            ids, (F.col("st_seq") == ids.oi_seq) & same(F.col("st_order"), ids.oi_order)).drop("oi_seq", "oi_order")
        x = x.select("*", *texts.values()).drop(TEXTS, LENGTHS)
    et = event_types(sources)
    return x.join(et, F.col("st_event") == et.et_seq)


def credit_core(sources) -> DataFrame:
    """Credit x live credit type x transaction core on (transaction, unit) - every period."""
    c, t = credits(sources), transaction_core(sources)
    return c.join(t, (c.c_txn == t.st_seq) & (c.c_unit == t.st_unit))


def credited_bits(sources, keys: list[int]) -> DataFrame:
    """Presence bits of the transactions that credits of the periods ``keys`` name."""
    return sources.memo(("credited", tuple(keys)), lambda: key_bits(
        sources["cs_credit"].where(F.col("periodseq").isin(keys)), "salestransactionseq"))


def source_incentives(sources, keys: list[int]) -> DataFrame:
    """Self traces of the target periods with the key columns of their source incentives."""
    if "path_source" in sources:
        return sources["path_source"].withColumnRenamed("periodseq", "ist_speriod").where(
            F.col("ist_speriod").isin(keys))
    ist = sources["cs_incentiveselftrace"].select(
        F.col("sourceincentiveseq").alias("ist_source"), F.col("targetincentiveseq").alias("ist_target"),
        F.col("sourceperiodseq").alias("ist_speriod")).where(F.col("ist_speriod").isin(keys))
    t = _incentive(sources, "t").select("t_incentiveseq", "t_periodseq", "t_processingunitseq", "t_positionseq")
    return ist.join(t, ist.ist_source == t.t_incentiveseq).drop("ist_source")


def run_sources(sources, params: DataFrame) -> DataFrame:
    """``source_incentives`` of the run's targets; without a path they are written once, because
    their periods are asked for before the plans that read them."""
    found = source_incentives(sources, period_keys(sources, params))
    if "path_source" in sources:
        return found
    return sources.memo(("sources", id(params)), lambda: (params, written(found, "source-incentives")))[1]


def source_keys(sources, params: DataFrame) -> list[int]:
    """Periods of the targets' source incentives: calendar-sized, so literals, as the target's own.

    Where they are the targets' periods, the arms read the same credits and traces and share their shuffles.
    """
    return sources.memo(("source-keys", id(params)), lambda: (params, sorted(
        r[0] for r in run_sources(sources, params).select("t_periodseq").distinct().collect()
        if r[0] is not None)))[1]


def _hot_measurements(sources, keys: list[int] | None) -> DataFrame:
    """Measurements whose credit traces are spread over several tasks (fewer than a thousand)."""
    if "path_hot_measurement" in sources:
        hot = sources["path_hot_measurement"].withColumnRenamed("periodseq", "b_tperiod")
        return hot if keys is None else hot.where(F.col("b_tperiod").isin(keys))
    traces = credit_traces(sources)
    return hot_keys(traces if keys is None else traces.where(F.col("b_tperiod").isin(keys)), MEASUREMENT_KEYS)


def bridge(sources, keys: list[int] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """credit -> measurement -> incentive on (measurement, period, unit), fan-out kept.

    Measurements and incentive traces (few rows a measurement) are joined first; the credit traces,
    of which one measurement may have a large share, come last and are salted.
    """
    mt = sources["cs_measurement"].select(
        F.col("measurementseq").alias("m_seq"), F.col("processingunitseq").alias("m_unit"),
        F.col("periodseq").alias("m_period"))
    ipm = sources["cs_incentivepmtrace"].select(
        F.col("incentiveseq").alias("i_inc"), F.col("measurementseq").alias("i_meas"),
        F.col("targetperiodseq").alias("i_tperiod"), F.col("processingunitseq").alias("i_unit"))
    pmc = credit_traces(sources)
    if keys is not None:  # each side reads the periods' partitions only
        pmc, mt, ipm = (x.where(F.col(c).isin(keys)) for x, c in (
            (pmc, "b_tperiod"), (mt, "m_period"), (ipm, "i_tperiod")))
    fed = mt.join(ipm, (ipm.i_meas == mt.m_seq) & (ipm.i_tperiod == mt.m_period)
                  & (ipm.i_unit == mt.m_unit)).select("i_inc", "m_seq", "m_period", "m_unit")
    on = list(zip(MEASUREMENT_KEYS, ("m_seq", "m_period", "m_unit")))
    hot = _hot_measurements(sources, keys) if hot is None else hot
    return salted_join(pmc, fed, on, "b_credit", hot).drop("m_seq", "m_period", "m_unit")


def _incentive(sources, prefix: str) -> DataFrame:
    return sources.memo(("incentive", prefix), lambda: _incentive_build(sources, prefix))


def _incentive_build(sources, prefix: str) -> DataFrame:
    inc = sources["cs_incentive"]
    return inc.select(*[F.col(c).alias(f"{prefix}_{c}") for c in (
        "incentiveseq", "name", "positionseq", "periodseq", "processingunitseq",
        "genericattribute1", "genericattribute2", "genericattribute4", "genericnumber1",
        "genericnumber6", "genericboolean1", "value")])


def _weight_positive(col: str) -> Column:
    return checked_number(col, col) > 0


# ---------------------------------------------------------------------------------------
# 58-column staging rows
# ---------------------------------------------------------------------------------------

# Column expressions are immutable and unresolved, so the shared column lists are built once
# per process and reused by every arm (each expression costs a JVM round trip to build).
@lru_cache(maxsize=8)
def _common_cached(invoice_label: str) -> tuple:
    return tuple(_common_build(invoice_label).items())


def _common(invoice_label: str) -> dict[str, Column]:
    return dict(_common_cached(invoice_label))


@lru_cache(maxsize=8)
def _credit_cached(invoice_label: str) -> tuple:
    return tuple(_credit_build(invoice_label).items())


def _credit_cols(invoice_label: str) -> dict[str, Column]:
    return dict(_credit_cached(invoice_label))


@lru_cache(maxsize=1)
def _null_padding() -> dict:
    return {name: F.lit(None).cast(STAGING_TYPES[name]).alias(name) for name in STAGING_NAMES}


def _common_build(invoice_label: str) -> dict[str, Column]:
    """Columns every arm takes from the parameters and the org row."""
    return {
        "periodseq": F.col("v_period"), "periodname": F.col("v_periodname"),
        "processingunitseq": F.col("v_unit"), "processingunitname": F.col("v_unitname"),
        "payeeseq": F.col("h_payeeseq"), "positionseq": F.col("h_positionseq"),
        "payeeid": F.col("h_payeeid"), "fullname": F.col("h_fullname"),
        "mfullname_l1": F.col("h_m1"), "mfullname_l2": F.col("h_m2"),
        "division": F.col("h_division"), "dept_code": dept_code("h_cc_dept"),
        "local_currency": F.col("h_currency"),
    }


def _credit_build(invoice_label: str) -> dict[str, Column]:
    """Credit, transaction and product columns shared by the four credit arms."""
    return {
        "credit_name": F.col("c_name"), "credittypeid": F.col("ct_id"),
        "credit_type": credit_type_label("ct_id", "c_name"),
        "salestransactionseq": F.col("st_seq"), "creditseq": F.col("c_seq"),
        "sublinenumber": F.col("st_subline"), "accountingdate": F.col("st_accdate"),
        "orderid": F.col("so_orderid"), "order_ship_date": F.col("st_gd2"),
        "compensationdate": F.col("st_compdate"), "eventtypeid": F.col("et_id"),
        "eventtype": event_type_label("et_id", invoice_label),
        "nativecurrency": F.col("st_native_ccy"),
        "billto_county": F.col("st_ga2"), "l8_item_number": F.col("st_ga4"),
        "l2_product": F.col("st_ga8"), "l3_product": F.col("st_ga9"),
        "l4_product": F.col("st_ga10"), "l5_product": F.col("st_ga11"),
        "l6_product": F.col("st_ga12"), "product_id": F.col("st_productid"),
        "product_desc": F.col("st_productdesc"), "invoice_lineno": F.col("st_ga6"),
        "numberofunits": F.col("st_units"), "revenue_account": F.col("st_ga21"),
        "comments": F.col("st_comments"), "customer_pono": F.col("st_ga20"),
        "order_book_date": F.col("st_gd3"),
    }


def _staging_row(df: DataFrame, arm: str, cols: dict[str, Column],
                 fx_text: Column | None = None) -> DataFrame:
    """Project to the 58 staging columns (typed NULL padding) + arm + parse_failed."""
    out = []
    pad = _null_padding()
    for name in STAGING_NAMES:
        c = cols.get(name)
        out.append(pad[name] if c is None else c.cast(STAGING_TYPES[name]).alias(name))
    failed = (F.lit(0) if fx_text is None else
              F.when(bad_number(fx_text), 1).otherwise(0))
    return df.select(*out, F.lit(arm).alias("arm"), failed.alias("parse_failed"))


# ---------------------------------------------------------------------------------------
# arms
# ---------------------------------------------------------------------------------------

def _bridge_regular(sources, params: DataFrame) -> DataFrame:
    """The bridge with the run's plan incentives, reduced to the DISTINCT tuples the output uses.

    Inner joins: the reference's WHERE on the last table of the left-join chain rejects NULL rows.
    The incentive side is filtered by flag, weight and plan element first.
    """
    p = F.broadcast(_params(params).select("v_period").distinct())
    keys = period_keys(sources, params)
    sinc = _incentive(sources, "s").where(F.col("s_periodseq").isin(keys))
    sinc = sinc.join(p, sinc.s_periodseq == p.v_period).where(
        flag_set("s_genericboolean1") & _weight_positive("s_genericattribute2")
        & ~F.col("s_genericattribute1").isin(*OWN_ARM_PLAN_ELEMENTS))
    b = bridge(sources, keys)
    b = b.join(sinc, (b.i_inc == sinc.s_incentiveseq) & (b.b_tperiod == sinc.s_periodseq)
               & (sinc.s_processingunitseq == b.b_unit))
    return b.select(
        "b_credit", "b_unit", F.col("b_tperiod").alias("b_period"),
        F.col("s_positionseq").alias("b_position"), "s_genericattribute1",
        "s_genericattribute4", "s_genericnumber1", "s_genericnumber6").distinct()


def arm_regular(sources, params: DataFrame, invoice_label: str = DEFAULT_INVOICE_LABEL) -> DataFrame:
    """FY26 regular arm: credits of the period with their plan incentive, DISTINCT.

    With a transaction path (one row per period, unit and transaction and its printed columns) the
    DISTINCT is taken over the narrow columns known before the transaction is attached, credit and
    transaction keys among them; two rows that differ there differ in the output (a credit's key is
    unique across units). Without one it is taken over all columns at the end.
    """
    keys = period_keys(sources, params)
    c = credits(sources).where(F.col("c_period").isin(keys))
    h = org_in_run(sources, params)
    # transactions are attached last. In a run of many periods the credits meet their incentives before
    # the org rows, so org texts are shuffled with the rows that stay
    br, many = _bridge_regular(sources, params), many_periods(sources, params)
    to_org = (F.col("h_positionseq") == F.col("c_position")) & (F.col("c_period") == F.col("v_period"))
    to_bridge = ((F.col("b_credit") == F.col("c_seq")) & (F.col("b_unit") == F.col("c_unit"))
                 & (F.col("b_period") == F.col("c_period")) & (F.col("b_position") == F.col("c_position")))
    x = c.join(br, to_bridge).join(h, to_org) if many else c.join(h, to_org).join(br, to_bridge)
    narrow = {**{n: e for n, e in _common(invoice_label).items()},
              "credit_name": F.col("c_name"), "credittypeid": F.col("ct_id"), "creditseq": F.col("c_seq"),
              "exchange_rate": fx_rate("s_genericattribute4"), "quota": F.col("s_genericnumber1"),
              "ti_loc": F.col("s_genericnumber6"), "plan_element": F.col("s_genericattribute1"),
              "c_txn": F.col("c_txn"), "c_unit": F.col("c_unit"), "c_period": F.col("c_period")}
    x = x.select(*[e.alias(n) for n, e in narrow.items()],
                 F.when(bad_number("s_genericattribute4"), 1).otherwise(0).alias("parse_failed"))
    early = "path_transaction" in sources
    if early:
        x = x.groupBy(*narrow).agg(F.max("parse_failed").alias("parse_failed"))
    x = with_transactions(sources, x, keys, many)
    known = {n: F.col(n) for n in narrow if n in STAGING_TYPES}
    cols = {**_credit_cols(invoice_label), **known,
            "credit_type": credit_type_label("credittypeid", "credit_name"),
            "nativecurrencyamount": F.coalesce(F.col("st_native"), F.lit(0)),
            "trxn_amount": exact_product("st_value", "exchange_rate")}
    pad = _null_padding()
    rows = x.select(*[pad[n] if n not in cols else cols[n].cast(STAGING_TYPES[n]).alias(n) for n in STAGING_NAMES],
                    F.lit("regular").alias("arm"), "parse_failed")
    if early:
        return rows
    return rows.groupBy(*STAGING_NAMES, "arm").agg(F.max("parse_failed").alias("parse_failed"))


def _org_incentive(sources, params: DataFrame, cond: Column) -> DataFrame:
    """org row x reported incentive of the same period and position, flag-1, ``cond``."""
    h = org_in_run(sources, params)
    s = _incentive(sources, "s").where(F.col("s_periodseq").isin(period_keys(sources, params)))
    s = s.where(flag_set("s_genericboolean1") & cond)
    return h.join(s, (h.h_period == s.s_periodseq) & (h.h_positionseq == s.s_positionseq))


def _to_credits(sources, x: DataFrame, inc_prefix: str, keys: list[int]) -> DataFrame:
    """incentive -> bridge -> credit (+ type); ``keys`` are the incentives' periods."""
    b = bridge(sources, keys)
    y = x.join(b, (F.col(f"{inc_prefix}_incentiveseq") == b.i_inc)
               & (F.col(f"{inc_prefix}_periodseq") == b.b_tperiod)
               & (F.col(f"{inc_prefix}_processingunitseq") == b.b_unit))
    c = credits(sources).where(F.col("c_period").isin(keys))
    return y.join(c, (c.c_period == y.b_tperiod) & (c.c_unit == y.b_unit) & (c.c_seq == y.b_credit))


# The MBO, YOY Growth, CIP and FY25-regular arms differ only in which incentive reaches which
# credit and in a handful of measures. Each arm is first built as a narrow "pre-staging" row
# (org + credit + incentive/commission fields, one shared schema); the arms are unioned and
# the transaction core - the widest dimension - is joined ONCE for all of them; the measures
# are then picked per arm with CASE on the arm name.
PRE_TYPES = {
    "s_incentiveseq": "bigint", "t_incentiveseq": "bigint", "s_genericattribute1": "string",
    "s_genericattribute4": "string", "s_value": "decimal(25,10)",
    "s_genericnumber1": "decimal(25,10)", "s_genericnumber6": "decimal(25,10)",
    "co_seq": "bigint", "co_value": "decimal(25,10)", "co_rate": "decimal(25,10)",
}
ORG_COLS = ["v_period", "v_periodname", "v_unit", "v_unitname", "h_payeeseq", "h_positionseq",
            "h_payeeid", "h_fullname", "h_m1", "h_m2", "h_division", "h_cc_dept", "h_currency"]
CREDIT_COLS = ["c_seq", "c_name", "ct_id", "c_txn", "c_unit", "c_period", "c_value", "c_gn2", "c_gn3",
               "c_gn6"]


def _pre(df: DataFrame, arm: str | Column) -> DataFrame:
    """Project an arm's joined rows to the shared pre-staging schema (typed NULL padding)."""
    have = set(df.columns)
    extra = [(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in PRE_TYPES.items()]
    return df.select(*ORG_COLS, *CREDIT_COLS, *extra,
                     (F.lit(arm) if isinstance(arm, str) else arm).alias("arm"))


def _pre_mbo(sources, params: DataFrame) -> DataFrame:
    """MBO: reported incentive <- self trace <- source incentive -> measurements -> credits."""
    x = _org_incentive(sources, params, (F.col("s_genericattribute1") == MBO)
                       & _weight_positive("s_genericattribute2"))
    t = run_sources(sources, params)
    x = x.join(t, (x.s_incentiveseq == t.ist_target) & (t.ist_speriod == x.s_periodseq))
    return _pre(_to_credits(sources, x, "t", source_keys(sources, params)), "mbo")


def _pre_direct(sources, params: DataFrame, arms: list[str]) -> DataFrame:
    """YOY Growth and CIP / Payment Adjustment: incentive -> measurements -> credits, one pass.

    The weight test applies to YOY Growth only."""
    element = F.col("s_genericattribute1")
    conds = {"yoy": (element == YOY) & _weight_positive("s_genericattribute2"),
             "cip": element.isin(*CIP_ELEMENTS)}
    x = _org_incentive(sources, params, reduce(Column.__or__, [conds[a] for a in arms]))
    y = _to_credits(sources, x, "s", period_keys(sources, params))
    return _pre(y, F.when(element == YOY, F.lit("yoy")).otherwise(F.lit("cip")))


def _pre_regular_fy25(sources, params: DataFrame) -> DataFrame:
    """FY25 regular: reported incentive <- self trace <- source incentive -> commission ->
    credit. No plan-element exclusion and no DISTINCT."""
    x = _org_incentive(sources, params, _weight_positive("s_genericattribute2"))
    t = run_sources(sources, params)
    x = x.join(t, (t.ist_speriod == x.s_periodseq) & (x.s_incentiveseq == t.ist_target))
    co = sources["cs_commission"].select(
        F.col("commissionseq").alias("co_seq"), F.col("periodseq").alias("co_period"),
        F.col("processingunitseq").alias("co_unit"), F.col("positionseq").alias("co_position"),
        F.col("incentiveseq").alias("co_inc"), F.col("creditseq").alias("co_credit"),
        F.col("value").alias("co_value"), F.col("ratevalue").alias("co_rate"))
    keys = source_keys(sources, params)
    co = co.where(F.col("co_period").isin(keys))
    x = x.join(co, (x.t_periodseq == co.co_period) & (x.t_processingunitseq == co.co_unit)
               & (x.t_positionseq == co.co_position) & (x.t_incentiveseq == co.co_inc))
    c = credits(sources).where(F.col("c_period").isin(keys))
    y = x.join(c, (c.c_period == x.co_period) & (c.c_unit == x.co_unit)
               & (c.c_position == x.co_position) & (c.c_seq == x.co_credit))
    return _pre(y, "regular")


def _case_on_arm(name: str, cases) -> Column:
    """CASE arm WHEN ... THEN ... END (NULL for arms not listed).

    Every branch is cast to the staging type first: a CASE over decimals of different scales
    would otherwise widen to a common type and drop digits from the exact ones.
    """
    typ = STAGING_TYPES[name]
    if isinstance(cases, Column):
        return cases.cast(typ)
    out = None
    for arm, expr in cases.items():
        cond, val = F.col("arm") == arm, expr.cast(typ)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def _credit_arm_measures(rules: str) -> tuple[dict[str, Column], Column]:
    """Per-arm measures of the credit arms (column -> CASE on arm) and the parse-failure flag."""
    c = F.col
    fx = fx_rate("s_genericattribute4")
    fx100 = fx_rate("s_genericattribute4", per_cent=True)
    rate = c("co_rate")
    fy25 = rules == "FY25"
    cols = {
        "commissionseq": {"regular": c("co_seq")},
        "incentiveseq": c("s_incentiveseq"),
        "source_incentiveseq": {"mbo": c("t_incentiveseq"), "regular": c("t_incentiveseq")},
        "nativecurrencyamount": {
            "mbo": c("c_gn2") * 100, "yoy": c("c_value") * 100, "cip": c("st_native"),
            "regular": F.coalesce(c("st_native"), F.lit(0))},
        "exchange_rate": {"mbo": c("c_gn3") * 100, "yoy": fx, "cip": c("c_gn3") * 100,
                                  "regular": fx},
        "trxn_amount": {
            "mbo": c("c_gn2") * 100 if fy25 else exact_product("st_value", c("c_gn3") * 100),
            "yoy": c("c_value") * 100 if fy25 else exact_product("st_value", fx),
            "cip": c("c_gn2") * 100,
            # a zero rate gives NULL (counted by step_log) where the reference would stop
            "regular": F.try_divide(c("co_value").cast("double"), rate.cast("double"))},
        "quota": {"regular": c("s_genericnumber1")},
        "ti_loc": {"mbo": c("c_gn6"), "yoy": c("c_gn6"), "cip": c("c_gn6"),
                           "regular": c("s_genericnumber6")},
        "tier_rate": {"regular": tier_rate(rate, c("s_genericnumber1"),
                                                   c("s_genericnumber6"))},
        "ratevalue": {"regular": rate},
        "commission_lc": {"mbo": c("c_value"), "yoy": c("s_value"), "cip": c("c_value"),
                                  "regular": c("co_value")},
        "commission_usd": {"mbo": exact_product("c_value", "c_gn3"), "yoy": exact_product("s_value", fx100),
                                   "cip": exact_product("c_value", "c_gn3"),
                                   "regular": exact_product("co_value", fx100)},
        "plan_element": c("s_genericattribute1"),
    }
    bad_text = bad_number("s_genericattribute4")
    failed = (F.when((c("arm") == "yoy") & bad_text, 1)
              .when((c("arm") == "regular") & ((rate == 0) | bad_text), 1).otherwise(0))
    return cols, failed


def credit_arms(sources, params: DataFrame, arms: list[str], rules: str = "FY26",
                invoice_label: str = DEFAULT_INVOICE_LABEL) -> DataFrame:
    """Staging rows of the credit arms in ``arms`` (mbo, yoy, cip, and 'regular' = FY25's),
    built with one transaction join for all of them."""
    direct = [a for a in arms if a in ("yoy", "cip")]
    parts = [_pre_mbo(sources, params)] if "mbo" in arms else []
    parts += [_pre_direct(sources, params, direct)] if direct else []
    parts += [_pre_regular_fy25(sources, params)] if "regular" in arms else []
    pre = reduce(DataFrame.unionByName, parts)
    # the direct arms' credits lie in the targets' own periods
    keys = _credit_keys(sources, params) if len(direct) < len(arms) else period_keys(sources, params)
    y = with_transactions(sources, pre, keys, many_periods(sources, params))
    measures, failed = _credit_arm_measures(rules)
    cols = {**_common(invoice_label), **_credit_cols(invoice_label),
            **{k: _case_on_arm(k, v) for k, v in measures.items()}}
    out = []
    pad = _null_padding()
    for name in STAGING_NAMES:
        c = cols.get(name)
        out.append(pad[name] if c is None else c.cast(STAGING_TYPES[name]).alias(name))
    return y.select(*out, "arm", failed.alias("parse_failed"))


def _credit_keys(sources, params: DataFrame) -> list[int]:
    """Periods in which the run's credits can lie: the targets' and their source incentives'."""
    return sorted({*period_keys(sources, params), *source_keys(sources, params)})


def arm_mbo(sources, params: DataFrame, rules: str = "FY26",
            invoice_label: str = DEFAULT_INVOICE_LABEL) -> DataFrame:
    """MBO arm: reported incentive <- self trace <- source incentive -> measurements -> credits."""
    return credit_arms(sources, params, ["mbo"], rules, invoice_label)


def arm_yoy(sources, params: DataFrame, rules: str = "FY26",
            invoice_label: str = DEFAULT_INVOICE_LABEL) -> DataFrame:
    """YOY Growth arm: incentive -> measurements -> credits; weight test applies."""
    return credit_arms(sources, params, ["yoy"], rules, invoice_label)


def arm_cip(sources, params: DataFrame, rules: str = "FY26",
            invoice_label: str = DEFAULT_INVOICE_LABEL) -> DataFrame:
    """CIP / Payment Adjustment arm: as YOY without the weight test."""
    return credit_arms(sources, params, ["cip"], rules, invoice_label)


def arm_regular_fy25(sources, params: DataFrame, invoice_label: str = DEFAULT_INVOICE_LABEL) -> DataFrame:
    """FY25 regular arm (commission-based, no exclusion, no DISTINCT)."""
    return credit_arms(sources, params, ["regular"], "FY25", invoice_label)


def arm_guarantee(sources, params: DataFrame, invoice_label: str = DEFAULT_INVOICE_LABEL) -> DataFrame:
    """Guarantee arm: org x 'IO Guarantee' incentives only; no transaction columns."""
    x = _org_incentive(sources, params, F.col("s_name").isin(*GUARANTEE_NAMES))
    cols = {**_common(invoice_label),
            "credit_name": F.lit(GUARANTEE_LABEL),
            "credit_type": F.col("s_genericattribute1"),
            "exchange_rate": fx_rate("s_genericattribute4"),
            "commission_lc": F.col("s_value"),
            "commission_usd": exact_product("s_value", fx_rate("s_genericattribute4", per_cent=True))}
    return _staging_row(x, "guarantee", cols, F.col("s_genericattribute4"))


# ---------------------------------------------------------------------------------------
# staging, bill-to, report
# ---------------------------------------------------------------------------------------

def accrual_staging(sources, params: DataFrame, rules: str = "FY26",
                    invoice_label: str = DEFAULT_INVOICE_LABEL, strict: bool = False) -> DataFrame:
    """Bag union of the five arms: 58 columns + arm + parse_failed.

    A staged row whose exchange rate is no number, or whose commission rate is zero where it
    divides, has parse_failed 1 and NULL there; ``strict`` raises on the first such row instead, as
    the reference stops. Rows that are not staged never raise.

    FY26: the regular arm (own transaction join: its DISTINCT needs those columns) + one
    combined job for MBO/YOY/CIP + guarantee. FY25: one combined job for all four credit arms.
    """
    if rules not in RULES:
        raise ValueError(f"rules must be one of {RULES}")
    if rules == "FY25":
        credit = credit_arms(sources, params, ["regular", "mbo", "yoy", "cip"], rules,
                             invoice_label)
        arms = [credit]
    else:
        arms = [arm_regular(sources, params, invoice_label),
                credit_arms(sources, params, ["mbo", "yoy", "cip"], rules, invoice_label)]
    arms.append(arm_guarantee(sources, params, invoice_label))
    if strict:
        arms = [_refuse_failed(a) for a in arms]
    staged = reduce(DataFrame.unionByName, arms)
    staged.parts = arms  # rows of a part still lie by their transaction's key
    return staged


def _refuse_failed(staged: DataFrame) -> DataFrame:
    """``staged`` with its rates and flag raising on a failed parse.

    Columns and no filter carry the check: a filter could be evaluated below a join, on rows that
    never reach the staging. FY25's regular arm takes the rates of the YOY incentives too; whichever
    row is met first, both arms are named then.
    """
    arms = F.when((F.col("arm") == "regular") & (F.col("plan_element") == YOY) & F.col("exchange_rate").isNull(),
                  F.lit("yoy, regular")).otherwise(F.col("arm"))
    stop = F.raise_error(F.concat(F.lit("not a number or zero rate in arm "), arms,
                                  F.lit(", payee "), F.coalesce("payeeid", F.lit("unknown"))))
    return staged.withColumns({
        c: F.when(F.col("parse_failed") != 0, stop.cast(staged.schema[c].dataType)).otherwise(F.col(c))
        for c in ("exchange_rate", "commission_usd", "parse_failed")})


def billto_enrich(sources, staging: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """Fill country/state/customer id/company from the transaction's BILLTO address.

    No address -> NULLs; more than one BILLTO row for a transaction raises (the reference's
    scalar subquery would); only transactions that are staged are checked. With ``params`` only the
    addresses of the run's periods are read from an address path; without such a path only those
    are shuffled, unless the run has many periods.
    """
    if params is not None and "path_billto" in sources:
        known = sources["path_billto"].where(F.col("periodseq").isin(_credit_keys(sources, params)))
        # a transaction credited in two periods stands in both
        one = known.groupBy("a_txn").agg(*[F.max(c).alias(c) for c in known.columns if c not in ("periodseq", "a_txn")])
    else:
        bill = billto_addresses(sources)
        if params is not None and not many_periods(sources, params):
            bill = may_match(bill, "salestransactionseq", credited_bits(sources, _credit_keys(sources, params)))
        one = one_address(bill, F.col("salestransactionseq").alias("a_txn"))
    parts = getattr(staging, "parts", [staging])
    return reduce(DataFrame.unionByName, [_with_address(part, one) for part in parts])


def _with_address(staging: DataFrame, one: DataFrame) -> DataFrame:
    j = staging.join(one, staging.salestransactionseq == one.a_txn, "left")
    ok = F.when(F.col("a_n") > 1, F.raise_error(F.concat(
        F.lit("more than one BILLTO address for transaction "), F.col("a_txn").cast("string"))))
    j = j.withColumns({c: F.coalesce(ok.cast("string"), F.col(c)) for c in
                       ("a_country", "a_state", "a_custid", "a_company")})
    repl = {"billto_country": "a_country", "billto_state": "a_state",
            "billto_custid": "a_custid", "billto_company": "a_company"}
    return j.select(*[F.col(repl[c]).alias(c) if c in repl else F.col(c)
                      for c in staging.columns])


def accrual_details(staging: DataFrame, rules: str = "FY26", by_period: bool = False) -> DataFrame:
    """The 40 report columns as text (titles as column names).

    ``by_period`` keeps the period's key in front as target_periodseq.
    """
    ct = F.col("credit_type")
    masked = (lambda c: mask_by_credit_type(ct, c)) if rules == "FY26" else (lambda c: c)
    s = lambda c: F.col(c).cast("string")
    cols = [
        s("periodname"), s("payeeid"), s("fullname"), s("division"), s("dept_code"),
        s("credit_type"), s("sublinenumber"), s("accountingdate"), s("orderid"),
        s("order_ship_date"), s("compensationdate"), s("eventtype"),
        format_by_plan_element("plan_element", F.col("nativecurrencyamount")),
        s("nativecurrency"), s("exchange_rate"),
        format_by_plan_element("plan_element", F.col("trxn_amount"), else_prefix="$"),
        masked(s("tier_rate")),
        masked(round4_text(F.col("commission_lc"))),
        masked(s("local_currency")),
        masked(round4_text(F.col("commission_usd"), prefix="$")),
        s("billto_country"), s("billto_county"), s("billto_state"), s("l8_item_number"),
        s("l2_product"), s("l3_product"), s("l4_product"), s("l5_product"), s("l6_product"),
        s("product_id"), s("product_desc"), s("billto_custid"), s("billto_company"),
        s("invoice_lineno"), s("numberofunits"), s("revenue_account"), s("plan_element"),
        s("comments"), s("customer_pono"), s("order_book_date"),
    ]
    key = [F.col("periodseq").alias("target_periodseq")] if by_period else []
    return staging.select(*key, *[c.alias(t) for c, t in zip(cols, ACCRUAL_TITLES)])


def accrual_report(staging: DataFrame, rules: str = "FY26", header: bool = True) -> DataFrame:
    """Header row, then the detail rows by name, plan element and order id (equal rows are kept)."""
    details = accrual_details(staging, rules)
    if not header:
        return report_order(details)
    head = header_rows(staging.sparkSession, ACCRUAL_TITLES)
    both = head.withColumn("_line", F.lit(0)).unionByName(details.withColumn("_line", F.lit(1)))
    return both.orderBy("_line", *accrual_order()).drop("_line")


def accrual_order() -> list[Column]:
    """Sort keys of the report: name, plan element, order id (nulls first)."""
    return [F.col(c).asc_nulls_first() for c in ("Name", "Plan Element", "Order ID")]


def report_order(details: DataFrame) -> DataFrame:
    """The report's rows in its order."""
    return details.orderBy(*accrual_order())


def step_log(staging: DataFrame) -> DataFrame:
    """Rows staged and failed number parses of every arm, arms without rows included."""
    counted = staging.groupBy("arm").agg(F.count(F.lit(1)).alias("rows"),
                                         F.sum("parse_failed").cast("bigint").alias("failed_parses"))
    arms = staging.sparkSession.createDataFrame([(a,) for a in ARMS], "arm string")
    return arms.join(counted, "arm", "left").fillna(0)


def accrual_job(sources, params: DataFrame, folder: str, run_date, rules: str = "FY26",
                root: str | None = None, strict: bool = False) -> DataFrame:
    """The procedure as one job: staging, ordered report files of every target, and the step log.

    The staging is computed and written once under ``root`` (default: the session's shared folder);
    the report reads it back. The log, returned and appended to ``root/step_log``, has a row per arm
    with its counts, one for the bill-to lookup, and one per report with its file name; a failed
    step is logged before its error goes on. ``strict``: see ``accrual_staging``.
    """
    spark = sources.spark
    root = root or scratch_path(spark, f"accrual-{uuid.uuid4().hex}")
    log = StepLog(spark, "accrual")
    try:
        with log.step("staging", "staging rows with their bill-to values written"):
            counted = Counted(billto_enrich(sources, accrual_staging(sources, params, rules, strict=strict), params),
                              "arm", ARMS, "parse_failed")
            staged = full_refresh(counted.df, root, "staging")
        _, _, _, started, ended, *_ = log.entries[-1]
        for arm, (rows, failed) in counted.results().items():
            log.add(f"arm {arm}", f"records of arm {arm} staged", started, ended, rows, failed)
        with log.step("report", "report files written"):
            write_reports(accrual_details(staged, rules, by_period=True), folder, accrual_order(), params,
                          ACCRUAL_PREFIX, run_date)
        log_files(log, params, ACCRUAL_PREFIX, run_date)
    finally:
        log.append(f"{root.rstrip('/')}/step_log")
    return log.frame()
