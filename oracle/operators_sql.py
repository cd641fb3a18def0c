"""DuckDB SQL for the operator-level queries (one per survey row that has its own key)."""

from __future__ import annotations

from oracle.accrual_sql import CREDIT_TYPE, TXN, _dec
from oracle.attainment_sql import (
    ATT_BASE, EXTRACT, PARAMS, PAYEES, PERIOD_LEVELS, TREE, attainment_text, base, cte, params)
from quotalens.schemas import ACCRUAL_TITLES

EOT = "DATE '2200-01-01'"
RUN_DATE = "DATE '2026-01-31'"

ALL_MONTHS = params(None)

DEC4 = ("replace(replace(replace(replace(replace(genericattribute4, ',', ''), '%', ''), "
        "'USD', ''), 'quantity', ''), 'integer', '')")


def _month_order(col: str) -> str:
    return ("list_position(['July', 'August', 'September', 'October', 'November', 'December', 'January', "
            f"'February', 'March', 'April', 'May', 'June'], regexp_extract({col}, '^[A-Za-z]+'))")


def _money(col: str, dollar: bool) -> str:
    txt = f"CAST(CAST({col} AS DECIMAL(20,4)) AS VARCHAR)"
    return f"'$' || {txt}" if dollar else txt


SQL = {
    "scan_current": f"""SELECT payeeseq, lastname, genericattribute7, effectivestartdate,
  effectiveenddate FROM cs_participant
WHERE removedate = CAST(strptime('01012200', '%m%d%Y') AS DATE)""",
    "effective_dated": cte(TREE) + f"""
SELECT month_periodseq AS periodseq, who.payeeseq, who.genericattribute7
FROM cs_participant who JOIN (FROM climb WHERE alive) months
  ON months.month_enddate > who.effectivestartdate AND months.month_enddate <= who.effectiveenddate
WHERE who.removedate = {EOT}""",
    "active_payees": cte(PARAMS) + f"""
SELECT run.target AS target_periodseq, payeeseq, terminationdate, effectivestartdate
FROM cs_participant, run
WHERE removedate = {EOT} AND NOT coalesce(terminationdate < run.first_day, FALSE)""",
    "semi_business_unit": f"""
SELECT DISTINCT pe.payeeseq, pe.payeeid, pe.businessunitmap
FROM cs_payee pe, cs_businessunit bu
WHERE pe.removedate = {EOT} AND pe.businessunitmap = bu.mask""",
    "payee_dedup": cte(PARAMS, PAYEES) + """
FROM staff QUALIFY payeeseq = min(payeeseq) OVER (PARTITION BY positionseq, target_periodseq)""",
    "period_types": cte(PERIOD_LEVELS) + "SELECT " + ", ".join(
        f"max(periodtypeseq) FILTER (WHERE depth = {k}) AS {n}_type"
        for k, n in enumerate(("month", "quarter", "half", "year"))) + " FROM level",
    "period_hierarchy": cte(TREE) + "SELECT * EXCLUDE (alive) FROM climb WHERE alive",
    "fiscal_month_order": f"""SELECT periodseq, name, {_month_order('name')} AS month_order
FROM cs_period WHERE periodtypeseq = 1""",
    "plan_element_in": """SELECT incentiveseq, genericattribute1, genericattribute16 FROM cs_incentive
WHERE genericattribute16 IN ('YTD Target Attainment', 'Monthly Target Attainment', 'Guarantee')
  AND genericattribute1 = 'MBO'""",
    "plan_element_not_in": """SELECT incentiveseq, genericattribute1 FROM cs_incentive
WHERE genericattribute1 NOT IN ('MBO', 'YOY Growth', 'CIP', 'Payment Adjustment')""",
    "flag_default": """SELECT incentiveseq, coalesce(genericboolean1, 0) AS flag1,
  coalesce(genericboolean3, 0) AS flag3 FROM cs_incentive
WHERE coalesce(genericboolean1, 0) = 1 OR coalesce(genericboolean3, 0) = 1""",
    "weight_threshold": f"""SELECT incentiveseq, genericattribute2,
  {_dec('genericattribute2')} AS weight FROM cs_incentive WHERE {_dec('genericattribute2')} > 0""",
    "parse_decorated": f"""SELECT incentiveseq, genericattribute4, {DEC4} AS stripped,
  TRY_CAST({DEC4} AS DOUBLE) AS parsed FROM cs_incentive""",
    "fx_factor": f"""SELECT incentiveseq, CASE WHEN TRY_CAST({DEC4} AS DOUBLE) <> 0
  THEN CAST(TRY_CAST({DEC4} AS DOUBLE) / 100 AS DECIMAL(20,10)) ELSE CAST(0 AS DECIMAL(20,10))
  END AS fx_factor FROM cs_incentive""",
    "target_income": f"""
WITH pay AS (
  SELECT i.incentiveseq, i.genericnumber6 AS own, i.genericnumber6::DECIMAL(18,2) AS cents,
         n.targetcompensation AS target, nullif({_dec("i.genericattribute4")}, 0) / 100 AS factor
  FROM (FROM cs_position WHERE removedate = {EOT}) n
  JOIN cs_incentive i ON (i.positionseq, i.payeeseq) = (n.ruleelementownerseq, n.payeeseq))
SELECT incentiveseq, if(own = 0, target, own)::DECIMAL(25,10) AS ti_loc,
       (if(cents = 0, target, cents) * coalesce(factor::DECIMAL(20,10), 0))::DECIMAL(18,2) AS ti_usd
FROM pay""",
    "tier_rate": """
WITH pair AS (
  SELECT commissionseq, ratevalue::DOUBLE AS rate, i.genericnumber1::DOUBLE AS quota, i.genericnumber6::DOUBLE AS ti
  FROM cs_incentive i JOIN cs_commission USING (incentiveseq))
SELECT commissionseq, CASE WHEN ti <> 0 THEN round(rate * quota / ti) ELSE 0.0 END AS tier_rate FROM pair""",
    "commission_usd": """SELECT creditseq, CAST(value * genericnumber3 AS DECIMAL(25,10)) AS commission_usd
FROM cs_credit""",
    "credit_type_label": f"""SELECT c.creditseq, c.name, ct.credittypeid, {CREDIT_TYPE} AS credit_type
FROM cs_credit c JOIN cs_credittype ct ON c.credittypeseq = ct.datatypeseq AND ct.removedate = {EOT}""",
    "accrual_mask": f"""SELECT c.creditseq, {CREDIT_TYPE} AS credit_type,
  CASE WHEN ({CREDIT_TYPE}) IN ('Direct Receiver', 'Revenue Adjustment', 'Roll up') THEN NULL
  ELSE c.value END AS masked_value
FROM cs_credit c JOIN cs_credittype ct ON c.credittypeseq = ct.datatypeseq AND ct.removedate = {EOT}""",
    "event_type_label": cte(TXN) + "SELECT salestransactionseq, eventtypeid, label AS event_type FROM txn",
    "order_txn_credit": cte(TXN) + f"""
SELECT creditseq, orderid, eventtypeid, credittypeid, periodseq
FROM cs_credit JOIN txn USING (salestransactionseq, processingunitseq)
JOIN (SELECT credittypeid, datatypeseq AS credittypeseq FROM cs_credittype WHERE removedate = {EOT})
  USING (credittypeseq)""",
    "bridge_join": """
WITH measured AS (
  SELECT measurementseq, periodseq AS targetperiodseq, processingunitseq FROM cs_measurement)
SELECT k.creditseq, measurementseq, i.incentiveseq
FROM measured
JOIN cs_incentivepmtrace i USING (measurementseq, targetperiodseq, processingunitseq)
JOIN cs_pmcredittrace k USING (measurementseq, targetperiodseq, processingunitseq)""",
    "self_trace": """
WITH who AS (SELECT incentiveseq, periodseq, genericattribute1 AS element FROM cs_incentive)
SELECT reported.incentiveseq, origin.incentiveseq AS source_incentiveseq,
       reported.element AS plan_element, origin.element AS source_plan_element
FROM cs_incentiveselftrace e
JOIN who origin ON origin.incentiveseq = e.sourceincentiveseq
JOIN who reported ON (reported.incentiveseq, reported.periodseq) = (e.targetincentiveseq, e.sourceperiodseq)""",
    "period_transactions": """
WITH credited AS (SELECT DISTINCT periodseq, salestransactionseq, processingunitseq FROM cs_credit)
SELECT c.periodseq, salestransactionseq, processingunitseq, t.value, o.orderid
FROM credited c JOIN cs_salestransaction t USING (salestransactionseq, processingunitseq)
JOIN cs_salesorder o USING (salesorderseq)
WHERE t.modelseq = 0 AND o.removedate = """ + EOT,
    "period_billto": """
SELECT c.periodseq, a.salestransactionseq, count(*) AS addresses, max(a.country) AS country, max(a.company) AS company
FROM (SELECT DISTINCT periodseq, salestransactionseq FROM cs_credit) c
JOIN cs_transactionaddress a USING (salestransactionseq)
WHERE a.addresstypeseq IN (SELECT addresstypeseq FROM cs_addresstype WHERE addresstypeid = 'BILLTO')
GROUP BY ALL""",
    "dept_code": "SELECT positionseq, periodseq, SUBSTRING(cc_dept, 1, 4) AS dept_code FROM rpt_orgdata",
    "full_name": f"""SELECT payeeseq, effectivestartdate, lastname || ' ' || firstname AS full_name
FROM cs_participant WHERE removedate = {EOT}""",
    "substr_from": "SELECT doc_id, substr(text, 100) AS tail FROM documents",
    "money_format": f"""SELECT incentiveseq, {_money('genericnumber1', True)} AS quota_text,
  {_money('value', False)} AS value_text FROM cs_incentive""",
    "percent_format": """SELECT incentiveseq,
  CAST(ROUND(genericnumber3 * 100, 4) AS VARCHAR) || '%' AS pct_text FROM cs_incentive""",
    "report_filename": cte(ALL_MONTHS) + f"""
SELECT target AS target_periodseq,
  'YTD_ATTAINMENT_DETAIL_' || replace(target_name, ' ', '_') || '_' || strftime({RUN_DATE}, '%Y%m%d') || '.csv' AS attainment_file,
  'ACCRUAL_DETAIL_' || replace(target_name, ' ', '_') || '_' || strftime({RUN_DATE}, '%Y%m%d') || '.csv' AS accrual_file
FROM run""",
    "report_header": cte(ALL_MONTHS) + "SELECT target AS target_periodseq, "
    + ", ".join(f"'{t}' AS \"{t}\"" for t in ACCRUAL_TITLES) + " FROM run",
    "attainment_out": cte(*ATT_BASE, EXTRACT) + attainment_text("extract", by_target=False),
    "overwrite_roundtrip": cte(PARAMS, PAYEES) + "FROM staff",
}
