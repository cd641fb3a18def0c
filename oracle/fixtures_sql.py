"""DuckDB SQL for the compensation tables of FIXTURES.md section 2.

Independent twin of ``quotalens.sources.fixtures``: the same rules, written as SQL over the
driver's pre-registered views (orders, lineitem, customer, nation, region). ``with_tables``
prepends the CTEs a query body needs, in dependency order.
"""

from __future__ import annotations

import re

EOT = "DATE '2200-01-01'"
OLD = "DATE '2010-01-01'"

# name -> (sql, dependencies)
TABLE_SQL: dict[str, tuple[str, tuple[str, ...]]] = {}


def _t(name: str, sql: str, *deps: str) -> None:
    TABLE_SQL[name] = (sql, deps)


_t("o_", f"""
SELECT o_orderkey AS k, o_custkey AS cust, CAST(o_orderdate AS DATE) AS od,
       o_orderpriority AS prio,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(25,10)) AS total,
       CAST((year(CAST(o_orderdate AS DATE)) + CASE WHEN month(CAST(o_orderdate AS DATE)) >= 7
             THEN 1 ELSE 0 END) * 100 + ((month(CAST(o_orderdate AS DATE)) + 5) % 12) + 1
            AS BIGINT) AS periodseq,
       CAST(CASE WHEN o_orderkey % 19 = 0 THEN 2 ELSE 1 END AS BIGINT) AS unit,
       o_custkey + 1000000 AS positionseq
FROM orders""")

_t("c_", """
SELECT c.c_custkey AS cust, c.c_name, CAST(c.c_nationkey AS BIGINT) AS nk, c.c_acctbal,
       c.c_mktsegment, n.n_name, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

_t("m_", """
SELECT ms, fy, fm, CAST(floor((fm + 2) / 3) AS BIGINT) AS q, CAST(floor((fm + 5) / 6) AS BIGINT) AS h
FROM (SELECT ms, CAST(year(ms) + CASE WHEN month(ms) >= 7 THEN 1 ELSE 0 END AS BIGINT) AS fy,
             CAST(((month(ms) + 5) % 12) + 1 AS BIGINT) AS fm
      FROM (SELECT DISTINCT CAST(date_trunc('month', od) AS DATE) AS ms FROM o_) x) y""", "o_")

_t("cs_period", f"""
SELECT * FROM (
  SELECT fy * 100 + fm AS periodseq, strftime(ms, '%B %Y') AS name, ms AS startdate,
         CAST(ms + INTERVAL 1 MONTH AS DATE) AS enddate, CAST(1 AS BIGINT) AS calendarseq,
         CAST(1 AS BIGINT) AS periodtypeseq, 100000000 + fy * 10 + q AS parentseq, {EOT} AS removedate
  FROM m_
  UNION ALL
  SELECT fy * 100 + fm + 900000, strftime(ms, '%B %Y'), ms, CAST(ms + INTERVAL 1 MONTH AS DATE),
         1, 1, 100000000 + fy * 10 + q, {OLD}
  FROM m_
  UNION ALL
  SELECT 100000000 + fy * 10 + q, 'Q' || q || ' FY' || fy, min(ms),
         max(CAST(ms + INTERVAL 1 MONTH AS DATE)), 1, 2, 200000000 + fy * 10 + h, {EOT}
  FROM m_ GROUP BY fy, q, h
  UNION ALL
  SELECT 200000000 + fy * 10 + h, 'H' || h || ' FY' || fy, min(ms),
         max(CAST(ms + INTERVAL 1 MONTH AS DATE)), 1, 3, 300000000 + fy, {EOT}
  FROM m_ GROUP BY fy, h
  UNION ALL
  SELECT 300000000 + fy, 'FY' || fy, make_date(CAST(fy - 1 AS BIGINT), 7, 1),
         make_date(CAST(fy AS BIGINT), 7, 1), 1, 4, CAST(NULL AS BIGINT), {EOT}
  FROM (SELECT DISTINCT fy FROM m_) z
) p""", "m_")

_t("cs_periodtype", f"""
SELECT t.periodtypeseq, t.name, {EOT} AS removedate
FROM (SELECT DISTINCT periodtypeseq FROM cs_period) p
JOIN (VALUES (1, 'month'), (2, 'Quarter'), (3, 'SemiAnnual'), (4, 'YEAR')) t(periodtypeseq, name)
  ON p.periodtypeseq = t.periodtypeseq
UNION ALL
SELECT CAST(9 AS BIGINT), 'month', {OLD}
FROM (SELECT DISTINCT periodtypeseq FROM cs_period) p WHERE p.periodtypeseq = 1""", "cs_period")

_t("cs_processingunit", """
SELECT CAST(processingunitseq AS BIGINT) AS processingunitseq, name
FROM (VALUES (1, 'PU1'), (2, 'PU2')) t(processingunitseq, name)""")

_t("cs_calendar", f"""
SELECT CAST(calendarseq AS BIGINT) AS calendarseq, name, removedate
FROM (VALUES (1, 'Main Fiscal Calendar', {EOT}), (2, 'Main Fiscal Calendar', {OLD}),
             (3, 'Other Calendar', {EOT})) t(calendarseq, name, removedate)""")

_t("part_base_", f"""
SELECT cust AS payeeseq, c_name AS lastname, 'F' || cust AS firstname, 'u' || cust AS userid,
       CASE nk % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' END AS genericattribute3,
       'Dept' || (nk % 5) AS genericattribute4, c_mktsegment AS genericattribute5,
       n_name AS genericattribute7,
       CASE WHEN cust % 13 = 0 THEN DATE '1998-09-15' WHEN cust % 13 = 1 THEN DATE '1998-10-15'
       END AS terminationdate,
       {EOT} AS removedate, DATE '1990-01-01' AS effectivestartdate, {EOT} AS effectiveenddate
FROM c_""", "c_")

_t("cs_participant", f"""
SELECT * FROM part_base_ WHERE payeeseq % 8 <> 0
UNION ALL
SELECT payeeseq, lastname, firstname, userid, genericattribute3, genericattribute4,
       genericattribute5, genericattribute7, terminationdate, removedate, effectivestartdate,
       DATE '1998-11-01'
FROM part_base_ WHERE payeeseq % 8 = 0
UNION ALL
SELECT payeeseq, lastname, firstname, userid, genericattribute3, genericattribute4,
       genericattribute5, genericattribute7 || ' (moved)', terminationdate, removedate,
       DATE '1998-11-01', effectiveenddate
FROM part_base_ WHERE payeeseq % 8 = 0
UNION ALL
SELECT payeeseq, 'OLD ' || lastname, firstname, userid, genericattribute3, genericattribute4,
       genericattribute5, genericattribute7, terminationdate, {OLD}, effectivestartdate,
       effectiveenddate
FROM part_base_ WHERE payeeseq % 9 = 0""", "part_base_")

_t("cs_payee", f"""
SELECT cust AS payeeseq, 'P' || cust AS payeeid, cust % 3 + 1 AS businessunitmap,
       {EOT} AS removedate, DATE '1990-01-01' AS effectivestartdate, {EOT} AS effectiveenddate
FROM c_""", "c_")

_t("cs_businessunit", """
SELECT CAST(b.businessunitseq AS BIGINT) AS businessunitseq, CAST(b.mask AS BIGINT) AS mask
FROM (SELECT DISTINCT cust % 3 AS r FROM c_) p
JOIN (VALUES (0, 1, 1), (1, 2, 2), (0, 3, 1)) b(r, businessunitseq, mask) ON p.r = b.r""", "c_")

_t("cs_position", f"""
SELECT cust + 1000000 AS ruleelementownerseq, cust AS payeeseq, r_name AS genericattribute5,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 10 AS DECIMAL(25,10)) AS targetcompensation,
       {EOT} AS removedate, DATE '1990-01-01' AS effectivestartdate, {EOT} AS effectiveenddate
FROM c_""", "c_")

_t("inc_reported_", """
SELECT k AS incentiveseq,
       CASE WHEN k % 17 = 0 THEN 'IO Guarantee' ELSE 'INC-' || k END AS name,
       positionseq, cust AS payeeseq, periodseq, unit AS processingunitseq,
       CASE prio WHEN '1-URGENT' THEN 'Revenue Quota' WHEN '2-HIGH' THEN 'MBO'
                 WHEN '3-MEDIUM' THEN 'YOY Growth' WHEN '4-NOT SPECIFIED' THEN 'CIP'
                 WHEN '5-LOW' THEN 'Payment Adjustment' END AS genericattribute1,
       CASE WHEN k % 11 = 0 THEN '0%' ELSE CAST(k % 100 + 1 AS VARCHAR) || '%' END AS genericattribute2,
       'QP' || CAST(k % 4 AS VARCHAR) AS genericattribute3,
       CASE k % 4 WHEN 0 THEN '100%' WHEN 1 THEN '1,05.5%' WHEN 2 THEN '92.25USD' END AS genericattribute4,
       CASE k % 3 WHEN 0 THEN 'Monthly Target Attainment' WHEN 1 THEN 'YTD Target Attainment'
                  WHEN 2 THEN 'Guarantee' END AS genericattribute16,
       CAST(CASE WHEN k % 23 = 0 THEN 1 ELSE total END AS DECIMAL(25,10)) AS genericnumber1,
       CAST(total * 2 AS DECIMAL(25,10)) AS genericnumber2,
       CAST((k % 150) / 100 AS DECIMAL(25,10)) AS genericnumber3,
       CAST(k % 10 AS DECIMAL(25,10)) AS genericnumber4,
       total AS genericnumber5,
       CAST(CASE WHEN k % 6 = 0 THEN 0 WHEN k % 6 = 1 THEN NULL ELSE k % 1000 + 50000 END
            AS DECIMAL(25,10)) AS genericnumber6,
       CAST(CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN 0 ELSE 1 END AS INTEGER) AS genericboolean1,
       CAST(CASE WHEN k % 5 = 0 THEN 1 END AS INTEGER) AS genericboolean3,
       total AS value
FROM o_""", "o_")

_t("cs_incentive", """
SELECT * FROM inc_reported_
UNION ALL
SELECT incentiveseq + 5000000000, name, positionseq, payeeseq, periodseq, processingunitseq,
       'Source', genericattribute2, genericattribute3, genericattribute4, CAST(NULL AS VARCHAR),
       genericnumber1, genericnumber2, genericnumber3, genericnumber4, genericnumber5,
       genericnumber6, CAST(0 AS INTEGER), CAST(NULL AS INTEGER), value
FROM inc_reported_""", "inc_reported_")

_t("mkeys_", """
SELECT k, periodseq, unit, prio, k + 1000000000 AS measurementseq FROM o_
UNION ALL
SELECT k, periodseq, unit, prio, k + 2000000000 FROM o_ WHERE k % 6 = 0""", "o_")

_t("cs_measurement", """
SELECT measurementseq, periodseq, unit AS processingunitseq FROM mkeys_""", "mkeys_")

_t("cs_incentivepmtrace", """
SELECT CASE WHEN prio = '2-HIGH' THEN k + 5000000000 ELSE k END AS incentiveseq, measurementseq,
       periodseq AS targetperiodseq, unit AS processingunitseq
FROM mkeys_""", "mkeys_")

_t("cs_incentiveselftrace", """
SELECT k + 5000000000 AS sourceincentiveseq, k AS targetincentiveseq, periodseq AS sourceperiodseq
FROM o_""", "o_")

_t("tx_", """
SELECT o.k, o.cust, o.od, o.periodseq, o.unit, o.positionseq,
       CAST(a.l_linenumber AS BIGINT) AS ln, a.l_orderkey * 10 + a.l_linenumber AS s,
       CAST(a.v AS DECIMAL(25,10)) AS value, CAST(a.units AS DECIMAL(25,10)) AS units,
       a.partkey, a.shipdate, CAST(a.disc AS DECIMAL(25,10)) AS disc, a.ls, a.rf
FROM (SELECT l_orderkey, l_linenumber,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v,
             sum(CAST(l_quantity AS DECIMAL(18,2))) AS units,
             min(l_partkey) AS partkey, min(CAST(l_shipdate AS DATE)) AS shipdate,
             max(CAST(l_discount AS DECIMAL(18,2))) AS disc,
             min(l_linestatus) AS ls, min(l_returnflag) AS rf
      FROM lineitem GROUP BY l_orderkey, l_linenumber) a
JOIN o_ o ON a.l_orderkey = o.k""", "o_")

_t("cs_salestransaction", """
SELECT s AS salestransactionseq, k AS salesorderseq, unit AS processingunitseq,
       CAST(CASE WHEN s % 29 = 0 THEN 1 ELSE 0 END AS BIGINT) AS modelseq,
       s % 5 AS eventtypeseq, ln AS sublinenumber, od AS accountingdate,
       od + CAST(s % 7 AS INTEGER) AS compensationdate, value,
       CAST(CASE WHEN s % 4 = 0 THEN NULL ELSE value * 2 END AS DECIMAL(25,10)) AS nativecurrencyamount,
       CASE s % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' END AS nativecurrency,
       units AS numberofunits, CAST(partkey AS VARCHAR) AS productid,
       'Part ' || partkey AS productdescription, 'Line ' || s AS comments,
       'County ' || (s % 50) AS genericattribute2, 'L8-' || (s % 97) AS genericattribute4,
       CAST(ln AS VARCHAR) AS genericattribute6, 'L2-' || (s % 3) AS genericattribute8,
       'L3-' || (s % 5) AS genericattribute9, 'L4-' || (s % 7) AS genericattribute10,
       'L5-' || (s % 11) AS genericattribute11, 'L6-' || (s % 13) AS genericattribute12,
       'PO' || k AS genericattribute20, 'RA' || (s % 17) AS genericattribute21,
       shipdate AS genericdate2, od AS genericdate3
FROM tx_""", "tx_")

_t("cs_credit", """
SELECT s AS creditseq, CASE WHEN ls = 'O' THEN 'CO-' || s ELSE 'ICO-' || s END AS name,
       CAST(CASE rf WHEN 'R' THEN 1 WHEN 'A' THEN 2 WHEN 'N' THEN 3 END AS BIGINT) AS credittypeseq,
       s AS salestransactionseq, positionseq, periodseq, unit AS processingunitseq, value,
       disc AS genericnumber2,
       CAST(CASE WHEN k % 4 = 0 THEN '1' WHEN k % 4 = 1 THEN '1.05' WHEN k % 4 = 2 THEN '0.92' END
            AS DECIMAL(25,10)) AS genericnumber3,
       CAST(k % 1000 AS DECIMAL(25,10)) AS genericnumber6
FROM tx_""", "tx_")

_t("cs_pmcredittrace", """
SELECT t.s AS creditseq, m.measurementseq, t.periodseq AS targetperiodseq,
       t.unit AS processingunitseq
FROM tx_ t JOIN mkeys_ m ON t.k = m.k""", "tx_", "mkeys_")

_t("cs_credittype", f"""
SELECT CAST(datatypeseq AS BIGINT) AS datatypeseq, credittypeid, removedate
FROM (VALUES (1, 'Invoice Revenue', {EOT}), (2, 'Invoice Revenue Adj', {EOT}),
             (3, 'Revenue Adjustment', {EOT}), (1, 'Removed', {OLD})) t(datatypeseq, credittypeid, removedate)""")

_t("cs_commission", """
SELECT s + 7000000000 AS commissionseq, periodseq, unit AS processingunitseq, positionseq,
       k + 5000000000 AS incentiveseq, s AS creditseq,
       CAST(value * CAST((s % 5) / 1000 AS DECIMAL(25,10)) AS DECIMAL(25,10)) AS value,
       CAST((s % 5) / 1000 AS DECIMAL(25,10)) AS ratevalue
FROM tx_""", "tx_")

_t("cs_eventtype", f"""
SELECT CAST(datatypeseq AS BIGINT) AS datatypeseq, eventtypeid, {EOT} AS removedate
FROM (VALUES (0, 'Invoice'), (1, 'Credit Memo'), (2, 'Debit Memo'), (3, 'Return'),
             (4, 'Manual')) t(datatypeseq, eventtypeid)""")

_t("cs_salesorder", f"""
SELECT k AS salesorderseq, 'O' || k AS orderid,
       CASE WHEN k % 31 = 0 THEN {OLD} ELSE {EOT} END AS removedate
FROM o_""", "o_")

_t("cs_transactionaddress", """
SELECT t.s AS salestransactionseq, CAST(1 AS BIGINT) AS addresstypeseq, c.n_name AS country,
       c.r_name AS state, 'P' || t.cust AS custid, c.c_name AS company
FROM tx_ t JOIN c_ c ON t.cust = c.cust WHERE t.s % 10 <> 3
UNION ALL
SELECT t.s, CAST(2 AS BIGINT), c.n_name, c.r_name, 'P' || t.cust, c.c_name
FROM tx_ t JOIN c_ c ON t.cust = c.cust""", "tx_", "c_")

_t("cs_addresstype", """
SELECT CAST(addresstypeseq AS BIGINT) AS addresstypeseq, addresstypeid
FROM (VALUES (1, 'BILLTO'), (2, 'SHIPTO')) t(addresstypeseq, addresstypeid)""")

_t("rpt_orgdata", """
SELECT CAST(1 AS BIGINT) AS processingunitseq, p.periodseq, p.cust AS payeeseq,
       p.cust + 1000000 AS positionseq, 'P' || p.cust AS payeeid, c.c_name AS fullname,
       'M' || c.nk AS mfullname_l1, 'M' || (c.nk % 5) AS mfullname_l2, c.c_mktsegment AS division,
       CAST(c.nk + 1000 AS VARCHAR) || '-' || c.c_mktsegment AS cc_dept,
       CASE c.nk % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' END AS local_currency
FROM (SELECT DISTINCT cust, periodseq FROM o_) p JOIN c_ c ON p.cust = c.cust""", "o_", "c_")


def _needed(body: str) -> list[str]:
    """Derived tables referenced by ``body`` plus their dependencies, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in TABLE_SQL[name][1]:
            visit(dep)
        # a table's own SQL may reference others without declaring them
        for other in _refs(TABLE_SQL[name][0], exclude=name):
            visit(other)
        order.append(name)

    for name in _refs(body):
        visit(name)
    return order


def _refs(sql: str, exclude: str | None = None) -> list[str]:
    found = []
    for name in TABLE_SQL:
        if name != exclude and re.search(rf"\b{re.escape(name)}\b", sql):
            found.append(name)
    return found


def with_tables(body: str) -> str:
    """``WITH <needed derived tables> <body>``: a self-contained DuckDB query."""
    names = _needed(body)
    body = body.strip()
    if not names:
        return body
    # MATERIALIZED: each fixture table is computed once and joined as a sized table, so the
    # optimizer never inlines derivations into the report joins
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({TABLE_SQL[n][0].strip()}\n)" for n in names)
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
