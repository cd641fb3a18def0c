"""Fixed constants and the declared output shapes of the reports."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql.types import DecimalType

# Fixed values of the data model: the end-of-time date that marks a live (not removed) row,
# and the date used for removed fixture rows.
EOT = _dt.date(2200, 1, 1)
OLD = _dt.date(2010, 1, 1)

MONEY = DecimalType(25, 10)        # genericnumberN, value, targetcompensation
MONEY_2 = DecimalType(18, 2)       # TI USD (Annualized)
FLOAT_DEC = DecimalType(38, 10)    # DECIMAL without scale (floating) in the extract DDL
TEXT_DEC = DecimalType(20, 4)      # TO_DECIMAL(x, 20, 4) before printing

# Attainment extract: (column, type) in declared order. The first three are NOT NULL.
EXTRACT_COLUMNS = [
    ("Month", "string"),
    ("Qtr", "string"),
    ("ID", "string"),
    ("Plan Participant", "string"),
    ("DIVISION", "string"),
    ("SITE", "string"),
    ("DEPARTMENT", "string"),
    ("REGION", "string"),
    ("Currency", "string"),
    ("Plan Elements", "string"),
    ("Quota Plan", "string"),
    ("Quota", "decimal(25,10)"),
    ("TI LOC (Annualized)", "decimal(25,10)"),
    ("TI USD (Annualized)", "decimal(18,2)"),
    ("YTD Attainment$ (USD)", "decimal(25,10)"),
    ("YTD Attainment%", "decimal(38,10)"),
    ("YTD Comm Earned%", "decimal(38,10)"),
    ("YTD Commission Earned (LOC)", "decimal(25,10)"),
    ("YTD Commission Earned (USD)", "decimal(25,10)"),
    ("Current Month Revenue Attainment", "decimal(25,10)"),
    ("Current Month Commission Earned (LOC)", "decimal(25,10)"),
    ("Current Month Commission Earned (USD)", "decimal(38,10)"),
    ("Guarantee Payout Amount", "decimal(25,10)"),
]
EXTRACT_NOT_NULL = ("Month", "Qtr", "ID")

# Accrual staging: 58 columns in insert order, with the types we give them.
STAGING_COLUMNS = [
    ("periodseq", "bigint"),
    ("periodname", "string"),
    ("processingunitseq", "bigint"),
    ("processingunitname", "string"),
    ("payeeseq", "bigint"),
    ("positionseq", "bigint"),
    ("payeeid", "string"),
    ("fullname", "string"),
    ("mfullname_l1", "string"),
    ("mfullname_l2", "string"),
    ("division", "string"),
    ("dept_code", "string"),
    ("credit_name", "string"),
    ("credittypeid", "string"),
    ("credit_type", "string"),
    ("salestransactionseq", "bigint"),
    ("creditseq", "bigint"),
    ("commissionseq", "bigint"),
    ("incentiveseq", "bigint"),
    ("source_incentiveseq", "bigint"),
    ("sublinenumber", "bigint"),
    ("accountingdate", "date"),
    ("orderid", "string"),
    ("order_ship_date", "date"),
    ("compensationdate", "date"),
    ("eventtypeid", "string"),
    ("eventtype", "string"),
    ("nativecurrencyamount", "decimal(25,10)"),
    ("nativecurrency", "string"),
    ("exchange_rate", "decimal(25,10)"),
    ("trxn_amount", "decimal(25,10)"),
    ("quota", "decimal(25,10)"),
    ("ti_loc", "decimal(25,10)"),
    ("tier_rate", "decimal(25,10)"),
    ("ratevalue", "decimal(25,10)"),
    ("commission_lc", "decimal(25,10)"),
    ("local_currency", "string"),
    ("commission_usd", "decimal(25,10)"),
    ("billto_country", "string"),
    ("billto_county", "string"),
    ("billto_state", "string"),
    ("l8_item_number", "string"),
    ("l2_product", "string"),
    ("l3_product", "string"),
    ("l4_product", "string"),
    ("l5_product", "string"),
    ("l6_product", "string"),
    ("product_id", "string"),
    ("product_desc", "string"),
    ("billto_custid", "string"),
    ("billto_company", "string"),
    ("invoice_lineno", "string"),
    ("numberofunits", "decimal(25,10)"),
    ("revenue_account", "string"),
    ("plan_element", "string"),
    ("comments", "string"),
    ("customer_pono", "string"),
    ("order_book_date", "date"),
]
STAGING_NAMES = [c for c, _ in STAGING_COLUMNS]
STAGING_TYPES = dict(STAGING_COLUMNS)

# Accrual report: 40 titles in order (fixed values of the report header).
ACCRUAL_TITLES = [
    "Report Period", "ID", "Name", "Division", "Dept Code", "Credit Type", "Invoice Number",
    "Account Date", "Order ID", "Order Line Shipped Date", "Compensation Date",
    "Transaction Type", "Native Amount", "Native Currency", "Exchange Rate",
    "Transaction Amount (USD)", "Tier rate", "Commission (LC)", "Local Currency",
    "Commission (USD)", "Country", "County", "State", "L8 Item Number", "L2 Product",
    "L3 Product", "L4 Product", "L5 Product", "L6 Product", "Product ID",
    "Product Description", "Customer ID", "Customer Name", "Invoice Line Number",
    "Number of Units", "Revenue Account", "Plan Element", "Comments", "Customer PO Number",
    "Order Line Booked Date",
]

# Input tables: the columns the reports read, by table (fixed names of the data model).
INPUT_COLUMNS = {
    "cs_processingunit": "processingunitseq name",
    "cs_calendar": "calendarseq name removedate",
    "cs_periodtype": "periodtypeseq name removedate",
    "cs_period": "periodseq name startdate enddate calendarseq periodtypeseq parentseq removedate",
    "cs_participant": "payeeseq lastname firstname userid genericattribute3 genericattribute4 genericattribute5 "
                      "genericattribute7 terminationdate removedate effectivestartdate effectiveenddate",
    "cs_payee": "payeeseq payeeid businessunitmap removedate effectivestartdate effectiveenddate",
    "cs_businessunit": "businessunitseq mask",
    "cs_position": "ruleelementownerseq payeeseq genericattribute5 targetcompensation removedate "
                   "effectivestartdate effectiveenddate",
    "cs_incentive": "incentiveseq name positionseq payeeseq periodseq processingunitseq genericattribute1 "
                    "genericattribute2 genericattribute3 genericattribute4 genericattribute16 genericnumber1 "
                    "genericnumber2 genericnumber3 genericnumber4 genericnumber5 genericnumber6 genericboolean1 "
                    "genericboolean3 value",
    "cs_incentiveselftrace": "sourceincentiveseq targetincentiveseq sourceperiodseq",
    "cs_incentivepmtrace": "incentiveseq measurementseq targetperiodseq processingunitseq",
    "cs_measurement": "measurementseq periodseq processingunitseq",
    "cs_pmcredittrace": "creditseq measurementseq targetperiodseq processingunitseq",
    "cs_credit": "creditseq name credittypeseq salestransactionseq positionseq periodseq processingunitseq value "
                 "genericnumber2 genericnumber3 genericnumber6",
    "cs_credittype": "datatypeseq credittypeid removedate",
    "cs_commission": "commissionseq periodseq processingunitseq positionseq incentiveseq creditseq value ratevalue",
    "cs_salestransaction": "salestransactionseq salesorderseq processingunitseq modelseq eventtypeseq sublinenumber "
                           "accountingdate compensationdate value nativecurrencyamount nativecurrency numberofunits "
                           "productid productdescription comments genericattribute2 genericattribute4 "
                           "genericattribute6 genericattribute8 genericattribute9 genericattribute10 "
                           "genericattribute11 genericattribute12 genericattribute20 genericattribute21 "
                           "genericdate2 genericdate3",
    "cs_eventtype": "datatypeseq eventtypeid removedate",
    "cs_salesorder": "salesorderseq orderid removedate",
    "cs_transactionaddress": "salestransactionseq addresstypeseq country state custid company",
    "cs_addresstype": "addresstypeseq addresstypeid",
    "rpt_orgdata": "processingunitseq periodseq payeeseq positionseq payeeid fullname mfullname_l1 mfullname_l2 "
                   "division cc_dept local_currency",
}
_MONEY_NAMES = ("value", "ratevalue", "nativecurrencyamount", "numberofunits", "targetcompensation")


def input_type(column: str) -> str:
    """The data model's type of an input column, which its name tells."""
    if column.endswith("seq") or column in ("sublinenumber", "businessunitmap", "mask"):
        return "bigint"
    if column.startswith("genericnumber") or column in _MONEY_NAMES:
        return "decimal(25,10)"
    if column.startswith("genericboolean"):
        return "int"
    if column.startswith("genericdate") or column.endswith("date"):
        return "date"
    return "string"


def input_schema(table: str) -> str:
    """Declared columns of an input table, partition columns among them."""
    return ", ".join(f"{c} {input_type(c)}" for c in INPUT_COLUMNS[table].split())
