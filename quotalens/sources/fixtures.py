"""Compensation tables derived from the driver's star schema (FIXTURES.md section 2).

Every table is a deterministic function of ``orders``, ``lineitem``, ``customer``, ``nation``
and ``region``, so its size grows with the scale factor. Money doubles are cast to
``decimal(18,2)`` first and all later arithmetic is exact; the DuckDB twin of these rules
(``oracle.fixtures_sql``) then produces the very same rows.

Scale notes: the only wide shuffle is that of lineitem by its order key, for the aggregation to one
transaction per (order, line) and the join to orders alike; everything else is a narrow projection
of those two or a distinct over small keys (months, customer x period).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotalens.schemas import EOT, MONEY, OLD
from quotalens.sources.tables import Sources

# Fixed values of the fixture rules (FIXTURES.md section 2), stated together.
PRIORITY_PLAN_ELEMENT = [
    ("1-URGENT", "Revenue Quota"),
    ("2-HIGH", "MBO"),
    ("3-MEDIUM", "YOY Growth"),
    ("4-NOT SPECIFIED", "CIP"),
    ("5-LOW", "Payment Adjustment"),
]
FX_TEXT_BY_K4 = ["100%", "1,05.5%", "92.25USD", None]
KIND_BY_K3 = ["Monthly Target Attainment", "YTD Target Attainment", "Guarantee"]
CURRENCY_BY_3 = ["USD", "EUR", "JPY"]
CREDIT_TYPE_BY_FLAG = [("R", 1), ("A", 2), ("N", 3)]
CREDIT_TYPES = [(1, "Invoice Revenue", EOT), (2, "Invoice Revenue Adj", EOT),
                (3, "Revenue Adjustment", EOT), (1, "Removed", OLD)]
EVENT_TYPES = [(0, "Invoice"), (1, "Credit Memo"), (2, "Debit Memo"), (3, "Return"), (4, "Manual")]
PERIOD_TYPE_NAMES = [(1, "month"), (2, "Quarter"), (3, "SemiAnnual"), (4, "YEAR")]
CALENDARS = [(1, "Main Fiscal Calendar", EOT), (2, "Main Fiscal Calendar", OLD),
             (3, "Other Calendar", EOT)]
ADDRESS_TYPES = [(1, "BILLTO"), (2, "SHIPTO")]
CALENDAR_NAME = "Main Fiscal Calendar"
START_OF_TIME = "1990-01-01"
VERSION_SPLIT = "1998-11-01"


def _lit_date(d) -> Column:
    return F.lit(d).cast("date")


def _pick(key: Column, values: list) -> Column:
    """values[key] for a small literal list (None entries give NULL)."""
    out = None
    for i, v in enumerate(values):
        expr = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(key == i, expr) if out is None else out.when(key == i, expr)
    return out


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast(MONEY)


def _fiscal(d: Column) -> tuple[Column, Column]:
    """(fiscal year, fiscal month) with July = month 1."""
    m = F.month(d)
    fy = F.year(d) + F.when(m >= 7, 1).otherwise(0)
    fm = ((m + 5) % 12) + 1
    return fy, fm


def _order_keys() -> list[Column]:
    """Columns that follow from an order's key, customer and date."""
    fy, fm = _fiscal(F.col("od"))
    return [(fy * 100 + fm).cast("bigint").alias("periodseq"),
            F.when(F.col("k") % 19 == 0, 2).otherwise(1).cast("bigint").alias("unit"),
            (F.col("cust") + 1000000).alias("positionseq")]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(os.path.join(sf_dir, "orders.parquet"))
    return o.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cust"),
        F.to_date("o_orderdate").alias("od"),
        F.col("o_orderpriority").alias("prio"),
        _money(F.col("o_totalprice")).alias("total"),
    ).select("*", *_order_keys())


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(os.path.join(sf_dir, "customer.parquet"))
    n = spark.read.parquet(os.path.join(sf_dir, "nation.parquet"))
    r = spark.read.parquet(os.path.join(sf_dir, "region.parquet"))
    # nation/region are fixed-size (25 / 5 rows): broadcasting them is bounded.
    nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    return c.join(F.broadcast(nr), c.c_nationkey == nr.n_nationkey).select(
        F.col("c_custkey").alias("cust"), "c_name", F.col("c_nationkey").cast("bigint").alias("nk"),
        F.col("c_acctbal"), "c_mktsegment", "n_name", "r_name")


def _periods(orders: DataFrame) -> DataFrame:
    months = orders.select(F.trunc("od", "MM").alias("ms")).distinct()
    fy, fm = _fiscal(F.col("ms"))
    q = F.floor((fm + 2) / 3).cast("bigint")
    h = F.floor((fm + 5) / 6).cast("bigint")
    m = months.select(
        "ms", fy.cast("bigint").alias("fy"), fm.cast("bigint").alias("fm"),
        q.alias("q"), h.alias("h"))
    month_rows = m.select(
        (F.col("fy") * 100 + F.col("fm")).alias("periodseq"),
        F.date_format("ms", "MMMM yyyy").alias("name"),
        F.col("ms").alias("startdate"),
        F.add_months("ms", 1).alias("enddate"),
        F.lit(1).cast("bigint").alias("calendarseq"),
        F.lit(1).cast("bigint").alias("periodtypeseq"),
        (F.lit(100000000) + F.col("fy") * 10 + F.col("q")).alias("parentseq"),
        _lit_date(EOT).alias("removedate"),
    )
    removed_rows = month_rows.select(
        (F.col("periodseq") + 900000).alias("periodseq"), "name", "startdate", "enddate",
        "calendarseq", "periodtypeseq", "parentseq", _lit_date(OLD).alias("removedate"))
    quarters = m.groupBy("fy", "q", "h").agg(
        F.min("ms").alias("startdate"), F.max(F.add_months("ms", 1)).alias("enddate")
    ).select(
        (F.lit(100000000) + F.col("fy") * 10 + F.col("q")).alias("periodseq"),
        F.concat(F.lit("Q"), F.col("q"), F.lit(" FY"), F.col("fy")).alias("name"),
        "startdate", "enddate",
        F.lit(1).cast("bigint").alias("calendarseq"),
        F.lit(2).cast("bigint").alias("periodtypeseq"),
        (F.lit(200000000) + F.col("fy") * 10 + F.col("h")).alias("parentseq"),
        _lit_date(EOT).alias("removedate"),
    )
    halves = m.groupBy("fy", "h").agg(
        F.min("ms").alias("startdate"), F.max(F.add_months("ms", 1)).alias("enddate")
    ).select(
        (F.lit(200000000) + F.col("fy") * 10 + F.col("h")).alias("periodseq"),
        F.concat(F.lit("H"), F.col("h"), F.lit(" FY"), F.col("fy")).alias("name"),
        "startdate", "enddate",
        F.lit(1).cast("bigint").alias("calendarseq"),
        F.lit(3).cast("bigint").alias("periodtypeseq"),
        (F.lit(300000000) + F.col("fy")).alias("parentseq"),
        _lit_date(EOT).alias("removedate"),
    )
    years = m.select("fy").distinct().select(
        (F.lit(300000000) + F.col("fy")).alias("periodseq"),
        F.concat(F.lit("FY"), F.col("fy")).alias("name"),
        F.make_date(F.col("fy") - 1, F.lit(7), F.lit(1)).alias("startdate"),
        F.make_date(F.col("fy"), F.lit(7), F.lit(1)).alias("enddate"),
        F.lit(1).cast("bigint").alias("calendarseq"),
        F.lit(4).cast("bigint").alias("periodtypeseq"),
        F.lit(None).cast("bigint").alias("parentseq"),
        _lit_date(EOT).alias("removedate"),
    )
    return (month_rows.unionByName(removed_rows).unionByName(quarters)
            .unionByName(halves).unionByName(years)
            .select(*[F.col(c).cast("bigint") if c.endswith("seq") else F.col(c)
                      for c in month_rows.columns]))


def _period_types(spark: SparkSession, periods: DataFrame) -> DataFrame:
    names = spark.createDataFrame(PERIOD_TYPE_NAMES, "periodtypeseq bigint, name string")
    present = periods.select("periodtypeseq").distinct()
    live_rows = present.join(F.broadcast(names), "periodtypeseq").select(
        "periodtypeseq", "name", _lit_date(EOT).alias("removedate"))
    # a removed 'month' type row (key 9) next to the live ones
    removed = present.where(F.col("periodtypeseq") == 1).select(
        F.lit(9).cast("bigint").alias("periodtypeseq"), F.lit("month").alias("name"),
        _lit_date(OLD).alias("removedate"))
    return live_rows.unionByName(removed)


def _incentives(orders: DataFrame) -> DataFrame:
    k = F.col("k")
    plan = None
    for prio, pe in PRIORITY_PLAN_ELEMENT:
        plan = (F.when(F.col("prio") == prio, pe) if plan is None
                else plan.when(F.col("prio") == prio, pe))
    total = F.col("total")
    reported = orders.select(
        k.alias("incentiveseq"),
        F.when(k % 17 == 0, F.lit("IO Guarantee")).otherwise(
            F.concat(F.lit("INC-"), k)).alias("name"),
        "positionseq", F.col("cust").alias("payeeseq"), "periodseq",
        F.col("unit").alias("processingunitseq"),
        plan.alias("genericattribute1"),
        F.when(k % 11 == 0, F.lit("0%")).otherwise(
            F.concat((k % 100 + 1).cast("string"), F.lit("%"))).alias("genericattribute2"),
        F.concat(F.lit("QP"), (k % 4).cast("string")).alias("genericattribute3"),
        _pick(k % 4, FX_TEXT_BY_K4).alias("genericattribute4"),
        _pick(k % 3, KIND_BY_K3).alias("genericattribute16"),
        F.when(k % 23 == 0, F.lit(1)).otherwise(total).cast(MONEY).alias("genericnumber1"),
        (total * 2).cast(MONEY).alias("genericnumber2"),
        ((k % 150) / 100).cast(MONEY).alias("genericnumber3"),
        (k % 10).cast(MONEY).alias("genericnumber4"),
        total.alias("genericnumber5"),
        F.when(k % 6 == 0, F.lit(0)).when(k % 6 == 1, F.lit(None))
        .otherwise(k % 1000 + 50000).cast(MONEY).alias("genericnumber6"),
        F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, F.lit(0)).otherwise(F.lit(1))
        .cast("int").alias("genericboolean1"),
        F.when(k % 5 == 0, F.lit(1)).cast("int").alias("genericboolean3"),
        total.alias("value"),
    )
    source = reported.select(
        *[(F.col("incentiveseq") + 5000000000).alias("incentiveseq") if c == "incentiveseq"
          else F.lit("Source").alias(c) if c == "genericattribute1"
          else F.lit(None).cast("string").alias(c) if c == "genericattribute16"
          else F.lit(0).cast("int").alias(c) if c == "genericboolean1"
          else F.lit(None).cast("int").alias(c) if c == "genericboolean3"
          else F.col(c)
          for c in reported.columns])
    return reported.unionByName(source)


def _measurement_keys(orders: DataFrame) -> DataFrame:
    """(k, measurementseq, periodseq, unit, prio): one or two measurements per order."""
    base = orders.select("k", "periodseq", "unit", "prio")
    first = base.withColumn("measurementseq", F.col("k") + 1000000000)
    second = base.where(F.col("k") % 6 == 0).withColumn(
        "measurementseq", F.col("k") + 2000000000)
    return first.unionByName(second)


def _transactions(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    # dealt by the order key once: the sums (with their texts a sort-based aggregate, which would
    # first sort a whole file split) and the join to the orders both take place there; of an order
    # only that is dealt from which its other columns follow
    li = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).repartition("l_orderkey")
    agg = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("units"),
        F.min("l_partkey").alias("partkey"),
        F.min(F.to_date("l_shipdate")).alias("shipdate"),
        F.max(F.col("l_discount").cast("decimal(18,2)")).alias("disc"),
        F.min("l_linestatus").alias("ls"),
        F.min("l_returnflag").alias("rf"),
    )
    o = orders.select("k", "cust", "od")
    return agg.join(o, agg.l_orderkey == o.k).select("*", *_order_keys()).select(
        "k", "cust", "od", "periodseq", "unit", "positionseq",
        F.col("l_linenumber").cast("bigint").alias("ln"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("s"),
        F.col("v").cast(MONEY).alias("value"),
        F.col("units").cast(MONEY).alias("units"),
        "partkey", "shipdate", F.col("disc").cast(MONEY).alias("disc"), "ls", "rf",
    )


def _salestransaction(tx: DataFrame) -> DataFrame:
    s = F.col("s")
    return tx.select(
        s.alias("salestransactionseq"),
        F.col("k").alias("salesorderseq"),
        F.col("unit").alias("processingunitseq"),
        F.when(s % 29 == 0, 1).otherwise(0).cast("bigint").alias("modelseq"),
        (s % 5).alias("eventtypeseq"),
        F.col("ln").alias("sublinenumber"),
        F.col("od").alias("accountingdate"),
        F.date_add("od", (s % 7).cast("int")).alias("compensationdate"),
        "value",
        F.when(s % 4 == 0, F.lit(None)).otherwise(F.col("value") * 2).cast(MONEY)
        .alias("nativecurrencyamount"),
        _pick(s % 3, CURRENCY_BY_3).alias("nativecurrency"),
        F.col("units").alias("numberofunits"),
        F.col("partkey").cast("string").alias("productid"),
        F.concat(F.lit("Part "), F.col("partkey")).alias("productdescription"),
        F.concat(F.lit("Line "), s).alias("comments"),
        F.concat(F.lit("County "), s % 50).alias("genericattribute2"),
        F.concat(F.lit("L8-"), s % 97).alias("genericattribute4"),
        F.col("ln").cast("string").alias("genericattribute6"),
        F.concat(F.lit("L2-"), s % 3).alias("genericattribute8"),
        F.concat(F.lit("L3-"), s % 5).alias("genericattribute9"),
        F.concat(F.lit("L4-"), s % 7).alias("genericattribute10"),
        F.concat(F.lit("L5-"), s % 11).alias("genericattribute11"),
        F.concat(F.lit("L6-"), s % 13).alias("genericattribute12"),
        F.concat(F.lit("PO"), F.col("k")).alias("genericattribute20"),
        F.concat(F.lit("RA"), s % 17).alias("genericattribute21"),
        F.col("shipdate").alias("genericdate2"),
        F.col("od").alias("genericdate3"),
    )


def _credit(tx: DataFrame) -> DataFrame:
    s, k = F.col("s"), F.col("k")
    ctype = None
    for flag, seq in CREDIT_TYPE_BY_FLAG:
        ctype = (F.when(F.col("rf") == flag, seq) if ctype is None
                 else ctype.when(F.col("rf") == flag, seq))
    return tx.select(
        s.alias("creditseq"),
        F.when(F.col("ls") == "O", F.concat(F.lit("CO-"), s))
        .otherwise(F.concat(F.lit("ICO-"), s)).alias("name"),
        ctype.cast("bigint").alias("credittypeseq"),
        s.alias("salestransactionseq"),
        "positionseq", "periodseq",
        F.col("unit").alias("processingunitseq"),
        "value",
        F.col("disc").alias("genericnumber2"),
        F.when(k % 4 == 0, F.lit("1")).when(k % 4 == 1, F.lit("1.05"))
        .when(k % 4 == 2, F.lit("0.92")).cast(MONEY).alias("genericnumber3"),
        (k % 1000).cast(MONEY).alias("genericnumber6"),
    )


def derive(spark: SparkSession, sf_dir: str) -> Sources:
    """Build all 22 input tables from ``sf_dir``'s star schema (lazy DataFrames)."""
    from quotalens.session import bound_tasks, ensure_checkpoint_dir, written
    ensure_checkpoint_dir(spark)
    orders = _orders(spark, sf_dir)
    bound_tasks(spark, orders.count())
    # customers (x nation x region) feed five tables; written once
    cust = written(_customers(spark, sf_dir), "customers")
    # The period calendar is read by every hierarchy level and lookup; it is calendar-sized
    # (months x 2 + quarters + halves + years), so compute it once and cut its lineage with a
    # reliable checkpoint (shared checkpoint folder) instead of re-scanning orders per use.
    periods = _periods(orders).checkpoint(eager=True)
    period_types = _period_types(spark, periods).checkpoint(eager=True)
    # the lineitem aggregate joined to orders feeds transactions, credits, credit traces,
    # commissions and addresses: written once and read back by columns, so report plans stay
    # small instead of repeating the aggregation in every branch, and a checkpoint's whole rows
    # are not on disk. (The smaller tables are not written with zstd: a join takes a file for as small
    # in memory as it is on disk.)
    tx = written(_transactions(spark, sf_dir, orders), "transactions", compression="zstd")
    mkeys = written(_measurement_keys(orders), "measurement-keys")

    def processingunit():
        return spark.createDataFrame([(1, "PU1"), (2, "PU2")],
                                     "processingunitseq bigint, name string")

    def calendar():
        return spark.createDataFrame(CALENDARS, "calendarseq bigint, name string, removedate date")

    def participant():
        key = F.col("cust")
        base = cust.select(
            key.alias("payeeseq"),
            F.col("c_name").alias("lastname"),
            F.concat(F.lit("F"), key).alias("firstname"),
            F.concat(F.lit("u"), key).alias("userid"),
            _pick(F.col("nk") % 3, CURRENCY_BY_3).alias("genericattribute3"),
            F.concat(F.lit("Dept"), F.col("nk") % 5).alias("genericattribute4"),
            F.col("c_mktsegment").alias("genericattribute5"),
            F.col("n_name").alias("genericattribute7"),
            F.when(key % 13 == 0, _lit_date("1998-09-15"))
            .when(key % 13 == 1, _lit_date("1998-10-15")).alias("terminationdate"),
            _lit_date(EOT).alias("removedate"),
            _lit_date(START_OF_TIME).alias("effectivestartdate"),
            _lit_date(EOT).alias("effectiveenddate"),
        )
        split = key % 8 == 0
        plain = base.where(~split)
        first = base.where(split).withColumn("effectiveenddate", _lit_date(VERSION_SPLIT))
        second = base.where(split).withColumn("effectivestartdate", _lit_date(VERSION_SPLIT)) \
            .withColumn("genericattribute7", F.concat(F.col("genericattribute7"), F.lit(" (moved)")))
        removed = base.where(key % 9 == 0).withColumn("removedate", _lit_date(OLD)) \
            .withColumn("lastname", F.concat(F.lit("OLD "), F.col("lastname")))
        return plain.unionByName(first).unionByName(second).unionByName(removed)

    def payee():
        key = F.col("cust")
        return cust.select(
            key.alias("payeeseq"), F.concat(F.lit("P"), key).alias("payeeid"),
            (key % 3 + 1).alias("businessunitmap"), _lit_date(EOT).alias("removedate"),
            _lit_date(START_OF_TIME).alias("effectivestartdate"),
            _lit_date(EOT).alias("effectiveenddate"))

    def businessunit():
        # masks 1, 2, 1: mask 1 twice (fan-out the DISTINCT must absorb), mask 3 missing
        present = cust.select((F.col("cust") % 3).alias("r")).distinct()
        one = present.where(F.col("r") == 0).select(F.lit(1).cast("bigint").alias("businessunitseq"),
                                                     F.lit(1).cast("bigint").alias("mask"))
        two = present.where(F.col("r") == 1).select(F.lit(2).cast("bigint").alias("businessunitseq"),
                                                     F.lit(2).cast("bigint").alias("mask"))
        three = present.where(F.col("r") == 0).select(F.lit(3).cast("bigint").alias("businessunitseq"),
                                                       F.lit(1).cast("bigint").alias("mask"))
        return one.unionByName(two).unionByName(three)

    def position():
        key = F.col("cust")
        return cust.select(
            (key + 1000000).alias("ruleelementownerseq"), key.alias("payeeseq"),
            F.col("r_name").alias("genericattribute5"),
            (_money(F.col("c_acctbal")) * 10).cast(MONEY).alias("targetcompensation"),
            _lit_date(EOT).alias("removedate"),
            _lit_date(START_OF_TIME).alias("effectivestartdate"),
            _lit_date(EOT).alias("effectiveenddate"))

    def incentiveselftrace():
        return orders.select((F.col("k") + 5000000000).alias("sourceincentiveseq"),
                             F.col("k").alias("targetincentiveseq"),
                             F.col("periodseq").alias("sourceperiodseq"))

    def incentivepmtrace():
        return mkeys.select(
            F.when(F.col("prio") == "2-HIGH", F.col("k") + 5000000000).otherwise(F.col("k"))
            .alias("incentiveseq"),
            "measurementseq", F.col("periodseq").alias("targetperiodseq"),
            F.col("unit").alias("processingunitseq"))

    def measurement():
        return mkeys.select("measurementseq", "periodseq",
                            F.col("unit").alias("processingunitseq"))

    def pmcredittrace():
        m = mkeys.select(F.col("k").alias("mk"), "measurementseq")
        return tx.select("k", "s", "periodseq", "unit").join(m, F.col("k") == F.col("mk")).select(
            F.col("s").alias("creditseq"), "measurementseq",
            F.col("periodseq").alias("targetperiodseq"), F.col("unit").alias("processingunitseq"))

    def credittype():
        return spark.createDataFrame(CREDIT_TYPES,
                                     "datatypeseq bigint, credittypeid string, removedate date")

    def commission():
        s = F.col("s")
        rate = ((s % 5) / 1000).cast(MONEY)
        return tx.select(
            (s + 7000000000).alias("commissionseq"), "periodseq",
            F.col("unit").alias("processingunitseq"), "positionseq",
            (F.col("k") + 5000000000).alias("incentiveseq"), s.alias("creditseq"),
            (F.col("value") * rate).cast(MONEY).alias("value"), rate.alias("ratevalue"))

    def eventtype():
        return spark.createDataFrame(
            [(seq, name, EOT) for seq, name in EVENT_TYPES],
            "datatypeseq bigint, eventtypeid string, removedate date")

    def salesorder():
        k = F.col("k")
        return orders.select(
            k.alias("salesorderseq"), F.concat(F.lit("O"), k).alias("orderid"),
            F.when(k % 31 == 0, _lit_date(OLD)).otherwise(_lit_date(EOT)).alias("removedate"))

    def transactionaddress():
        c = cust.select(F.col("cust").alias("ccust"), "c_name", "n_name", "r_name")
        # the lines meet the customers once for both of their addresses
        t = tx.select("s", "cust").join(c, F.col("cust") == F.col("ccust"))
        kinds = F.when(F.col("s") % 10 != 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
        return t.select("*", F.explode(kinds).alias("kind")).select(
            F.col("s").alias("salestransactionseq"), F.col("kind").cast("bigint").alias("addresstypeseq"),
            F.col("n_name").alias("country"), F.col("r_name").alias("state"),
            F.concat(F.lit("P"), F.col("cust")).alias("custid"), F.col("c_name").alias("company"))

    def addresstype():
        return spark.createDataFrame(ADDRESS_TYPES, "addresstypeseq bigint, addresstypeid string")

    def orgdata():
        pairs = orders.select("cust", "periodseq").distinct()
        c = cust.select(F.col("cust").alias("ccust"), "c_name", "nk", "c_mktsegment")
        key = F.col("cust")
        return pairs.join(c, key == F.col("ccust")).select(
            F.lit(1).cast("bigint").alias("processingunitseq"), "periodseq",
            key.alias("payeeseq"), (key + 1000000).alias("positionseq"),
            F.concat(F.lit("P"), key).alias("payeeid"), F.col("c_name").alias("fullname"),
            F.concat(F.lit("M"), F.col("nk")).alias("mfullname_l1"),
            F.concat(F.lit("M"), F.col("nk") % 5).alias("mfullname_l2"),
            F.col("c_mktsegment").alias("division"),
            F.concat((F.col("nk") + 1000).cast("string"), F.lit("-"), F.col("c_mktsegment"))
            .alias("cc_dept"),
            _pick(F.col("nk") % 3, CURRENCY_BY_3).alias("local_currency"))

    factories = {
        "cs_processingunit": processingunit,
        "cs_calendar": calendar,
        "cs_periodtype": lambda: period_types,
        "cs_period": lambda: periods,
        "cs_participant": participant,
        "cs_payee": payee,
        "cs_businessunit": businessunit,
        "cs_position": position,
        "cs_incentive": lambda: _incentives(orders),
        "cs_incentiveselftrace": incentiveselftrace,
        "cs_incentivepmtrace": incentivepmtrace,
        "cs_measurement": measurement,
        "cs_pmcredittrace": pmcredittrace,
        "cs_credit": lambda: _credit(tx),
        "cs_credittype": credittype,
        "cs_commission": commission,
        "cs_salestransaction": lambda: _salestransaction(tx),
        "cs_eventtype": eventtype,
        "cs_salesorder": salesorder,
        "cs_transactionaddress": transactionaddress,
        "cs_addresstype": addresstype,
        "rpt_orgdata": orgdata,
    }
    return Sources(spark, factories=factories)
