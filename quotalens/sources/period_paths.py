"""Access paths by period: small derived tables that let one period's report skip the large ones.

Transactions, orders, addresses and source incentives carry no period of the credits that refer to
them, so a report of one month would scan and shuffle all of them. The paths below follow the
credits (or self traces) of a period once, when the catalogue is written or a period is refreshed,
and are partitioned by that period; a report then reads its own partitions only.

* ``path_transaction``: live order x model-0 transaction of every (period, unit) whose credits name it;
* ``path_billto``: the BILLTO address of those transactions, with the number of such addresses
  (more than one is an error only when the transaction is staged);
* ``path_source``: every self trace with the key columns of its source incentive, by the trace's
  source period;
* ``path_hot_measurement``: measurements that many credits of a period feed, for the salted bridge.

A transaction credited in several periods stands in each of them. ``refresh`` rebuilds the
partitions of some periods after their credits changed and leaves the others alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalens.operators.packing import packed, text_columns, unpacked
from quotalens.operators.skew import hot_keys
from quotalens.operators.versioning import live
from quotalens.session import PARTITIONS
from quotalens.sinks import files
from quotalens.sources.tables import PATHS, Sources

BILLTO = "BILLTO"

# Column of the transaction table -> name in plans.
TRANSACTION_COLUMNS = {
    "salestransactionseq": "st_seq", "salesorderseq": "st_order", "processingunitseq": "st_unit",
    "eventtypeseq": "st_event", "sublinenumber": "st_subline", "accountingdate": "st_accdate",
    "compensationdate": "st_compdate", "value": "st_value", "nativecurrencyamount": "st_native",
    "nativecurrency": "st_native_ccy", "numberofunits": "st_units", "productid": "st_productid",
    "productdescription": "st_productdesc", "comments": "st_comments",
    **{f"genericattribute{i}": f"st_ga{i}" for i in (2, 4, 6, 8, 9, 10, 11, 12, 20, 21)},
    "genericdate2": "st_gd2", "genericdate3": "st_gd3",
}
PERIOD_SHARE_ROWS = 1_000_000


def transactions(sources) -> DataFrame:
    """Model-0 transactions under their names in plans."""
    return sources["cs_salestransaction"].where(F.col("modelseq") == 0).select(
        *[F.col(c).alias(a) for c, a in TRANSACTION_COLUMNS.items()])


def orders(sources) -> DataFrame:
    """Live orders: key and id."""
    return live(sources["cs_salesorder"]).select(
        F.col("salesorderseq").alias("so_seq"), F.col("orderid").alias("so_orderid"))


def same(a: Column, b: Column) -> Column:
    """Equality that is no join key: the join's other equalities decide how rows are dealt."""
    return a.between(b, b)


def order_ids(sources) -> DataFrame:
    """(oi_seq, oi_order, so_orderid): the live orders of every transaction key.

    A transaction key and order that several rows name stand once, an order's live rows all.
    """
    st, so = transactions(sources), orders(sources)
    named = st.select(F.col("st_seq").alias("oi_seq"), F.col("st_order").alias("oi_order"))
    # both the distinct and the join find a row by its order
    named = named.repartition("oi_order").distinct()
    return named.join(so, named.oi_order == so.so_seq).drop("so_seq")


def billto_addresses(sources) -> DataFrame:
    """Addresses of type BILLTO (types are few: broadcast)."""
    at = F.broadcast(sources["cs_addresstype"].where(F.col("addresstypeid") == BILLTO).select(
        F.col("addresstypeseq").alias("at_seq")))
    return sources["cs_transactionaddress"].join(at, F.col("addresstypeseq") == F.col("at_seq"))


def one_address(addresses: DataFrame, *keys) -> DataFrame:
    """One row per key: the number of addresses and their columns (exact where the number is 1)."""
    return addresses.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("a_n"), *[F.max(c).alias(f"a_{c}") for c in ("country", "state", "custid", "company")])


MEASUREMENT_KEYS = ["b_meas", "b_tperiod", "b_unit"]


def credit_traces(sources) -> DataFrame:
    """Which credit fed which measurement, under the names of the plans."""
    return sources["cs_pmcredittrace"].select(
        F.col("creditseq").alias("b_credit"), F.col("measurementseq").alias("b_meas"),
        F.col("targetperiodseq").alias("b_tperiod"), F.col("processingunitseq").alias("b_unit"))


def _credited(sources, periods, *columns: str) -> DataFrame:
    """Distinct ``columns`` of the credits, dealt by the first of them."""
    credits = sources["cs_credit"]
    if periods is not None:
        credits = credits.where(F.col("periodseq").isin(list(periods)))
    return credits.select(*columns).repartition(columns[0]).distinct()


def transaction_path(sources, periods: Sequence[int] | None = None) -> DataFrame:
    # everything by the transaction's key: wide rows are dealt once, and the distincts take place there
    keys = _credited(sources, periods, "salestransactionseq", "periodseq", "processingunitseq")
    wide, ids = transactions(sources), order_ids(sources)
    st = packed(wide)
    found = keys.join(st, (F.col("salestransactionseq") == st.st_seq)
                      & same(F.col("processingunitseq"), st.st_unit)).join(
        ids, (F.col("st_seq") == ids.oi_seq) & same(F.col("st_order"), ids.oi_order))
    texts = unpacked(text_columns(wide))
    return found.select("periodseq", *st.columns, "so_orderid").distinct().select(
        "periodseq", *[texts.get(c, F.col(c)) for c in wide.columns], "so_orderid")


def billto_path(sources, periods: Sequence[int] | None = None) -> DataFrame:
    keys = _credited(sources, periods, "salestransactionseq", "periodseq").withColumnRenamed(
        "salestransactionseq", "a_txn")
    bill = billto_addresses(sources)
    return one_address(keys.join(bill, F.col("a_txn") == bill.salestransactionseq), "periodseq", "a_txn")


def source_path(sources, periods: Sequence[int] | None = None) -> DataFrame:
    ist = sources["cs_incentiveselftrace"].select(
        F.col("sourceincentiveseq").alias("ist_source"), F.col("targetincentiveseq").alias("ist_target"),
        F.col("sourceperiodseq").alias("periodseq"))
    if periods is not None:
        ist = ist.where(F.col("periodseq").isin(list(periods)))
    t = sources["cs_incentive"].select(*[F.col(c).alias(f"t_{c}") for c in (
        "incentiveseq", "periodseq", "processingunitseq", "positionseq")])
    return ist.join(t, F.col("ist_source") == F.col("t_incentiveseq")).drop("ist_source")


def hot_measurement_path(sources, periods: Sequence[int] | None = None,
                         rows: int = PERIOD_SHARE_ROWS) -> DataFrame:
    traces = credit_traces(sources)
    if periods is not None:
        traces = traces.where(F.col("b_tperiod").isin(list(periods)))
    return hot_keys(traces, MEASUREMENT_KEYS, rows).withColumnRenamed("b_tperiod", "periodseq")


BUILD: dict[str, Callable] = {
    "path_transaction": transaction_path, "path_billto": billto_path, "path_source": source_path,
    "path_hot_measurement": hot_measurement_path,
}


#: Paths whose whole build leaves its wide rows dealt by transaction, for every period alike, and so many
#: shuffle partitions of which go into one writing task: each such task has a file for every period, and
#: files of a thousand rows cost more time and bytes than their rows.
DEALT = {"path_transaction": 4, "path_billto": 6}


def _to_write(sources: Sources, name: str) -> DataFrame:
    rows = BUILD[name](sources)
    if name not in DEALT:
        return rows.hint("rebalance", "periodseq")
    # no fewer tasks than run at a time
    tasks = max(sources.spark.sparkContext.defaultParallelism, int(sources.spark.conf.get(PARTITIONS)) // DEALT[name])
    return rows.coalesce(tasks)


def write_paths(sources: Sources, root: str) -> Sources:
    """Write all paths under ``root`` and return ``sources`` with them.

    The wide ones are written from the tasks that joined them: dealing them by period as well would
    shuffle every row a second time. A task takes several of their partitions, one after the other.
    """
    for name in PATHS:
        (_to_write(sources, name).write.mode("overwrite").option("compression", "zstd")
         .partitionBy("periodseq").parquet(f"{root.rstrip('/')}/{name}"))
    return with_paths(sources, root)


def refresh(sources: Sources, root: str, periods: Sequence[int]) -> Sources:
    """Rebuild the partitions of ``periods``; those that have become empty are removed.

    Files are replaced in place: frames opened before have to be opened again (``with_paths``).
    """
    root = root.rstrip("/")
    for name in PATHS:
        new = BUILD[name](sources, periods)
        (new.hint("rebalance", "periodseq").write.mode("overwrite").option("compression", "zstd")
         .option("partitionOverwriteMode", "dynamic").partitionBy("periodseq").parquet(f"{root}/{name}"))
        # a rewritten partition holds rows; one of ``periods`` without any still has its old files
        left = {r[0] for r in new.select("periodseq").distinct().collect()}
        for period in set(periods) - left:
            files.remove(sources.spark, f"{root}/{name}/periodseq={period}")
    return with_paths(sources, root)


def with_paths(sources: Sources, root: str) -> Sources:
    """``sources`` with the paths below ``root`` read by their declared columns."""
    out = sources
    for name in PATHS:
        # a path without rows has no file that could tell its columns
        schema = BUILD[name](sources).schema
        out = out.with_table(name, sources.spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}"))
    return out
