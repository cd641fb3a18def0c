"""Run parameters: processing unit, calendar and target periods resolved to keys.

The reference resolves one period per call with ``SELECT ... INTO`` (exactly one row or an
error). Here the parameters are a small DataFrame with one row per target period, so one job
can produce many periods. Lookups are validated lazily inside the plan: a missing or ambiguous
name raises when the job runs, with no extra driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotalens.operators.versioning import live

DEFAULT_CALENDAR = "Main Fiscal Calendar"


def _exactly_one(matches: DataFrame, key: str, what: str, requested: DataFrame) -> DataFrame:
    """Left-join the requested names to their matches; raise unless exactly one matches each."""
    counted = matches.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    joined = requested.join(counted, key, "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    check = F.when(n == 1, F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit(f"{what} lookup must return one row, got "), n.cast("string"),
        F.lit(" for "), F.col(key).cast("string"))))
    return joined.where(check).drop("_n")


def period_keys(sources, params: DataFrame) -> list[int]:
    """Keys of the target periods: calendar-sized, so they can stand in plans as literals.

    A literal list prunes period-partitioned facts at planning time. The entry keeps the frame
    alive, so its id can't come to name another one.
    """
    return sources.memo(("period-keys", id(params)), lambda: (params, sorted(
        r[0] for r in params.select("target_periodseq").distinct().collect())))[1]


def params(sources, processing_unit: str, periods: Sequence[str] | None,
           calendar: str = DEFAULT_CALENDAR, materialize: bool = True) -> DataFrame:
    """One row per target period (checkpointed: lookups are validated here).

    Columns: processingunitseq, processingunitname, target_periodseq, periodname, startdate,
    enddate, calendarseq. ``periods=None`` takes every live month of the calendar.
    """
    spark = sources.spark
    pu_req = spark.createDataFrame([(processing_unit,)], "name string")
    pu = _exactly_one(sources["cs_processingunit"].select("processingunitseq", "name"),
                      "name", "processing unit", pu_req)
    cal_req = spark.createDataFrame([(calendar,)], "name string")
    cal = _exactly_one(live(sources["cs_calendar"]).select("calendarseq", "name"),
                       "name", "calendar", cal_req).select("calendarseq")

    per = live(sources["cs_period"]).select(
        F.col("periodseq").alias("target_periodseq"), F.col("name").alias("periodname"),
        "startdate", "enddate", "calendarseq", "periodtypeseq")
    # calendar is a one-row relation: broadcasting it is bounded
    per = per.join(F.broadcast(cal), "calendarseq")
    if periods is None:
        month_types = live(sources["cs_periodtype"]).where(F.col("name") == "month") \
            .select(F.col("periodtypeseq"))
        chosen = per.join(F.broadcast(month_types), "periodtypeseq")
    else:
        req = spark.createDataFrame([(p,) for p in periods], "periodname string")
        chosen = _exactly_one(per, "periodname", "period", req)
    # the unit lookup is validated to exactly one row: attaching it is a bounded broadcast
    out = chosen.crossJoin(F.broadcast(pu.select(
        "processingunitseq", F.col("name").alias("processingunitname")))).select(
        "processingunitseq", "processingunitname", "target_periodseq", "periodname",
        "startdate", "enddate", "calendarseq")
    if materialize:
        # One row per target period. Every report step joins it (often through dynamic
        # partition pruning subqueries); a reliable checkpoint resolves and validates the
        # lookups once - the SELECT ... INTO moment - and turns it into a leaf of each plan.
        out = out.checkpoint(eager=True)
    return out
