"""Payee snapshot: people, payee ids and positions in force at each target period's end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotalens.functions.exprs import full_name
from quotalens.operators.intervals import in_force_join
from quotalens.operators.versioning import active_at, live

SNAPSHOT_COLUMNS = [
    "processingunitseq", "periodseq", "periodname", "startdate", "enddate",
    "participantfullname", "userid", "participantid", "division", "site", "department",
    "region", "localcurrency", "targetcompensation", "positionseq", "payeeseq",
]


def target_periods(sources, params: DataFrame) -> DataFrame:
    """Live period rows of the targets, restricted to live calendars of the run's name.

    A calendar name matching two live calendars multiplies rows here; the DISTINCT of the
    snapshot removes them, as in the reference.
    """
    cal = live(sources["cs_calendar"])
    pd = live(sources["cs_period"]).select(
        "periodseq", F.col("name").alias("pd_name"), F.col("enddate").alias("pd_enddate"),
        F.col("calendarseq").alias("pd_calendarseq"))
    p = params.select("target_periodseq", "processingunitseq", F.col("startdate").alias("v_start"),
                      F.col("enddate").alias("v_end"), "periodname")
    t = pd.join(F.broadcast(p), pd.periodseq == p.target_periodseq)
    run_cal_names = params.select("calendarseq").join(cal, "calendarseq").select("name")
    cal_ok = cal.join(F.broadcast(run_cal_names), "name").select(
        F.col("calendarseq").alias("ok_calendarseq"))
    return t.join(F.broadcast(cal_ok), t.pd_calendarseq == cal_ok.ok_calendarseq, "left_semi")


def _common_interval(a: DataFrame, b: DataFrame, a_payee: str, b_payee: str) -> DataFrame:
    """Versions of the same payee in both, with the interval in which both are in force."""
    start, end = "effectivestartdate", "effectiveenddate"
    a, b = a.dropna(subset=[start, end]), b.dropna(subset=[start, end])
    b = b.withColumnsRenamed({start: "_start", end: "_end"})
    met = a.join(b, (F.col(a_payee) == F.col(b_payee)) & (F.greatest(start, "_start") < F.least(end, "_end")))
    return met.withColumns({start: F.greatest(start, "_start"), end: F.least(end, "_end")}).drop("_start", "_end")


def payee_snapshot(sources, params: DataFrame, one_payee_per_position: bool = False) -> DataFrame:
    """16 snapshot columns (+ target_periodseq), DISTINCT.

    Versions of a payee's participant, id and position rows meet by payee where their intervals
    overlap; only then they are laid out over the (calendar-sized, broadcast) target periods, so
    neither a shuffle nor a join sees a row per period. The business-unit join only tests existence
    (semi join).
    ``one_payee_per_position`` applies the dense-rank filter the reference keeps commented out.
    """
    t = target_periods(sources, params).select(
        "target_periodseq", "processingunitseq", "periodname", "v_start", "v_end", "pd_enddate")
    tb = F.broadcast(t)

    pt = live(sources["cs_participant"]).select(
        F.col("payeeseq").alias("pt_payeeseq"), "lastname", "firstname", "userid",
        "genericattribute3", "genericattribute4", "genericattribute5", "genericattribute7",
        "terminationdate", "effectivestartdate", "effectiveenddate")

    bu = sources["cs_businessunit"].select(F.col("mask").alias("bu_mask"))
    pe = live(sources["cs_payee"]).join(bu, F.col("businessunitmap") == F.col("bu_mask"),
                                        "left_semi")
    pe = pe.select(F.col("payeeseq").alias("pe_payeeseq"), "payeeid",
                   "effectivestartdate", "effectiveenddate")

    pn = live(sources["cs_position"]).select(
        F.col("payeeseq").alias("pn_payeeseq"), F.col("ruleelementownerseq").alias("positionseq"),
        F.col("genericattribute5").alias("region"), "targetcompensation",
        "effectivestartdate", "effectiveenddate")

    j = _common_interval(_common_interval(pt, pe, "pt_payeeseq", "pe_payeeseq"), pn, "pt_payeeseq", "pn_payeeseq")
    # narrow still: what reads the snapshot by position and payee finds its rows together
    j = j.repartition("positionseq", "pt_payeeseq")
    j = in_force_join(j, tb, "pd_enddate", on=active_at("terminationdate", F.col("v_start")))
    snap = j.select(
        "processingunitseq",
        F.col("target_periodseq").alias("periodseq"),
        "periodname",
        F.col("v_start").alias("startdate"),
        F.col("v_end").alias("enddate"),
        full_name("lastname", "firstname").alias("participantfullname"),
        "userid",
        F.col("payeeid").alias("participantid"),
        F.col("genericattribute5").alias("division"),
        F.col("genericattribute7").alias("site"),
        F.col("genericattribute4").alias("department"),
        "region",
        F.col("genericattribute3").alias("localcurrency"),
        "targetcompensation",
        "positionseq",
        F.col("pt_payeeseq").alias("payeeseq"),
    ).distinct()
    if one_payee_per_position:
        w = Window.partitionBy("positionseq", "periodseq").orderBy("payeeseq")
        snap = snap.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") == 1).drop("_r")
    return snap.withColumn("target_periodseq", F.col("periodseq"))
