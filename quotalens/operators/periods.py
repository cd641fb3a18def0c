"""Fiscal period hierarchy (month -> quarter -> half -> year) and the YTD run-period table.

All inputs here are calendar-sized (a few hundred periods per calendar, independent of fact
volume), so the period sides are broadcast: that size is bounded by the calendar, not by data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotalens.operators.versioning import live

LEVELS = ("month", "quarter", "half", "year")


def period_types(sources) -> DataFrame:
    """One row: month_type, quarter_type, half_type, year_type (live rows only).

    'month' is matched case-sensitively, the other three names case-insensitively.
    """
    pt = live(sources["cs_periodtype"])
    name, lname = F.col("name"), F.lower(F.col("name"))
    return pt.agg(
        F.max(F.when(name == "month", F.col("periodtypeseq"))).alias("month_type"),
        F.max(F.when(lname == "quarter", F.col("periodtypeseq"))).alias("quarter_type"),
        F.max(F.when(lname == "semiannual", F.col("periodtypeseq"))).alias("half_type"),
        F.max(F.when(lname == "year", F.col("periodtypeseq"))).alias("year_type"),
    )


def _level(periods: DataFrame, types: DataFrame, level: str, only_live: bool = True) -> DataFrame:
    p = live(periods) if only_live else periods
    p = p.join(F.broadcast(types.select(F.col(f"{level}_type").alias("periodtypeseq"))),
               "periodtypeseq")
    return p.select(
        F.col("periodseq").alias(f"{level}_periodseq"),
        F.col("name").alias(f"{level}_name"),
        F.col("startdate").alias(f"{level}_startdate"),
        F.col("enddate").alias(f"{level}_enddate"),
        F.col("parentseq").alias(f"{level}_parentseq"),
        F.col("calendarseq").alias(f"{level}_calendarseq"),
    )


def period_hierarchy(sources, month_live: bool = True) -> DataFrame:
    """Each month with its quarter, half and year (three parent self-joins).

    Columns: <level>_periodseq/_name/_startdate/_enddate for the 4 levels, calendarseq.
    """
    periods = sources["cs_period"]
    types = period_types(sources)
    m = _level(periods, types, "month", only_live=month_live)
    q = _level(periods, types, "quarter")
    s = _level(periods, types, "half")
    y = _level(periods, types, "year")
    h = (m.join(F.broadcast(q), m.month_parentseq == q.quarter_periodseq)
         .join(F.broadcast(s), q.quarter_parentseq == s.half_periodseq)
         .join(F.broadcast(y), s.half_parentseq == y.year_periodseq))
    cols = [f"{lvl}_{c}" for lvl in LEVELS for c in ("periodseq", "name", "startdate", "enddate")]
    return h.select(*cols, F.col("month_calendarseq").alias("calendarseq"))


def run_period(sources, params: DataFrame, materialize: bool = True) -> DataFrame:
    """Months of the fiscal year up to each target period, with their hierarchy and rank.

    Per target period: the target month is looked up by name among live months of any
    calendar; its year comes from the hierarchy; the months kept are live months of the run
    calendar starting between the year start and the day before the target's end. Rank is
    by (month periodseq, month start) within the target.
    Columns: 16 hierarchy columns, calendarseq, period_rank, target_periodseq,
    processingunitseq.
    """
    periods = sources["cs_period"]
    types = period_types(sources)
    months = _level(periods, types, "month")
    p = params.select("target_periodseq", "periodname", "processingunitseq",
                      F.col("calendarseq").alias("run_calendarseq"))
    # target_period: the month named like the parameter, in any calendar
    tp = p.join(F.broadcast(months), p.periodname == months.month_name).select(
        "target_periodseq", F.col("month_periodseq").alias("tp_periodseq"),
        F.col("month_enddate").alias("tp_enddate"))
    hier_all = period_hierarchy(sources, month_live=False)
    # year_period: the year above each target month
    yp = tp.join(F.broadcast(hier_all), tp.tp_periodseq == hier_all.month_periodseq).select(
        F.col("target_periodseq").alias("yp_target"),
        F.col("year_startdate").alias("yp_startdate"))
    bounds = tp.join(yp, tp.target_periodseq == yp.yp_target).select(
        "target_periodseq", "tp_enddate", "yp_startdate")
    bounds = bounds.join(p.select("target_periodseq", "run_calendarseq", "processingunitseq"),
                         "target_periodseq")
    hier = period_hierarchy(sources)
    # range join of calendar-sized sides: every month whose start lies in [year start, end-1]
    rp = hier.join(
        F.broadcast(bounds),
        (hier.calendarseq == bounds.run_calendarseq)
        & hier.month_startdate.between(bounds.yp_startdate, F.date_add(bounds.tp_enddate, -1)))
    w = Window.partitionBy("target_periodseq").orderBy("month_periodseq", "month_startdate")
    cols = [f"{lvl}_{c}" for lvl in LEVELS for c in ("periodseq", "name", "startdate", "enddate")]
    out = rp.select(*cols, "calendarseq", F.rank().over(w).cast("bigint").alias("period_rank"),
                    "target_periodseq", "processingunitseq")
    # calendar-sized (<= 12 rows per target): computed once, a leaf in the fact joins
    return out.checkpoint(eager=True) if materialize else out
