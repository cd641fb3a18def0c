"""YTD attainment report: incentive facts, the 23-column extract, and its text output.

The reference stages four copies of one join (Monthly / YTD / Guarantee / earned-%) and
unions them before a GROUP BY. Here the extract is one pass:

1. one scan of ``cs_incentive`` (filters pushed to parquet) joined to the run-period table
   (calendar-sized, broadcast);
2. each incentive row carries a weight ``w`` = number of staged copies it would have
   (flag-1 copy + flag-3 copy), and every branch measure becomes a conditional aggregate;
3. *eager aggregation*: measures are pre-aggregated per (month, position, payee), then meet the
   targets that read the month and the payee snapshot, so both joins see one row per
   position-month (a hot position cannot skew it) and facts are shuffled once, after a
   map-side partial aggregate;
4. the final GROUP BY on the 10 report keys combines the pre-aggregates.

Measures that depend on the payee row (TI with its target-compensation fallback) are kept
as partial aggregates that are exact to combine after the join: max over non-zero TI, a
zero flag, and max/min of the FX factor for rows whose TI falls back (max(TC * fx) is
TC * max(fx) for TC >= 0 and TC * min(fx) otherwise).

``extract_literal`` builds the reference's four-branch union as is; tests check both agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalens.functions.exprs import (
    bad_number, exact_product,
    fiscal_month_order, flag_set, fx_factor, money_text, percent_text, ti_loc, ti_usd)
from quotalens.operators.payees import payee_snapshot
from quotalens.operators.periods import run_period
from quotalens.sinks.report import ATTAINMENT_PREFIX, header_rows, log_files, write_reports
from quotalens.sinks.steplog import StepLog
from quotalens.sources.period_paths import same
from quotalens.schemas import EXTRACT_COLUMNS, EXTRACT_NOT_NULL, FLOAT_DEC, MONEY, MONEY_2

# Incentive kinds (genericattribute16) that the attainment report reads.
MONTHLY = "Monthly Target Attainment"
YTD = "YTD Target Attainment"
GUARANTEE = "Guarantee"
KINDS = [YTD, MONTHLY, GUARANTEE]

FACT_COLUMNS = [
    "positionseq", "payeeseq", "periodseq", "genericattribute1", "genericattribute3",
    "genericattribute4", "genericattribute16", "value", "genericnumber1", "genericnumber2",
    "genericnumber3", "genericnumber4", "genericnumber5", "genericnumber6",
    "month_name", "quarter_name", "period_rank",
]

KEY_COLUMNS = ["Month", "Qtr", "ID", "Plan Participant", "DIVISION", "SITE", "DEPARTMENT",
               "REGION", "Currency"]


def _run_months(rp: DataFrame) -> DataFrame:
    """The targets' months, bounded by the calendar (<= 12 per target)."""
    return rp.select("month_periodseq", "month_name", "quarter_name", "period_rank",
                     "target_periodseq", F.col("processingunitseq").alias("rp_unit"))


def _incentives(sources, rp: DataFrame) -> DataFrame:
    """Incentives of the run's months, each once however many targets read it."""
    inc = sources["cs_incentive"].select(
        "positionseq", "payeeseq", "periodseq", "processingunitseq", "genericattribute1",
        "genericattribute3", "genericattribute4", "genericattribute16", "value",
        "genericnumber1", "genericnumber2", "genericnumber3", "genericnumber4",
        "genericnumber5", "genericnumber6", "genericboolean1", "genericboolean3")
    # the months' keys as literals: the incentive scan reads their partitions only
    months = sorted(x[0] for x in rp.select("month_periodseq").distinct().collect())
    return inc.where(F.col("periodseq").isin(months))


def _of_targets(inc: DataFrame, rp: DataFrame) -> DataFrame:
    """Rows of a period and unit with every target whose YTD months have it (broadcast)."""
    r = _run_months(rp)
    return inc.join(F.broadcast(r), (inc.periodseq == r.month_periodseq)
                    & (inc.processingunitseq == r.rp_unit))


def _incentives_in_run(sources, params: DataFrame, rp: DataFrame | None = None) -> DataFrame:
    """Incentives of the run's unit in the YTD months of each target."""
    rp = run_period(sources, params) if rp is None else rp
    return _of_targets(_incentives(sources, rp), rp)


def _arm1(inc: DataFrame) -> Column:
    return flag_set("genericboolean1") & F.col("genericattribute16").isin(*KINDS)


def _arm2(inc: DataFrame) -> Column:
    return flag_set("genericboolean3")


def incentive_facts(sources, params: DataFrame, rp: DataFrame | None = None) -> DataFrame:
    """The staged UNION ALL: flag-1 rows of the three kinds, plus flag-3 rows (any kind)
    with genericboolean3 in place of genericnumber1. A row with both flags appears twice."""
    inc = _incentives_in_run(sources, params, rp)
    cols = [c for c in FACT_COLUMNS if c != "genericnumber1"]
    a1 = inc.where(_arm1(inc)).select(*cols, F.col("genericnumber1"), "target_periodseq")
    a2 = inc.where(_arm2(inc)).select(
        *cols, F.col("genericboolean3").cast(MONEY).alias("genericnumber1"), "target_periodseq")
    return a1.unionByName(a2).select(*FACT_COLUMNS, "target_periodseq")


def _pre_aggregate(inc: DataFrame) -> DataFrame:
    """Measures by (period, unit, position, payee); the targets' months are attached to the sums."""
    # Per-row inputs are projected once (FX parse, weight, kind flags) so the aggregate
    # references plain columns: smaller plans and task binaries than inlining the
    # five-replace FX parse into every conditional aggregate.
    m1, m2 = _arm1(inc), _arm2(inc)
    kind = F.col("genericattribute16")
    rows = inc.where(m1 | m2).select(
        "periodseq", "processingunitseq", "positionseq", "payeeseq",
        "genericattribute1", "genericattribute3", "genericnumber1", "genericnumber2",
        "genericnumber3", "genericnumber5", "genericnumber6", "value",
        m1.alias("m1"), m2.alias("m2"), (m1.cast("int") + m2.cast("int")).alias("w"),
        (kind == MONTHLY).alias("monthly"), (kind == YTD).alias("ytd"),
        (kind == GUARANTEE).alias("guar"),
        fx_factor("genericattribute4").alias("fx"),
        "genericattribute4", bad_number("genericattribute4").alias("fx_bad"),
        F.col("genericnumber6").cast(MONEY_2).alias("gn6_2"))
    c = F.col
    w, fx, gn6, gn6_2, value = c("w"), c("fx"), c("genericnumber6"), c("gn6_2"), c("value")
    monthly, ytd, guar, m1, m2 = c("monthly"), c("ytd"), c("guar"), c("m1"), c("m2")
    ti_rows = monthly | guar

    def twice(x: Column) -> Column:
        """A row with both flags counts twice: added, because a product would cut the scale."""
        return F.when(w == 2, x + x).otherwise(x)

    quota_row = F.greatest(F.when(monthly & m1, c("genericnumber1")),
                           F.when(monthly & m2, F.lit(1).cast(MONEY)))
    return rows.groupBy("periodseq", "processingunitseq", "positionseq", "payeeseq").agg(
        F.max(F.when(monthly, c("genericattribute1"))).alias("pe"),
        F.max(F.when(monthly, c("genericattribute3"))).alias("qp"),
        F.max(quota_row).alias("quota"),
        F.max(F.when(ti_rows & (gn6 != 0), gn6)).alias("ti_nz"),
        F.max(F.when(ti_rows & (gn6 == 0), F.lit(1))).alias("ti_zero"),
        F.max(F.when(ti_rows & (gn6_2 != 0), (gn6_2 * fx).cast(MONEY_2))).alias("usd_nz"),
        F.max(F.when(ti_rows & (gn6_2 == 0), fx)).alias("fx_zmax"),
        F.min(F.when(ti_rows & (gn6_2 == 0), fx)).alias("fx_zmin"),
        F.sum(F.when(monthly, c("genericnumber2") * w)).alias("att_usd"),
        F.sum(F.when(monthly, c("genericnumber3") * w)).alias("att_pct"),
        F.max(F.when((m1 & (c("genericnumber1") == 1)) | m2, c("genericnumber3")))
        .alias("earned"),
        F.sum(F.when(ytd, value * w)).alias("ytd_loc"),
        F.sum(F.when(ytd, twice(exact_product(value, fx).cast(MONEY)))).alias("ytd_usd"),
        F.sum(F.when(monthly, c("genericnumber5") * w)).alias("cm_rev"),
        F.sum(F.when(monthly, value * w)).alias("cm_loc"),
        F.sum(F.when(monthly, twice(exact_product(value, fx).cast("decimal(27,10)")))).alias("cm_usd"),
        F.sum(F.when(guar, value * w)).alias("guar_pay"),
        F.max(F.when((monthly | ytd | guar) & c("fx_bad"), c("genericattribute4"))).alias("bad_rate"),
    )


def _payee_keys(payees: DataFrame) -> DataFrame:
    return payees.select(
        F.col("target_periodseq").alias("p_target"), F.col("positionseq").alias("p_position"),
        F.col("payeeseq").alias("p_payee"),
        F.col("participantid").alias("ID"),
        F.col("participantfullname").alias("Plan Participant"),
        F.col("division").alias("DIVISION"), F.col("site").alias("SITE"),
        F.col("department").alias("DEPARTMENT"), F.col("region").alias("REGION"),
        F.col("localcurrency").alias("Currency"), F.col("targetcompensation").alias("tc"))


def _finish(df: DataFrame) -> DataFrame:
    """Cast to the declared extract types; the three NOT NULL columns raise on NULL."""
    out = []
    for name, typ in EXTRACT_COLUMNS:
        c = F.col(name).cast(typ)
        if name in EXTRACT_NOT_NULL:
            c = F.when(c.isNotNull(), c).otherwise(
                F.raise_error(F.lit(f"NULL in NOT NULL column {name}")))
        out.append(c.alias(name))
    return df.select("target_periodseq", *out)


def attainment_extract(sources, params: DataFrame, payees: DataFrame | None = None,
                       rp: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """target_periodseq + the 23 extract columns, one row per month x participant x attributes.

    An exchange rate that is no number gives factor 0 (``attainment_log`` counts them); ``strict``
    raises on one instead, as the reference stops, but only for incentives that reach the report:
    the text passes the pre-aggregate and is looked at after the join to the payees.
    """
    if payees is None:
        payees = payee_snapshot(sources, params)
    rp = run_period(sources, params) if rp is None else rp
    # a month's sums serve every target that reads it, so targets multiply sums and not incentives;
    # both sides are dealt by position and payee before their rows are multiplied by the targets
    pre = _of_targets(_pre_aggregate(_incentives(sources, rp)).repartition("positionseq", "payeeseq"), rp)
    pk = _payee_keys(payees)
    j = pre.join(pk, same(pre.target_periodseq, pk.p_target) & (pre.positionseq == pk.p_position)
                 & (pre.payeeseq == pk.p_payee))
    tc = F.col("tc")
    ti_loc_row = F.greatest(F.col("ti_nz"), F.when(F.col("ti_zero") == 1, tc))
    if strict:
        stop = F.raise_error(F.concat(F.lit("not a number in an exchange rate: "), F.col("bad_rate")))
        # on two measures that every row of the output carries
        j = j.withColumns({m: F.when(F.col("bad_rate").isNotNull(), stop.cast(j.schema[m].dataType))
                           .otherwise(F.col(m)) for m in ("ytd_usd", "cm_usd")})
    usd_zero = F.when(tc >= 0, tc * F.col("fx_zmax")).otherwise(tc * F.col("fx_zmin")) \
        .cast(MONEY_2)
    ti_usd_row = F.greatest(F.col("usd_nz"), usd_zero)
    # dealt by some of the keys, so the text output's DISTINCT finds equal rows together
    agg = j.repartition("target_periodseq", "Plan Participant", "SITE").groupBy(
        "target_periodseq", F.col("month_name").alias("Month"), F.col("quarter_name").alias("Qtr"),
        "ID", "Plan Participant", "DIVISION", "SITE", "DEPARTMENT", "REGION", "Currency",
        fiscal_month_order("month_name").alias("month_order"),
    ).agg(
        F.max("pe").alias("Plan Elements"),
        F.max("qp").alias("Quota Plan"),
        F.max("quota").alias("Quota"),
        F.max(ti_loc_row).alias("TI LOC (Annualized)"),
        F.max(ti_usd_row).alias("TI USD (Annualized)"),
        F.sum("att_usd").alias("YTD Attainment$ (USD)"),
        F.sum("att_pct").alias("YTD Attainment%"),
        F.max("earned").alias("YTD Comm Earned%"),
        F.sum("ytd_loc").alias("YTD Commission Earned (LOC)"),
        F.sum("ytd_usd").alias("YTD Commission Earned (USD)"),
        F.sum("cm_rev").alias("Current Month Revenue Attainment"),
        F.sum("cm_loc").alias("Current Month Commission Earned (LOC)"),
        F.sum("cm_usd").alias("Current Month Commission Earned (USD)"),
        F.sum("guar_pay").alias("Guarantee Payout Amount"),
    )
    return _finish(agg.drop("month_order"))


# ---------------------------------------------------------------------------------------
# The literal four-branch form (kept to prove the fused plan equal, and for inspection)
# ---------------------------------------------------------------------------------------

def attainment_branches(facts: DataFrame, payees: DataFrame) -> DataFrame:
    """UNION ALL of the four branch selects over facts x payee snapshot (before GROUP BY)."""
    pk = _payee_keys(payees)
    j = facts.join(pk, (facts.target_periodseq == pk.p_target)
                   & (facts.positionseq == pk.p_position) & (facts.payeeseq == pk.p_payee))
    kind = F.col("genericattribute16")
    fxv = fx_factor("genericattribute4")
    usd = exact_product("value", fxv)
    null_s, null_m, null_f = (F.lit(None).cast("string"), F.lit(None).cast(MONEY),
                              F.lit(None).cast(FLOAT_DEC))

    def branch(cond, **m):
        cols = {
            "Plan Elements": null_s, "Quota Plan": null_s, "Quota": null_m,
            "TI LOC (Annualized)": null_m, "TI USD (Annualized)": F.lit(None).cast(MONEY_2),
            "YTD Attainment$ (USD)": null_m, "YTD Attainment%": null_f,
            "YTD Comm Earned%": null_f, "YTD Commission Earned (LOC)": null_m,
            "YTD Commission Earned (USD)": null_m, "Current Month Revenue Attainment": null_m,
            "Current Month Commission Earned (LOC)": null_m,
            "Current Month Commission Earned (USD)": null_f, "Guarantee Payout Amount": null_m,
        }
        cols.update(m)
        return j.where(cond).select(
            "target_periodseq", F.col("month_name").alias("Month"),
            F.col("quarter_name").alias("Qtr"), *KEY_COLUMNS[2:],
            *[v.cast(dict(EXTRACT_COLUMNS)[k]).alias(k) for k, v in cols.items()],
            fiscal_month_order("month_name").alias("month_order"))

    tc = F.col("tc")
    monthly = branch(
        kind == MONTHLY,
        **{"Plan Elements": F.col("genericattribute1"), "Quota Plan": F.col("genericattribute3"),
           "Quota": F.col("genericnumber1"),
           "TI LOC (Annualized)": ti_loc("genericnumber6", tc),
           "TI USD (Annualized)": ti_usd("genericnumber6", tc, "genericattribute4"),
           "YTD Attainment$ (USD)": F.col("genericnumber2"),
           "YTD Attainment%": F.col("genericnumber3"),
           "Current Month Revenue Attainment": F.col("genericnumber5"),
           "Current Month Commission Earned (LOC)": F.col("value"),
           "Current Month Commission Earned (USD)": usd})
    ytd = branch(kind == YTD, **{"YTD Commission Earned (LOC)": F.col("value"),
                                 "YTD Commission Earned (USD)": usd})
    guar = branch(kind == GUARANTEE,
                  **{"TI LOC (Annualized)": ti_loc("genericnumber6", tc),
                     "TI USD (Annualized)": ti_usd("genericnumber6", tc, "genericattribute4"),
                     "Guarantee Payout Amount": F.col("value")})
    earned = branch(F.col("genericnumber1") == 1,
                    **{"YTD Comm Earned%": F.col("genericnumber3")})
    return reduce(DataFrame.unionByName, [monthly, ytd, guar, earned])


def extract_literal(branches: DataFrame) -> DataFrame:
    """GROUP BY the 10 keys over the branch union (the reference's statement as written)."""
    max_cols = {"Plan Elements", "Quota Plan", "Quota", "TI LOC (Annualized)",
                "TI USD (Annualized)", "YTD Comm Earned%"}
    measures = [c for c, _ in EXTRACT_COLUMNS[9:]]
    agg = branches.groupBy("target_periodseq", *KEY_COLUMNS, "month_order").agg(
        *[(F.max(c) if c in max_cols else F.sum(c)).alias(c) for c in measures])
    return _finish(agg.drop("month_order"))


# ---------------------------------------------------------------------------------------
# Text output
# ---------------------------------------------------------------------------------------

DOLLAR_COLUMNS = {"Quota", "YTD Attainment$ (USD)", "YTD Commission Earned (USD)",
                  "Current Month Commission Earned (USD)"}
PERCENT_COLUMNS = {"YTD Attainment%", "YTD Comm Earned%"}


def attainment_details(extract: DataFrame) -> DataFrame:
    """The extract as text: money as decimal(20,4) ('$' on four), percents x100 with '%'.

    ``target_periodseq`` stays in front if the extract has it.
    """
    cols = [F.col("target_periodseq")] if "target_periodseq" in extract.columns else []
    for k, (name, _) in enumerate(EXTRACT_COLUMNS):
        c = F.col(name)
        if name in PERCENT_COLUMNS:
            c = percent_text(c)
        elif name in DOLLAR_COLUMNS:
            c = money_text(c, dollar=True)
        elif k >= 11:
            c = money_text(c)
        cols.append(c.cast("string").alias(name))
    return extract.select(*cols)


def attainment_out(extract: DataFrame, header: bool = True, params: DataFrame | None = None) -> DataFrame:
    """Header row UNION (distinct) text detail rows: 23 text columns.

    Equal detail rows collapse, as the reference's ``UNION`` does. An extract that keeps
    ``target_periodseq`` gives one report per target (rows of different targets never
    collapse); its headers are one per row of ``params``.
    """
    details = attainment_details(extract)
    if not header:
        return details.distinct()
    by_target = "target_periodseq" in details.columns
    if by_target and params is None:
        raise ValueError("headers of several targets need their params")
    keys = params.select("target_periodseq").distinct() if by_target else None
    head = header_rows(extract.sparkSession, [c for c, _ in EXTRACT_COLUMNS], keys)
    # no detail row equals a header: its amounts are numbers
    return head.distinct().unionByName(details.distinct())


def attainment_order() -> list[Column]:
    """Sort keys of the text report: participant, then fiscal month (nulls first)."""
    return [F.col("ID").asc_nulls_first(), fiscal_month_order("Month").asc_nulls_first()]


def attainment_log(sources, params: DataFrame) -> DataFrame:
    """Per target: staged incentive rows and those whose exchange rate is no number (USD 0)."""
    facts = incentive_facts(sources, params)
    counted = facts.groupBy("target_periodseq").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad_number("genericattribute4")).alias("failed_parses"))
    return params.select("target_periodseq").join(counted, "target_periodseq", "left").fillna(0)


def attainment_report(sources, params: DataFrame, folder: str, run_date,
                      root: str | None = None, strict: bool = False) -> DataFrame:
    """The procedure as one job: every target's report, ordered, in a folder of its file name.

    Returns the step log: the report step, a row per file name, and the targets' staged rows with
    their bad exchange rates. With ``root`` it is appended to ``root/step_log`` too.
    ``strict``: see ``attainment_extract``.
    """
    log = StepLog(sources.spark, "attainment")
    try:
        with log.step("report", "report files written"):
            details = attainment_out(attainment_extract(sources, params, strict=strict), header=False)
            write_reports(details, folder, attainment_order(), params, ATTAINMENT_PREFIX, run_date)
        log_files(log, params, ATTAINMENT_PREFIX, run_date)
        _, _, _, started, ended, *_ = log.entries[0]
        for r in attainment_log(sources, params).orderBy("target_periodseq").collect():  # one per target
            log.add("facts", f"incentives staged for period {r.target_periodseq}", started, ended,
                    r["rows"], r.failed_parses)
    finally:
        if root:
            log.append(f"{root.rstrip('/')}/step_log")
    return log.frame()
