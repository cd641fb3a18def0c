
from pyspark.sql import functions as F

from quotalens.operators.params import params
from quotalens.operators.payees import payee_snapshot
from quotalens.operators.periods import run_period


def test_month_name_in_two_calendars_multiplies_run_period(spark, src):
    per = src["cs_period"]
    twin = per.where((F.col("name") == "October 1998") & (F.col("periodtypeseq") == 1)
                     & (F.col("removedate") == F.lit("2200-01-01").cast("date"))) \
        .withColumn("periodseq", F.col("periodseq") + 500000) \
        .withColumn("calendarseq", F.lit(3).cast("bigint"))
    s2 = src.with_table("cs_period", per.unionByName(twin))
    p = params(s2, "PU1", ["October 1998"])          # the run calendar still has one match
    rp = run_period(s2, p)
    # target month found in two calendars -> 2 targets x 2 years = 4 bound rows per month
    assert rp.count() == 4 * 4
    ranks = sorted(r[0] for r in rp.select("period_rank").collect())
    assert ranks == [1] * 4 + [5] * 4 + [9] * 4 + [13] * 4


def test_one_payee_per_position_switch(spark, src):
    p = params(src, "PU1", ["October 1998"])
    snap = payee_snapshot(src, p)
    a, b = [r[0] for r in snap.select("payeeseq").distinct().orderBy("payeeseq").limit(2).collect()]
    pos = src["cs_position"]
    target = pos.where(F.col("payeeseq") == a).select("ruleelementownerseq").first()[0]
    moved = pos.withColumn("ruleelementownerseq",
                           F.when(F.col("payeeseq") == b, F.lit(target))
                           .otherwise(F.col("ruleelementownerseq")))
    s2 = src.with_table("cs_position", moved)
    p2 = params(s2, "PU1", ["October 1998"])
    both = payee_snapshot(s2, p2).where(F.col("positionseq") == target)
    one = payee_snapshot(s2, p2, one_payee_per_position=True).where(F.col("positionseq") == target)
    assert sorted(r[0] for r in both.select("payeeseq").collect()) == [a, b]
    assert [r[0] for r in one.select("payeeseq").collect()] == [a]
