"""Interval join: against brute force, and without a nested loop in the plan."""

import datetime as dt
import random

from pyspark.sql import functions as F

from helpers import rows
from quotalens.operators.intervals import in_force_join
from quotalens.operators.params import params
from quotalens.operators.payees import payee_snapshot

VERSION = "k int, effectivestartdate date, effectiveenddate date"


def test_equals_brute_force(spark):
    rnd, day = random.Random(7), dt.date(1997, 12, 1)
    dates = [day + dt.timedelta(days=rnd.randrange(900)) for _ in range(200)]
    versions = [(k, a, rnd.choice([dt.date(2200, 1, 1), a, a + dt.timedelta(days=rnd.randrange(200))]))
                for k, a in enumerate(dates)]
    ends = [dt.date(1998, 1, 31), dt.date(1998, 2, 28), dt.date(1998, 2, 28), dt.date(1999, 7, 1)]
    # on the edges, ended before it began, nulls, a row twice
    versions += [(900, ends[0], ends[1]), (901, ends[1], ends[1]), (902, dt.date(1998, 3, 1), dt.date(1998, 1, 1)),
                 (903, None, ends[1]), (904, ends[0], None), (900, ends[0], ends[1])]
    want = sorted((k, p, e) for k, a, b in versions if a and b for p, e in enumerate(ends) if a < e <= b)
    got = in_force_join(spark.createDataFrame(versions, VERSION),
                        spark.createDataFrame([(*r,) for r in enumerate(ends)] + [(9, None)], "p int, e date"), "e")
    assert sorted(map(tuple, got.select("k", "p", "e").collect())) == want


def test_empty_sides_give_no_rows(spark):
    one = spark.createDataFrame([(1, dt.date(1998, 1, 1), dt.date(2200, 1, 1))], VERSION)
    at = spark.createDataFrame([(dt.date(1998, 1, 31),)], "e date")
    assert in_force_join(one, at.limit(0), "e").count() == 0
    assert in_force_join(one.limit(0), at, "e").count() == 0
    assert in_force_join(one, at, "e", on=F.lit(False)).count() == 0


def test_snapshot_of_many_periods_has_no_nested_loop(src):
    many = payee_snapshot(src, params(src, "PU1", None))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    two = ["September 1998", "October 1998"]
    some = many.where(F.col("periodname").isin(two))
    each = [payee_snapshot(src, params(src, "PU1", [n])) for n in two]
    assert rows(some) == rows(each[0].union(each[1])) and some.count() > 0
