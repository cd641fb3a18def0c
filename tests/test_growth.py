"""What one task gets and what is shuffled grow no faster than the input."""

from __future__ import annotations

import datetime as dt

import pytest

from quotalens import session
from quotalens.operators import payees
from quotalens.operators.params import params
from quotalens.plans import attainment as att
from quotalens.sources import period_paths as paths


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_partitions_grow_where_adaptive_execution_does_not_merge(spark):
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    old = {k: spark.conf.get(k, None) for k in (merge, session.PARTITIONS, session.INITIAL_PARTITIONS)}
    try:
        spark.conf.set(merge, "false")
        spark.conf.set(session.PARTITIONS, "4")
        session.bound_tasks(spark, 30 * session.ROWS_A_PARTITION)
        assert spark.range(100).repartition("id").rdd.getNumPartitions() == 30
        session.bound_tasks(spark, 1)  # a small input after a large one lowers nothing
        assert spark.conf.get(session.PARTITIONS) == "30"
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", paths.DEALT)
def test_wide_paths_are_not_dealt_again_by_period(src, name):
    assert "Rebalance" not in optimized(paths._to_write(src, name))
    assert "Rebalance" in optimized(paths._to_write(src, "path_source"))


@pytest.mark.parametrize("name", paths.DEALT)
def test_a_writing_task_takes_several_partitions(spark, src, name):
    # each task has a file for every period: their number must not follow that of the shuffle's partitions
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    old = {k: spark.conf.get(k, None) for k in (merge, session.PARTITIONS)}
    try:
        spark.conf.set(merge, "false")
        spark.conf.set(session.PARTITIONS, "40")
        assert paths._to_write(src, name).rdd.getNumPartitions() <= 10
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_snapshot_is_laid_out_after_its_joins(src):
    text = optimized(payees.payee_snapshot(src, params(src, "PU1", None)))
    assert text.count("Generate explode") == 1
    assert text.index("Generate explode") < text.index("RepartitionByExpression")


def test_extract_is_shuffled_before_targets_multiply_it(src):
    p = params(src, "PU1", None)
    text = att.attainment_extract(src, p)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(target_periodseq#" not in text.replace("hashpartitioning(target_periodseq#", "X", 1)
    assert "hashpartitioning(positionseq#" in text


def test_common_interval_of_versions(spark):
    d = dt.date
    a = spark.createDataFrame(
        [(1, "a", d(2000, 1, 1), d(2000, 6, 1)), (1, "b", d(2000, 6, 1), d(2001, 1, 1)),
         (2, "c", None, d(2001, 1, 1)), (None, "d", d(2000, 1, 1), d(2001, 1, 1))],
        "p int, x string, effectivestartdate date, effectiveenddate date")
    b = spark.createDataFrame(
        [(1, "u", d(2000, 3, 1), d(2000, 9, 1)), (1, "v", d(2000, 9, 1), None), (2, "w", d(2000, 1, 1), d(2001, 1, 1)),
         (None, "z", d(2000, 1, 1), d(2001, 1, 1))],
        "q int, y string, effectivestartdate date, effectiveenddate date")
    got = payees._common_interval(a, b, "p", "q").select("x", "y", "effectivestartdate", "effectiveenddate")
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", "u", d(2000, 3, 1), d(2000, 6, 1)), ("b", "u", d(2000, 6, 1), d(2000, 9, 1))]


def test_task_sizes_of_the_session_are_lowered_never_raised(spark):
    keys = list(session.TASK_SIZES)
    old = {k: spark.conf.get(k, None) for k in [*keys, session.PARTITIONS, session.INITIAL_PARTITIONS]}
    try:
        for given, kept in [("256m", None), ("268435456", None), ("1GB", None), ("16k", "16k"), ("4096", "4096")]:
            for k in keys:
                spark.conf.set(k, given)
            session.bound_tasks(spark, 1)
            assert [spark.conf.get(k) for k in keys] == [kept or session.TASK_SIZES[k] for k in keys]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_map_task_reads_no_more_where_the_file_is_larger(spark, tmp_path):
    keys = [*session.TASK_SIZES, session.PARTITIONS, session.INITIAL_PARTITIONS, "spark.sql.files.minPartitionNum"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        spark.range(2_000_000, numPartitions=1).write.parquet(str(tmp_path / "rows"))
        size = sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet"))
        session.bound_tasks(spark, 1)
        assert size > 7 << 20
        assert spark.read.parquet(str(tmp_path / "rows")).rdd.getNumPartitions() == -(-size // (4 << 20))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
