"""Sinks: file names, CSV with header per target period, versioned full refresh."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quotalens.schemas import INPUT_COLUMNS, input_type
from quotalens.sinks import files
from quotalens.sinks.report import (ACCRUAL_PREFIX, ATTAINMENT_PREFIX, full_refresh, read_table,
                                    report_filename, write_report)
from quotalens.sources.tables import Sources


def test_report_filename(spark):
    df = spark.createDataFrame([("October 1998",)], "p string")
    got = df.select(report_filename(ATTAINMENT_PREFIX, "p", dt.date(2026, 1, 31))).first()[0]
    assert got == "YTD_ATTAINMENT_DETAIL_October_1998_20260131.csv"
    got = df.select(report_filename(ACCRUAL_PREFIX, "p", dt.date(2026, 1, 31))).first()[0]
    assert got == "ACCRUAL_DETAIL_October_1998_20260131.csv"


def test_write_report_partitioned_with_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", "x"), (1, "a", None), (2, "c", "y")],
                               "target_periodseq bigint, Name string, `Plan Element` string")
    path = str(tmp_path / "out")
    write_report(df, path, order_by=[F.col("Name").asc_nulls_first()],
                 partition_by="target_periodseq")
    parts = sorted(os.listdir(path))
    assert "target_periodseq=1" in parts and "target_periodseq=2" in parts
    back = spark.read.option("header", True).csv(os.path.join(path, "target_periodseq=1"))
    assert back.columns == ["Name", "Plan Element"] and back.count() == 2


def test_full_refresh_replaces_content(spark, tmp_path):
    root = str(tmp_path / "tables")
    a = full_refresh(spark.range(3), root, "t")
    b = full_refresh(spark.range(5, 7), root, "t")
    assert sorted(r[0] for r in b.collect()) == [5, 6]
    assert a.count() == 3  # the earlier version stays readable where it was


def test_readers_beside_a_refresh_see_the_old_content(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "tables"), []
    full_refresh(spark.range(3), root, "t")
    commit = files.create_text

    def read_first(*args):
        seen.append(read_table(spark, root, "t").count())
        return commit(*args)

    monkeypatch.setattr(files, "create_text", read_first)
    full_refresh(spark.range(10), root, "t")
    assert seen == [3] and read_table(spark, root, "t").count() == 10


def test_old_versions_are_removed_and_failed_ones_too(spark, tmp_path):
    root = str(tmp_path / "tables")
    full_refresh(spark.range(1), root, "t")
    os.makedirs(f"{root}/t/v20000101000000000000-dead/part")  # a refresh that never ended
    b = full_refresh(spark.range(2), root, "t")
    c = full_refresh(spark.range(3), root, "t")
    folders = [n for n in os.listdir(f"{root}/t") if n.startswith("v")]
    assert len(folders) == 2 and b.count() == 2 and c.count() == 3
    full_refresh(spark.range(4), root, "t", keep=1)
    assert len([n for n in os.listdir(f"{root}/t") if n.startswith("v")]) == 1
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "missing")


def test_of_two_refreshes_at_a_time_none_is_lost(spark, tmp_path, monkeypatch):
    root, commit = str(tmp_path / "tables"), files.create_text
    full_refresh(spark.range(1), root, "t")

    def other_first(s, path, text):
        monkeypatch.setattr(files, "create_text", commit)
        full_refresh(spark.range(2), root, "t", keep=9)
        return commit(s, path, text)

    monkeypatch.setattr(files, "create_text", other_first)
    full_refresh(spark.range(3), root, "t", keep=9)
    assert read_table(spark, root, "t").count() == 3
    assert len(files.names(spark, f"{root}/t/_commits")) == 3
    assert not [n for n in files.names(spark, f"{root}/t/_commits") if n.startswith("_draft")]


def test_declared_schemas(spark, src, tmp_path):
    root = str(tmp_path / "cat")
    cat = src.write_parquet(root, names=["cs_eventtype", "cs_measurement"])
    assert dict(cat["cs_measurement"].dtypes) == dict.fromkeys(cat["cs_measurement"].columns, "bigint")
    assert cat["cs_measurement"].count() == src["cs_measurement"].count()
    for name, names in INPUT_COLUMNS.items():
        assert dict(src[name].dtypes) == {c: input_type(c) for c in names.split()}, name
    src["cs_eventtype"].withColumn("datatypeseq", F.lit("x")).write.mode("overwrite").parquet(f"{root}/cs_eventtype")
    with pytest.raises(Exception, match="(?i)datatypeseq|cannot be converted|mismatch"):
        Sources.from_parquet(spark, root)["cs_eventtype"].collect()
