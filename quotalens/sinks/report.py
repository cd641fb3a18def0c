"""Report sinks: file names, header + CSV writing, full-refresh writes."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotalens.sinks import files

# The file-name prefixes of the two reports.
ATTAINMENT_PREFIX = "YTD_ATTAINMENT_DETAIL_"
ACCRUAL_PREFIX = "ACCRUAL_DETAIL_"

# Values as they are: blanks at their ends stay, a quote inside a quoted value is doubled.
_CSV = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
# What a missing value is read as before it becomes null: no text, so that "" stays empty.
_NO_TEXT = "\0"


def report_filename(prefix: str, periodname, run_date) -> Column:
    """``PREFIX_<period name with '_' for ' '>_<yyyyMMdd>.csv`` as a Column.

    ``run_date`` is a Column or a date; pass a fixed date for reproducible output (the
    reference uses CURRENT_DATE).
    """
    pn = F.col(periodname) if isinstance(periodname, str) else periodname
    rd = run_date if isinstance(run_date, Column) else F.lit(run_date).cast("date")
    return F.concat(F.lit(prefix), F.replace(pn, F.lit(" "), F.lit("_")), F.lit("_"),
                    F.date_format(rd, "yyyyMMdd"), F.lit(".csv"))


def header_rows(spark: SparkSession, titles: list[str], keys: DataFrame | None = None) -> DataFrame:
    """One header row of ``titles`` (text), or one per row of ``keys`` (e.g. per target period)."""
    head = spark.createDataFrame([tuple(titles)], ", ".join(f"`{t}` string" for t in titles))
    if keys is None:
        return head
    # the header side is exactly one row: attaching it is a bounded broadcast
    return keys.crossJoin(F.broadcast(head))


def write_report(details: DataFrame, path: str, order_by: list[Column] | None = None,
                 partition_by: str | None = None) -> str:
    """Write text rows as CSV with a header line (Spark writes a folder of part files).

    With ``partition_by`` (e.g. target_periodseq) one job writes every period's rows into its
    own sub-folder. Rows are range-partitioned and sorted by (folder, keys): that is the order
    the partitioned writer asks for, so it adds no sort of its own, and part files in name
    order hold the rows in order.
    """
    df = details
    keys = ([F.col(partition_by)] if partition_by else []) + list(order_by or [])
    if keys:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = df.write.mode("overwrite").options(header=True, **_CSV)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)
    return path


def write_reports(details: DataFrame, folder: str, order_by: list[Column], params: DataFrame,
                  prefix: str, run_date) -> str:
    """Write the report of every target period under ``folder/report_file=<file name>``.

    ``details`` carries ``target_periodseq``. The titles are one row per report that sorts
    first, so a report has its header once however many part files it has. Rows that ``order_by``
    leaves equal follow by all their columns, so the same rows always give the same file.
    """
    names = params.select(F.col("target_periodseq").alias("_target"), report_filename(
        prefix, "periodname", run_date).alias("report_file"))
    titles = [c for c in details.columns if c != "target_periodseq"]
    # one row per target period: bounded by the calendar
    rows = details.join(F.broadcast(names), details["target_periodseq"] == names["_target"])
    head = header_rows(details.sparkSession, titles, names.select("report_file"))
    both = head.withColumn("_line", F.lit(0)).unionByName(
        rows.select("report_file", *titles).withColumn("_line", F.lit(1)))
    keys = [F.col("report_file"), F.col("_line"), *order_by, *[F.col(t).asc_nulls_first() for t in titles]]
    (both.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_line")
     .write.mode("overwrite").partitionBy("report_file").options(header=False, **_CSV).csv(folder))
    return folder


def read_reports(spark: SparkSession, folder: str, titles: list[str]) -> DataFrame:
    """The reports under ``folder`` line by line: report_file, line (from 1: the header), the values.

    A line's number is its place in its piece of a part file plus the lines of the pieces before
    it. Row ids run on within a piece, so a piece's first id gives the place without a sort; only
    one row per piece is windowed, never the lines.
    """
    schema = ", ".join(f"`{t}` string" for t in titles) + ", report_file string"
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
    lines = (spark.read.schema(schema).options(header=False, multiLine=True, nullValue=_NO_TEXT, **_CSV).csv(folder)
             .select("*", part.alias("_part"), F.col("_metadata.file_name").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_id")))
    piece = ["report_file", "_part", "_file", "_block"]
    pieces = lines.groupBy(*piece).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy("report_file").orderBy("_part", "_file", "_block")
               .rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    line = (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("bigint")
    return lines.join(pieces, piece).select("report_file", line.alias("line"), *[F.col(f"`{t}`") for t in titles])


def log_files(log, params: DataFrame, prefix: str, run_date) -> None:
    """A log row per target with its report's file name (one per target period: calendar-sized)."""
    _, _, _, started, ended, *_ = log.entries[-1]
    for row in params.select(report_filename(prefix, "periodname", run_date).alias("name")).distinct() \
            .orderBy("name").collect():
        log.add("file", row.name, started, ended)


def _commits(spark: SparkSession, base: str) -> list[str]:
    return [n for n in files.names(spark, f"{base}/_commits") if n.isdigit()]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current content of a refreshed table, found by its name.

    The commit with the highest number names the version folder; a commit file is there whole or
    not at all, so a reader beside a refresh gets the old content or the new one.
    """
    base = f"{root.rstrip('/')}/{name}"
    commits = _commits(spark, base)
    if not commits:
        raise FileNotFoundError(f"{base}/_commits")
    version = files.read_text(spark, f"{base}/_commits/{commits[-1]}")
    return spark.read.parquet(f"{base}/{version}")


def full_refresh(df: DataFrame, root: str, name: str, keep: int = 2) -> DataFrame:
    """Truncate-and-insert: write ``df`` as the new content of table ``name`` under ``root``.

    Spark cannot overwrite a path it is reading in the same job, so each refresh writes a new
    version folder and then publishes it by a commit file that gets its number by a rename; of two
    refreshes at a time one takes the next number. The newest ``keep`` versions stay for readers
    that began before the refresh (at least 1); older commits and their folders are removed, and
    with them folders of refreshes that failed before these. The returned DataFrame reads the new
    version, which cuts the lineage.
    """
    spark = df.sparkSession
    base = f"{root.rstrip('/')}/{name}"
    version = f"v{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(f"{base}/{version}")
    while True:
        commits = _commits(spark, base)
        number = int(commits[-1]) + 1 if commits else 0
        if files.create_text(spark, f"{base}/_commits/{number:012d}", version):
            break
    _forget_old(spark, base, max(1, keep))
    return spark.read.parquet(f"{base}/{version}")


def _forget_old(spark: SparkSession, base: str, keep: int) -> None:
    """Remove all but the newest ``keep`` versions; commits go first, so no commit lacks its folder."""
    commits = _commits(spark, base)
    kept = {files.read_text(spark, f"{base}/_commits/{c}") for c in commits[-keep:]}
    for c in commits[:-keep]:
        files.remove(spark, f"{base}/_commits/{c}")
    for folder in files.names(spark, base):
        # a folder later than the oldest kept version may be a refresh still running
        if folder.startswith("v") and folder not in kept and folder < min(kept):
            files.remove(spark, f"{base}/{folder}")
