"""Benchmark: headline report queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

1. ``load``: derive the 22 compensation tables from the star schema and write them as parquet
   under the session's checkpoint folder (facts partitioned by period), and the access paths by
   period - the production layout.
2. Time each report over that catalogue; every query is forced with the ``noop`` sink (full
   computation, nothing collected to the driver).

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
PERIOD = "October 1998"


def main() -> None:
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master(f"local[{CPUS}]").appName("quotalens-bench")
               .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
               .config("spark.sql.shuffle.partitions", str(max(8, CPUS * 2)))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quotalens-bench-"))

    from quotalens.operators.params import params
    from quotalens.plans import accrual as acc
    from quotalens.plans import attainment as att
    from quotalens.session import scratch_path
    from quotalens.sources.fixtures import derive
    from quotalens.sources.period_paths import write_paths

    times: dict[str, float] = {}

    t0 = time.time()
    src = derive(spark, SF_DIR).write_parquet(scratch_path(spark, "catalog"))
    src = write_paths(src, scratch_path(spark, "paths"))
    times["load"] = round(time.time() - t0, 3)

    def run(name, build):
        t = time.time()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    one = params(src, "PU1", [PERIOD])
    every = params(src, "PU1", None)
    run("attainment_extract", lambda: att.attainment_extract(src, one))
    run("attainment_out", lambda: att.attainment_out(
        att.attainment_extract(src, one).drop("target_periodseq")))
    run("accrual_report", lambda: acc.accrual_report(
        acc.billto_enrich(src, acc.accrual_staging(src, one), one), "FY26"))
    run("accrual_report_fy25", lambda: acc.accrual_report(
        acc.billto_enrich(src, acc.accrual_staging(src, one, rules="FY25"), one), "FY25"))
    run("attainment_extract_all_periods", lambda: att.attainment_extract(src, every))
    run("accrual_report_all_periods", lambda: acc.accrual_report(
        acc.billto_enrich(src, acc.accrual_staging(src, every), every), "FY26"))

    report_total = round(sum(v for k, v in times.items() if k != "load"), 3)
    print(json.dumps({
        "metric": "report_queries_total", "value": report_total, "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS, "load_sec": times["load"],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
