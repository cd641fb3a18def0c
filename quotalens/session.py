"""SparkSession construction with the settings the report jobs rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes, splits skewed
# join partitions and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the report plans are large; keep few finished executions' plan graphs in driver memory
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quotalens", driver_memory: str | None = None) -> SparkSession:
    """Return the active session or build one (local mode for tests/bench)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    ``sc.setCheckpointDir`` wins, then ``spark.checkpoint.dir``. A scratch folder is made only
    in local mode (tests); elsewhere a missing setting is an error, because a folder of one
    machine is invisible to the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # Spark adds a folder of its own below the one that was set
        return current.rstrip("/").rpartition("/")[0]
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="quotalens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once as parquet below the shared folder and read back: readers take only the
    columns they need of it, and its plan is one scan."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The most that one task takes of a file or a merged shuffle; the session may ask for less. Beyond 200
#: shuffle partitions a map task sorts its whole file split in memory, some 25 times the file's bytes.
TASK_SIZES = {"spark.sql.files.maxPartitionBytes": "4m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}
PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ROWS_A_PARTITION = 50_000


def _size_bytes(text: str) -> int:
    """Bytes of a size setting as Spark reads it: digits and a unit of 1024s (none: bytes)."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def bound_tasks(spark: SparkSession, rows: int) -> None:
    """Let the number of shuffle partitions grow with the input's ``rows`` (of its orders), so that a
    task's memory does not; adaptive execution merges those that turn out small.

    Both numbers are raised: the initial one counts only while adaptive execution may merge. Larger
    task sizes of the session are lowered: partitions merged up to them grow with the input until
    their sorts spill.
    """
    for key, value in TASK_SIZES.items():
        usual = spark.conf.get(key, None)
        if usual is None or _size_bytes(usual) > _size_bytes(value):
            spark.conf.set(key, value)
    usual = int(spark.conf.get(PARTITIONS))
    wanted = max(usual, -(-rows // ROWS_A_PARTITION))
    if usual < wanted:
        spark.conf.set(PARTITIONS, wanted)
    if int(spark.conf.get(INITIAL_PARTITIONS, None) or 0) < wanted:
        spark.conf.set(INITIAL_PARTITIONS, wanted)
