"""The step log of a report job: what each step wrote, when, and how many numbers didn't parse.

Counts come from ``DataFrame.observe`` on the rows as they are written, so a step is computed once.
The observed plan must end in the write: each of its tasks then counts its rows once, however often
it was tried.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("job string, step string, message string, started timestamp, ended timestamp, rows bigint, "
           "failed_parses bigint")


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class Counted:
    """Rows and failed parses of every group of a frame, gathered while it is written."""

    def __init__(self, df: DataFrame, column: str, groups: Sequence[str], failed: str):
        self.groups, self._seen = tuple(groups), Observation()
        mine = [(F.col(column) == g) for g in self.groups]
        self.df = df.observe(
            self._seen, *[F.count_if(m).alias(f"rows_{k}") for k, m in enumerate(mine)],
            *[F.coalesce(F.sum(F.when(m, F.col(failed))), F.lit(0)).cast("bigint").alias(f"failed_{k}")
              for k, m in enumerate(mine)])

    def results(self) -> dict[str, tuple[int, int]]:
        """group -> (rows, failed parses); groups without rows included."""
        got = self._seen.get
        return {g: (got[f"rows_{k}"], got[f"failed_{k}"]) for k, g in enumerate(self.groups)}


class StepLog:
    """Rows of the log in the order of the steps; times are UTC."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.job, self.entries = spark, job, []

    def add(self, step: str, message: str, started, ended, rows: int | None = None,
            failed: int | None = None) -> None:
        self.entries.append((self.job, step, message, started, ended, rows, failed))

    @contextmanager
    def step(self, step: str, message: str) -> Iterator[None]:
        """Log a step when it ends; a step that fails is logged with its error, which goes on."""
        started = _now()
        try:
            yield
        except Exception as exc:
            self.add(step, f"failed: {message}: {str(exc).splitlines()[0] if str(exc) else type(exc).__name__}",
                     started, _now())
            raise
        self.add(step, message, started, _now())

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.entries, COLUMNS)

    def append(self, path: str) -> None:
        """Add this job's rows to the log table at ``path``."""
        self.frame().coalesce(1).write.mode("append").parquet(path)
