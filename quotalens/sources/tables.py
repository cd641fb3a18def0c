"""Sources: the named input tables of the reports as DataFrames.

A report job never reads paths directly; it asks a ``Sources`` for ``cs_incentive``,
``rpt_orgdata`` and so on. Production jobs build one from a parquet catalogue (one folder per
table, facts partitioned by ``periodseq`` so a period list prunes files); tests build one from
the driver's star schema (``quotalens.sources.fixtures``).
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from quotalens.schemas import INPUT_COLUMNS, input_schema

# The 22 inputs the reports read.
TABLES = tuple(INPUT_COLUMNS)

# Fact tables worth partitioning by period on disk (the period list then prunes partitions).
PERIOD_PARTITIONED = {
    "cs_incentive": "periodseq",
    "cs_credit": "periodseq",
    "cs_measurement": "periodseq",
    "cs_pmcredittrace": "targetperiodseq",
    "cs_incentivepmtrace": "targetperiodseq",
    "cs_commission": "periodseq",
    "rpt_orgdata": "periodseq",
    "cs_incentiveselftrace": "sourceperiodseq",
}

# Derived access paths by period (quotalens.sources.period_paths); a catalogue may lack them.
PATHS = ("path_transaction", "path_billto", "path_source", "path_hot_measurement")


class Sources(Mapping):
    """Name -> DataFrame mapping with lazy construction."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame] | None = None,
                 factories: Mapping | None = None):
        self.spark = spark
        self._frames: dict[str, DataFrame] = dict(frames or {})
        self._factories = dict(factories or {})

    def __getitem__(self, name: str) -> DataFrame:
        name = name.lower()
        if name not in self._frames:
            if name not in self._factories:
                raise KeyError(name)
            self._frames[name] = self._factories[name]()
        return self._frames[name]

    def __iter__(self):
        return iter(sorted(set(self._frames) | set(self._factories)))

    def __contains__(self, name) -> bool:
        return name in self._frames or name in self._factories

    def __len__(self) -> int:
        return len(set(self._frames) | set(self._factories))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as exc:
            raise AttributeError(name) from exc

    def memo(self, key, build):
        """Reuse a derived DataFrame (immutable) across the steps of one report build."""
        cache = self.__dict__.setdefault("_memo", {})
        if key not in cache:
            cache[key] = build()
        return cache[key]

    def with_table(self, name: str, df: DataFrame) -> "Sources":
        frames = dict(self._frames)
        frames[name.lower()] = df
        return Sources(self.spark, frames, self._factories)

    # -- parquet catalogue -------------------------------------------------------------
    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str,
                     names: Iterable[str] = TABLES) -> "Sources":
        """Read each table from ``root/<name>`` (a parquet folder, maybe partitioned).

        Columns and types are declared, partition columns too, so no file is opened to infer
        them and a column of another type fails when it is read; further columns of the files
        are not read.
        """
        factories = {n: (lambda n=n: spark.read.schema(input_schema(n)).parquet(os.path.join(root, n)))
                     for n in names}
        return cls(spark, factories=factories)

    def write_parquet(self, root: str, names: Iterable[str] = TABLES,
                      mode: str = "overwrite") -> "Sources":
        """Materialise every table under ``root``; facts partitioned by their period column.

        Returns a ``Sources`` that reads the written copy, which cuts the derivation lineage.
        """
        for name in names:
            df = self[name]
            writer = df.write.mode(mode)
            part = PERIOD_PARTITIONED.get(name)
            if part:
                # REBALANCE: AQE clusters rows by period (few files per period) but splits a
                # hot period over several tasks and coalesces small ones, so neither skew
                # nor a small-files explosion follows from the partitioned layout.
                writer = df.hint("rebalance", part).write.mode(mode).partitionBy(part)
            writer.parquet(os.path.join(root, name))
        return Sources.from_parquet(self.spark, root, names)
