"""Current-version and effective-dated filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalens.schemas import EOT


def eot() -> Column:
    """The end-of-time date as a typed literal (pushes down to the parquet scan)."""
    return F.lit(EOT)


def is_live(removedate: str | Column = "removedate") -> Column:
    c = F.col(removedate) if isinstance(removedate, str) else removedate
    return c == eot()


def live(df: DataFrame, removedate: str = "removedate") -> DataFrame:
    """Rows not soft-deleted: ``removedate = 2200-01-01``."""
    return df.where(is_live(removedate))


def in_force_at(period_end: Column, start: str | Column = "effectivestartdate",
                end: str | Column = "effectiveenddate") -> Column:
    """Version in force at a period end: ``start < period_end AND end >= period_end``."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (s < period_end) & (e >= period_end)


def active_at(termination: str | Column, period_start: Column) -> Column:
    """Terminated on/after the period start, or never terminated."""
    t = F.col(termination) if isinstance(termination, str) else termination
    return (t >= period_start) | t.isNull()
