"""Point-in-interval join of versions and period ends, as an equi-join on month bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalens.operators.versioning import in_force_at


def _bin(day) -> Column:
    """Number of the calendar month a date lies in."""
    return F.year(day) * 12 + F.month(day)


def in_force_join(versions: DataFrame, periods: DataFrame, at: str, start: str = "effectivestartdate",
                  end: str = "effectiveenddate", on: Column | None = None) -> DataFrame:
    """Every version with every period whose date ``at`` it is in force at (start < at <= end).

    A version is laid out over the months it covers, cut to the months that hold a date of
    ``periods``, and meets the periods by month; the dates themselves (and ``on``) decide. The
    layout has one row per month of the run that the version covers, so where every month has
    a period it is as large as the result, and a version outside the run gives no row at all. A
    nested loop would test every version against every period instead.

    ``periods`` is calendar-sized and broadcast. Its first and last month are a scalar
    subquery of the plan. Null dates are never in force; equal rows of either side multiply.
    """
    month = _bin(at)
    ends = periods.agg(F.struct(F.min(month).alias("low"), F.max(month).alias("high")).alias("e")).scalar()
    low, high = ends["low"], ends["high"]
    first, last = F.greatest(_bin(start), low), F.least(_bin(end), high)
    # without periods both bounds are null and nothing is laid out
    laid = versions.withColumn("_month", F.explode(F.when(
        low.isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull() & (first <= last),
        F.sequence(first, last))))
    met = F.broadcast(periods.withColumn("_at_month", _bin(at)))
    hit = (F.col("_month") == F.col("_at_month")) & in_force_at(F.col(at), start, end)
    return laid.join(met, hit if on is None else hit & on).drop("_month", "_at_month")
