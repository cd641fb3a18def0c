"""quotalens: sales-compensation reports (YTD attainment, commission accrual) as Spark jobs.

Sub-packages:
  sources    tables as DataFrames (parquet catalogue, fixture derivation from a star schema)
  functions  pure Column expressions (decorated numbers, FX factors, labels, text formats)
  operators  reusable relational steps (current-version / effective-dated filters, parameter
             lookups, fiscal period hierarchy, payee snapshot, unique lookups)
  plans      the report pipelines (attainment, accrual FY25/FY26), single- or many-period
  sinks      header + CSV report writer, file names, step log, full-refresh writes
  streaming  (the reports are batch; see module docstring)
"""

from quotalens.session import get_session  # noqa: F401
