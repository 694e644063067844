"""rxlens: prescription-monitoring mandatory-use analytics on Spark DataFrames.

Layout:
  sources/    extract readers (CSV with raw headers), extract builders over
              base tables, the fixture derivation over the driver tables
  functions/  string/date column helpers and the Jaro-Winkler scorer
  operators/  preparation, search match, interval joins, overlaps, naive
              counts, per-prescriber metrics
  plans/      report assembly and sinks, the registered queries, the SQL oracle
"""

from rxlens.config import Eligibility, ReportConfig, report_file_name, report_period  # noqa: F401
