"""costlens — month-end construction-project costing on Spark.

The package turns ERP ledgers, planning/budget lines, purchase and unposted
invoices and production-tracking sheets into a per-chapter cost summary for
any number of (company, project) requests in one Spark job.

Layout:
  sources/    canonical loaders (parquet / JDBC), column resolution, fixtures
  functions/  column-expression helpers (text, chapters, money, dates)
  operators/  dataset queries and chapter aggregates
  plans/      composite plans: the summary (`resumen`), gap fill, run stamp
  sinks/      upsert / append / latest-row writers over parquet tables
"""

from costlens.plans.period import Period

__all__ = ["Period"]
