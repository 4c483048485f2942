"""Canonical source loaders (parquet directory or JDBC).

``Sources`` is a plain mapping ``table name -> DataFrame``; every plan in the
package takes one, so the same plan runs over parquet exports, a JDBC
database or the test fixtures. Nothing is read until an action runs, and
Catalyst pushes each plan's filters and column pruning into the scans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from costlens.sources.schema import TABLES, resolve_columns

Sources = Mapping[str, DataFrame]


def load_parquet_sources(spark: SparkSession, root: str, tables=None,
                         cast: bool = True, merge_schema: bool = False) -> dict[str, DataFrame]:
    """Read ``{root}/{table}`` parquet datasets and resolve them to canonical form.

    ``merge_schema`` is for exports whose files differ in columns: it opens the
    footer of every file before planning, so it is off by default.
    """
    out = {}
    for name in tables or TABLES:
        df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(f"{root.rstrip('/')}/{name}")
        out[name] = resolve_columns(df, name, cast=cast)
    return out


def load_jdbc_sources(spark: SparkSession, url: str, tables=None,
                      properties: dict | None = None,
                      partitioning: dict | None = None,
                      predicates: dict | None = None,
                      schema: str = "public") -> dict[str, DataFrame]:
    """Read source tables over JDBC (e.g. the PostgreSQL ERP replicas).

    Big tables are read in parallel, one query per Spark partition, either by
    ``partitioning`` (table -> ``{"column", "lowerBound", "upperBound",
    "numPartitions"}``, numeric / date range splits) or by ``predicates``
    (table -> list of WHERE clauses, e.g. one per company or month). Spark
    pushes simple filters and the column list into every query.
    ``properties`` are passed to the driver (user, password, fetchsize, ...).
    """
    props = dict(properties or {})
    partitioning = partitioning or {}
    predicates = predicates or {}
    out = {}
    for name in tables or TABLES:
        table = f'{schema}."{name}"'
        if name in predicates:
            df = spark.read.jdbc(url, table, predicates=list(predicates[name]), properties=props)
        else:
            reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
            for k, v in props.items():
                reader = reader.option(k, v)
            for k, v in partitioning.get(name, {}).items():
                reader = reader.option("partitionColumn" if k == "column" else k, v)
            df = reader.load()
        out[name] = resolve_columns(df, name, cast=True)
    return out
