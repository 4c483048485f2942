from costlens.sources.schema import TABLES, CANONICAL, resolve_columns, MissingColumnError
from costlens.sources.loaders import Sources, load_parquet_sources, load_jdbc_sources
from costlens.sources.fixtures import load_fixture_sources

__all__ = [
    "TABLES", "CANONICAL", "resolve_columns", "MissingColumnError",
    "Sources", "load_parquet_sources", "load_jdbc_sources", "load_fixture_sources",
]
