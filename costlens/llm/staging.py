"""Intermediate tables: written once to the cluster's shared checkpoint folder.

A written table cuts lineage (a lost executor re-reads it instead of running
everything before it again) and is computed once, unlike an eager checkpoint.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlens.session import scratch_path


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back; ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of a row's place in its file.
_PLACE = 36


def _in_files(df: DataFrame) -> DataFrame | None:
    """``df`` with each row's file and place in it; None where it isn't a plain read of Parquet files."""
    if "_metadata" in df.columns:
        return None
    try:
        out = df.withColumns({"__file": F.col("_metadata.file_path"), "__place": F.col("_metadata.row_index")})
        return out if out.schema else None
    except AnalysisException:
        return None


def numbered(df: DataFrame, name: str = "__row") -> DataFrame:
    """``df`` with a long column that tells its rows apart, the same in every job that reads it.
    Rows read from Parquet files are numbered by their file (files get numbers in a small
    written table, a row a file) and their place in it, so nothing is copied; rows of another
    origin are numbered in a written copy."""
    rows = _in_files(df)
    if rows is None:
        return staged(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    files = df.select(F.col("_metadata.file_path").alias("__file")).distinct()
    files = staged(files.withColumn("__no", F.row_number().over(Window.orderBy("__file")).cast("long") - 1), "files")
    return rows.join(files, "__file").withColumn(name, F.shiftleft("__no", _PLACE) + F.col("__place")).drop("__file", "__no", "__place")


def bounded_rows(df: DataFrame, drawn: DataFrame, most: int, group: str | None = None, groups: tuple = ()) -> DataFrame:
    """The rows of ``df`` whose doc_id is in ``drawn`` (doc_id and further columns, at most as many
    rows as the bound allows), with those columns: at most ``most`` rows, of each of ``groups`` (values of
    ``group``) where they are given, however often an id repeats. Rows are cut in the order of a hash
    of their number, from ids alone; texts are read for the rows that are left."""
    rows = numbered(df)
    ids = rows.select("__row", "doc_id").join(F.broadcast(drawn), "doc_id").drop("doc_id")
    parts = [ids.where(F.col(group) == x) for x in groups] if group else [ids]
    cut = [x.orderBy(F.xxhash64("__row"), "__row").limit(most) for x in parts]
    chosen = cut[0]
    for x in cut[1:]:
        chosen = chosen.unionByName(x)
    chosen = staged(chosen, "drawn-rows")
    return rows.join(F.broadcast(chosen), "__row").drop("__row")
