"""Snapshot sinks over parquet tables: upsert, append, latest row, run log.

Upsert on plain parquet (no MERGE): the new rows are written once to a staging
folder beside the table; the rows of the touched partitions whose key isn't among
them are added to it, and the staged partition folders then take their predecessors'
places in a journaled commit (``sinks.commit``): a crash at any point is finished by the
next write. Only touched partitions are read and replaced, no job reads what it
overwrites, and a lost executor re-runs from written files.

Columns. A table keeps its own column list beside the data. A write unites the declared
columns, the stored ones, those of the new rows and those found in the files that it
replaces, so columns that a later run or another tool has added are never lost; declared
types are fixed, and a row that lacks a column has null there.

Isolation. With ``isolate`` the batch's rows belong to requests (say, a company and a
project); requests that break the table's rules, by a null key or by two rows of one key,
are split off in the very write of the batch and go to a quarantine table with the reason,
and the other requests are written.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from costlens.functions.text import clean_value
from costlens.sinks import commit as J
from costlens.sinks.commit import recover

__all__ = [
    "DUPLICATE_KEY", "DuplicateKeys", "META_COLS", "NULL_KEY", "RunStamp", "append", "append_run_log", "clean_text_columns", "keep_first",
    "latest_rows", "quarantined", "read_table", "recover", "stamp_run", "table_exists", "table_schema", "upsert",
]


@dataclass(frozen=True)
class RunStamp:
    run_id: str
    run_ts: dt.datetime

    @staticmethod
    def new() -> "RunStamp":
        return RunStamp(str(uuid.uuid4()), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


META_COLS = ("snapshot_run_id", "snapshot_run_ts")


def stamp_run(df: DataFrame, stamp: RunStamp) -> DataFrame:
    """Prefix the run id / timestamp (UTC) columns."""
    return df.select(F.lit(stamp.run_id).alias("snapshot_run_id"),
                     F.lit(stamp.run_ts).cast("timestamp").alias("snapshot_run_ts"), *df.columns)


def clean_text_columns(df: DataFrame) -> DataFrame:
    """Sink-side cleaning: text cells stripped, blank text -> NULL."""
    return df.select(*[clean_value(f.name).alias(f.name) if f.dataType.simpleString() == "string"
                       else F.col(f.name) for f in df.schema.fields])


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = J.fs_path(spark, path)
    return fs.exists(jpath) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(jpath))


def _united(*schemas: StructType | None) -> StructType:
    """The fields of all schemas; of fields of one name (whatever the case) the first."""
    out, seen = [], set()
    for schema in schemas:
        for f in schema.fields if schema else []:
            if f.name.lower() not in seen:
                seen.add(f.name.lower())
                out.append(f)
    return StructType(out)


def _stored(spark: SparkSession, path: str) -> StructType | None:
    text = J.stored_columns(spark, path)
    return StructType.fromJson(json.loads(text)) if text else None


def table_schema(spark: SparkSession, path: str, declared: StructType | None = None) -> StructType | None:
    """The declared columns and those that the table has stored beside its data."""
    stored = _stored(spark, path)
    return _united(declared, stored) if declared or stored else None


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a sink table. With ``schema`` the column types, including those of partition
    columns, which would otherwise be inferred from folder names (a company called '0001'
    would become the number 1), are fixed, and columns that the table has stored beside
    follow; without it ``mergeSchema`` finds the columns in the files."""
    if schema is not None:
        return spark.read.schema(table_schema(spark, path, schema)).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def _cols(partition_by) -> list[str]:
    if not partition_by:
        return []
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def _keys_equal(left: DataFrame, right: DataFrame, keys) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return cond


#: Files that the rows of one partition are spread over, at most.
SPREAD = 8
#: Partitions whose files an appending task keeps open.
OPEN_FILES = 4
#: Touched partitions whose values are passed to the scan as literals.
LITERALS = 1000
#: The column, in staging only, that says why a row is refused.
_WHY = "refused_because"
_FINE = "no"
NULL_KEY, DUPLICATE_KEY = "null key", "duplicate key"


class DuplicateKeys(ValueError):
    """A batch holds two rows of one key."""


def _clustered(df: DataFrame, parts: list[str], keys: list[str]) -> DataFrame:
    """Before a partitioned write, bring a partition's rows together in up to
    ``SPREAD`` tasks (by a hash of the first other key): few files a partition, and
    a hot partition value is still written by several tasks."""
    if not parts:
        return df
    extra = [F.pmod(F.xxhash64(k), F.lit(SPREAD)) for k in keys if k not in parts][:1]
    return df.repartition(*[F.col(c) for c in parts], *extra)


def _write(df: DataFrame, path: str, parts: list[str], mode: str) -> None:
    w = df.write.mode(mode)
    (w.partitionBy(*parts) if parts else w).parquet(path)


def _refused(df: DataFrame, keys: list[str], isolate: list[str]) -> DataFrame:
    """``df`` with the reason why a row's request is refused. Both windows cluster on the request
    (a key holds it), so one shuffle by request serves both."""
    df = df.repartition(*isolate)
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    twice = F.count(F.lit(1)).over(Window.partitionBy(*isolate, *[k for k in keys if k not in isolate])) > 1
    df = df.withColumn("__why", F.when(null, 2).when(twice, 1).otherwise(0))
    why = F.max("__why").over(Window.partitionBy(*isolate))
    return df.withColumn(_WHY, F.when(why == 2, NULL_KEY).when(why == 1, DUPLICATE_KEY).otherwise(_FINE)).drop("__why")


def _hashes_twice(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hashes (``__hash``) that two keys share. Keys hardly ever repeat, so a task holds all that it
    reads: eight bytes each, not the texts."""
    return df.groupBy(F.xxhash64(*keys).alias("__hash")).count().where("count > 1").select("__hash")


def _has_twice(df: DataFrame, keys: list[str]) -> bool:
    """Does a key appear twice? The keys themselves are compared where their hashes meet."""
    met = _hashes_twice(df, keys)
    if not met.limit(1).count():
        return False
    rows = df.select(*keys, F.xxhash64(*keys).alias("__hash")).join(met, "__hash", "left_semi")
    return rows.groupBy(*keys).count().where("count > 1").limit(1).count() > 0


def _only_partitions(table: DataFrame, wanted: DataFrame, parts: list[str]) -> DataFrame:
    """``table`` cut to the partitions in ``wanted``: known values become literals, so
    the scan lists only their folders; the semi-join makes it exact."""
    values = wanted.limit(LITERALS + 1).collect()
    if len(values) <= LITERALS:
        for c in parts:
            known = {r[c] for r in values}
            if None not in known:
                table = table.where(F.col(c).isin(list(known)))
    keys = wanted.select(*[F.col(c).alias(f"_k_{c}") for c in parts])
    return table.join(keys, _keys_equal(table, keys, parts), "left_semi")


def _found_columns(spark: SparkSession, path: str, parts: list[str], rels: list[str]) -> StructType | None:
    """Columns of the files that a write replaces (their footers are read by Spark)."""
    there = [f"{path}/{rel}".rstrip("/") for rel in J.existing_folders(spark, path, rels)]
    if not there:
        return None
    found = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*there).schema
    return StructType([f for f in found.fields if f.name not in parts])



def upsert(spark: SparkSession, incoming: DataFrame, path: str, keys: list[str],
           partition_by=None, schema=None, isolate: list[str] | None = None) -> dict:
    """Insert-or-replace ``incoming`` rows by ``keys`` into the parquet table at ``path``.

    ``incoming`` is evaluated once. A key that appears twice in it raises
    ``DuplicateKeys`` before the table is touched, as the reference's database
    would: sum or choose before. With ``isolate`` (columns of the key that name a request)
    only the requests that hold such a key, or a null one, are left out: their rows go to
    the quarantine table (``quarantined``), and ``rejected`` counts them.

    ``partition_by`` is a column or a list of columns; a row whose key lies in another
    partition of the table moves to its new one. ``schema`` fixes the types of the columns
    that it names; all others are kept as they are (module docstring). An interrupted
    earlier write is finished first.
    """
    path = path.rstrip("/")
    recover(spark, path)
    parts, staging = _cols(partition_by), J.staging_for(path)
    obs = Observation("upsert")
    rows = _refused(incoming, keys, isolate) if isolate else incoming.withColumn(_WHY, F.lit(_FINE))
    rows = _clustered(rows, parts, keys).observe(obs, F.count(F.lit(1)).alias("rows"))
    # one write splits good rows from refused ones, and both into partitions
    _write(rows, f"{staging}/batch", [_WHY, *parts], "overwrite")
    batch, rejected = int(obs.get["rows"]), 0
    fine = f"{staging}/batch/{_WHY}={_FINE}"
    if isolate:
        rejected = _to_quarantine(spark, staging, path, incoming.schema)
    inserted = batch - rejected
    if not inserted:
        if not table_exists(spark, path) and not batch:  # an empty table of the right shape
            incoming.limit(0).write.parquet(f"{staging}/new")
            J.commit(spark, staging, path, 0, _united(schema, incoming.schema).json())
        else:
            J.remove(spark, staging)
        return {"inserted": 0, "skipped": rejected, "rejected": rejected}
    J.fs_path(spark, fine)[0].rename(J.fs_path(spark, fine)[1], J.fs_path(spark, f"{staging}/new")[1])
    new_schema = _united(schema, incoming.schema)
    new = spark.read.schema(new_schema).parquet(f"{staging}/new")
    if not isolate and _has_twice(new, keys):
        J.remove(spark, staging)
        raise DuplicateKeys(f"{path}: two rows of one key ({', '.join(keys)}) in a batch")

    columns = _united(new_schema, _stored(spark, path))
    if table_exists(spark, path):
        planned, moved = J.partition_folders(spark, f"{staging}/new", len(parts)), []
        new_keys = new.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        touched = new.select(*parts).distinct() if parts else None
        if not set(parts) <= set(keys):  # keys may have moved from other partitions
            slim = spark.read.schema(columns).parquet(path).select(*dict.fromkeys([*keys, *parts]))
            left = slim.join(new_keys, _keys_equal(slim, new_keys, keys), "left_semi").select(*parts)
            # folders named by Spark's own writer
            touched.union(left).distinct().withColumn("__one", F.lit(1)).write.partitionBy(*parts).parquet(f"{staging}/touched")
            touched = spark.read.schema(StructType([f for f in columns.fields if f.name in parts])).parquet(f"{staging}/touched")
            moved = J.partition_folders(spark, f"{staging}/touched", len(parts))
            planned = list(dict.fromkeys([*planned, *moved]))
        columns = _united(columns, _found_columns(spark, path, parts, planned))
        existing = spark.read.schema(columns).parquet(path)
        if parts:
            existing = _only_partitions(existing, touched, parts)
        kept = existing.join(new_keys, _keys_equal(existing, new_keys, keys), "left_anti")
        _write(_clustered(kept, parts, keys), f"{staging}/new", parts, "append")
        # a partition that only lost rows has no staged successor
        for rel in set(moved) - set(J.partition_folders(spark, f"{staging}/new", len(parts)) if moved else ()):
            J.plan_removal(spark, staging, rel)
        J.commit(spark, staging, path, len(parts), columns.json())
    else:
        J.commit(spark, staging, path, 0, columns.json())
    return {"inserted": inserted, "skipped": rejected, "rejected": rejected}


def quarantine_path(path: str) -> str:
    return f"{path.rstrip('/')}.quarantine"


def _to_quarantine(spark: SparkSession, staging: str, path: str, schema: StructType) -> int:
    """Add the refused rows of a staged batch to the table's quarantine; their number."""
    reasons = [x for x in J.child_folders(spark, f"{staging}/batch") if x != f"{_WHY}={_FINE}"]
    if not reasons:
        return 0
    kinds = StructType([*schema.fields, *StructType().add(_WHY, "string").fields])
    bad = spark.read.schema(kinds).option("basePath", f"{staging}/batch").parquet(*[f"{staging}/batch/{x}" for x in reasons])
    n = bad.count()
    bad.write.mode("append").parquet(quarantine_path(path))
    return n


def quarantined(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame | None:
    """Refused rows of the table at ``path`` with ``refused_because``, of all runs or of one; None if
    there never were any."""
    where = quarantine_path(path)
    if not table_exists(spark, where):
        return None
    rows = spark.read.option("mergeSchema", "true").parquet(where)
    return rows if run_id is None else rows.where(F.col("snapshot_run_id") == run_id)


@contextmanager
def _open_files(spark: SparkSession, n: int):
    """While it holds, a writing task keeps a file of up to ``n`` partitions open and sorts only the
    rows of further ones, instead of first sorting all that it read by partition."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append(incoming: DataFrame, path: str, partition_by=None) -> dict:
    """Append rows (detail photos). Re-running a period appends again, as the
    reference does (its detail tables have no key). Rows of one run have one period, so they
    are written as they come."""
    recover(incoming.sparkSession, path)
    obs = Observation("append")
    w = incoming.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if _cols(partition_by):
        w = w.partitionBy(*_cols(partition_by))
    with _open_files(incoming.sparkSession, OPEN_FILES):
        w.parquet(path)
    return {"inserted": int(obs.get["rows"]), "skipped": 0}


def _chosen(df: DataFrame, keys: list[str], pick, order: list[Column]) -> DataFrame:
    """One row of each key by one aggregation: ``pick`` (max_by or min_by) of the other columns by
    ``order``. It sorts, so rows are first brought together by a hash of the key, in parts that
    adaptive execution bounds: a task that combined rows of its files would sort all of them.
    A key with very many rows is split there, and combined before the next shuffle."""
    columns = df.columns
    rest = [c for c in columns if c not in keys]
    if not rest:
        return df.distinct()
    row = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*order))
    if keys:
        df = df.withColumn("__hash", F.xxhash64(*keys)).hint("rebalance", "__hash")
    out = df.groupBy(*keys).agg(row.alias("__row"))
    return out.select(*[F.col(c) if c in keys else F.col("__row").getField(c).alias(c) for c in columns])


def latest_rows(table: DataFrame, keys: list[str], ts_col: str = "snapshot_run_ts") -> DataFrame:
    """Newest row per key (``DISTINCT ON (keys) ... ORDER BY ts DESC``; a NULL
    timestamp comes first, as in PostgreSQL's DESC; equal timestamps: the
    largest run id, null first). A filter on key columns that the table is partitioned
    by prunes the scan."""
    have = [c for c in (ts_col, "snapshot_run_id") if c in table.columns and c not in keys]
    order = [x for i, c in enumerate(have) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))]
    return _chosen(table, keys, F.max_by, order or [F.lit(1)])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the order of ``order``, nulls last (pandas'
    ``drop_duplicates(keep='first')`` of rows so sorted). Rows equal in ``order`` are told
    apart by the other columns, left to right, nulls last; a null key is a key."""
    by = [c for c in [*order, *[c for c in df.columns if c not in order]] if c not in keys]
    columns = [x for i, c in enumerate(by) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))]
    return _chosen(df, keys, F.min_by, columns or [F.lit(1)])


def append_run_log(spark: SparkSession, path: str, stamp: RunStamp, params: dict) -> None:
    """One row per run: id, start time, parameters as JSON (by name; null ones are kept)."""
    values = [F.lit(v if isinstance(v, (bool, int, float, str, type(None))) else str(v)).alias(k) for k, v in sorted(params.items())]
    text = F.to_json(F.struct(*values), {"ignoreNullFields": "false"}) if values else F.lit("{}")
    row = spark.range(1).select(F.lit(stamp.run_id).alias("snapshot_run_id"), F.lit(stamp.run_ts).cast("timestamp").alias("started_at"),
                                text.alias("params_json"))
    row.coalesce(1).write.mode("append").parquet(path)
