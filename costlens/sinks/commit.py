"""Journaled replacement of table folders.

A write prepares its folders beside the table, in ``<table>.staging-<id>/new``. The
journal ``<table>.commit.json`` is the commit point: it is created whole, by a rename, and
names the staging folder, whose contents are the plan. Each folder of the plan then takes
its predecessor's place; the predecessor goes to ``<staging>/old``. When all have moved,
the staging folder and then the journal go.

Whatever step a crash interrupts, ``recover`` finishes it: without a journal nothing of
the table was touched; with one, what is still in ``new`` hasn't moved yet. Every move can
be repeated. Writers recover a table before they write; one process writes a table at a
time, and a second one finds the journal and stops.

A folder that only has to go is planned as an empty folder with the file ``_removed``.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Moves at a time.
MOVERS = 16
_REMOVED = "_removed"
_COLUMNS = "_columns.json"


class CommitInProgress(RuntimeError):
    """Another write of the table has begun and not ended."""


def fs_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its form."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = fs_path(spark, path)
    return fs.exists(jpath)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that this package made."""
    fs, jpath = fs_path(spark, path)
    fs.delete(jpath, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, jpath = fs_path(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file whole (a reader sees all of it or none); with ``replace`` false, false
    if the file is there already."""
    fs, target = fs_path(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    draft = hadoop(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if replace:
        fs.delete(target, False)
    elif fs.exists(target):
        fs.delete(draft, False)
        return False
    if fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = fs_path(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(jpath) if x.isDirectory()] if fs.exists(jpath) else []
    return [x for x in names if not x.startswith((".", "_")) or "=" in x]


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Paths of the partition folders under ``path``, relative to it."""
    level = [""]
    for _ in range(depth):
        level = [f"{rel}/{x}".lstrip("/") for rel in level for x in child_folders(spark, f"{path}/{rel}".rstrip("/"))]
    return level


def existing_folders(spark: SparkSession, path: str, rels: list[str]) -> list[str]:
    """Those of the folders ``rels`` that are under ``path``."""
    with ThreadPoolExecutor(MOVERS) as pool:
        there = list(pool.map(lambda rel: exists(spark, f"{path}/{rel}".rstrip("/")), rels))
    return [rel for rel, yes in zip(rels, there) if yes]


def staging_for(path: str) -> str:
    """A fresh staging folder for the table, beside it on the same file system."""
    return f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"


def _journal(path: str) -> str:
    return f"{path.rstrip('/')}.commit.json"


def pending(spark: SparkSession, path: str) -> dict | None:
    """The journal of a write that has begun to replace folders and not ended."""
    text = read_text(spark, _journal(path))
    return json.loads(text) if text else None


def plan_removal(spark: SparkSession, staging: str, rel: str) -> None:
    write_text(spark, f"{staging}/new/{rel}/{_REMOVED}", "")


def replace_folder(spark: SparkSession, staging: str, path: str, rel: str) -> None:
    """Put the planned folder ``rel`` in its place; repeatable at any point."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs, new = fs_path(spark, f"{staging}/new/{rel}".rstrip("/"))
    target, old = hadoop(f"{path.rstrip('/')}/{rel}".rstrip("/")), hadoop(f"{staging}/old/{rel}".rstrip("/"))
    if not fs.exists(new):  # moved before
        return
    if fs.exists(target) and not fs.exists(old):
        fs.mkdirs(old.getParent())
        if not fs.rename(target, old):
            raise OSError(f"can't set {target} aside")
    if fs.exists(hadoop(new, _REMOVED)):
        fs.delete(new, True)
        return
    fs.mkdirs(target.getParent())
    if not fs.rename(new, target):
        raise OSError(f"can't move {new} to {target}")


def _finish(spark: SparkSession, path: str, journal: dict, move=replace_folder) -> None:
    staging, depth = journal["staging"], journal["depth"]
    if depth == 0:
        move(spark, staging, path, "")
    else:
        planned = partition_folders(spark, f"{staging}/new", depth)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda rel: move(spark, staging, path, rel), planned))
    if journal["columns"]:
        write_text(spark, f"{path.rstrip('/')}/{_COLUMNS}", journal["columns"])
    remove(spark, staging)
    remove(spark, _journal(path))


def commit(spark: SparkSession, staging: str, path: str, depth: int, columns: str | None = None, move=replace_folder) -> None:
    """Replace the folders of ``path``, ``depth`` partition levels down (0: the whole table),
    by those under ``staging``/new; ``columns`` becomes the table's stored column list."""
    journal = {"staging": staging, "depth": depth, "columns": columns}
    if not write_text(spark, _journal(path), json.dumps(journal), replace=False):
        raise CommitInProgress(path)
    _finish(spark, path, journal, move)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an interrupted write of the table; was there one?"""
    journal = pending(spark, path)
    if journal is None:
        return False
    _finish(spark, path, journal)
    return True


def stored_columns(spark: SparkSession, path: str) -> str | None:
    """The table's own column list (a schema as JSON), kept beside its data."""
    return read_text(spark, f"{path.rstrip('/')}/{_COLUMNS}")
