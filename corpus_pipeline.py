"""Corpus pipeline over ``documents``: each stage applies one operator to all that
its predecessor kept, and its decisions take effect.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is written
as Parquet to the cluster's shared checkpoint folder and read again as the next
stage's docs. All stages but the last return exactly the columns they were given.

Decisions are taken and applied row by row, whatever the doc_ids: rows of a null or
repeated doc_id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.llm import mixing
from costlens.llm.decontaminate import without_items
from costlens.llm.hilbert import document_dims, hilbert_shards
from costlens.llm.near_dedup import near_rows
from costlens.llm.staging import numbered, staged, table
from costlens.llm.toxicity import without_toxic

#: Similarity, in percent, at which the pipeline counts documents as near copies.
NEAR_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id; a
    null id is the smallest, and of rows that share it any one."""
    rows = numbered(docs)
    near = near_rows(rows.select(F.col("__row").alias("row"), "text"), percent=NEAR_PERCENT)
    copies = staged(near.where("row <> component").select(F.col("row").alias("__row"), F.col("component").alias("__group")), "copies")
    members = copies.unionByName(copies.select(F.col("__group").alias("__row"), "__group").distinct())
    members = members.join(rows.select("__row", F.col("doc_id").cast("long").alias("doc_id")), "__row")
    stays = members.groupBy("__group").agg(F.min(F.struct("doc_id", "__row")).alias("__first")).select(F.col("__first.__row").alias("__row"))
    lost = members.join(stays, "__row", "left_anti").select("__row")
    return rows.join(lost, "__row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target weight asks, in training order."""
    return mixing.training_order(docs, copy="__copy", position="__position").select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards along a Hilbert curve over language, source and length."""
    return hilbert_shards(docs, document_dims())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: The toxicity stage is a trained classifier: SQL can't express the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
