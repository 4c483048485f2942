"""Connected components of a link table by alternating star contractions.

Each round is two aggregations (the smallest neighbour of every node, partially
aggregated, so a node with very many links costs one row per task) and two joins
that Spark may split by skew. Links stay in distributed tables; the driver sees
one row of counts per round. The number of rounds grows with the logarithm of
the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.staging import staged


def _contract(links: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v) rows with u > v."""
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        joined = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = joined.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id): the smallest id reachable over the undirected links
    ``a``-``b``. Ids without a link don't appear; null ends and loops are no links;
    repeated links count once; no links give an empty table."""
    edges = links.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = staged(edges, "links")
    state = _state(edges)
    while state[0]:
        edges = staged(_contract(_contract(edges, large=True), large=False), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return ids.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
