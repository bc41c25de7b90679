"""Property graphs as two tables: nodes (id, type, ...) and edges (type, source, target, ...)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_edges(parts: dict[str, DataFrame]) -> DataFrame:
    """One edge table from a (source, target, ...) table per type, duplicates dropped."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("type", F.lit(t)) for t, df in parts.items())).distinct()


def without_dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose source is a node; targets may lie outside."""
    return edges.join(nodes.select(F.col("id").alias("source")).distinct(), "source", "left_semi")


def adjacency(edges: DataFrame, types: list[str], reverse: bool = False) -> DataFrame:
    """id, neighbours: sorted distinct neighbours along (or against) edges of the types."""
    a, b = ("target", "source") if reverse else ("source", "target")
    return edges.where(F.col("type").isin(types)).groupBy(F.col(a).alias("id")).agg(F.array_sort(F.collect_set(b)).alias("neighbours"))


def one_hop(facts: DataFrame, edges: DataFrame, types: list[str]) -> DataFrame:
    """id, fact: a node's own facts and those of the nodes it points to; facts has id and fact."""
    far = edges.where(F.col("type").isin(types)).join(facts.withColumnRenamed("id", "target"), "target").select(F.col("source").alias("id"), "fact")
    return facts.select("id", "fact").union(far).distinct()


def verify(edges: DataFrame, facts: DataFrame, decidable: Column) -> DataFrame:
    """edges with a verdict against independent facts (type, source, target): confirmed, mismatch or unverifiable."""
    there = facts.select("type", "source", "target").distinct().withColumn("__there", F.lit(True))
    verdict = F.when(F.col("__there"), "confirmed").when(decidable, "mismatch").otherwise("unverifiable")
    return edges.join(there, ["type", "source", "target"], "left").withColumn("verdict", verdict).drop("__there")


def reachable(edges: DataFrame, start: DataFrame, steps: int) -> DataFrame:
    """id, depth: nodes within `steps` edges of the start nodes (id), with their smallest depth."""
    seen = start.select("id", F.lit(0).alias("depth"))
    front = seen
    pairs = edges.select(F.col("source").alias("id"), "target").distinct()
    for depth in range(1, steps + 1):
        front = front.join(pairs, "id").select(F.col("target").alias("id")).distinct().join(seen.select("id"), "id", "left_anti").withColumn("depth", F.lit(depth))
        seen = seen.union(front)
    return seen
