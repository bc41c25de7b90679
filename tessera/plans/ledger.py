"""Incremental recomputation: a ledger of steps and the hash of what each was computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "step string, status string, input_hash string, seq long"


def latest(ledger: DataFrame) -> DataFrame:
    """The last entry of each step of an append-only ledger."""
    w = Window.partitionBy("step").orderBy(F.col("seq").desc())
    return ledger.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def stale(steps: DataFrame, ledger: DataFrame, forced: list[str] = (), fresh: bool = False) -> DataFrame:
    """Steps (step, input_hash) that must run: forced ones, and those not done from this very input."""
    if fresh:
        return steps
    done = latest(ledger).where("status = 'done'").select("step", "input_hash")
    todo = steps.join(done, ["step", "input_hash"], "left_anti")
    return todo if not forced else todo.union(steps.where(F.col("step").isin(list(forced)))).distinct()


def mark(ledger: DataFrame, steps: DataFrame, status: str, seq: int) -> DataFrame:
    """The ledger with an entry per step added."""
    return ledger.unionByName(steps.select("step", F.lit(status).alias("status"), "input_hash", F.lit(seq).cast("long").alias("seq")))


def reuse(rows: DataFrame, store: DataFrame, key: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their stored decisions, and rows whose key the store lacks."""
    there = rows.join(store.select(*key, *columns).dropDuplicates(key), key)
    return there, rows.join(store.select(*key).distinct(), key, "left_anti")


def obsolete(outputs: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """Outputs that no step produces any more."""
    return outputs.join(keep.select(key).distinct(), key, "left_anti")


def batches_until(rows: DataFrame, ord_col: str, good: str, batch: int, wanted: int, at_most: int) -> DataFrame:
    """rows with `ran`: batches run in order until those before hold `wanted` good rows or `at_most` rows have run.

    rows are the candidates of one decision process; their batch sums are one row per batch.
    """
    numbered = rows.withColumn("__batch", F.floor(F.col(ord_col) / batch).cast("long"))
    sums = numbered.groupBy("__batch").agg(F.count_if(good).alias("__good"))
    before = F.coalesce(F.sum("__good").over(Window.orderBy("__batch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = sums.select("__batch", ((before < wanted) & (F.col("__batch") * batch < at_most)).alias("ran"))
    return numbered.join(runs, "__batch").drop("__batch")
