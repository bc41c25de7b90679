"""Sinks: JSON artifacts, append-only records, keyed stores and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def write_artifact(df: DataFrame, path: str, order: list[str]) -> None:
    """Rows as sorted JSON lines: equal tables give equal bytes, whatever their partitioning."""
    lines = df.select(*order, F.to_json(F.struct(*sorted(df.columns))).alias("__json"))
    lines.orderBy(*order, "__json").select(F.col("__json").alias("value")).write.mode("overwrite").text(path)


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def upsert(store: DataFrame, new: DataFrame, key: list[str], version: str = "version") -> DataFrame:
    """The store with new rows in place of older ones of the same key."""
    both = store.withColumn(version, F.lit(0)).unionByName(new.withColumn(version, F.lit(1)))
    w = Window.partitionBy(*key).orderBy(F.col(version).desc())
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", version)


def merge_report(old: DataFrame, new: DataFrame) -> DataFrame:
    """key, value of two reports: the new one's keys win."""
    return upsert(old, new, ["key"])


def write_pages(df: DataFrame, path: str, kind: str = "kind", text: str = "text") -> None:
    """Page texts in a folder per kind."""
    df.select(kind, F.col(text).alias("value")).write.mode("overwrite").partitionBy(kind).text(path)
