"""Run reports: one nested row assembled from the artifacts that exist, and its rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import aggregates as ag


def assemble(spark: SparkSession, artifacts: dict[str, DataFrame | None]) -> DataFrame:
    """One row with a struct per artifact (its first and only row; null if it has none) and `missing`: the absent ones, sorted."""
    out = spark.range(1).select(F.lit(1).alias("__one"))
    for name, df in artifacts.items():
        if df is None:
            continue
        # an artifact is one row by construction; limit keeps a broken one from multiplying the report
        row = df.limit(1).select(F.struct(*df.columns).alias(name), F.lit(1).alias("__one"))
        out = out.join(row, "__one", "left")
    absent = F.array(*[F.lit(n) for n, df in sorted(artifacts.items()) if df is None]).cast("array<string>")
    empty = [F.when(F.col(n).isNull(), F.lit(n)) for n, df in artifacts.items() if df is not None]
    missing = F.array_sort(F.filter(F.concat(absent, F.array(*empty).cast("array<string>")), lambda x: x.isNotNull()))
    return out.withColumn("missing", missing).drop("__one")


def mutation_summary(functions: DataFrame) -> DataFrame:
    """killed, valid, score of (killed, valid) rows; the score is null without mutants."""
    got = functions.agg(F.sum("killed").alias("killed"), F.sum("valid").alias("valid"))
    return got.withColumn("score", F.round(F.try_divide(F.col("killed").cast("double"), F.col("valid")), 3))


def token_summary(usage: DataFrame, tiers: DataFrame) -> DataFrame:
    """tier, tokens: usage (step, tokens) by the tier of its step, `other` where it has none."""
    both = usage.join(tiers, "step", "left").withColumn("tier", F.coalesce("tier", F.lit("other")))
    return both.groupBy("tier").agg(F.sum("tokens").alias("tokens"))


def run_summary(runs: DataFrame) -> DataFrame:
    """dimension, key, n: runs by stage, by outcome, and in all."""
    stage = ag.histogram(runs, F.lit("stage").alias("dimension"), F.col("stage").alias("key"))
    outcome = ag.histogram(runs, F.lit("outcome").alias("dimension"), F.col("outcome").alias("key"))
    return stage.union(outcome).union(runs.agg(F.lit("all").alias("dimension"), F.lit(None).cast("string").alias("key"), F.count("*").alias("n")))


def markdown_table(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """table: rows as a Markdown table in the given order; a report's tables are small by construction."""
    line = tx.markdown_row(*[tx.cell(F.col(c)) for c in columns])
    body = df.agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("__line")))), lambda s: s["__line"]).alias("lines"))
    head = [tx.markdown_row(*[F.lit(c) for c in columns]), tx.markdown_row(*[F.lit("---") for _ in columns])]
    return body.select(F.array_join(F.concat(F.array(*head), "lines"), "\n").alias("table"))
