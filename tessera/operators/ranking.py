"""Rankings over groups: interleaving, stratified samples, two-level top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_robin(df: DataFrame, group: str, score: str, ident: str, out: str = "place") -> DataFrame:
    """Rows in turns over groups: each group's best first, groups by their best score, then by name."""
    best = F.max(score).over(Window.partitionBy(group))
    turn = F.row_number().over(Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(ident)))
    return df.withColumn("turn", turn.cast("long")).withColumn("best", best)


def round_robin_order() -> list[Column]:
    """Order of rows that round_robin() numbered."""
    return [F.col("turn"), F.col("best").desc()]


def stratified_sample(df: DataFrame, stratum: str, key: list[str], budget: int) -> DataFrame:
    """The first ceil(budget / strata) rows of each stratum, one at least, cut to the budget (0: not cut)."""
    n = df.agg(F.count_distinct(stratum).alias("n"))
    per = F.greatest(F.lit(1), F.ceil(F.lit(budget) / F.greatest(F.col("n"), F.lit(1))))
    w = Window.partitionBy(stratum).orderBy(*key)
    # a stratum gives no more than the budget, whatever the number of strata
    first = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= max(1, budget))
    picked = first.crossJoin(F.broadcast(n)).where(F.col("__rn") <= per).drop("__rn", "n")
    return picked if budget <= 0 else picked.orderBy(stratum, *key).limit(budget)


def two_level_top(df: DataFrame, group: str, score: str, ident: str, groups: int, per_group: int) -> DataFrame:
    """df with `selected`: the per_group best rows of the groups with the greatest sums of score."""
    sums = df.groupBy(group).agg(F.sum(score).alias("group_score"))
    top = sums.orderBy(F.desc("group_score"), group).limit(groups).withColumn("__top", F.lit(True))
    rn = F.row_number().over(Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(ident)))
    return df.withColumn("__rn", rn).join(top.select(group, "__top"), group, "left").withColumn("selected", F.coalesce("__top", F.lit(False)) & (F.col("__rn") <= per_group)).drop("__rn", "__top")
