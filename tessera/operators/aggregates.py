"""Grouped aggregates: histograms, inversions, argmax, ratios, comparisons of runs, nested groups and folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, *keys: Column | str, known: DataFrame | None = None, out: str = "n") -> DataFrame:
    """Rows per key; `known` (a small table of keys) adds those without a row, with 0."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(out))
    if known is None:
        return counts
    return known.join(counts, known.columns, "left").withColumn(out, F.coalesce(out, F.lit(0)).cast("long"))


def invert(df: DataFrame, key: str, values: str) -> DataFrame:
    """values, keys: for each element of the lists the sorted distinct keys that list it."""
    return df.select(key, F.explode(values).alias("value")).groupBy("value").agg(F.array_sort(F.collect_set(key)).alias("keys"))


def argmax(df: DataFrame, by: list[str], item: str, weight: Column, ties: Column, out: str = "best") -> DataFrame:
    """by, best: the item of greatest weight, of equal weights that with the smallest `ties`."""
    top = Window.partitionBy(*by).orderBy(weight.desc(), ties)
    return df.withColumn("__rn", F.row_number().over(top)).where("__rn = 1").select(*by, F.col(item).alias(out))


def keep_last(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key: the first in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def precision(df: DataFrame, kind: str, verdict: str, good: str, bad: str, digits: int = 3) -> DataFrame:
    """Tally per kind: good, bad and other verdicts, and good / (good + bad), null where nothing was decided."""
    g, b = F.count_if(F.col(verdict) == good), F.count_if(F.col(verdict) == bad)
    return df.groupBy(kind).agg(g.alias("good"), b.alias("bad"), F.count_if(~F.col(verdict).isin(good, bad)).alias("other"), F.round(F.try_divide(g.cast("double"), g + b), digits).alias("precision"))


def histogram_distance(df: DataFrame, key: str, target: DataFrame) -> DataFrame:
    """distance: sum of |rows - wanted| over all keys of either side; target has key and wanted."""
    got = histogram(df, key)
    both = got.join(target, key, "full")
    return both.agg(F.sum(F.abs(F.coalesce("n", F.lit(0)) - F.coalesce("wanted", F.lit(0)))).cast("long").alias("distance"))


def runs_identical(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """identical: whether two runs map the same keys to the same values."""
    both = a.select(key, F.col(value).alias("x"), F.lit(1).alias("ina")).join(b.select(key, F.col(value).alias("y"), F.lit(1).alias("inb")), key, "full")
    differs = ~F.col("x").eqNullSafe(F.col("y")) | F.col("ina").isNull() | F.col("inb").isNull()
    return both.agg((F.count_if(differs) == 0).alias("identical"))


def group_list(df: DataFrame, by: list[str], ord_col: str, value: str, out: str = "items") -> DataFrame:
    """by, items: values of each key in the order of the rows."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), F.col(value).alias("v"))))
    return df.groupBy(*by).agg(F.transform(packed, lambda s: s["v"]).alias(out))


def reduce_by(df: DataFrame, by: list[str], ord_col: str, value: str, op: Callable[[Column, Column], Column], initial: Column | None = None, out: str = "value") -> DataFrame:
    """by, value: op folded over a key's values in order; without initial the first value starts."""
    listed = group_list(df, by, ord_col, value, "__items")
    items = F.col("__items")
    rest = items if initial is not None else F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))
    start = initial if initial is not None else items[0]
    return listed.select(*by, F.aggregate(rest, start, op).alias(out))


def limit_per_group(df: DataFrame, by: list[str], ord_col: str, n: int) -> DataFrame:
    """The first n rows of each key, for an aggregate that takes no more."""
    w = Window.partitionBy(*by).orderBy(ord_col)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def reservoir(df: DataFrame, by: list[str], n: int, seed: int, ident: Column) -> DataFrame:
    """n rows of each key, drawn evenly: those with the smallest keyed hash of `ident`, whatever the partitioning."""
    w = Window.partitionBy(*by).orderBy(F.xxhash64(F.lit(seed), ident), ident)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def totals(df: DataFrame, by: list[str], sums: dict[str, str]) -> DataFrame:
    """Sums per group and, with null keys and is_total true, over all."""
    got = df.rollup(*by).agg(*[F.sum(c).cast("long").alias(o) for c, o in sums.items()], F.grouping_id().alias("__g"))
    keep = F.col("__g").isin(0, (1 << len(by)) - 1)
    return got.where(keep).withColumn("is_total", F.col("__g") != 0).drop("__g")


def running_total(df: DataFrame, by: list[str], ord_col: str, value: str, budget: int) -> DataFrame:
    """df with `spent` so far and `within`: whether the budget still holds."""
    w = Window.partitionBy(*by).orderBy(ord_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("spent", F.sum(value).over(w)).withColumn("within", F.col("spent") <= budget)


def merge_maps(maps: DataFrame, by: list[str], ord_col: str, column: str, combine: Callable[[Column], Column] | None = None, out: str = "merged") -> DataFrame:
    """by, key, merged: the last value of each key over all maps, or combine() of the list of its values in order."""
    rows = maps.select(*by, ord_col, F.explode(column).alias("key", "value"))
    if combine is None:
        return rows.groupBy(*by, "key").agg(F.max_by("value", ord_col).alias(out))
    return group_list(rows, [*by, "key"], ord_col, "value", "__vals").select(*by, "key", combine(F.col("__vals")).alias(out))
