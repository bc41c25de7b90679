"""Joins of records whose keys may be null, with defaults for the side that is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _matched(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> Column:
    cond = None
    for a, b in on:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner", defaults: dict[str, object] | None = None) -> DataFrame:
    """Equi-join where null keys meet null keys; how is inner, left, right or full; defaults fill columns of a missing side."""
    both = left.withColumn("__l", F.lit(True)).alias("l").join(right.withColumn("__r", F.lit(True)).alias("r"), _matched(left, right, on), how)
    fills = defaults or {}
    cols = []
    for side, frame, mark in (("l", left, "__l"), ("r", right, "__r")):
        for c in frame.columns:
            col = F.col(f"{side}.{c}")
            cols.append((F.when(F.col(mark).isNull(), F.lit(fills[c])).otherwise(col) if c in fills else col).alias(c))
    return both.select(*cols)


def present(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of left with a partner in right; null keys match."""
    return left.join(right, _matched(left, right, on), "left_semi")


def absent(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of left without a partner in right; null keys match."""
    return left.join(right, _matched(left, right, on), "left_anti")


def positional_diff(seqs: list[DataFrame], by: list[str], ord_col: str, value: str, pad: object | None = None, padded: bool = False) -> DataFrame:
    """by, ord, v0..vn: positions at which the sequences differ; short sequences end the comparison unless padded."""
    out = None
    for i, s in enumerate(seqs):
        one = s.select(*by, ord_col, F.col(value).alias(f"v{i}"), F.lit(True).alias(f"__in{i}"))
        out = one if out is None else out.join(one, [*by, ord_col], "full" if padded else "inner")
    if padded and pad is not None:
        for i in range(len(seqs)):
            out = out.withColumn(f"v{i}", F.when(F.col(f"__in{i}").isNull(), F.lit(pad)).otherwise(F.col(f"v{i}")))
    same = F.lit(True)
    for i in range(1, len(seqs)):
        same &= F.col("v0").eqNullSafe(F.col(f"v{i}"))
    return out.where(~same).select(*by, ord_col, *[f"v{i}" for i in range(len(seqs))])


def first_later(df: DataFrame, same: list[str], id_col: str, ord_col: str, extra: Column | None = None) -> DataFrame:
    """id, later: for each row the first row of equal `same` values with a greater ord (and `extra` over l, r)."""
    if extra is None:  # the next greater ord of a group, and its least id: a window over the distinct ords
        groups = df.dropna(subset=[*same, ord_col]).groupBy(*same, ord_col).agg(F.min(id_col).alias("__first"))
        following = groups.withColumn("later", F.lead("__first").over(Window.partitionBy(*same).orderBy(ord_col))).where("later IS NOT NULL")
        return df.join(following, [*same, ord_col]).select(id_col, "later")
    cond = (F.col(f"r.{ord_col}") > F.col(f"l.{ord_col}")) & extra
    for c in same:
        cond &= F.col(f"l.{c}") == F.col(f"r.{c}")
    pairs = df.alias("l").join(df.alias("r"), cond)
    return pairs.groupBy(F.col(f"l.{id_col}").alias(id_col)).agg(F.min_by(F.col(f"r.{id_col}"), F.struct(F.col(f"r.{ord_col}"), F.col(f"r.{id_col}"))).alias("later"))


def prefix_join(texts: DataFrame, targets: DataFrame, prefix: str, target: str, at_least: int) -> DataFrame:
    """Pairs where `target` starts with `prefix`; prefixes have `at_least` characters, which serve as hash key."""
    a = texts.where(F.length(prefix) >= at_least).withColumn("__key", F.substring(prefix, 1, at_least))
    b = targets.withColumn("__key", F.substring(target, 1, at_least))
    return a.join(b, "__key").where(F.startswith(F.col(target), F.col(prefix))).drop("__key")


def lookup(df: DataFrame, decisions: DataFrame, key: list[str], columns: dict[str, object]) -> DataFrame:
    """df with columns of a keyed store, or their defaults where the store has no such key."""
    got = df.join(decisions.select(*key, *columns), key, "left")
    return got.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in columns.items() if d is not None})
