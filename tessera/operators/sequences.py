"""Ordered sequences as rows: `by` names the sequence, `ord` the place in it, counted from 0.

Every operator works inside a sequence, so sequences are the unit of parallel work; `with_ordinals` numbers a
whole table without gathering it in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lineage import cut


def _ordered(by: list[str], ord_col: str) -> Window:
    return Window.partitionBy(*by).orderBy(ord_col)


def _so_far(by: list[str], ord_col: str) -> Window:
    return _ordered(by, ord_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def number(df: DataFrame, by: list[str], order: list[Column | str], ord_col: str = "ord") -> DataFrame:
    """df with places from 0 in each sequence."""
    return df.withColumn(ord_col, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))


def with_ordinals(df: DataFrame, order: list[str], ord_col: str = "ord", partitions: int | None = None) -> DataFrame:
    """df with places from 0 over the whole table: ranges are sorted apart, then moved by the rows before them.

    The rows are written with the number of their range: the bounds of ranges come from a sample of the rows, and another
    pass over them would draw another sample.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    # the counts are one row per partition
    counts = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    before = counts.select("__part", (F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    local = ranged.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1)
    joined = local.join(F.broadcast(before), "__part")
    return joined.withColumn(ord_col, (F.col("__at") + F.coalesce("before", F.lit(0))).cast("long")).drop("__part", "__at", "before")


def accumulate(df: DataFrame, by: list[str], ord_col: str, value: Column, out: str, initial: object | None = None) -> DataFrame:
    """Running sum; `initial` is added to every place (its own row before the first is `initial` itself)."""
    total = F.sum(value).over(_so_far(by, ord_col))
    return df.withColumn(out, total if initial is None else total + F.lit(initial))


def accumulate_with(values: Column, op, initial: Column | None = None) -> Column:
    """Array of the running results of op over an array column, for any operation."""
    rest = values if initial is not None else F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))
    start = initial if initial is not None else values[0]
    return F.aggregate(rest, F.array(start), lambda acc, x: F.concat(acc, F.array(op(F.element_at(acc, -1), x))))


def sliding_window(df: DataFrame, by: list[str], ord_col: str, value: str, n: int, out: str = "window") -> DataFrame:
    """One row per place with n values from there on; incomplete windows are left out."""
    w = _ordered(by, ord_col).rowsBetween(0, n - 1)
    return df.withColumn(out, F.collect_list(value).over(w)).where(F.size(out) == n)


def chunks(df: DataFrame, by: list[str], ord_col: str, value: str, n: int, out: str = "chunk", pad: object | None = None, drop_short: bool = False) -> DataFrame:
    """by, no, chunk: n values each, the last one short, padded, or dropped."""
    no = F.floor(F.col(ord_col) / n).cast("long")
    got = df.groupBy(*by, no.alias("no")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), F.col(value).alias("v")))), lambda s: s["v"]).alias(out))
    if pad is not None:
        got = got.withColumn(out, F.concat(out, F.array_repeat(F.lit(pad), F.lit(n) - F.size(out))))
    return got.where(F.size(out) == n) if drop_short else got


def islands(df: DataFrame, by: list[str], ord_col: str, key: Column, out: str = "island") -> DataFrame:
    """df with the number of the run of equal keys (nulls are equal) that a row is in."""
    w = _ordered(by, ord_col)
    change = F.when(F.row_number().over(w) == 1, 0).otherwise(F.when(key.eqNullSafe(F.lag(key).over(w)), 0).otherwise(1))
    return df.withColumn("__change", change).withColumn(out, F.sum("__change").over(_so_far(by, ord_col))).drop("__change")


def split(df: DataFrame, by: list[str], ord_col: str, is_sep: Column, maxsplit: int | None = None, keep_empty: bool = False, out: str = "part") -> DataFrame:
    """Rows between separators with the number of their part.

    keep_empty counts every separator, so parts may be missing (they are empty); otherwise runs of separators
    count once and leading ones not at all. After maxsplit splits, separators are rows like any other.
    """
    w = _ordered(by, ord_col)
    marked = df.withColumn("__sep", F.coalesce(is_sep, F.lit(False)))
    if keep_empty:
        splits = F.col("__sep")
    else:  # a split is the first separator after a row that is none
        splits = F.col("__sep") & ~F.coalesce(F.lag("__sep").over(w), F.lit(True))
    counted = marked.withColumn("__split", splits.cast("int")).withColumn(out, F.sum("__split").over(_so_far(by, ord_col)))
    if maxsplit is None:
        return counted.where(~F.col("__sep")).drop("__sep", "__split")
    used = F.col(out) <= maxsplit
    kept = counted.where(~F.col("__sep") | ~used)
    return kept.withColumn(out, F.least(F.col(out), F.lit(maxsplit))).drop("__sep", "__split")


def take_while(df: DataFrame, by: list[str], ord_col: str, pred: Column) -> DataFrame:
    return _failures(df, by, ord_col, pred).where("__failed = 0").drop("__failed")


def drop_while(df: DataFrame, by: list[str], ord_col: str, pred: Column) -> DataFrame:
    return _failures(df, by, ord_col, pred).where("__failed > 0").drop("__failed")


def _failures(df: DataFrame, by: list[str], ord_col: str, pred: Column) -> DataFrame:
    failed = F.when(F.coalesce(pred, F.lit(False)), 0).otherwise(1)
    return df.withColumn("__fail", failed).withColumn("__failed", F.sum("__fail").over(_so_far(by, ord_col))).drop("__fail")


def take_slice(df: DataFrame, ord_col: str, start: int = 0, stop: int | None = None, step: int = 1) -> DataFrame:
    """Rows at start, start + step, ... before stop; take, drop, nth and every-nth are slices."""
    cond = (F.col(ord_col) >= start) & ((F.col(ord_col) - start) % step == 0)
    return df.where(cond if stop is None else cond & (F.col(ord_col) < stop))


def tail(df: DataFrame, by: list[str], ord_col: str, n: int) -> DataFrame:
    """The last n rows of each sequence."""
    w = Window.partitionBy(*by).orderBy(F.col(ord_col).desc())
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def unique(df: DataFrame, by: list[str], ord_col: str, key: Column) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*by, key).orderBy(ord_col)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_k(df: DataFrame, by: list[str], key: Column, ord_col: str, k: int, out: str = "rank") -> DataFrame:
    """The k greatest of each sequence, the earlier of equals first."""
    w = Window.partitionBy(*by).orderBy(key.desc(), F.col(ord_col))
    return df.withColumn(out, F.row_number().over(w).cast("long")).where(F.col(out) <= k)


def first_match(df: DataFrame, by: list[str], ord_col: str, pred: Column, value: str, default: object, out: str = "first") -> DataFrame:
    """by, first: the first value with pred in each sequence, or the default."""
    got = df.groupBy(*by).agg(F.min_by(F.when(pred, F.col(value)), F.when(pred, F.col(ord_col))).alias(out), F.count_if(pred).alias("__n"))
    return got.withColumn(out, F.when(F.col("__n") > 0, F.col(out)).otherwise(F.lit(default))).drop("__n")


def interleave(seqs: list[DataFrame], by: list[str], ord_col: str, value: str) -> DataFrame:
    """by, ord, value: one value of each sequence in turn; those at their end drop out."""
    out = None
    for i, s in enumerate(seqs):
        one = s.select(*by, F.col(ord_col).alias("__pos"), F.lit(i).alias("__seq"), F.col(value).alias("value"))
        out = one if out is None else out.unionByName(one)
    return number(out, by, ["__pos", "__seq"]).drop("__pos", "__seq")


def interpose(df: DataFrame, by: list[str], ord_col: str, value: str, element: object) -> DataFrame:
    """by, ord, value: the element between each two values."""
    items = df.select(*by, (F.col(ord_col) * 2).alias("ord"), F.col(value).alias("value"))
    between = df.where(F.col(ord_col) > 0).select(*by, (F.col(ord_col) * 2 - 1).alias("ord"), F.lit(element).alias("value"))
    return items.unionByName(between)


def merge_sorted(seqs: list[DataFrame], by: list[str], key: str, ord_col: str, columns: list[str]) -> DataFrame:
    """All rows in key order with their place; of equal keys the earlier sequence, then the earlier row comes first."""
    out = None
    for i, s in enumerate(seqs):
        one = s.select(*by, *columns, F.col(ord_col).alias("__ord"), F.lit(i).alias("__seq"))
        out = one if out is None else out.unionByName(one)
    return number(out, by, [key, "__seq", "__ord"], "place").drop("__ord", "__seq")


def concat(seqs: list[DataFrame], by: list[str], ord_col: str, value: str) -> DataFrame:
    """by, ord, value: one sequence after the other."""
    out = None
    for i, s in enumerate(seqs):
        one = s.select(*by, F.lit(i).alias("__seq"), F.col(ord_col).alias("__ord"), F.col(value).alias("value"))
        out = one if out is None else out.unionByName(one)
    return number(out, by, ["__seq", "__ord"]).drop("__seq", "__ord")
