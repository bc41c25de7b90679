"""Point-in-interval joins with an equality key and, for long intervals, buckets of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, spans: DataFrame, keys: list[str], point: str, start: str, end: str, bucket: int | None = None, closed: bool = True) -> DataFrame:
    """Pairs of a point and a span of the same keys with start <= point <= end (closed) or start <= point < end.

    With `bucket`, spans are cut into buckets of that width and the bucket is part of the key: a key that holds
    many rows is dealt over its buckets, and a pair still appears once.
    """
    upper = F.col(point) <= F.col(end) if closed else F.col(point) < F.col(end)
    inside = (F.col(point) >= F.col(start)) & upper
    if bucket is None:
        return points.join(spans, keys).where(inside)
    cut = lambda c: F.floor(F.col(c) / bucket)
    p = points.withColumn("__bucket", cut(point))
    s = spans.where(F.col(start) <= F.col(end)).withColumn("__bucket", F.explode(F.sequence(cut(start), cut(end))))
    return p.join(s, [*keys, "__bucket"]).where(inside).drop("__bucket")


def ratio_by_span(points: DataFrame, spans: DataFrame, keys: list[str], point: str, start: str, end: str, span_id: list[str], hit: Column, digits: int = 1, bucket: int | None = None) -> DataFrame:
    """span_id, pct: share in percent of a span's points with `hit`; spans without a point are left out."""
    met = interval_join(points, spans, keys, point, start, end, bucket)
    return met.groupBy(*span_id).agg(F.round(F.count_if(hit) * 100.0 / F.count("*"), digits).alias("pct"))


def uncovered_ratio(points: DataFrame, spans: DataFrame, keys: list[str], point: str, start: str, end: str, span_id: list[str], hit: Column) -> DataFrame:
    """span_id, ratio, measured: share without `hit`; a span whose keys have no point at all counts as wholly uncovered
    over its length, one with points elsewhere only has no ratio."""
    met = interval_join(points, spans, keys, point, start, end).groupBy(*span_id).agg(F.count("*").alias("n"), F.count_if(~hit).alias("miss"))
    seen = points.select(*keys).distinct().withColumn("__seen", F.lit(True))
    all_spans = spans.join(met, span_id, "left").join(seen, keys, "left")
    ratio = F.when(F.col("__seen").isNull(), 1.0).otherwise(F.try_divide(F.col("miss").cast("double"), F.col("n")))
    measured = F.when(F.col("__seen").isNull(), F.col(end) - F.col(start) + 1).otherwise(F.coalesce("n", F.lit(0)))
    return all_spans.select(*span_id, ratio.alias("ratio"), measured.cast("long").alias("measured"))


def first_containing(points: DataFrame, spans: DataFrame, point: str, start: str, end: str, span_ord: str, point_id: list[str], width: int) -> DataFrame:
    """points with the span of smallest span_ord that holds them (start <= point < end), or nulls."""
    met = interval_join(points, spans, [], point, start, end, bucket=width, closed=False)
    names = [c for c in spans.columns]
    first = met.groupBy(*point_id).agg(F.min_by(F.struct(*names), F.col(span_ord)).alias("__span"))
    return points.join(first, point_id, "left").select(*points.columns, *[F.col(f"__span.{c}").alias(c) for c in names if c not in points.columns])
