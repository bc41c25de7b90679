"""Memory segments: binary contents at virtual addresses, searched and read without handling a content as one value.

segments: segment, start (virtual address), content binary. Contents are cut into ranges that overlap by the length of
the longest pattern less one byte, so that a hit lies whole in the range that it begins in, and in no other. Ranges are dealt over
all tasks, whatever segment they come from; addresses meet modules and segments by range joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.operators import ranges as rg

#: Bytes of a range, and ranges that go to a Python worker at a time.
RANGE_BYTES, RANGES = 1 << 20, 16


def cut_ranges(segments: DataFrame, size: int, overlap: int) -> DataFrame:
    """segment, start, at, n, data: ranges of `size` bytes from offset `at` on, with the overlap behind them."""
    n = F.octet_length("content")
    at = F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size)))
    cut = segments.where(n > 0).select("segment", "start", "content", at.alias("at"))
    return cut.select("segment", "start", "at", F.least(F.lit(size), F.octet_length("content") - F.col("at")).alias("n"), F.substring("content", F.col("at") + 1, F.lit(size + overlap)).alias("data"))


def search(segments: DataFrame, patterns: list[bytes], find_first: bool = False, size: int = RANGE_BYTES) -> DataFrame:
    """segment, pattern, address: every place of every pattern, overlapping ones too; with find_first the first of each segment and pattern.

    With find_first a task leaves a segment's further ranges
    unread once all patterns have been met in it, and the first of what tasks have found is taken.
    """
    if not patterns or not all(patterns):
        raise ValueError("patterns must hold bytes")
    told = sorted(set(patterns))
    # patterns that cannot overlap are found by one expression; else each by its own, whose look-ahead takes no bytes
    finder = re.compile(b"|".join(re.escape(p) for p in told), re.DOTALL) if not _overlapping(told) else None
    each = [re.compile(b"(?=" + re.escape(p) + b")", re.DOTALL) for p in told]
    number = {p: i for i, p in enumerate(told)}

    def hits(data: bytes, n: int) -> Iterator[tuple[int, int]]:
        if finder:
            for m in finder.finditer(data):
                if m.start() < n:
                    yield number[m[0]], m.start()
        else:
            for i, one in enumerate(each):
                yield from ((i, m.start()) for m in one.finditer(data) if m.start() < n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict = {}
        for batch in batches:
            out: list[tuple] = []
            for segment, start, at, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if find_first:
                    if segment not in met:
                        met = {segment: {}}  # ranges of a segment follow each other
                    if len(met[segment]) == len(told):
                        continue
                for i, place in sorted(hits(data, n), key=lambda h: h[1]) if find_first else hits(data, n):
                    if not find_first or met[segment].setdefault(i, at + place) == at + place:
                        out.append((segment, i, start + at + place))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((kind, pa.int32(), pa.int64()))], names=["segment", "pattern", "address"])

    ranges = cut_ranges(segments, size, max(map(len, told)) - 1)
    key = ranges.schema["segment"].dataType
    kind = to_arrow_type(key)
    segments.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(RANGES))
    found = ranges.select("segment", F.col("start").cast("long"), "at", "n", "data").mapInArrow(run, f"segment {key.simpleString()}, pattern int, address long")
    if find_first:
        found = found.groupBy("segment", "pattern").agg(F.min("address").alias("address"))
    names = F.array(*[F.lit(bytearray(p)) for p in told])
    return found.select("segment", F.element_at(names, F.col("pattern") + 1).alias("pattern"), "address")


def _overlapping(patterns: list[bytes]) -> bool:
    """Whether a place of one pattern may begin inside a place of another one or of its own."""
    meets = lambda a, b: any(a[i:].startswith(b) or b.startswith(a[i:]) for i in range(1, len(a)))
    return any(meets(a, b) or (a != b and b.startswith(a)) for a in patterns for b in patterns)


def search_modules(segments: DataFrame, modules: DataFrame, patterns: list[bytes], width: int, find_first: bool = False, size: int = RANGE_BYTES) -> DataFrame:
    """module, segment, pattern, address: hits in segments that start inside a module (base <= start < end).

    width is the extent of a bucket of the range join. With find_first only the first hit of a module and pattern is kept.
    """
    within = rg.interval_join(segments, modules.select("module", "base", "end"), [], "start", "base", "end", bucket=width, closed=False)
    searched = within.select("segment", "start", "content").dropDuplicates(["segment"])
    found = search(searched, patterns, find_first, size).join(within.select("segment", "module").distinct(), "segment")
    if not find_first:
        return found.select("module", "segment", "pattern", "address")
    first = found.groupBy("module", "pattern").agg(F.min_by(F.struct("segment", "address"), F.struct("address", "segment")).alias("f"))
    return first.select("module", "f.segment", "pattern", "f.address")


def find_modules(modules: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (name) with the module whose name holds it, ignoring case; of several the first in order (ord), loaded ones before unloaded ones.

    wanted is a side of few names, checked by Catalyst before it is sent around.
    """
    met = wanted.join(modules, F.contains(F.lower("module"), F.lower("name")), "left")
    first = met.groupBy("name").agg(F.min_by(F.struct("module", "base", "end"), F.struct("unloaded", "ord")).alias("m"))
    return first.select("name", "m.module", "m.base", "m.end")


def read_at(segments: DataFrame, requests: DataFrame, width: int) -> DataFrame:
    """requests (request, address, size) plus segment, data and error: `size` bytes from a virtual address on.

    An address in no segment, and a read that would leave its segment, have no data and say so.
    """
    spans = segments.withColumn("__end", F.col("start") + F.octet_length("content"))
    there = rg.interval_join(requests, spans, [], "address", "start", "__end", bucket=width, closed=False)
    inside = F.col("address") + F.col("size") <= F.col("__end")
    got = there.select("request", "segment", inside.alias("__fits"), F.when(inside, F.substring("content", (F.col("address") - F.col("start") + 1).cast("int"), F.col("size").cast("int"))).alias("data"))
    error = F.when(F.col("segment").isNull(), "address not in memory range").when(~F.col("__fits"), "read would cross boundaries")
    return requests.join(got, "request", "left").withColumn("error", error).drop("__fits")
