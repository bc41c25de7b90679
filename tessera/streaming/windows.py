"""Event-time aggregates for streams and tables, and incremental folding of record files.

The surveyed engine has no event time; these are an extension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tumbling(events: DataFrame, ts: str, width: str, by: list[str], value: str, late: str | None = None) -> DataFrame:
    """by, hour, n, total: counts and sums per window; `late` is how long a stream waits for late rows."""
    e = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    e = e.withWatermark("__ts", late) if late else e
    got = e.groupBy(F.window("__ts", width).alias("w"), *by).agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total"))
    return got.select(*by, F.floor(F.unix_micros("w.start") / 3_600_000_000).alias("hour"), "n", "total")


def sessions(events: DataFrame, ts: str, gap: str, by: list[str], late: str | None = None) -> DataFrame:
    """by, start, n: runs of events with less than `gap` between them."""
    e = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    e = e.withWatermark("__ts", late) if late else e
    got = e.groupBy(F.session_window("__ts", gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return got.select(*by, F.unix_micros("w.start").alias("start"), "n")


def first_seen(events: DataFrame, ts: str, key: list[str], late: str) -> DataFrame:
    """The first row of each key of a stream, with state kept for `late` only."""
    e = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return e.dropDuplicatesWithinWatermark(key).drop("__ts")


def read_records(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of append-only JSON record files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a stream once, file by file, up to what is there now."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
