"""Helpers shared by the training-data operators.

Every helper keeps memory bounded by a slice of rows, never by a partition or a key.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A slice handed to Python code ends at so many rows or bytes, whichever comes first (one row at least).
SLICE_ROWS, SLICE_BYTES = 256, 4 << 20
#: Rows that go to a Python worker at a time.
BATCH_ROWS = 1_024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of at most `rows` rows and about SLICE_BYTES bytes."""
    at, n = 0, batch.num_rows
    per_row = max(1, batch.nbytes // max(1, n))
    step = max(1, min(rows, SLICE_BYTES // per_row))
    while at < n:
        yield batch.slice(at, step)
        at += step


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without the columns whose names clash (case-insensitively, as Spark resolves them) with names."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def add_columns(df: DataFrame, inputs: list[Column], fields: list[T.StructField], make: Callable, as_arrow: bool = False) -> DataFrame:
    """df plus the columns that make() computes per row from inputs; older columns of those names are replaced.

    make() is called once per task and returns a function from lists of Python values (one list per input)
    to a list of value lists (one per field); as_arrow hands over Arrow arrays instead. Rows keep their order and their other columns.
    """
    bound_batches(df.sparkSession)
    names = [f.name for f in fields]
    temp = [f"__in_{i}" for i in range(len(inputs))]
    kept = without(df, names)
    fed = df.select(*[F.col(f"`{c}`") for c in kept.columns], *[c.alias(t) for c, t in zip(inputs, temp, strict=True)])
    schema = T.StructType([*kept.schema.fields, *fields])
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in batches:
            for part in slices(batch):
                n = part.num_columns - len(temp)
                given = [part.column(n + i) for i in range(len(temp))]
                made = row(*(given if as_arrow else [c.to_pylist() for c in given]))
                new = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *new], names=[*part.schema.names[:n], *names])

    return fed.mapInArrow(run, schema)


def cut_table(df: DataFrame) -> DataFrame:
    """As cut(), as a compressed table in the same folder, for intermediates too large to keep as plain rows.

    The table is deleted when the driver ends.
    """
    spark = df.sparkSession
    prepare_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def _delete_at_end(spark: SparkSession, path: str) -> None:
    if not _WRITTEN:
        atexit.register(_delete_written, spark)
    _WRITTEN.append(path)


def _delete_written(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is None:  # stopped already
        return
    for path in _WRITTEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def bound_batches(spark: SparkSession) -> None:
    """Let Python workers get BATCH_ROWS rows at a time at most, so that a task's memory is bounded on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def prepare_checkpoints(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names; where none is named, one of our own on a single machine only.

    What is written there is deleted when the driver ends.
    """
    bound_batches(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tessera-"))
        _delete_at_end(spark, sc.getCheckpointDir())


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the reliable checkpoint folder: it is computed once and survives lost executors.

    Nothing behind the cut is needed any more. Spark deletes its shuffle files once the driver has collected what refers
    to them, which a driver that is mostly idle would put off for long; so that is asked for here.
    """
    spark = df.sparkSession
    prepare_checkpoints(spark)
    done = df.checkpoint(eager=True)
    del df
    spark._jvm.System.gc()
    return done


def tree_sum(vectors: DataFrame, like: np.ndarray) -> np.ndarray:
    """The sum of the vectors that the tasks of a one-column binary table yield, one each, in the shape and type of like.

    Executors merge them as a tree, so that the driver gets a few vectors at any number of tasks.
    """
    kind = like.dtype
    rows = vectors.rdd.map(lambda r: np.frombuffer(r[0], kind))
    return rows.treeReduce(np.add).reshape(like.shape).copy() if rows.getNumPartitions() else np.zeros_like(like)
