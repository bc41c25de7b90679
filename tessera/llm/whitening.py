"""Operator 12: whitening of embeddings by matrix-free block subspace iteration.

Entries become whole numbers, so that sums and deviations are exact. The covariance is never formed: a pass over the
rows sends a block of vectors Q to every task, which adds up X'(XQ) over its centred rows; executors add the blocks up as
a tree. On the driver the Ritz vectors of the block follow from a small eigenproblem, and QR of what the pass returned
is the next block. The iteration ends when the residuals |Vu - eu| of all wanted components are below `tolerance` times
the largest eigenvalue; a last pass with the components themselves measures them and the covariance of what is returned.

The block has twice the wanted components (all dimensions, if fewer), so that the error of a component falls by the
ratio of the first eigenvalue beyond the block to its own in every pass, whatever lies between the wanted ones. The driver and a
task hold blocks of dimensions x 2k numbers. At 64 dimensions and 32 components the block is the whole space, and one
pass suffices.

Defined cases: rows whose vector is null or empty, holds null or non-finite entries, or entries of 2**26 and more, which
leave the exact range, take no part; vectors of another length than the most frequent one (of equally frequent ones the shortest) neither; a
null id stays null, repeated rows count each; components without variance (to rounding) are not returned, so equal or
single rows give no row; a deviation beyond 64 bits is null; an empty table gives an empty table; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, cut_table, table, tree_sum

COMPONENTS, SCALE, SHIFT = 32, 64.0, 1_000_000
#: Residual, relative to the largest eigenvalue, at which a component is certified, and passes after which the iteration gives up.
TOLERANCE, PASSES = 1e-12, 500
#: Absolute value from which an entry is no part of the exact range.
LIMIT = float(1 << 26)
#: Rows that a task turns into output at a time.
OUT_ROWS = 256


def usable(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LIMIT))), F.lit(False))


def whole_numbers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and x array<long> of the rows that take part, as a written table."""
    vector = F.col("v")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where(usable(vector))
    x = F.transform(vector, lambda c: F.floor(c * F.lit(SCALE)).cast("long") + F.lit(SHIFT).cast("long"))
    made = cut_table(rows.select("vec_id", x.alias("x")))
    sizes = made.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return made.where(F.size("x") == (sizes[0]["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def sums(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + 1, np.int64)
        for batch in batches:
            total[0] += batch.num_rows
            total[1:] += _matrix(batch.column(0)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    total = tree_sum(rows.select("x").mapInArrow(run, "total binary"), np.zeros(d + 1, np.int64))
    return int(total[0]), total[1:]


class Centre:
    """The mean as its floor and the rest, so that centred rows are accurate to the last digit."""

    def __init__(self, n: int, total: np.ndarray):
        self.n, self.floor = n, total // n
        self.rest = total - n * self.floor

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n x - S)**2; null beyond 64 bits."""
        off = x - self.floor
        if x.shape[1] * ((float(np.abs(off).max(initial=0)) + 1) * self.n) ** 2 < 2.0**62:
            return ((self.n * off - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * off.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in exact]


def block_product(rows: DataFrame, centre: Centre, q: np.ndarray) -> tuple[np.ndarray, float]:
    """V Q and the trace of V, the covariance of the rows, from one pass."""
    shared = rows.sparkSession.sparkContext.broadcast((centre, q))  # dimensions x block numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, q = shared.value
        z = np.zeros((len(q) + 1, q.shape[1]))
        for batch in batches:
            y = centre(_matrix(batch.column(0)))
            z[:-1] += y.T @ (y @ q)
            z[-1, 0] += (y * y).sum()
        yield pa.RecordBatch.from_arrays([pa.array([z.tobytes()], pa.binary())], names=["z"])

    z = tree_sum(rows.select("x").mapInArrow(run, "z binary"), np.zeros((len(q) + 1, q.shape[1]))) / centre.n
    shared.destroy()
    return z[:-1], float(z[-1, 0])


def components(rows: DataFrame, centre: Centre, d: int, k: int, tolerance: float = TOLERANCE, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray, float, float, int]:
    """Eigenvalues, unit eigenvectors (columns), trace, largest entry of the whitened covariance minus the identity, passes."""
    block = min(d, 2 * k)
    q = np.linalg.qr(np.random.default_rng(12).standard_normal((d, block)))[0]
    for done in range(1, passes + 1):
        z, trace = block_product(rows, centre, q)
        values, turn = _ritz(q, z)
        u, vu = q @ turn, z @ turn
        residual = np.linalg.norm(vu - u * values, axis=0)[:k]
        if residual.max(initial=0.0) <= tolerance * values[0]:
            break
        q = np.linalg.qr(vu)[0]
    else:
        raise RuntimeError(f"after {passes} passes the largest residual is {residual.max() / values[0]:.2g} of the largest eigenvalue")
    keep = min(k, int((values > values[0] * d * np.finfo(float).eps * 16).sum()) if values[0] > 0 else 0)
    if not keep:
        return values[:0], u[:, :0], trace, 0.0, done
    u = np.linalg.qr(u[:, :keep])[0]
    z, trace = block_product(rows, centre, u)
    values, turn = _ritz(u, z)
    u, vu = u @ turn, z @ turn
    error = np.abs((u.T @ vu) / np.sqrt(np.outer(values, values)) - np.eye(keep)).max()
    return values, u, trace, float(error), done + 1


def _ritz(q: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of Q'VQ."""
    h = q.T @ z
    values, turn = np.linalg.eigh((h + h.T) / 2)
    return values[::-1].copy(), turn[:, ::-1].copy()


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per remaining row and component."""
    spark = df.sparkSession
    bound_batches(spark)
    rows = whole_numbers(df, id_col, vector_col)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    first = rows.select(F.size("x")).first()
    if first is None:
        return spark.createDataFrame([], schema)
    d = first[0]
    centre = Centre(*sums(rows, d))
    values, vectors, trace, error, _ = components(rows, centre, d, k)
    shared = spark.sparkContext.broadcast((centre, vectors / np.sqrt(values), values / trace if len(values) else values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, project, explained = shared.value
        m = len(explained)
        for batch in batches:
            for at in range(0, batch.num_rows if m else 0, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                x, n = _matrix(part.column(1)), part.num_rows
                by_row = pa.array(np.repeat(np.arange(n), m))
                out = [
                    part.column(0).take(by_row),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * m, centre.n)),
                    pa.array(centre.deviations(x), pa.int64()).take(by_row),
                    pa.array((centre(x) @ project).ravel()),
                    pa.array(np.tile(explained, n)),
                    pa.array(np.full(n * m, error)),
                ]
                yield pa.RecordBatch.from_arrays(out, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """Contract query: 32 components of all embeddings."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
