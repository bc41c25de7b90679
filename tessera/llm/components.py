"""Connected components of an edge list: blocks of edges become stars in place, alternating large-star and small-star steps join the blocks.

A block holds at most TASK_EDGES edges; where all that is left are so many, they are one block and done. A star step
is a partial aggregate (smallest neighbour of each node) and an equi-join, so a hub of any degree is
summed map-side and its join partition can be split; the number of steps grows with the logarithm of the
longest path between blocks. Each step is checkpointed in the shared folder. A step is dealt over as many tasks as its edges ask for:
a few edges over hundreds of partitions would cost more in files than they hold. No side of a join goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut

#: Steps after which an unfinished run raises instead of looping for ever.
MAX_STEPS = 60
#: Edges that a task handles.
TASK_EDGES = 100_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node that these edges let each reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _contracted(edges: DataFrame, block: int) -> DataFrame:
    """a, b: the stars of the blocks of edges, of at most `block` edges (or one batch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def star(part: list[pa.RecordBatch]) -> pa.RecordBatch:
            made = stars(*[np.concatenate([p.column(i).to_numpy() for p in part]) for i in range(2)])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["a", "b"])

        part: list[pa.RecordBatch] = []
        for batch in batches:
            if part and sum(p.num_rows for p in part) + batch.num_rows > block:
                yield star(part)
                part = []
            part.append(batch)
        if part:
            yield star(part)

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> node, root: the smallest node reachable. Self-loops keep a node without partners."""
    e, seen = cut(_contracted(edges, TASK_EDGES)), None
    n = e.count()
    for _ in range(MAX_STEPS):
        few = lambda df, tasks=max(1, -(-n // TASK_EDGES)): df.coalesce(tasks)
        e = cut(_contracted(few(e), TASK_EDGES))
        if n <= TASK_EDGES:
            break
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = few(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
        # large star: neighbours above a node move to the smallest of its neighbourhood
        large = few(few(both.join(least.hint("merge"), "a")).where(F.col("b") >= F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: what lies at or below a node moves there too
        down = few(large.groupBy("a").agg(F.min("b").alias("m")))
        small = few(large.join(down.hint("merge"), "a")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        e = cut(few(small.distinct()))
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        n = state[0]
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components: no fixed point; raise MAX_STEPS")
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
