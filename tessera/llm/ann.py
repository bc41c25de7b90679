"""Operator 5: approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Equal vectors are one node that carries its smallest ids. Nodes are dealt over shards of bounded size. In a
shard, nodes enter in batches: a greedy beam search over the graph so far proposes neighbours, and pruning
keeps a neighbour only if no kept one is nearer to it by the factor `alpha`, so the edges that stay point in
different directions. A search walks every shard's graph with a beam; the shards' best are merged and scored
in double precision on the original vectors.

Defined cases: vectors that are null, all zero, or hold null or non-finite components are neither indexed
nor searched; a repeated (id, vector) counts once; ties go to the smaller id; fewer candidates than k give
fewer rows; vectors of another length never meet; an empty table gives an empty result; other columns of the
input take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, cut

#: Vectors in a shard and queries in a block, on average: both bound a task's memory.
SHARD_ROWS, QUERY_ROWS = 4_096, 16_384
#: Edges a node keeps, width of the beam, and how much nearer a kept neighbour must be to hide another.
DEGREE, BEAM, ALPHA = 32, 64, 1.2
#: Nodes that enter a graph at once, or queries that walk it together.
BATCH = 512


def beam_search(vectors: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (-1: none) and squared distances of each query's beam, nearest first."""
    n = len(queries)
    ids, dist, done = np.full((n, beam), -1), np.full((n, beam), np.inf, np.float32), np.zeros((n, beam), bool)
    ids[:, 0] = entry
    dist[:, 0] = ((queries - vectors[entry]) ** 2).sum(axis=1)
    while True:
        waiting = ~done & (ids >= 0)
        rows = np.flatnonzero(waiting.any(axis=1))
        if not len(rows):
            return ids, dist
        at = waiting[rows].argmax(axis=1)
        done[rows, at] = True
        near = graph[ids[rows, at]]
        there = ids[rows]
        fresh = (near >= 0) & ~(near[:, :, None] == there[:, None, :]).any(axis=2)
        d = ((vectors[near] - queries[rows][:, None, :]) ** 2).sum(axis=2)
        d[~fresh] = np.inf
        all_ids = np.concatenate([there, np.where(fresh, near, -1)], axis=1)
        all_dist = np.concatenate([dist[rows], d], axis=1)
        all_done = np.concatenate([done[rows], np.zeros_like(fresh)], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[rows], dist[rows], done[rows] = (np.take_along_axis(x, order, axis=1) for x in (all_ids, all_dist, all_done))


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node, up to `degree` of its candidates (-1: none), diverse ones first come nearest first."""
    own = vectors[nodes]
    dist = ((vectors[candidates] - own[:, None, :]) ** 2).sum(axis=2)
    dist[(candidates < 0) | (candidates == nodes[:, None])] = np.inf
    order = np.argsort(dist, axis=1, kind="stable")
    candidates, dist = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(dist, order, axis=1)
    dist[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = np.inf  # a candidate counts once
    there = vectors[candidates]
    alive, out = np.isfinite(dist), np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for k in range(degree):
        any_left = alive.any(axis=1)
        if not any_left.any():
            break
        at = alive.argmax(axis=1)
        out[any_left, k] = candidates[rows, at][any_left]
        between = ((there - there[rows, at][:, None, :]) ** 2).sum(axis=2)
        alive &= alpha * alpha * between > dist
        alive[rows, at] = False
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Neighbour lists (-1: none) of all vectors, and the entry: the vector nearest to the mean."""
    n = len(vectors)
    graph = np.full((n, degree), -1)
    entry = int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.concatenate([[entry], np.delete(np.arange(n), entry)])
    at = 1
    while at < n:
        batch = order[at : at + max(1, min(BATCH, at))]
        found, _ = beam_search(vectors, graph, entry, vectors[batch], beam)
        if len(batch) > 1:  # those that enter together may be neighbours too
            mates = np.tile(batch, (len(batch), 1))
            d = ((vectors[batch][:, None, :] - vectors[batch][None]) ** 2).sum(axis=2) if len(batch) <= 64 else -2 * vectors[batch] @ vectors[batch].T + (vectors[batch] ** 2).sum(axis=1)
            k = min(degree // 2, len(batch) - 1)
            found = np.concatenate([found, np.take_along_axis(mates, np.argpartition(d, k, axis=1)[:, : k + 1], axis=1)], axis=1)
        graph[batch] = robust_prune(vectors, batch, found, degree, alpha)
        # edges back, pruned where a list overflows
        to = graph[batch].ravel()
        back = np.repeat(batch, degree)[to >= 0]
        to = to[to >= 0]
        by = np.argsort(to, kind="stable")
        to, back = to[by], back[by]
        heads, starts, sizes = np.unique(to, return_index=True, return_counts=True)
        for part in np.array_split(np.argsort(sizes), max(1, len(heads) // BATCH)):
            if len(part):
                more = np.full((len(part), int(sizes[part].max())), -1)
                for i, k in enumerate(part.tolist()):
                    more[i, : sizes[k]] = back[starts[k] : starts[k] + sizes[k]]
                graph[heads[part]] = robust_prune(vectors, heads[part], np.concatenate([graph[heads[part]], more], axis=1), degree, alpha)
        at += len(batch)
    return graph, entry


def _matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    array = column.combine_chunks()
    array = array if isinstance(array, pa.Array) else pa.concat_arrays(array.chunks)
    return array.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(array), -1)


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def build_index(df: DataFrame, id_col: str, vector_col: str, copies: int, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """dim, shard, node, vector, ids (the smallest `copies` ids of the vector), neighbours, entry: one row per vector."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("rn") <= copies)
    nodes = cut(ranked.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    shards = max(1, -(-nodes.count() // shard_rows))
    shard = F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int")
    dealt = nodes.select(F.size("vector").alias("dim"), shard.alias("shard"), "vector", "ids", F.col("ids")[0].alias("first"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _shards(batches):
            graph, entry = build_graph(_scaled(_matrix(t.column("vector"), np.float64)), degree, beam, alpha)
            more = [pa.array(np.arange(len(t)), pa.int32()), _lists(graph), pa.array(np.full(len(t), entry), pa.int32())]
            made = pa.Table.from_arrays([*t.drop_columns(["first"]).columns, *more], names=["dim", "shard", "vector", "ids", "node", "neighbours", "entry"])
            yield from made.to_batches(max_chunksize=BATCH)

    # a partition for every shard, so that each is a task of its own
    by_shard = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("dim", "first")
    return by_shard.mapInArrow(build, "dim int, shard int, vector array<double>, ids array<long>, node int, neighbours array<int>, entry int")


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel().astype(np.int32)))


def _scaled(vectors: np.ndarray, more: float = 0.0) -> np.ndarray:
    """Single precision of vectors over their largest component, so that no distance overflows."""
    return (vectors / max(np.abs(vectors).max(initial=0.0), more, np.finfo(np.float64).tiny)).astype(np.float32)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (dim, shard) after another, which follow each other."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        dims = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(dims)]
        for a, b in zip(edges, edges[1:], strict=False):
            part = batch.slice(a, b - a)
            if parts and part.num_rows and parts[-1].column(0)[0] != part.column(0)[0]:
                yield pa.Table.from_batches(parts)
                parts = []
            if part.num_rows:
                parts.append(part)
    if parts:
        yield pa.Table.from_batches(parts)


def search(index: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int, beam: int = 2 * BEAM, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, its own id left out.

    The queries go to the index, a block of bounded size at a time: each is broadcast for one pass over the shards.
    """
    spark = queries.sparkSession
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("query")).where(F.col("query_id").isNotNull() & usable(F.col("query"))).distinct()
    asked = cut(asked)
    blocks = max(1, -(-asked.count() // query_rows))
    index = cut(index)

    def walk(block) -> DataFrame:
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, vectors = block.value
            sizes = np.array([len(v) for v in vectors], np.int64)
            for t in _shards(batches):
                mine = np.flatnonzero(sizes == t.column("dim")[0].as_py())
                if not len(mine):
                    continue
                asks = np.stack([vectors[i] for i in mine.tolist()])
                exact, ids = _matrix(t.column("vector"), np.float64), t.column("ids").to_pylist()
                most = max(np.abs(exact).max(), np.abs(asks).max())
                near, graph, entry = _scaled(exact, most), _matrix(t.column("neighbours"), np.int64), t.column("entry")[0].as_py()
                for at in range(0, len(mine), BATCH):
                    out: list[list] = [[], [], []]
                    part = asks[at : at + BATCH]
                    found, _ = beam_search(near, graph, entry, _scaled(part, most), max(beam, 2 * k))
                    for row, x, i in zip(found, part, mine[at : at + BATCH].tolist(), strict=True):
                        row = row[row >= 0]
                        score = np.sqrt(((exact[row] - x) ** 2).sum(axis=1))
                        best = np.argsort(score, kind="stable")[: k + 1]
                        for node, s in zip(row[best].tolist(), score[best].tolist(), strict=True):
                            out[0].append(names[i])
                            out[1].append(ids[node])
                            out[2].append(s)
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.float64())], names=["query_id", "ids", "score"])

        return index.mapInArrow(go, "query_id long, ids array<long>, score double")

    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    done = []
    for i in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).orderBy("query_id").toArrow()
        told = [np.array(v) for v in rows.column("query").to_pylist()]
        block = spark.sparkContext.broadcast((rows.column("query_id").to_pylist(), told))
        one = walk(block).select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
        ranked = one.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        done.append(cut(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")))
        block.destroy()
    return reduce(DataFrame.union, done)


def op5_graph_ann(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 10 nearest found of every vector whose id is divisible by 100, among all others."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(build_index(rows, "vec_id", "embedding", copies=11), rows.where(F.col("vec_id") % 100 == 0), "vec_id", "embedding", k=10)
