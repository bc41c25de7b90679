"""Operators 2 and 5 against brute force."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import ann, search


def brute_bm25(docs, queries, k):
    """query -> [(doc, score)] by plain sums."""
    tf = {d: collections.Counter(re.findall(r"\w+", (t or "").lower())) for d, t in docs}
    df = collections.Counter(w for c in tf.values() for w in c)
    length = {d: sum(c.values()) for d, c in tf.items()}
    n, mean = len(tf), max(1.0, sum(length.values()) / max(1, len(tf)))
    idf = {w: math.log(1 + (n - x + 0.5) / (x + 0.5)) for w, x in df.items()}
    out = {}
    for q in queries:
        found = []
        for d, c in tf.items():
            s = sum(m * idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length[d] / mean)) for w, m in tf[q].items() if w in c)
            if d != q and s > 0:
                found.append((-round(s, 6), d))
        out[q] = [(d, -s) for s, d in sorted(found)[:k]]
    return out


def same(got, want):
    assert {q: [d for d, _ in v] for q, v in got.items()} == {q: [d for d, _ in v] for q, v in want.items() if v}
    assert all(abs(a[1] - b[1]) < 2e-6 for q in got for a, b in zip(got[q], want[q], strict=True))


def hits(rows):
    out = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["doc_id"], r["score"]))
    return dict(out)


def test_search_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    same(hits(search.op2_bm25_search(spark, "/root/testdata/sf0.001").collect()), brute_bm25(docs, [d for d, _ in docs if d % 20 == 0], 10))


def corpus():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(60)], k=rng.randrange(1, 40)))) for i in range(300)]
    docs += [(300 + i, docs[7][1]) for i in range(30)]  # copies: ties go to the smaller ids
    return [*docs, (400, None), (420, ""), (440, "nowhere else"), (460, "?!")]


def test_search_over_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 50)
    monkeypatch.setattr(search, "BLOCK_DOCS", 8)
    monkeypatch.setattr(search, "BATCH", 4)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("terms", F.lit(0)).repartition(3)
    vectors = search.term_vectors(df, "doc_id", "text")
    for terms in (10**6, 60):
        got = hits(search.search(vectors, vectors.where("id % 20 = 0"), 5, terms).collect())
        same(got, brute_bm25(docs, [d for d, _ in docs if d % 20 == 0], 5))
    assert hits(search.top_k(df, F.col("doc_id") % 20 == 0, 5).collect()) == got


def test_scores_that_round_alike_tie(spark, monkeypatch):
    """Documents of one term and lengths so large that their scores differ behind the sixth decimal only."""
    vectors = spark.createDataFrame([(i, 1_000_000 + i, [5], [1]) for i in range(1, 301)] + [(1000, 1, [5], [1])], "id long, length int, terms array<long>, counts array<int>")
    n, mean = 301, (sum(1_000_000 + i for i in range(1, 301)) + 1) / 301
    idf = math.log(1 + 0.5 / (n + 0.5))
    score = lambda length: round(idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * length / mean)), 6)
    want = [d for _, d in sorted((-score(1_000_000 + d), d) for d in range(1, 301))[:10]]
    for docs, block in ((4096, 256), (7, 3)):
        monkeypatch.setattr(search, "SHARD_DOCS", docs)
        monkeypatch.setattr(search, "BLOCK_DOCS", block)
        for df in (vectors, vectors.orderBy(F.desc("id")).coalesce(1)):
            got = search.search(df, vectors.where("id = 1000"), 10).orderBy("rank").collect()
            assert [r["doc_id"] for r in got] == want == list(range(1, 11))


def test_blocks_that_cannot_win_are_not_read(monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", 4)
    monkeypatch.setattr(search, "DENSE", 1.0)
    docs = {bytes([i]): (10 + i, np.array([1, 2 + i]), np.array([9 if i < 4 else 1, 1]), {i}) for i in range(40)}
    q = search.QueryBlock(__import__("pyarrow").table({"query_id": [0], "terms": [[1]], "weights": [[1.0]]}))
    shard = search.Shard(docs, q.vocabulary, 20.0, 4)
    read = []
    shard.impact = type("Seen", (), {"__getitem__": lambda self, at, kept=shard.impact: read.extend(at.tolist()) or kept[at]})()
    best = np.zeros((1, 4))
    ((row, hits),) = shard.walk(q, 0, 1, best)
    assert row == 0 and sorted(d for _, d in hits) == [0, 1, 2, 3] and len(read) == 4


def test_double_scores_are_taken_of_few_pairs(monkeypatch):
    """Close scores are ranked in double precision, but the products of all pairs are in single precision."""
    monkeypatch.setattr(search, "BLOCK_DOCS", 50)
    rng = np.random.default_rng(1)
    terms = np.arange(40)
    docs = {bytes([i]): (1000, terms, rng.integers(1, 4, 40) if i % 2 else np.where(terms == i // 5, 2, 1), {i}) for i in range(200)}
    weights = 5 + rng.random(40) * 1e-6
    q = search.QueryBlock(__import__("pyarrow").table({"query_id": [0], "terms": [terms.tolist()], "weights": [weights.tolist()]}))
    shard = search.Shard(docs, q.vocabulary, 1000.0, 8)
    plain = [(round(float((weights * d[2] * 2.2 / (d[2] + 1.2)).sum()), 6), i) for i, d in enumerate(docs.values())]
    read = []
    shard.matrix = type("Seen", (), {"shape": shard.matrix.shape, "__getitem__": lambda self, at, kept=shard.matrix: read.extend(np.arange(200)[at].tolist()) or kept[at]})()
    ((row, hits),) = shard.walk(q, 0, 1, np.zeros((1, 8)))
    best = sorted(plain, key=lambda h: (-h[0], h[1]))[:8]
    assert row == 0 and set(best) <= set(hits) and len(read) < 40


def test_search_cases(spark):
    df = spark.createDataFrame([(0, "a b"), (0, "a b"), (1, "b c"), (1, "b c"), (None, "b")], "doc_id long, text string")
    rows = search.top_k(df, F.col("doc_id") == 0, 3).collect()
    assert [(r["query_id"], r["rank"], r["doc_id"]) for r in rows] == [(0, 1, 1)]
    assert search.top_k(df.limit(0), F.col("doc_id") == 0).count() == 0
    assert search.top_k(df, F.col("doc_id") == 77).count() == 0


def brute_nearest(rows, query, k):
    vec = dict(rows)
    scored = sorted((math.dist(vec[query], v), i) for i, v in rows if i != query)
    return [(i, d) for d, i in scored[:k]]


def test_ann_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = collections.defaultdict(list)
    for r in ann.op5_graph_ann(spark, sf).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    found = total = 0
    for q, mine in got.items():
        want = brute_nearest(rows, q, 10)
        found += len({i for i, _ in mine} & {i for i, _ in want})
        total += len(want)
        exact = dict(rows)
        assert all(abs(s - math.dist(exact[q], exact[i])) < 1e-9 for i, s in mine) and mine == sorted(mine, key=lambda x: (x[1], x[0]))
    assert len(got) == sum(i % 100 == 0 for i, _ in rows) and found / total >= 0.9


def test_ann_of_several_shards(spark):
    rng = np.random.default_rng(0)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(ann.build_index(df, "vec_id", "embedding", 6, shard_rows=200), df.where("vec_id < 40"), "vec_id", "embedding", 5).collect()
    found = sum(r["vec_id"] in {i for i, _ in brute_nearest(rows, r["query_id"], 5)} for r in got)
    assert len(got) == 200 and found / 200 >= 0.95


def test_ann_recall_over_shards_of_real_size(spark):
    """Clustered vectors in three shards of the production size, blocks of queries, against brute force."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    vectors = centres[rng.integers(0, 40, 10_000)] + 0.4 * rng.normal(size=(10_000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(8)
    index = ann.build_index(df, "vec_id", "embedding", 11)
    got = collections.defaultdict(list)
    for r in ann.search(index, df.where("vec_id % 100 = 0"), "vec_id", "embedding", 10, query_rows=40).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    found = 0
    for q, mine in got.items():
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        found += len(set(np.argsort(d)[:10].tolist()) & set(mine))
    assert len(got) == 100 and found / 1000 >= 0.97


def test_ann_of_very_large_components(spark):
    rows = [(i, [1e30 * i, 1e30]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(ann.build_index(df, "vec_id", "embedding", 3), df.where("vec_id = 20"), "vec_id", "embedding", 2).collect()
    assert {r["vec_id"] for r in got} == {19, 21} and all(math.isclose(r["score"], 1e30) for r in got)


def test_ann_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [0.0, 0.0]), (5, None), (6, [1.0, None]), (7, [inf, 1.0]), (8, [nan, 1.0]), (9, [1.0, 1.0, 1.0]), (1, [1.0, 0.0]), (None, [3.0, 3.0]), (10, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("ids", F.lit("clash")).withColumn("shard", F.lit(1))
    index = ann.build_index(df, "vec_id", "embedding", 3)
    got = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in ann.search(index, df, "vec_id", "embedding", 2).collect()]
    assert sorted(got) == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (1, 1, 0, 0.0), (1, 2, 2, 0.0), (2, 1, 0, 0.0), (2, 2, 1, 0.0), (3, 1, 0, 2.236068), (3, 2, 1, 2.236068)]
    empty = df.limit(0)
    assert ann.search(ann.build_index(empty, "vec_id", "embedding", 3), empty, "vec_id", "embedding", 2).count() == 0


def test_pruned_edges_are_diverse():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(60, 4)).astype(np.float32)
    nodes = np.arange(10)
    kept = ann.robust_prune(vectors, nodes, np.tile(np.arange(60), (10, 1)), 8, 1.2)
    d = lambda a, b: float(((vectors[a] - vectors[b]) ** 2).sum())
    for node, row in zip(nodes, kept, strict=True):
        row = [x for x in row if x >= 0]
        assert node not in row and len(set(row)) == len(row) and row[0] == min((x for x in range(60) if x != node), key=lambda x: d(node, x))
        assert all(1.44 * d(a, b) > d(node, b) - 1e-4 for i, b in enumerate(row) for a in row[:i])
