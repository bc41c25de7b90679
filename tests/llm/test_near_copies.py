"""The pipeline's near copies against brute-force Jaccard similarity."""

from __future__ import annotations

import random

import corpus_pipeline
from tessera.llm import simhash
from tests.llm.test_duplicates import plain_fingerprint


def brute_kept(docs, radius=7):
    """Rows (doc_id, text) that stay: links within the radius of Jaccard 0.8 or more, least (doc_id, text) of each group."""
    rows = sorted({(d, t or "") for d, t in docs})
    grams = []
    for _, t in rows:
        w = t.lower().split()
        grams.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    prints = [plain_fingerprint(t, 5) for _, t in rows]
    root = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            a, b = grams[x], grams[y]
            if (prints[x] ^ prints[y]).bit_count() <= radius and 5 * len(a & b) >= 4 * len(a | b) and root[x] != root[y]:
                lo, hi = sorted((root[x], root[y]))
                root = [lo if r == hi else r for r in root]
    return {rows[x] for x in range(len(rows)) if root[x] == x}


def family(seed=4):
    """Copies edited more and more: some near by fingerprint, not by shingles."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    docs = []
    for f in range(12):
        base = [word() for _ in range(rng.choice([60, 200, 400]))]
        for k in range(9):
            text = list(base)
            for at in rng.sample(range(len(text)), len(text) * k // 120):
                text[at] = word()
            docs.append((f * 10 + k, " ".join(text)))
    return docs


def test_near_copies_are_similar(spark):
    docs = family()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute_kept(docs)
    got = corpus_pipeline.keep_one_of_copies(spark, df, "")
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == want
    by_print = simhash.near_duplicates(df, radius=7).where("doc_id = component_id").count()
    assert by_print < len(want) < len(docs)
    found = simhash.near_copies(df, block_chars=2_000)  # groups dealt over pairs of blocks
    assert {r["doc_id"] for r in found.where("doc_id = leader.doc_id").collect()} == {d for d, _ in want}


def test_no_side_of_a_join_goes_through_the_driver(spark):
    df = spark.createDataFrame(family(), "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_copies(spark, df, "")
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
