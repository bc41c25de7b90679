"""Operators 3 and 10 against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import components as comp
from tessera.llm import simhash, substrings
from tessera.llm.components import components


def brute_repeats(docs, threshold):
    """(n_bytes, n_removed, n_spans, kept) of texts in the order of their ids."""
    seen, out = {}, {}
    for doc, text in sorted(docs, key=lambda x: (x[0] is None, x[0])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - threshold + 1):
            w = raw[p : p + threshold]
            if seen.setdefault(w, (doc, p)) != (doc, p):
                gone[p : p + threshold] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[doc] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randrange(1, 9)))
    base = ["".join(word() for _ in range(120)) for _ in range(6)]
    docs = [(i, rng.choice(base)[: rng.randrange(0, 500)] + "".join(word() for _ in range(rng.randrange(30))) + rng.choice(base)[rng.randrange(200) :]) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "x" * 700), (103, "x" * 99), (104, "ab" * 300), (105, docs[3][1]), (106, docs[3][1]), (None, docs[4][1])]
    return docs


def test_suffix_dedup(spark, tmp_path):
    docs = texts()
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("kept", F.lit(1)).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.op3_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == brute_repeats(docs, 100) and sum(v[1] for v in got.values()) > 0


def test_suffix_dedup_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(substrings, "EMIT_ROWS", 3)
    docs = texts()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rng = random.Random(9)
    shared = "".join(rng.choice("abcdefgh") for _ in range(400))
    docs += [(2000 + k, shared[:180] + f"{k:010d}" + shared[190:]) for k in range(5)]  # windows that differ in their middle only
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for threshold in (40, 130, 200, 300):
        got = {r["doc_id"]: len(r["kept"]) for r in substrings.deduplicate(df, threshold).collect()}
        assert got == {k: v[0] - v[1] for k, v in brute_repeats(docs, threshold).items()}


def test_suffix_dedup_cases(spark):
    df = spark.createDataFrame([(1, "q" * 150, "z"), (1, "q" * 150, "z")], "doc_id long, text string, DOC string")
    rows = substrings.deduplicate(df, 100).collect()
    assert [len(r["kept"]) for r in rows] == [0 + 100 - 99, 0 + 100 - 99] or rows[0]["kept"] == rows[1]["kept"]
    assert substrings.deduplicate(df.limit(0), 100).count() == 0
    cut = spark.createDataFrame([(1, "é" * 80), (2, "a" + "é" * 80)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in substrings.deduplicate(cut, 100, as_text=True).collect()}[2] == "a"
    with pytest.raises(ValueError, match="threshold"):
        substrings.deduplicate(df, 8)


def test_long_texts_are_cut_in_stretches(monkeypatch):
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = substrings.representatives(raw, 60)
    monkeypatch.setattr(substrings, "STRETCH", 700)
    parts = substrings.representatives(raw, 60)
    covered = lambda r: np.concatenate([np.arange(s, s + n) for s, n in zip(r[1], r[2], strict=True)]).tolist()
    assert covered(whole) == covered(parts) == list(range(5000 - 59))
    chosen = lambda r: np.repeat(r[1] + r[3], r[2]).tolist()
    assert chosen(whole) == chosen(parts)


def plain_fingerprint(text, words):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    parts = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark, tmp_path):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "İ É x y z"), (1006, docs[5][1] + " tail"), (1007, docs[5][1])]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("FP", F.lit(0)).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.op10_simhash(spark, str(tmp_path)).collect()}
    prints = {d: plain_fingerprint(t, 4) for d, t in docs}
    roots = brute_components(prints, 4)
    assert got == {d: (prints[d], roots[d]) for d in prints}


@pytest.mark.parametrize("bucket_rows", [8192, 20])
def test_links_of_dense_groups(spark, bucket_rows):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    near = {centre ^ sum(1 << b for b in rng.sample(range(12), rng.randrange(6))) for _ in range(150)} | {rng.getrandbits(64) for _ in range(200)}
    far = rng.getrandbits(64)
    near |= {far, far ^ 0b1111, far ^ 0b11111110000}
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    df = spark.createDataFrame([(x, x) for x in signed], "fp long, root long")
    pairs = simhash.links(df, 4, bucket_rows).collect()
    assert all(((r["a"] ^ r["b"]) & ((1 << 64) - 1)).bit_count() <= 4 for r in pairs)
    want = brute_components(dict(zip(range(len(signed)), near, strict=True)), 4)
    size = lambda roots: sorted(list(roots).count(r) for r in set(roots))
    for step in (31, 5):
        assert size([r["root"] for r in simhash.connect(df.select("fp"), 4, bucket_rows, step).collect()]) == size(want.values())


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=7))
@settings(max_examples=300, deadline=None)
def test_every_close_pair_meets_in_a_table(x, bits):
    y = x ^ sum(1 << b for b in bits)
    for radius in range(max(1, len(bits)), 8):
        assert any(x & m == y & m for m in simhash.covering_masks(radius))


@pytest.mark.parametrize("radius", range(1, 9))
def test_tables_keep_about_half_the_bits(radius):
    kept = [m.bit_count() for m in simhash.covering_masks(radius)]
    assert len(kept) == 2 ** (radius + 1) - 1 and min(kept) >= 20


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_take_few_steps(spark, monkeypatch):
    """What fits a task is done in two written tables, however long its paths; more edges meet in blocks, step by step."""
    made = []
    monkeypatch.setattr(comp, "cut", lambda df, cut=comp.cut: made.append(1) or cut(df))
    order = random.Random(3).sample(range(500), 500)
    pairs = list(zip(order, order[1:], strict=False))
    few = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    assert {r["root"] for r in components(few).collect()} == {0} and len(made) == 2
    rng = random.Random(7)
    many = [(rng.randrange(900), rng.randrange(900)) for _ in range(500)]
    root = brute_roots(many + pairs[:200])
    monkeypatch.setattr(comp, "TASK_EDGES", 60)
    got = components(spark.createDataFrame(many + pairs[:200], "a long, b long").repartition(6)).collect()
    assert len(got) == len(root) and {r["node"]: r["root"] for r in got} == root and len(made) > 4


def brute_roots(edges):
    root = {x: x for e in edges for x in e}
    for a, b in edges:
        lo, hi = sorted((root[a], root[b]))
        root = {x: lo if r == hi else r for x, r in root.items()}
    return root


def test_no_side_of_a_join_goes_through_the_driver(spark):
    """At the default threshold of broadcasts: the driver would build and keep each side."""
    df = spark.createDataFrame([(i, f"w{i % 40} x{i % 3} y z") for i in range(200)], "doc_id long, text string")
    for found in (simhash.near_duplicates(df, words=2), simhash.near_copies(df, words=2)):
        found.collect()
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_simhash_cases(spark):
    df = spark.createDataFrame([(None, "same text here"), (7, "same text here"), (7, "same text here"), (None, "alone it is, quite")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df, words=2).collect()), key=str)
    assert got == [(7, 7), (7, 7), (None, 7), (None, None)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
