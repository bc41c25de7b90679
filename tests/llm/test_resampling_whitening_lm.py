"""Operators 11 to 13 against plain versions, and their defined cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import brown, resampling, whitening

TEXTS = [
    (1, "The cat sat on the mat. THE CAT sat"), (2, "the dog; the dog; the dog"), (3, None), (4, ""), (5, "   ...  "), (6, "Éclair ÉCLAIR éclair naïve 12 12"),
    (7, "the cat sat on the mat. the cat sat"), (8, "x" * 50), (8, "x" * 50), (None, "the cat"), (9, "日本 語 the cat 日本"), (10, "one two three four " * 300), (-5, "\x00 tab\tand\x0bmore\x1fcat"),
]


# -- operator 11


def plain_features(text, order=1):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return len(words), [" ".join(words[i : i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1)]


def plain_resample(rows, target, buckets, order, min_words, percent, seed):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(place, plain_features(text, order)[1]))
    for text in target:
        t.update(map(place, plain_features(text, order)[1]))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    out = []
    for doc, text in rows:
        n, features = plain_features(text, order)
        weight = math.floor(sum(gain(place(f)) for f in features) / len(features)) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2]))
    drawn = able[: percent * len(able) // 100]
    left = [*out]
    for r in drawn:
        left.remove(r)
    return sorted([(*r, i + 1) for i, r in enumerate(drawn)] + [(*r, None) for r in left], key=repr)


@pytest.mark.parametrize(("order", "percent", "buckets"), [(1, 40, 50), (2, 100, 997), (3, 10, 7)])
def test_resample_equals_plain(spark, order, percent, buckets):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in TEXTS], "doc_id long, text string, Rank string, score int, weight int")
    target = ["the cat", None, "", "three four one"]
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), buckets=buckets, order=order, min_words=2, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(TEXTS, target, buckets, order, 2, percent, 2024)


def test_resample_without_rows_or_target(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert resampling.resample(none, some).count() == 0
    got = resampling.resample(some, none.select("text"), buckets=5, min_words=2)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(TEXTS, [], 5, 1, 2, 10, 2024)


@pytest.mark.parametrize("order", [1, 3])
def test_features_of_pieces_are_those_of_the_whole(monkeypatch, order):
    monkeypatch.setattr(resampling, "PIECE_BYTES", 40)
    text = "The quick brown fox " * 30 + "y" * 200 + " é" * 50
    found = [b for _, part in resampling.Hasher(10_000, order)(text.encode()) for b in part.tolist()]
    assert Counter(found) == Counter(zlib.crc32(f.encode()) % 10_000 for f in plain_features(text, order)[1])
    assert sum(n for n, _ in resampling.Hasher(10_000, order)(text.encode())) == plain_features(text)[0]


def test_draw_follows_the_weights(spark):
    """Over many seeds, a document is the first drawn in proportion to exp(weight / 1000)."""
    docs = spark.createDataFrame([(1, "a a"), (2, "b b"), (3, "c c")], "doc_id long, text string")
    weights = {1: 700, 2: 0, 3: -400}
    rows = docs.withColumn("w", __import__("pyspark.sql.functions", fromlist=["lit"]).expr("CASE doc_id WHEN 1 THEN 700 WHEN 2 THEN 0 ELSE -400 END"))
    first = Counter()
    noise = rows.select("doc_id", "w", *[resampling.gumbel("doc_id", s).alias(f"g{s}") for s in range(600)]).collect()
    for s in range(600):
        first[max(noise, key=lambda r: r["w"] + r[f"g{s}"])["doc_id"]] += 1
    total = sum(math.exp(w / 1000) for w in weights.values())
    for doc, w in weights.items():
        assert abs(first[doc] / 600 - math.exp(w / 1000) / total) < 0.06


# -- operator 12


def plain_whiten(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(int) + 1_000_000
    n = len(x)
    centred = x - x.mean(axis=0)
    values, u = np.linalg.eigh(centred.T @ centred / n)
    values, u = values[::-1][:k], u[:, ::-1][:, :k]
    return values / np.trace(centred.T @ centred / n), centred @ u / np.sqrt(values), ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)


@pytest.mark.parametrize(("d", "k", "n"), [(48, 6, 400), (5, 8, 60), (12, 3, 2000)])
def test_whitening_equals_a_full_decomposition(spark, d, k, n):
    rng = np.random.default_rng(d)
    vectors = rng.standard_normal((n, d)) @ np.diag(np.linspace(3, 0.3, d)) + rng.standard_normal(d) * 5
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, N int").repartition(7)
    got = whitening.whiten(df, k=k).toPandas()
    m = min(d, k)
    explained, want, deviation = plain_whiten(vectors, m)
    assert len(got) == n * m and set(got["n"]) == {n} and got["identity_error"].max() < 1e-10
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[range(n)].to_numpy()
    assert np.abs(table * np.sign((table * want).sum(axis=0)) - want).max() < 1e-7
    assert got.groupby("vec_id")["deviation"].first().tolist() == deviation.tolist()
    assert np.abs(got.groupby("component")["explained"].first().to_numpy() - explained).max() < 1e-12


def test_iteration_takes_more_than_a_pass_and_certifies(spark):
    """With a block below the dimensions the components come from repeated passes, and a flat spectrum is told as such."""
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((3000, 60)) @ np.diag([9, 8, 7, *[1] * 57]) * 64).astype(int)
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<long>")
    centre = whitening.Centre(*whitening.sums(rows, 60))
    values, u, trace, error, passes = whitening.components(rows, centre, 60, 3)
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    assert 3 < passes < 40 and np.linalg.norm(v @ u - u * values, axis=0).max() < 1e-11 * values[0] and abs(trace / np.trace(v) - 1) < 1e-12
    with pytest.raises(RuntimeError, match="residual"):
        whitening.components(rows, centre, 60, 8, passes=3)


def test_whitening_defined_cases(spark):
    schema = "vec_id long, embedding array<float>, x int"
    inf, nan = float("inf"), float("nan")
    odd = [(1, None, 0), (2, [], 0), (3, [1.0, None, 2.0], 0), (4, [nan, 1.0, 1.0], 0), (5, [inf, 0.0, 0.0], 0), (6, [1.0, 2.0], 0), (7, [3e38, 0.0, 0.0], 0)]
    assert whitening.whiten(spark.createDataFrame(odd[:5], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 4, schema)).count() == 0
    good = [(10, [1.0, 5.0, 0.0], 0), (11, [2.0, 5.0, 1.0], 0), (None, [4.0, 5.0, -1.0], 0), (11, [2.0, 5.0, 1.0], 0), (12, [-3.0, 5.0, 0.5], 0)]
    got = whitening.whiten(spark.createDataFrame(odd + good, schema)).toPandas()
    assert len(got) == 10 and set(got["component"]) == {1, 2} and set(got["n"]) == {5}  # the second dimension has no variance
    explained, want, _ = plain_whiten([v for _, v, _ in good], 2)
    for c in (1, 2):
        assert np.allclose(sorted(got[got["component"] == c]["whitened"].abs()), sorted(np.abs(want[:, c - 1])))


def test_deviations_are_exact_or_null():
    centre = whitening.Centre(10**6, np.array([10**12 + 1, 5 * 10**11]))
    x = np.array([[10**6 + 3, 5 * 10**5], [10**6 + 4_000_000, 0]])
    exact = [sum((10**6 * a - s) ** 2 for a, s in zip(map(int, r), (10**12 + 1, 5 * 10**11), strict=True)) for r in x]
    assert centre.deviations(x) == [v if v < 2**63 else None for v in exact] and exact[1] >= 2**63


# -- operator 13


def corpus():
    rng = np.random.default_rng(5)
    nouns, verbs, ends = ["cat", "dog", "cow", "hen"], ["runs", "eats", "sees"], ["now.", "here.", "5x,"]
    rows = [(i, " ".join(" ".join([rng.choice(["the", "a"]), rng.choice(nouns), rng.choice(verbs), rng.choice(ends)]) for _ in range(rng.integers(1, 6)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "the Cat"), (202, "zyx unseen word the"), (3, "the the the the"), (203, "\t\n"), (9, "ÉÉ rare-one")]
    return rows


def tokens(text):
    return [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))] + [b""]


def shape(word):
    if word[-1:] in b".!?":
        return 2
    if word[-1:] in b",;:":
        return 3
    return 0 if word.isalpha() else 1 if re.search(rb"[0-9]", word) else 4


def is_held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def test_scores_equal_a_plain_model(spark, monkeypatch):
    found = {}
    exchange = brown.exchange
    monkeypatch.setattr(brown, "exchange", lambda *a, **k: found.setdefault("r", exchange(*a, **k)))
    rows, k, frequent, prior = corpus(), 4, 1 / 60, 3.0
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, Score int").repartition(5)
    got = brown.score_corpus(df, classes=k, rounds=8, frequent=frequent, prior=prior).collect()
    c, pairs = Counter(), Counter()
    for doc, text in rows:
        if not is_held(doc):
            c.update(tokens(text))
            pairs.update(zip([b"", *tokens(text)], tokens(text), strict=False))
    total, distinct = sum(c.values()), len(c)
    head = sorted((w for w in c if w and c[w] >= total * frequent), key=lambda w: (-c[w], w))
    assert 8 < len(head) < len(c) - 2
    of_number, m, told = found["r"]
    assert all(b >= a for a, b in zip(told, told[1:], strict=False)) and told[-1] > told[0]
    cls = lambda w: int(of_number[brown.END + 1 + head.index(w)]) if w in head else shape(w) if w else brown.END
    n_classes = brown.END + 1 + k
    between, size = Counter(), Counter()
    for (a, b), n in pairs.items():
        between[cls(a), cls(b)] += n
    for w, n in c.items():
        size[cls(w)] += n
    assert all(m[i, j] == between[i, j] for i in range(n_classes) for j in range(n_classes))
    once = Counter(shape(w) for w, n in c.items() if n == 1 and w and w not in head)

    def p(b, a):
        ca, cb = cls(a), cls(b)
        after = sum(between[ca, j] for j in range(n_classes))
        own = (size[cb] + 1) / (total + n_classes)
        turn = (between[ca, cb] + prior * own) / (after + prior)
        if cb < brown.SHAPES:
            unseen = once[cb] + 1
            return turn * (c[b] or unseen) / (size[cb] + unseen)
        return turn * c[b] / size[cb]

    for a in (b"", b"the", b"now.", b"zyx"):  # the known, the end, and the unseen of each shape
        assert abs(sum(p(b, a) for b in [*c, b"qq", b"q7", b"q.", b"q,", b"q-"]) - 1) < 1e-12
    want = []
    for doc, text in rows:
        t = tokens(text)
        want.append((doc, is_held(doc), len(t), sum(w in c for w in t), total, sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in t), sum(math.log10(p(b, a)) for a, b in zip([b"", *t], t, strict=False))))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-9 and abs(g[6] - w[6]) < 1e-9 and abs(g[7] / 10 ** (-w[6] / w[2]) - 1) < 1e-9


def test_best_class_equals_counting_anew():
    rng = np.random.default_rng(2)
    n, k, first = 14, 4, 2
    pairs = rng.integers(0, 9, (n, n)) * (rng.random((n, n)) < 0.5)
    pairs[n - 1] += pairs.sum(axis=0) - pairs.sum(axis=1) - min(0, (pairs.sum(axis=0) - pairs.sum(axis=1)).min())
    of = np.concatenate([np.arange(first), first + np.arange(n - first) % k])

    def counted(of):
        m = np.zeros((first + k, first + k))
        np.add.at(m, (of[:, None], of[None, :]), pairs)
        return m

    for w in range(first, n):
        others = np.arange(n) != w
        left, right = (np.bincount(of[others], weights=x[others], minlength=first + k) for x in (pairs[:, w], pairs[w]))
        to, gain = brown.best_class(counted(of), int(of[w]), left, right, float(pairs[w, w]), first)
        tried = []
        for c in range(first, first + k):
            moved = of.copy()
            moved[w] = c
            tried.append(brown.likelihood(counted(moved)))
        assert abs(tried[to - first] - max(tried)) < 1e-8 and abs(max(tried) - tried[int(of[w]) - first] - gain) < 1e-8


def test_exchange_finds_the_kinds_of_words_and_helps(spark):
    """Words of one kind come together, and held-out texts are likelier than under single words."""
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    got = brown.score_corpus(df, classes=5, rounds=16, frequent=1 / 100).where("held_out and n_tokens = n_known and n_tokens > 4").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    assert got["sum(score)"] > 0.75 * got["sum(base_score)"]


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    one, many = (sorted((r["doc_id"] or -1, r["n_tokens"], round(r["score"], 9)) for r in brown.score_corpus(d, classes=4, rounds=4, frequent=0.01).collect()) for d in (df.coalesce(1), df.repartition(9, "text")))
    assert one == many


def test_tokens_are_those_of_the_pattern():
    texts = ["  Alpha\tBETA\x0bÉa\x1fb \u00a0 c\n", None, "", "   ", "the The THE x", *(f"a{chr(i)}b" for i in range(1, 200))]
    made = brown.Tokens(pa.array(texts))
    at, text = made.numbered(brown.END + 1 + np.arange(len(made.words)))
    words = [*[b""] * (brown.END + 1), *(w.encode() for w in made.words.to_pylist())]
    assert [[words[k] for k, j in zip(at, text, strict=True) if j == i] for i in range(len(texts))] == [tokens(t) for t in texts]


def test_shapes_of_words():
    words = ["abc", "a1", "1", "a.", "é.", "x,", "é", "a-b", "日本", "5!", "-", "É9"]
    assert brown.shapes(pa.array(words)).tolist() == [shape(w.encode()) for w in words] and len(brown.shapes(pa.array([], pa.string()))) == 0


def test_without_training_texts(spark):
    held = next(i for i in range(100) if is_held(i))
    got = brown.score_corpus(spark.createDataFrame([(held, "a b.")], "doc_id long, text string")).first()
    assert got["train_tokens"] == 0 and got["n_known"] == 0 and got["base_score"] == 0 and got["score"] < 0
    assert brown.score_corpus(spark.createDataFrame([], "doc_id long, text string")).count() == 0
