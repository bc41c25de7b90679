"""Operators 1 and 6 against the libraries that define their ids, and packing against its own rules."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing, tokenizer

MULTI, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
TEXTS = ["", " ", "a", "Hello world", "it's  12345 naïve\n\n\tçà", "x" * 5000, "日本語テキスト 123", "'s 'S", "  x", "<|endoftext|> b", "🙂🙂 é", "\x00\x1c\x85", "a\r\n\r\n b   "]


@pytest.fixture(scope="module")
def tools():
    ranks = tokenizer.read_ranks(MULTI)
    own = tokenizer.Encoder(tokenizer.serialise_model(ranks), ranks, P.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(own, texts):
    at, flat = own(texts)
    return [flat[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]


@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"])), max_size=5))
@settings(max_examples=200, deadline=None)
def test_encoder_equals_tiktoken(tools, texts):
    own, other = tools
    assert ids(own, texts) == [other.encode_ordinary(t) for t in texts]


def test_encoder_forgets_without_harm(tools, monkeypatch):
    own, other = tools
    monkeypatch.setattr(tokenizer, "CACHE_SIZE", 3)
    for t in TEXTS:
        assert ids(own, [t]) == [other.encode_ordinary(t)]


def test_letters_and_numbers_are_told_apart_alike(tools):
    own, other = tools
    every = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(every[i : i + 64]) for i in range(0, len(every), 64)] + [f"a{c} {c}1" for c in every[::7]]
    assert ids(own, texts) == [other.encode_ordinary(t) for t in texts]


def test_round_trip_and_query(spark, tools, tmp_path):
    rows = [*enumerate(TEXTS), (99, None), (3, "Hello world")]
    df = spark.createDataFrame([(i, t, "old", "y") for i, t in rows], "doc_id long, text string, ids string, N_TOKENS string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = tokenizer.op1_byte_bpe(spark, str(tmp_path)).collect()
    want = sorted((i, *(lambda x: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()))(tools[1].encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert tokenizer.encode(df, MULTI, P.PATTERN).columns == ["doc_id", "text", "N_TOKENS", "ids"]
    assert tokenizer.encode(df.limit(0), MULTI, P.PATTERN).count() == 0
    lists = spark.createDataFrame([([0, 1],), ([],), (None,)], "ids array<int>")
    assert sorted(r["decoded"] for r in tokenizer.decode(lists, MULTI).collect())[:2] == [b"", b""]


def check_packing(rows, documents, capacity):
    """Pieces rebuild the ids of every document, sequences are gapless and within the capacity."""
    tk = Tokenizer.from_file(JSON)
    want, have = [], []
    for doc, text in documents:
        own = np.array([*tk.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(own) % capacity or capacity
        for k, a in enumerate([0, *range(first, len(own), capacity)]):
            part = own[a : first if k == 0 else a + capacity]
            want.append((doc, k, a, len(part), zlib.crc32(part.tobytes())))
    places: dict = {}
    for r in rows:
        have.append((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(have) == sorted(want)
    for seq in places.values():
        at = 0
        for offset, n in sorted(seq):
            assert offset == at
            at += n
        assert at <= capacity
    return len(places), sum(w[3] for w in want)


def test_packing(spark):
    docs = [*enumerate(TEXTS), (99, None), (3, "Hello world"), (100, "word " * 7000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("offset", F.lit("clash")).withColumn("Shard", F.lit(1))
    rows = packing.pack_documents(df, JSON, P.PATTERN, 64).collect()
    n, total = check_packing(rows, docs, 64)
    assert n <= total / 64 + 4
    assert packing.pack_documents(df.limit(0), JSON, P.PATTERN, 64).count() == 0
    some = packing.pack_documents(df, JSON, P.PATTERN, 64, with_ids=True).where("doc_id = 100").first()
    assert len(some["ids"]) == some["length"]


def test_packing_query_wastes_little(spark):
    sf = "/root/testdata/sf0.01"
    rows = packing.op6_best_fit_packing(spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    n, total = check_packing(rows, docs, 2048)
    assert n <= total / 2048 * 1.003 + 1


def test_long_runs_of_blanks(spark):
    """tiktoken refuses these texts; tokenizers does not."""
    docs = [(i, c * 2_000_000) for i, c in enumerate(" \n\t")] + [(9, "a" + " " * 1_200_000 + "<|endoftext|>b")]
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), JSON, P.PATTERN).collect()
    check_packing(rows, docs, 2048)


def test_shards_follow_the_pieces(spark, monkeypatch):
    """Few long documents are many pieces: a shard gets a bounded number of them."""
    monkeypatch.setattr(packing, "SHARD_PIECES", 16)
    df = spark.createDataFrame([(i, "a b c " * 4_000) for i in range(20)], "doc_id long, text string")
    rows = packing.pack_documents(df, JSON, P.PATTERN, 256).collect()
    sizes = np.bincount([r["sequence_id"] >> 40 for r in rows])
    assert len(rows) > 900 and len(sizes) > 20 and sizes.max() <= 16 * packing.TOKEN_BYTES * 2


@given(st.lists(st.integers(1, 20), max_size=80))
@settings(max_examples=200, deadline=None)
def test_sum_of_squares_takes_the_least_change(lengths):
    capacity, gaps = 20, []
    bins, offsets = packing.sum_of_squares(np.array(lengths, dtype=np.int64), capacity)

    def total(g):
        counts = np.bincount([x for x in g if x > 0], minlength=capacity + 1)
        return int((counts[1:] ** 2).sum())

    for i, s in enumerate(lengths):
        options = {total([*gaps[:k], g - s, *gaps[k + 1 :]]) for k, g in enumerate(gaps) if g >= s} or {total([*gaps, capacity - s])}
        if bins[i] == len(gaps):
            assert offsets[i] == 0
            gaps.append(capacity - s)
        else:
            assert offsets[i] == capacity - gaps[bins[i]] and gaps[bins[i]] >= s
            gaps[bins[i]] -= s
        assert total(gaps) == min(options)
