"""Operator 1: byte-level BPE encoding and decoding through a sentencepiece model built from a rank file.

The model is serialised directly: every ranked byte string becomes a piece of printable characters (one per
byte) whose score is the negative rank, with identity normalisation and no dummy prefix, so sentencepiece's
best-score-first merges are the rank-ordered merges of a byte-level BPE. Pre-tokens are encoded one by one;
a pre-token that is itself a ranked string is that one id. Decoding is the inverse mapping id -> bytes.

Defined cases: null text counts as empty and gives no ids; an empty list (or null) decodes to empty bytes;
repeated rows and ties each give their own result row; an empty table gives an empty table; columns of the
output names that exist already are replaced, all others are kept.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_columns

#: Encoded pre-tokens a task remembers; beyond this it starts afresh. It bounds memory, not results.
CACHE_SIZE = 200_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable in Latin-1, else the next free one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: a base64 byte string and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    chars = byte_characters()
    model = pb.ModelProto()
    for piece, rank in by_rank:
        model.pieces.add(piece="".join(chars[b] for b in piece), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(by_rank) + 1
    model.trainer_spec.unk_id = len(by_rank)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Encoder:
    """Encodes texts to ids, pre-token by pre-token."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.find = regex.compile(pattern).findall
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ranks = ranks
        self.to_chars = dict(enumerate(byte_characters()))
        self.forget()

    def forget(self) -> None:
        """Start afresh: codes of pre-tokens, and by code the place of their ids in one flat array."""
        self.code: dict[str, int] = {}
        self.ids, self.start, self.size = np.empty(1 << 16, np.int32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    def learn(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        ranks = list(map(self.ranks.get, raw))
        mapped = [b.decode("latin-1").translate(self.to_chars) for b, r in zip(raw, ranks, strict=True) if r is None]
        merged = iter(self.processor.encode(mapped, num_threads=1) if mapped else ())
        found = [next(merged) if r is None else (r,) for r in ranks]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32)
        at, known = np.cumsum(size) - size + self.used, len(self.code)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while known + len(pieces) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.ids[self.used : self.used + len(flat)] = flat
        self.start[known : known + len(pieces)], self.size[known : known + len(pieces)] = at, size
        self.used += len(flat)
        self.code.update(zip(pieces, range(known, known + len(pieces)), strict=True))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts' ids, and the ids of all texts in a row."""
        split = [self.find(t) if t else [] for t in texts]
        if len(self.code) > CACHE_SIZE:
            self.forget()
        if new := set(chain.from_iterable(split)).difference(self.code):
            self.learn(list(new))
        codes = np.fromiter(map(self.code.__getitem__, chain.from_iterable(split)), np.int64)
        size = self.size[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.start[codes] - ends[:-1], size) + np.arange(ends[-1])]
        return ends[np.cumsum([0, *map(len, split)])].astype(np.int32), ids


@lru_cache(maxsize=4)
def _ranks_and_model(path: str) -> tuple[dict[bytes, int], bytes]:
    ranks = read_ranks(path)
    return ranks, serialise_model(ranks)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: Column | str = "text", out: str = "ids") -> DataFrame:
    """df plus out array<int>: the ids of each whole text."""
    ranks, model = _ranks_and_model(ranks_path)
    text = F.col(text) if isinstance(text, str) else text

    def make():
        encoder = Encoder(model, ranks, pattern)
        return lambda texts: [pa.ListArray.from_arrays(*map(pa.array, encoder(texts.to_pylist())))]

    return add_columns(df, [text], [T.StructField(out, T.ArrayType(T.IntegerType()))], make, as_arrow=True)


def decode(df: DataFrame, ranks_path: str, ids: Column | str = "ids", out: str = "decoded") -> DataFrame:
    """df plus out binary: the bytes that the ids stand for (unknown ids raise)."""
    ranks, _ = _ranks_and_model(ranks_path)
    ids = F.col(ids) if isinstance(ids, str) else ids

    def make():
        pieces = {rank: piece for piece, rank in ranks.items()}
        look = pieces.__getitem__

        def row(lists: pa.ListArray) -> list:
            flat = lists.flatten().to_numpy(zero_copy_only=False).tolist()
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
            return [[b"".join(map(look, flat[a:b])) for a, b in zip([0, *ends], ends, strict=False)]]

        return row

    return add_columns(df, [ids], [T.StructField(out, T.BinaryType())], make, as_arrow=True)


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query: ids of every whole document, their digest, and the digest of the decoded bytes."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = decode(encode(docs, path, public_tokenizers.PATTERN).drop("text"), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
