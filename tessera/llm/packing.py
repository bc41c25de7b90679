"""Operator 6: sum-of-squares packing of tokenised documents into sequences of a fixed length.

Each piece goes where the sum over gaps of squared counts of open bins with that gap becomes smallest, among the
open bins that have room. Pieces are dealt over shards by a hash; every shard packs its own pieces from the longest to the shortest,
so its state is one counter per gap and the work holds at any number of documents. Only documents longer
than a sequence are cut; the first piece takes the remainder.

Defined cases: null text counts as empty, and an empty document is its closing id alone; texts of any length are
encoded whole, in memory, runs of blanks of any length included; repeated rows and equal lengths each get a place of
their own; an empty table packs into nothing; other columns of the input take no part.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_checkpoints, slices
from tessera.llm.tokenizer import byte_characters

#: Pieces a shard gets on average. More pieces leave relatively fewer bins open; a shard holds ~100 bytes for each.
SHARD_PIECES = 16_384
#: Bytes of a token on average, for the number of shards before tokens are counted. A token has a byte at least, so a
#: shard gets at most so many times SHARD_PIECES on average, whatever the texts are.
TOKEN_BYTES = 4


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks and special tokens of a byte-level BPE in tokenizers' JSON; ids are the merge order."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    back = {c: b for b, c in enumerate(byte_characters())}
    return {bytes(back[c] for c in p): i for p, i in spec["model"]["vocab"].items() if p not in special}, special


class Encoder:
    """Ids of a text with special tokens read as such: by tiktoken, four times as fast, and by tokenizers where that gives up.

    tiktoken's pattern matcher refuses runs of blanks of about a million characters.
    """

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], pattern: str, vocabulary: str):
        import tiktoken

        self.fast, self.vocabulary, self.sure = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special), vocabulary, None

    def __call__(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:
            if self.sure is None:
                from tokenizers import Tokenizer

                self.sure = Tokenizer.from_str(self.vocabulary)
            return self.sure.encode(text, add_special_tokens=False).ids


def tokenise(df: DataFrame, vocabulary: str, pattern: str, capacity: int, closing_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves."""
    ranks, special = read_vocabulary(vocabulary)
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    fed = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(ranks, special, pattern, spec)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    ids = np.array([*encode(text), closing_id], dtype="<u4")
                    first = len(ids) % capacity or capacity
                    for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                        own = ids[start : first if k == 0 else start + capacity]
                        rows.append((doc, k, start, len(own), zlib.crc32(own.tobytes()), own))
                cols = list(zip(*rows, strict=True))
                ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(cols[3])]).astype("i4"), pa.array(np.concatenate(cols[5]).astype("i4")))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:5]], ids], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return fed.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the order given.

    Putting an item of length s into a bin with gap g changes the sum of squares by
    2 * (count[g - s] - count[g]) + 2; filling a bin changes it by 1 - 2 * count[s], for full bins do not count. The
    least change among the bins that have room wins, of equal changes the smallest gap; a bin is opened where none has.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n_bins = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        there = counts[s:capacity]
        gap = capacity
        if there.any():
            change = 2 * (counts[: capacity - s] - there) + 2
            change[0] -= 2 * counts[0] + 1  # a full bin adds nothing
            gap = s + int(np.where(there > 0, change, np.iinfo(np.int64).max).argmin())
        if gap == capacity:
            at, n_bins = n_bins, n_bins + 1
        else:
            at = open_bins[gap].pop()
            counts[gap] -= 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > s:
            counts[gap - s] += 1
            open_bins[gap - s].append(at)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int, n_shards: int) -> DataFrame:
    """pieces (with doc_id, piece, length) plus sequence_id and offset."""
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset", "shard")]
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*kept).schema), "sequence_id long", "offset long"])
    names = [*kept, "sequence_id", "offset"]

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.select(kept)
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = sum_of_squares(rows.column("length").to_numpy(), capacity)
        return pa.Table.from_arrays([*rows.columns, pa.array(bins + (key[0].as_py() << 40)), pa.array(offsets)], names=names)

    shard = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(max(1, n_shards)))
    return pieces.select(*kept, shard.alias("shard")).groupBy("shard").applyInArrow(place, out)


def pack_documents(df: DataFrame, vocabulary: str, pattern: str, capacity: int = 2048, closing_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise and pack df; with_ids also returns each piece's ids."""
    prepare_checkpoints(df.sparkSession)
    octets = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0))
    expected = df.agg(F.sum(F.ceil((octets + 1) / (TOKEN_BYTES * capacity)))).first()[0] or 0
    n_shards = -(-int(expected) // SHARD_PIECES)
    pieces = tokenise(df, vocabulary, pattern, capacity, closing_id, id_col, text_col)
    return pack(pieces if with_ids else pieces.drop("ids"), capacity, n_shards)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's pieces and their places in sequences of at most 2048 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
