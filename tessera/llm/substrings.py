"""Operator 3: exact-substring deduplication by prefix doubling over distributed (rank, position) rows.

Ranks are names: equal strings have equal 64-bit names, and the name of a string twice as long is made from
the pair of names at its two halves (the doubling step, done inside a document, whose text a task holds
whole). Spark sorts (name, position) rows at growing lengths, and what turns out unique leaves:

1. length 32: every threshold-long window is represented by its least 32-byte name (the leftmost, if equal).
   Equal windows have equal representatives, so only representatives are sorted, about one byte in 35.
   A name seen once proves all its windows unique.
2. the whole stretch of windows that one representative stands for: a stretch seen earlier is a copy, and all
   its windows are removed at once. Copies of documents end here, whatever their number.
3. the threshold itself: of the first stretches whose name recurs with different surroundings, every window is
   named by the hashes of the 64-byte parts that cover it (two at 100 bytes) and sorted once more.

The sorts stream: a task remembers the last row only, so a name shared by a third of all rows needs no memory;
repeats inside a batch are settled before the shuffle.

Defined cases: null text counts as empty; texts under the threshold lose nothing; matches never cross texts;
among equal strings the one with the smallest (id, start) stays; rows with a null id come after all others;
rows that repeat an id and text are one document told twice, and each gets the same result; rows that share
an id only are kept apart by a digest of their text; an empty table gives an empty table; further columns are
kept, but for those of the output's names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_columns, bound_batches, cut_table, without

#: Bytes of the strings whose names are sorted first.
FIRST = 32
#: Windows of a text handled at once; it bounds a task's memory, not what is found.
STRETCH = 1 << 19

#: Texts among which repeats are settled before the shuffle.
EMIT_ROWS = 1_024
#: Bytes of the parts whose hashes name a window; as many as cover it.
PART = 64
#: Neighbouring windows that are sorted in one task.
SLOT = 8
#: Columns that the operator adds for itself.
_DOC, _TAG, _SPANS = "__tessera_doc", "__tessera_tag", "__tessera_spans"
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64((1 << 20) - 1)


def names(data: np.ndarray, length: int) -> np.ndarray:
    """Name of the string of the given length at each position, by doubling pairs of names."""
    h, done = (data.astype(np.uint64) + np.uint64(1)) * _MIX, 1
    while done < length:
        step = min(done, length - done)
        h = (h[:-step] ^ (h[:-step] >> np.uint64(31))) * _ODD + h[step:]
        h = (h ^ (h >> np.uint64(29))) * _MIX
        h ^= h >> np.uint64(32)
        done += step
    return h


def representatives(data: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, windows, place in the first window) of each stretch of windows with one representative."""
    width = threshold - FIRST + 1
    parts = []
    for at in range(0, len(data) - threshold + 1, STRETCH):
        h = names(data[at : at + STRETCH + threshold - 1], FIRST)
        least, done = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64), 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        chosen = (least & _LOW).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        place = chosen[start]
        parts.append((h[place], start + at, np.diff(np.append(start, len(chosen))), place - start))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _merge(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows that touch or overlap, joined."""
    if not len(doc):
        return doc, tag, start, n
    order = np.lexsort((start, tag, doc))
    doc, tag, start, n = doc[order], tag[order], start[order], n[order]
    end = start + n
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > end[:-1])
    head = np.flatnonzero(new)
    return doc[head], tag[head], start[head], np.maximum.reduceat(end, head) - start[head]


_ROWS = ["key", "span", "doc", "tag", "start", "n", "place"]
_ROW_TYPES = "key long, span long, doc long, tag long, start long, n int, place int"
#: In `place`: the windows are known copies already.
_SETTLED = -1


def _rows(cols: list[np.ndarray]) -> pa.RecordBatch:
    kinds = [np.int64] * 5 + [np.int32] * 2
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).astype(k, copy=False)) for c, k in zip(cols, kinds, strict=True)], names=_ROWS)


def _emit(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Representatives of every text; copies within a batch are settled here."""
    from xxhash import xxh64_intdigest

    for batch in (b.slice(at, EMIT_ROWS) for b in batches for at in range(0, b.num_rows, EMIT_ROWS)):
        got: list[list[np.ndarray]] = []
        for doc, tag, text in zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), batch.column("text"), strict=True):
            raw = text.as_buffer().to_pybytes()
            if len(raw) < threshold:
                continue
            key, start, n, place = representatives(np.frombuffer(raw, np.uint8), threshold)
            ends = (start + n - 1 + threshold).tolist()
            span = np.fromiter((xxh64_intdigest(raw[a:b], p) for a, b, p in zip(start.tolist(), ends, place.tolist(), strict=True)), np.uint64, len(start))
            got.append([key.view(np.int64), span.view(np.int64), np.full(len(key), doc), np.full(len(key), tag), start, n, place])
        if not got:
            continue
        cols = [np.concatenate(c) for c in zip(*got, strict=True)]
        order = np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))
        cols = [c[order] for c in cols]
        again = np.zeros(len(order), bool)
        again[1:] = (cols[0][1:] == cols[0][:-1]) & (cols[1][1:] == cols[1][:-1]) & ~_same_place(cols, slice(1, None), slice(None, -1))
        if again.any():
            # a row equal to the first of its group in every way (a document told twice) is no later copy
            head = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
            again &= ~_same_place(cols, slice(None), head)
            doc, tag, start, n = _merge(*[c[again] for c in cols[2:6]])
            none = np.full(len(doc), _SETTLED)
            yield _rows([(doc * 31 + start) ^ tag, start, doc, tag, start, n, none])
        yield _rows([c[~again] for c in cols])


def _same_place(cols: list[np.ndarray], a, b) -> np.ndarray:
    return (cols[2][a] == cols[2][b]) & (cols[3][a] == cols[3][b]) & (cols[4][a] == cols[4][b])


def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (key, span, doc, tag, start): later copies of a stretch are settled, first stretches whose
    key has others go on with their key, the rest is unique and leaves. State: the first row of the current stretch,
    and the last first row with whether its key was met before."""
    first: list[int] | None = None
    waiting: tuple[list[int], bool] | None = None
    for batch in batches:
        cols = [c.to_numpy() for c in batch.columns]
        known = cols[6] == _SETTLED
        if known.any():
            yield _rows([c[known] for c in cols])
            cols = [c[~known] for c in cols]
        if not len(cols[0]):
            continue
        new = np.ones(len(cols[0]), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        if first is not None:
            new[0] = first[0] != cols[0][0] or first[1] != cols[1][0]
        at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        head = [np.where(at >= 0, c[np.maximum(at, 0)], 0 if first is None else first[i]) for i, c in enumerate(cols)]
        later = ~new & ~((cols[2] == head[2]) & (cols[3] == head[3]) & (cols[4] == head[4]))
        if later.any():
            doc, tag, start, n = _merge(*[c[later] for c in cols[2:6]])
            none = np.full(len(doc), _SETTLED)
            yield _rows([none, none, doc, tag, start, n, none])
        first = [int(c[-1]) for c in head]
        heads = [c[new] for c in cols]
        if not len(heads[0]):
            continue
        if waiting is not None:
            heads = [np.concatenate([[w], c]) for w, c in zip(waiting[0], heads, strict=True)]
        same = heads[0][1:] == heads[0][:-1]
        before = np.concatenate([[waiting[1] if waiting is not None else False], same])
        after = np.append(same, False)
        goes = (before | after)[:-1]
        waiting = ([int(c[-1]) for c in heads], bool(before[-1]))
        if goes.any():
            yield _rows([c[:-1][goes] for c in heads])
    if waiting is not None and waiting[1]:
        yield _rows([np.array([w]) for w in waiting[0]])


def _windows(batches: Iterator[pa.RecordBatch], threshold: int, text_at: int) -> Iterator[pa.RecordBatch]:
    """A row (key, name, doc, tag, start, slot) for every window of the stretches that went on.

    Equal windows have their representative at the same distance, whose SLOT-th part is the slot: a name that many
    stretches share is dealt over its slots, and windows that follow each other mostly stay together.
    """
    from xxhash import xxh64_intdigest

    half = min(PART, threshold)
    shifts = sorted({min(k, threshold - half) for k in range(0, threshold, half)})
    for batch in batches:
        for doc, tag, text, spans in zip(batch.column(_DOC), batch.column(_TAG), batch.column(text_at), batch.column(_SPANS), strict=True):
            raw, doc, tag = text.as_buffer().to_pybytes(), doc.as_py(), tag.as_py()
            out: list[list[np.ndarray]] = []
            for s in spans.as_py():
                a, n = s["start"], s["n"]
                name = np.zeros(n, np.uint64)
                for shift in shifts:
                    own = np.fromiter((xxh64_intdigest(raw[p : p + half]) for p in range(a + shift, a + shift + n)), np.uint64, n)
                    name = (name ^ (name >> np.uint64(31))) * _ODD + own
                    name = (name ^ (name >> np.uint64(29))) * _MIX
                out.append([np.full(n, s["key"]), name.view(np.int64), np.full(n, doc), np.full(n, tag), np.arange(a, a + n), (s["place"] - np.arange(n)) // SLOT])
            cols = [np.concatenate(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["key", "name", "doc", "tag", "start", "slot"])


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (key, name, doc, tag, start): runs of the windows that are not the first of their name."""
    first: list[int] | None = None
    for batch in batches:
        cols = [c.to_numpy() for c in batch.columns]
        if not len(cols[0]):
            continue
        new = np.ones(len(cols[0]), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        if first is not None:
            new[0] = first[0] != cols[0][0] or first[1] != cols[1][0]
        at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        head = [np.where(at >= 0, c[np.maximum(at, 0)], 0 if first is None else first[i]) for i, c in enumerate(cols)]
        later = ~new & ~((cols[2] == head[2]) & (cols[3] == head[3]) & (cols[4] == head[4]))
        first = [int(c[-1]) for c in head]
        if later.any():
            doc, tag, start = (c[later] for c in cols[2:5])
            doc, tag, start, n = _merge(doc, tag, start, np.ones(len(doc), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(start), pa.array(n.astype(np.int32))], names=["doc", "tag", "start", "n"])


def removed_spans(runs: list[dict] | None, threshold: int) -> list[tuple[int, int]]:
    """Maximal removed runs [start, end) of bytes, from runs of removed windows."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["start"], r["start"] + r["n"] - 1 + threshold) for r in runs or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def deduplicate(df: DataFrame, threshold: int = 100, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """df plus removed_spans array<struct<start, end>> (bytes) and kept binary: the bytes that stay.

    as_text gives kept as a string instead, without the pieces of characters that the cuts leave.
    """
    if threshold < FIRST:
        raise ValueError(f"threshold must be {FIRST} or more")
    bound_batches(df.sparkSession)
    # null ids come last: they are told apart from the largest id by their tag only
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = without(df, ["removed_spans", "kept"])
    told = rows.withColumn(_DOC, doc).withColumn(_TAG, F.xxhash64(text))
    texts = told.select(F.col(_DOC).alias("doc"), F.col(_TAG).alias("tag"), text.cast("binary").alias("text"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    emitted = texts.mapInArrow(lambda it: _emit(it, threshold), _ROW_TYPES)
    by_name = emitted.repartition(n, "key").sortWithinPartitions("key", "span", "doc", "tag", "start")
    stretches = cut_table(by_name.mapInArrow(_sieve, _ROW_TYPES))

    # both joins read the very same exchange of the texts: it is written once
    still = stretches.where(F.col("place") != _SETTLED).groupBy(F.col("doc").alias(_DOC), F.col("tag").alias(_TAG)).agg(F.collect_list(F.struct("start", "n", "place", "key")).alias(_SPANS))
    at = [*told.columns].index(text_col)
    windows = told.join(still, [_DOC, _TAG]).select(*[F.col(f"`{c}`") for c in told.columns], _SPANS)
    windows = windows.mapInArrow(lambda it: _windows(it, threshold, at), "key long, name long, doc long, tag long, start long, slot long")
    by_window = windows.repartition(n, "key", "slot").sortWithinPartitions("key", "name", "doc", "tag", "start")
    runs = by_window.mapInArrow(_repeats, "doc long, tag long, start long, n int")
    all_runs = stretches.where(F.col("place") == _SETTLED).select("doc", "tag", "start", "n").union(runs)
    by_doc = all_runs.groupBy(F.col("doc").alias(_DOC), F.col("tag").alias(_TAG)).agg(F.collect_list(F.struct("start", "n")).alias(_SPANS))
    met = told.join(by_doc, [_DOC, _TAG], "left")

    fields = [
        T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
    ]

    def apply():
        def row(texts: list[str], runs: list[list[dict] | None]) -> list[list]:
            spans, kept = [], []
            for text, found in zip(texts, runs, strict=True):
                raw, gone = text.encode(), removed_spans(found, threshold)
                edges = [0, *(x for span in gone for x in span), len(raw)]
                spans.append([{"start": a, "end": b} for a, b in gone])
                stays = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                kept.append("".join(raw[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], edges[1::2], strict=True)) if as_text else stays)
            return [spans, kept]

        return row

    return add_columns(met, [text, F.col(_SPANS)], fields, apply).drop(_DOC, _TAG, _SPANS)


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: bytes, removed bytes and runs, and a digest of what stays, for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = deduplicate(docs, 100)
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return done.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
