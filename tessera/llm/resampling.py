"""Operator 11: importance resampling towards a target distribution, by hashed features and two passes over Arrow batches.

Features are the runs of 1 to `order` consecutive words. The first pass counts a task's features in a vector of one
count per bucket (numpy.bincount); executors add the vectors up as a tree. From the counts of the corpus and of the
target follows a gain per bucket. The second pass gathers the broadcast gains of each document's features and sums
them by document (numpy.bincount with weights). Gumbel noise from a digest of the id is added to the mean gain, and the
highest scores among the eligible documents are drawn: a sample without replacement in proportion to the weights.

The vectors have a fixed number of buckets; a task holds one, and the words of at most PIECE_BYTES at a time. Ranks
come from sorted ranges and their counts, never from one task.

Defined cases: null and empty texts, and texts without a word, have no feature and weight 0; texts of any length are
read whole, a piece at a time; equal scores go to the smaller id, then null ids, then more features, then any order; a
null id draws its noise as the empty text; repeated rows each get a row, with equal weights and scores; without a target
text every gain is the floored log of (S + buckets) / (s + 1) / buckets; an empty table gives an empty table; other columns take no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, cut_table, slices, table, tree_sum

BUCKETS, ORDER, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Bytes of a text that are taken apart at a time, and words whose bucket a task remembers: they bound memory, not results.
PIECE_BYTES, CACHE_SIZE = 1 << 20, 300_000

#: Digits, lower-case letters, and every byte of a character beyond ASCII.
WORD, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about PIECE_BYTES at a time. bytes.lower() knows A to Z only."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + PIECE_BYTES)
        end = gap.start() if gap else len(text)
        yield WORD.findall(text[at:end].lower())
        at = end


class Hasher:
    """Buckets of the features of a text, a piece at a time."""

    def __init__(self, buckets: int, order: int):
        self.buckets, self.order, self.cache = buckets, order, {}

    def __call__(self, text: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """Number of words and buckets of the features that end in a piece."""
        before: list[bytes] = []
        for words in words_of(text):
            there, n = [*before, *words], len(before)
            features = words
            for k in range(2, self.order + 1):
                features = features + [b" ".join(there[i : i + k]) for i in range(max(0, n - k + 1), len(there) - k + 1)]
            if len(self.cache) > CACHE_SIZE:
                self.cache.clear()
            cache = self.cache
            for f in set(features).difference(cache):
                cache[f] = crc32(f) % self.buckets
            yield len(words), np.fromiter(map(cache.__getitem__, features), np.int64, len(features))
            before = there[max(0, len(there) - self.order + 1) :] if self.order > 1 else []


def count_features(df: DataFrame, text: Column, buckets: int, order: int) -> np.ndarray:
    """Features of all rows by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = Hasher(buckets, order), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for t in part.column(0):
                    for _, found in hasher(t.as_py() or b""):
                        counts += np.bincount(found, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])

    bound_batches(df.sparkSession)
    return tree_sum(df.select(text.cast("string").cast("binary").alias("text")).mapInArrow(run, "counts binary"), np.zeros(buckets, np.int64))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed probabilities, floored."""
    n = len(corpus)
    all_s, all_t = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _together(words: np.ndarray, pieces: Iterator[tuple[int, tuple[int, np.ndarray]]]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows and buckets of pieces, about PIECE_BYTES features at a time; their words are added to words."""
    rows, found, held = [], [], 0
    for i, (k, at) in pieces:
        words[i] += k
        rows.append(i)
        found.append(at)
        held += len(at)
        if held > PIECE_BYTES:
            yield rows, found
            rows, found, held = [], [], 0
    if rows:
        yield rows, found


def weigh(df: DataFrame, gain: np.ndarray, order: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean of the gains of a row's features."""
    shared = df.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, gain = Hasher(len(shared.value), order), shared.value.astype(np.float64)
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                words, features, sums = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for rows, found in _together(words, ((i, piece) for i, t in enumerate(part.column(1)) for piece in hasher(t.as_py() or b""))):
                    doc, at = np.repeat(rows, [len(x) for x in found]), np.concatenate(found)
                    # sums of whole numbers below 2**53 are exact
                    sums += np.bincount(doc, weights=gain[at], minlength=n).astype(np.int64)
                    features += np.bincount(doc, minlength=n)
                weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (words, features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    bound_batches(df.sparkSession)
    fed = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return fed.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: int) -> Column:
    """Thousandths of standard Gumbel noise from a digest of the id, floored."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """scored plus rank long: places of the highest scores among the eligible rows, null where not drawn.

    Rows are dealt by sorted ranges and written with the number of their range; what comes before a range is one count
    per range.
    """
    n = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("__in").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").desc(), F.col("__row")]
    # written first: finding the ranges reads the rows once more
    marked = cut_table(scored.withColumn("__in", F.coalesce(eligible, F.lit(False))).withColumn("__row", F.monotonically_increasing_id()))
    ranged = cut_table(marked.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part").agg(F.count(F.when(F.col("__in"), 1)).alias("n"))
    before = counts.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    most = percent * (counts.agg(F.sum("n")).first()[0] or 0) // 100
    at = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) + F.col("__before")
    ranked = ranged.join(F.broadcast(before), "__part").withColumn("rank", at.cast("long"))
    return ranked.withColumn("rank", F.when(F.col("__in") & (F.col("rank") <= most), F.col("rank"))).drop("__in", "__row", "__part", "__before")


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS, order: int = ORDER, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of df; rank counts the drawn from 1 and is null elsewhere."""
    gain = gains(count_features(df, F.col(f"`{text_col}`"), buckets, order), count_features(target, F.col(f"`{target_text}`"), buckets, order))
    weighed = weigh(df, gain, order, id_col, text_col)
    scored = weighed.withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    return draw(scored, F.col("n_words") >= min_words, percent)


def op11_resampling(spark, sf_dir: str) -> DataFrame:
    """Contract query: a tenth of the documents of 20 words and more, drawn towards the texts of benchmark."""
    done = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
    return done.select("doc_id", "n_features", "weight", "score", "rank")
