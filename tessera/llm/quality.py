"""Operator 4: quality selection by importance resampling with hashed n-gram models.

Words and runs of signs are hashed as unigrams and bigrams into buckets. Two bag-of-n-grams models are
counted: the target (labelled good documents) and the raw corpus (every document). A document's log weight is
the log of the ratio of its probabilities under them, taken per n-gram so that length does not decide. Gumbel
noise from a keyed hash of its id is added to the weight over a stated temperature, and the k highest are kept: that
samples k documents without replacement in proportion to exp(sharpness * log weight). By default k is the number of documents above
the weight that parts the labelled good from the labelled bad with the fewest errors, counted over the whole corpus.

The models have a fixed number of buckets; everything else follows the data. The target may be fitted on a
bounded sample of labelled rows (`target_rows`); the corpus counts, the weights and the k-th highest value
cover every document.

Defined cases: null and empty texts, and texts without a word, have weight minus infinity and are selected only
if k exceeds all others; rows tied with the k-th value are all kept; repeated rows get equal values; a null id
draws its noise as its own value; without good labelled rows every other weight is 0, and without bad ones all
documents with a word are asked for; an empty table gives an empty table; older columns of the output's names
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_columns, bound_batches, cut

#: Buckets of the models, a power of two, and labelled rows that the target is fitted on at most.
BUCKETS, TARGET_ROWS = 1 << 17, 20_000
#: Words whose hash a task remembers; it bounds memory, not results.
CACHE_SIZE = 300_000
#: Added to every bucket's count, so that unseen n-grams stay comparable.
SMOOTHING = 1.0
#: Inverse temperature: factor of the weight per n-gram before noise of unit scale is added. At 12, noise changes two
#: to four in a thousand of the selected documents of the given tables; at 32, fewer than one.
SHARPNESS = 12.0

WORD = re.compile(r"\w+|[^\w\s]+")


class Hasher:
    """Buckets of a text's unigrams and bigrams."""

    def __init__(self, buckets: int):
        self.mask, self.cache = np.uint64(buckets - 1), {}

    def __call__(self, text: str | None) -> np.ndarray:
        from xxhash import xxh64_intdigest

        words = WORD.findall(text) if text else []
        if not words:
            return np.empty(0, np.int64)
        cache = self.cache
        if len(cache) > CACHE_SIZE:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = xxh64_intdigest(w)
        one = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[1:] + (one[:-1] >> np.uint64(29)))
        two = (two ^ (two >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return (np.concatenate([one, two ^ (two >> np.uint64(31))]) & self.mask).astype(np.int64)


def count_models(df: DataFrame, text: Column, is_target: Column, buckets: int) -> DataFrame:
    """bucket, raw, target: n-grams of all documents and of the target ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, raw, target = Hasher(buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for body, good in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = hasher(body.as_py())
                counts = np.bincount(found, minlength=0)
                raw[: len(counts)] += counts
                if good:
                    target[: len(counts)] += counts
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, raw[some], target[some])], names=["bucket", "raw", "target"])

    bound_batches(df.sparkSession)
    fed = df.select(text.alias("text"), is_target.alias("good"))
    return fed.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratio(models: DataFrame, buckets: int) -> np.ndarray:
    """log p_target - log p_raw by bucket; zeros where there is no target."""
    rows = models.toPandas()  # at most `buckets` rows
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    if not target.sum():
        return np.zeros(buckets, np.float64)
    p, q = target + SMOOTHING, raw + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def gumbel(id_col: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the id."""
    h = F.xxhash64(F.lit(seed), id_col)
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def weigh(df: DataFrame, ratio: np.ndarray, id_col: str, text_col: str, seed: int, sharpness: float) -> DataFrame:
    """df plus log_weight (per n-gram) and gumbel_key double."""
    table = df.sparkSession.sparkContext.broadcast(ratio)  # one number per bucket

    def make():
        hasher, values = Hasher(len(table.value)), table.value
        return lambda texts: [[float(values[at].mean()) if len(at) else -np.inf for at in map(hasher, texts)]]

    done = add_columns(df, [F.col(f"`{text_col}`")], [T.StructField("log_weight", T.DoubleType(), False)], make)
    return done.withColumn("gumbel_key", F.lit(sharpness) * F.col("log_weight") + gumbel(F.col(f"`{id_col}`"), seed))


def kth_highest(values: DataFrame, column: str, k: int) -> float | None:
    """The exact k-th highest value, by counts over ever finer ranges; None if k is 0, the lowest if there are fewer."""
    if k <= 0:
        return None
    finite = values.where(F.col(column) > float("-inf"))
    low, high, n = finite.agg(F.min(column), F.max(column), F.count("*")).first()
    if k > n:
        return float("-inf")
    values = finite
    parts = 65_536
    while low < high:
        width = (high - low) / parts
        if width == 0 or low + width == low:
            break
        at = F.least(F.lit(parts - 1), F.floor((F.col(column) - F.lit(low)) / F.lit(width))).cast("int")
        rows = values.where(F.col(column).between(low, high)).groupBy(at.alias("part")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        above = values.where(F.col(column) > high).count()
        for r in sorted(rows, key=lambda r: -r["part"]):
            if above + r["n"] >= k:
                break
            above += r["n"]
        if (r["low"], r["high"]) == (low, high):
            break
        low, high = r["low"], r["high"]
    return float(low)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts good from bad with the fewest errors; minus infinity without bad ones."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    gain = np.concatenate([[0], np.cumsum(~good)]) - np.concatenate([[0], np.cumsum(good)])
    gain[1:-1][weights[1:] == weights[:-1]] = -len(good) - 1  # no cut between equal weights
    k = int(gain.argmax())
    if k == 0 or not np.isfinite(weights[k - 1]):
        return -np.inf
    return float(weights[k - 1] if k == len(weights) else (weights[k - 1] + weights[k]) / 2)


def select(df: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", text_col: str = "text", target_rows: int = TARGET_ROWS, buckets: int = BUCKETS, seed: int = 7, sharpness: float = SHARPNESS, texts: bool = True) -> DataFrame:
    """df plus log_weight, gumbel_key and selected boolean; without texts, the id and these three, which are kept from
    the ranking instead of being computed once more.

    labels has id_col, quality and, where there is one, toxic: the target is quality 1 and not toxic, quality 0 is bad.
    """
    toxic = F.coalesce("toxic", F.lit(0)) == 1 if "toxic" in labels.columns else F.lit(False)
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1) & ~((F.col("quality") == 1) & toxic))
    known = known.groupBy(F.col(id_col).alias("__known_id")).agg((F.min("quality") == 1).alias("__good"))
    drawn = [known.where(good).orderBy(F.xxhash64(F.lit(seed), "__known_id"), "__known_id").limit(target_rows) for good in (F.col("__good"), ~F.col("__good"))]
    sample = cut(drawn[0].union(drawn[1]))  # 2 * target_rows ids at most
    marked = df.join(F.broadcast(sample), F.col(f"`{id_col}`") == F.col("__known_id"), "left")
    ratio = log_ratio(count_models(marked, F.col(f"`{text_col}`"), F.coalesce("__good", F.lit(False)), buckets), buckets)
    scored = weigh(df, ratio, id_col, text_col, seed, sharpness)
    keys = cut(scored.select(F.col(f"`{id_col}`").alias("id"), "log_weight", "gumbel_key"))
    if k is None:
        # one row per labelled id, 2 * target_rows at most: rows that share an id count with their least weight
        seen = keys.join(F.broadcast(sample), F.col("id") == F.col("__known_id")).groupBy("__known_id", "__good").agg(F.min("log_weight").alias("log_weight")).toPandas()
        parted = best_cut(seen["log_weight"].to_numpy(float), seen["__good"].to_numpy(bool))
        k = keys.where(F.col("log_weight") > parted).count()
    limit = kth_highest(keys, "gumbel_key", k)
    found = scored if texts else keys.withColumnRenamed("id", id_col)
    return found.withColumn("selected", F.lit(False) if limit is None else F.col("gumbel_key") >= F.lit(limit))


def op4_importance(spark, sf_dir: str) -> DataFrame:
    """The documents that resampling selects, with their log weights and noisy keys."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return select(docs, labels, texts=False).where("selected").select("doc_id", "log_weight", "gumbel_key", "selected")
