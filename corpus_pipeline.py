"""Corpus pipeline: documents in, packed training sequences out.

Five stages, each on what its predecessor kept: importance resampling keeps the documents that read like the
labelled good ones; SimHash proposes near copies, of which one document (the smallest id) of each group that exact
shingle similarity connects stays; exact-substring
deduplication cuts passages of 100 bytes and more that stand earlier; personal data get pseudonyms; the
rest is tokenised and packed. All stages but the last return the columns of documents, n_chars brought up to
date where the text changed. The last returns a row per piece with its token ids and its place in a sequence: the
pieces of a sequence_id, in order of offset, are a training sequence.

Defined cases: documents with null or empty text are rejected by the first stage, which finds no word in them;
a document that the cuts leave empty stays, as an empty text; empty tables pass through; columns beside those
of documents are kept up to the last stage, whatever their names; texts of any length are read whole; repeated rows are near copies of which one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import packing, pii, quality, simhash, substrings
from tessera.llm.common import cut, cut_table
from tessera.plans.ship import ship

#: Words in a shingle, differing bits of 64 up to which documents are compared, and the Jaccard similarity of their
#: sets of shingles (a fraction) from which they are near copies.
SHINGLE_WORDS, RADIUS, SIMILAR = 5, 7, (4, 5)
#: Bytes from which a repeated passage is cut, and tokens in a sequence.
REPEATED_BYTES, SEQUENCE_TOKENS = 100, 2048


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """changed with the columns of docs, in their order, n_chars counted anew."""
    return changed.select(*[F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c, t in docs.dtypes])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    chosen = quality.select(docs, labels)
    return chosen.where("selected").select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group the row with the smallest id stays, of equal rows one. Rows without an id cannot be told and stay.

    Rows are told by id and text, so that unrelated texts that share an id are decided apart."""
    ship(spark)
    found = simhash.near_copies(docs, words=SHINGLE_WORDS, radius=RADIUS, least=SIMILAR)
    stays = found.where((F.col("doc_id") == F.col("leader.doc_id")) & (F.col("digest") == F.col("leader.digest")))
    stays = cut(stays.groupBy("doc_id", "digest").agg(F.count("*").alias("n")))
    told = "__tessera_digest"
    kept = docs.withColumn(told, simhash.text_digest("text"))
    kept = kept.join(stays.select("doc_id", F.col("digest").alias(told)).hint("merge"), ["doc_id", told], "left_semi")
    if not stays.where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", told])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).union(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Characters that a cut would split go with the cut."""
    ship(spark)
    done = substrings.deduplicate(docs, REPEATED_BYTES, as_text=True)
    text = F.when(F.size("removed_spans") > 0, F.col("kept")).otherwise(F.col("text"))
    return _like(docs, done.withColumn("text", text))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _like(docs, pii.pseudonymise(docs, pii.DEMO_KEY, found_col=None))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, SEQUENCE_TOKENS, with_ids=True)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", keep_one_of_copies),
    ("repeats", cut_repeats),
    ("private", hide_private),
    ("packing", pack),
]

#: SQL expresses neither the hashed models nor the tokenizer; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written to the shared folder and reread, as in STAGES' contract."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
