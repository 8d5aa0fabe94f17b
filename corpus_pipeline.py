"""Corpus pipeline: language, repeated lines, near-duplicates, packing.

Each stage takes all documents that the one before kept and returns documents, the last one packed pieces.
``run`` writes each stage's result to the shared folder and reads it for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import small_batches, table, written
from tripmill.llm.language import UNKNOWN, predict, trained_on
from tripmill.llm.line_chunks import without_repeated_chunks
from tripmill.llm.minhash import near_duplicates
from tripmill.llm.packing import pack

END_ID = 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, whatever the chance of their best language, and also if there is none to learn."""
    small_batches(spark)
    model = trained_on(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return predict(docs, model).where(F.col("lang_pred") != UNKNOWN).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those of which nothing is left go.

    NULL texts, and documents with NULL ids, stay as they are.
    """
    small_batches(spark)
    cut = without_repeated_chunks(docs)
    left = (F.col("removed_chunks") == 0) | (F.trim("text") != "")
    return cut.where(left).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, shingles of five words: the rows of the smallest doc_id.

    NULL texts and documents with NULL ids are in no group and stay.
    """
    small_batches(spark)
    groups = near_duplicates(docs, size=5, percent=80)
    dropped = groups.where(~F.col("kept")).select(F.col("doc_id").alias("__doc_id")).distinct()
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col("__doc_id"), "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens; a NULL text is its end alone."""
    small_batches(spark)
    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), "space_first", END_ID)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("best_fit_packing", packing),
]

#: SQL has no tokenizer and no fitted classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
