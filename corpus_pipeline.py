"""From raw documents to packed training sequences, in five stages.

Every stage reads the table its predecessor wrote. A rejected document is gone
for all later stages, the predicted language replaces the given one, and
repeated strings are taken out of the texts that are packed.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearcast.llm import langid, minhash, packing, quality, substrings
from nearcast.llm.batches import bounded_batches
from nearcast.session import scratch_path

#: A language must reach this share of a document's positions.
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; ``lang`` is the predicted one. No letter or no clear language: rejected."""
    bounded_batches(spark)
    judged = langid.predict(docs, langid.fit(docs))
    kept = judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    bounded_batches(spark)
    return minhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that also occur elsewhere; ``n_chars`` follows the text."""
    bounded_batches(spark)
    return substrings.cleaned(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most 4096 tokens."""
    bounded_batches(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: The stages are a trained network, iterated estimates and components: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
