"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearcast.session import scratch_path

from . import (
    bpe,
    embeddings,
    html,
    langid,
    merkle,
    minhash,
    packing,
    perplexity,
    pii,
    quality,
    runs,
    substrings,
    warc,
)
from .batches import bounded_batches
from .sql import MERKLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html.extract(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a network trained on the documents that are not held out."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and component of every document over pairs at 0.8 or more."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document under models of trusted text."""
    return perplexity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``pages`` as WARC records, read the archives back; digests are taken from what is read."""
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    read = warc.read_warc(spark, path)
    whole = F.col("payload").isNotNull()
    return read.select(
        F.col("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(whole, warc.base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings removed from every whole text."""
    return substrings.removed(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics, base rules and the MCD verdict of every document."""
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9."""
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    rows = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(rows)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text; digests of both."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, every proof folded again over a table that was tampered with."""
    return merkle.audited(_table(spark, sf_dir, "documents"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodic words in every whole text, and the texts with every run cut to its first period."""
    return runs.digests(_table(spark, sf_dir, "documents"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: what rules find and what its contexts and shapes reveal."""
    return pii.personal_data(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html": op1_html, "op2_language_id": op2_language_id, "op3_minhash": op3_minhash, "op4_perplexity": op4_perplexity,
    "op5_warc": op5_warc, "op6_embeddings": op6_embeddings, "op7_packing": op7_packing, "op8_bpe": op8_bpe,
    "op9_suffix_array": op9_suffix_array, "op10_quality_rules": op10_quality_rules,
    "op11_merkle": op11_merkle, "op12_runs": op12_runs, "op13_pii": op13_pii,
}

#: base32 of a hex digest: digit i holds the bits 5i..5i+4, which lie in two hex digits.
BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + (((('0x' || substr({0}, 1 + (5 * i) // 4, 2))::INTEGER >> (3 - (5 * i) % 4)) & 31))::INTEGER, 1)), '')"""

ORACLE = {
    "op11_merkle": MERKLE_SQL,
    "op5_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, {BASE32.format('s')} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d""",
}
