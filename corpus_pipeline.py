"""The pipeline over documents: each stage reads all that the one before kept.

Quality rules drop documents that fail them; exact dedup and near-dedup keep one row of each group; the mix repeats or leaves
out rows so that each source's words come to its target; the last stage returns the ids of each row's text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.bpe import encode
from gleanery.llm.common import words
from gleanery.llm.exact import exact_dedup
from gleanery.llm.mixing import mixed_rows
from gleanery.llm.quality import quality_filter
from gleanery.llm.queries import tokenizer_path
from gleanery.llm.simhash import near_dedup


#: Text bytes of a block of the last stage: smaller than a lone ``encode`` takes, as other stages' workers and caches are in memory too.
BLOCK_BYTES = 4 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the counts and the perplexity band of their language."""
    return quality_filter(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the row with the smallest id."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the row with the smallest id."""
    return near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixed_rows(docs, words("text"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each row's text, and the SHA-256 of the text that they decode to."""
    done = encode(docs, tokenizer_path(), block_bytes=BLOCK_BYTES)
    return done.select(F.col("row").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mix),
    ("bpe", token_ids),
]

#: A trained model, fingerprints and a tokenizer are beyond SQL; tests/llm compares with a plain version in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
