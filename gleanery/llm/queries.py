"""Registered queries of this package with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import bpe, exact, extraction, jaccard, language, lines, mixing, negatives, quality, sharding, simhash, toxicity, trie
from gleanery.llm.common import table

#: The tokenizer's file is a parameter of the operator; this is where the public one is installed.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": lambda spark, sf_dir: toxicity.op1(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op2_quality": lambda spark, sf_dir: quality.op2(table(spark, sf_dir, "documents")),
    "op3_mixing": lambda spark, sf_dir: mixing.op3(table(spark, sf_dir, "documents")),
    "op4_language": lambda spark, sf_dir: language.op4(table(spark, sf_dir, "documents")),
    "op5_line_dedup": lambda spark, sf_dir: lines.op5(table(spark, sf_dir, "pages")),
    "op6_exact_dedup": lambda spark, sf_dir: exact.op6(table(spark, sf_dir, "documents")),
    "op7_sharding": lambda spark, sf_dir: sharding.op7(table(spark, sf_dir, "documents")),
    "op8_bpe": lambda spark, sf_dir: bpe.op8(table(spark, sf_dir, "documents"), tokenizer_path()),
    "op9_simhash": lambda spark, sf_dir: simhash.op9(table(spark, sf_dir, "documents")),
    "op11_jaccard": lambda spark, sf_dir: jaccard.op11(table(spark, sf_dir, "documents")),
    "op12_negatives": lambda spark, sf_dir: negatives.op12(table(spark, sf_dir, "embeddings")),
    "op13_trie": lambda spark, sf_dir: trie.op13(table(spark, sf_dir, "conversations")),
    "op10_extraction": lambda spark, sf_dir: extraction.op10(table(spark, sf_dir, "pages")),
}

ORACLES: dict[str, str] = {"op3_mixing": mixing.OP3_SQL, "op5_line_dedup": lines.OP5_SQL, "op6_exact_dedup": exact.OP6_SQL, "op12_negatives": negatives.OP12_SQL, "op13_trie": trie.OP13_SQL}
