"""Quality rules: counts on whole texts, and perplexity bands of an n-gram model for each language."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm import ngrams
from gleanery.llm.common import SENT_KEYS, broadcast_if_small, distinct_texts, release_memory, settled, text_batches, text_pair

SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
#: Bytes scored at once.
STEP = 1 << 18
#: Spreads (of the middle half, as a normal deviation) below and above the language's median entropy at which a text goes, the
#: least such spread, and the length at which a text's spread is taken twice as a variance.
BELOW, ABOVE = 4.5, 3.75
LEAST_SPREAD = 0.01
SHORT = 300
GRID = 0.002

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, entropy double, n_scored long"


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and words in repeated 3-word windows."""
    found = text.split()
    points = len(text.translate(None, BLANK).decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    windows = list(zip(found, found[1:], found[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        end = 0
        for i, w in enumerate(windows):
            if often[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return len(found), points, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated


def measures(sent: Broadcast, text: str | Column, lang: str | Column) -> Column:
    """A struct of ``MEASURES`` for each row, by a model's arrays as they were sent to the workers."""
    held: list[ngrams.Model] = []

    @F.arrow_udf(MEASURES)
    def of(texts: pa.Array, langs: pa.Array) -> pa.Array:
        if not held:
            held.append(ngrams.Model(*sent.value))
        raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts]
        rows = np.array([measure(t) for t in raw], np.int64).reshape(-1, 5)
        entropy, scored = np.zeros(len(raw)), np.zeros(len(raw), np.int64)
        names = [x or "" for x in langs.to_pylist()]
        for name, own in ngrams.by_lang(names).items():
            at, n, part = 0, 0, []
            for k, i in enumerate(own):
                part.append(i)
                n += len(raw[i])
                if n >= STEP or k == len(own) - 1:
                    entropy[part], scored[part] = held[0].entropies([raw[i].decode("utf-8", "replace") for i in part], name)
                    n, part = 0, []
        del raw
        release_memory()
        columns = [pa.array(rows[:, i]) for i in range(5)] + [pa.array(entropy), pa.array(scored)]
        return pa.StructArray.from_arrays(columns, names=[x.split()[0] for x in MEASURES.split(", ")])

    return of(text, lang)


def base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def bands(scored: DataFrame) -> DataFrame:
    """(lang, middle, spread) of the entropies of rows (lang, entropy), from their counts on a fixed grid."""
    counts = scored.groupBy("lang", F.floor(F.col("entropy") / GRID).alias("bin")).agg(F.count("*").alias("n"))
    up = Window.partitionBy("lang").orderBy("bin")
    placed = counts.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), (F.col("bin") + 0.5) * GRID))
    quarters = placed.groupBy("lang").agg(at(0.25).alias("q1"), at(0.5).alias("middle"), at(0.75).alias("q3"))
    return quarters.select("lang", "middle", F.greatest((F.col("q3") - F.col("q1")) / 1.349, F.lit(LEAST_SPREAD)).alias("spread"))


def in_band(prefix: str = "") -> Column:
    """Whether entropy lies in its language's band, which is wider for short texts."""
    wide = F.col("spread") * F.sqrt(1 + SHORT / F.col(f"{prefix}n_scored"))
    return F.col(f"{prefix}entropy").between(F.col("middle") - BELOW * wide, F.col("middle") + ABOVE * wide)


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """A row per row of ``docs``: id, the measures, perplexity, band, base_failed and kept.

    The model and the bands are of all distinct texts of ``docs``, each once for its language however often it is copied. Null
    texts are empty, and fail by their number of words; null languages are one language of their own. Equal rows get equal
    results. An empty table gives an empty table; other columns aren't read.
    """
    name = F.coalesce(F.col(lang).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), name.alias("lang"), F.col(text).alias("text"), *text_pair(text))
    scored = _scored(distinct_texts(docs, name, text), rows)
    found = scored.join(broadcast_if_small(settled(bands(scored.dropDuplicates(TEXT)))), "lang")
    return found.select(
        F.col("id").alias(doc_id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & in_band()).alias("kept"),
        F.exp("entropy").alias("perplexity"), F.exp(F.col("middle") - BELOW * F.col("spread")).alias("lower"), F.exp(F.col("middle") + ABOVE * F.col("spread")).alias("upper"),
    )


TEXT = ["lang", "_h1", "_h2"]


def _scored(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The measures of ``rows`` by a model of ``texts``, settled, without the texts. The model is dropped from the workers after it."""
    spark = texts.sparkSession
    own = [c for c in rows.columns if c != "text"]
    with text_batches(spark):
        sent = spark.sparkContext.broadcast(ngrams.train(texts, "lang", "text").arrays())
        scored = settled(rows.select(*own, measures(sent, F.col("text"), F.col("lang")).alias("m")).select(*own, "m.*"))
    sent.destroy()
    return scored


def quality_filter(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their columns as they are.

    A verdict depends on text and language only. Each distinct text is scored once, and the rows of those that fail are left out
    where they are read: texts are only moved when too many fail to send their hashes.
    """
    name = F.coalesce(F.col(lang).cast("string"), F.lit(""))
    texts = distinct_texts(docs, name, text)
    scored = _scored(texts, texts)
    limits = settled(bands(scored))
    failed = settled(scored.join(broadcast_if_small(limits), "lang").where(base_failed() | ~in_band()).select(*[F.col(c).alias(f"_f{c}") for c in TEXT]))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name.alias("lang"), *text_pair(text))
    here = (F.col("lang") == F.col("_flang")) & (F.col("_h1") == F.col("_f_h1")) & (F.col("_h2") == F.col("_f_h2"))
    return rows.join(broadcast_if_small(failed, SENT_KEYS), here, "left_anti").select("row.*")


def op2(docs: DataFrame) -> DataFrame:
    """Counts, verdict and perplexity of every document."""
    return quality(docs)
