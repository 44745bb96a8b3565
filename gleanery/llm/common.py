"""Helpers of the operators in this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: ASCII only, as bytes.split() sees it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's shared checkpoint folder.

    The folder is ``spark.checkpoint.dir``; where a session has none, as in tests, a folder in the warehouse.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        conf = df.sparkSession.conf
        context.setCheckpointDir(conf.get("spark.checkpoint.dir", None) or f"{conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return df.checkpoint()


#: Rows of a batch in which texts go to Python.
TEXT_ROWS = 1000


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """Jobs run and plans made here send so many rows at once to Python: long texts then take little memory on both sides."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def release_memory() -> None:
    """Give what a task has freed back to the system: Python workers live on between tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def words(text: str | Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """The documents that no model here learns labels from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 == 2, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_hash(text: str | Column = "text") -> Column:
    """Hash by which a row is found again beside its id; null and empty differ."""
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(text, text.isNull())


def broadcast_if_small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """``df`` (settled, of short rows) with a broadcast hint if it has at most so many rows; Spark chooses beyond that."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Rows of two numbers that are sent to the readers of texts (8 MB); more meet the texts in a shuffle.
SENT_KEYS = 500_000


def rows_of_keepers(docs: DataFrame, keepers: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` named by ``keepers`` (id, text_hash); rows repeated with id and text count as one row.

    Texts are only moved where there are too many keepers to send, or for rows that are repeated.
    """
    named = settled(keepers.select(F.col("id").alias("_id"), F.col("text_hash").alias("_th")))
    hashed = docs.withColumn(own := free_name(docs, "_text_hash"), text_hash(text))
    same = lambda of: hashed[doc_id].eqNullSafe(of["_id"]) & (hashed[own] == of["_th"])
    counts = docs.select(F.col(doc_id).alias("_id"), text_hash(text).alias("_th")).groupBy("_id", "_th").agg(F.count("*").alias("_n")).where("_n > 1")
    repeated = settled(counts.select("_id", "_th"))
    found = hashed.join(broadcast_if_small(named, SENT_KEYS), same(named), "left_semi")
    if repeated.isEmpty():
        return found.drop(own)
    again = broadcast_if_small(repeated, SENT_KEYS)
    once = found.join(again, same(repeated), "left_anti").unionByName(found.join(again, same(repeated), "left_semi").dropDuplicates([doc_id, own]))
    return once.drop(own)


def text_pair(text: str | Column) -> list[Column]:
    """Two hashes that stand for a text (null as empty), as ``_h1`` and ``_h2``."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def distinct_texts(docs: DataFrame, lang: Column, text: str) -> DataFrame:
    """(lang, text, _h1, _h2): each distinct text of a language once, null texts as empty.

    Only texts that are repeated are moved, one row of each from a task.
    """
    keyed = docs.select(lang.alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"), *text_pair(text))
    key = ["lang", "_h1", "_h2"]
    repeated = settled(keyed.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    again = broadcast_if_small(repeated, SENT_KEYS)
    several = keyed.join(again, key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"))
    return keyed.join(again, key, "left_anti").unionByName(several)
