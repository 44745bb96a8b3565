"""Exact dedup by an extendible-hash index.

Texts are normalised and hashed to 64-bit keys. The directory holds the leading bits of the keys: a bucket with too many
distinct keys is split on its next bit, and the directory doubles when a bucket uses all its bits. The owner task of a bucket
reads the bucket's texts in key order, chains the distinct texts of one key and compares their bytes; the classes that it
finds are the index, kept in the shared checkpoint folder. Copies are merged within each task before anything is sent, so a
group of any size reaches its owner as one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import SPACE, release_memory, rows_of_keepers, settled, text_batches, text_hash

#: Distinct keys that a bucket may hold before it is split, the bits by which keys are counted at a time, and the deepest the
#: directory gets: 65,536 entries. Beyond that buckets grow, and their owners read them as a stream just the same.
CAPACITY = 256
STEP_BITS = 8
MOST_BITS = 16
SALTS = 16


def normal_text(text) -> F.Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def split_counts(counts: dict[int, int], bits: int, at: int, room: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Buckets (prefix, depth) below depth ``at``, from the key counts of all prefixes of ``bits`` bits; and those still too full."""
    by_depth = [counts]
    for _ in range(bits - at):
        up: dict[int, int] = {}
        for prefix, n in by_depth[-1].items():
            up[prefix >> 1] = up.get(prefix >> 1, 0) + n
        by_depth.append(up)
    done, full, todo = [], [], [(p, at) for p in by_depth[-1]]
    while todo:
        prefix, depth = todo.pop()
        n = by_depth[bits - depth].get(prefix, 0)
        if n <= room:
            done.append((prefix, depth))
        elif depth == bits:
            full.append((prefix, depth))
        else:
            todo += [(2 * prefix, depth + 1), (2 * prefix + 1, depth + 1)]
    return done, full


def directory(keys: DataFrame, room: int = CAPACITY) -> np.ndarray:
    """First keys (unsigned) of the buckets, in order, for a table of distinct long keys.

    Keys are counted by prefixes, some bits more each time and only within the buckets that are still too full; at most
    ``2 ** MOST_BITS`` counts reach the driver.
    """
    spread = keys.select(F.shiftrightunsigned("key", 64 - MOST_BITS).alias("high"))
    buckets: list[tuple[int, int]] = []
    full, at = [(0, 0)], 0
    while full and at < MOST_BITS:
        bits = at + STEP_BITS
        prefix = F.shiftright("high", MOST_BITS - bits)
        part = spread
        if at:
            part = spread.where(F.shiftright("high", MOST_BITS - at).isin([p for p, _ in full]))
        counts = {p: n for p, n in part.groupBy(prefix.alias("p")).count().collect()}
        done, full = split_counts(counts, bits, at, room)
        buckets += done
        at = bits
    starts = {p << (64 - d) for p, d in buckets + full}
    return np.array(sorted(starts | {0}), dtype=np.uint64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[bytes, int | None, int]]]]:
    """(key, its chain): of rows sorted by key, the distinct texts with their smallest id and count."""
    key, chain = None, []
    for batch in batches:
        keys, texts, ids, counts = (batch.column(i).to_pylist() for i in range(4))
        for k, t, i, n in zip(keys, texts, ids, counts):
            if k != key:
                if chain:
                    yield key, chain
                key, chain = k, []
            for link in chain:
                if link[0] == t:
                    link[1] = i if link[1] is None or i is not None and i < link[1] else link[1]
                    link[2] += n
                    break
            else:
                chain.append([t, i, n])
    if chain:
        yield key, chain


def _merged(batches: Iterator[pa.RecordBatch], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The copies within a task, merged, and the bucket that owns each: the last whose first key isn't above the row's."""
    rows, size = [], 0
    for key, chain in _runs(batches):
        for text, doc_id, n in chain:
            rows.append((key, text, doc_id, n))
            size += len(text)
        if size > 4_000_000 or len(rows) > 5000:
            yield _batch(rows, starts)
            rows, size = [], 0
    if rows:
        yield _batch(rows, starts)
    rows.clear()
    release_memory()


def _batch(rows: list[tuple], starts: np.ndarray) -> pa.RecordBatch:
    keys, texts, ids, counts = zip(*rows)
    bucket = np.searchsorted(starts, np.array(keys, np.int64).view(np.uint64), side="right") - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(texts, pa.binary()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(bucket, pa.int32())],
        ["key", "bytes", "doc_id", "n", "bucket"],
    )


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What an owner task finds: a class for each distinct text, with its place in the chain of its key."""
    rows = []

    def out() -> pa.RecordBatch:
        key, chain, sha, keep, n = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(chain, pa.int32()), pa.array(sha, pa.string()), pa.array(keep, pa.int64()), pa.array(n, pa.int64())], ["key", "chain", "text_sha256", "keep_id", "group_size"])

    for key, chain in _runs(batches):
        for place, (text, doc_id, n) in enumerate(sorted(chain)):
            rows.append((key, place, hashlib.sha256(text).hexdigest(), doc_id, n))
        if len(rows) > 20_000:
            yield out()
            rows = []
    if rows:
        yield out()
    rows.clear()
    release_memory()


def index(docs: DataFrame, entries: DataFrame, doc_id: str, text: str, room: int = CAPACITY) -> DataFrame:
    """The classes of equal texts: key, place in the key's chain, hash, smallest id and number of rows."""
    starts = directory(entries.select("key").distinct(), room)
    norm = docs.select(normal_text(F.col(text)).alias("t"), F.col(doc_id).cast("long").alias("doc_id"))
    # One pass through Python merges the copies and finds the owner: a second in the same task would take a worker more on
    # every core, which lives on through all later stages.
    sent = (
        norm.select(F.xxhash64("t").alias("key"), F.col("t").cast("binary").alias("bytes"), "doc_id", F.lit(1).cast("long").alias("n"))
        .sortWithinPartitions("key").mapInArrow(lambda b: _merged(b, starts), "key long, bytes binary, doc_id long, n long, bucket int")
    )
    owned = sent.repartition("bucket").sortWithinPartitions("bucket", "key")
    return owned.select("key", "bytes", "doc_id", "n").mapInArrow(_classes, "key long, chain int, text_sha256 string, keep_id long, group_size long")


def exact_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", room: int = CAPACITY) -> DataFrame:
    """A row per row of ``docs``: doc_id, keep_id, group_size, text_sha256, text_hash.

    Null texts are empty texts, and empty texts are equal. Rows without an id belong to their group but are kept only if no
    row of it has one. Repeated rows count each time. An empty table gives an empty table; other columns aren't read.
    """
    norm = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_hash(text).alias("text_hash"), normal_text(F.col(text)).alias("t"))
    entries = settled(norm.select("doc_id", "text_hash", F.xxhash64("t").alias("key"), F.unhex(F.sha2("t", 256)).alias("sha")))
    with text_batches(docs.sparkSession):
        classes = settled(index(docs, entries, doc_id, text, room))
    # A text without a copy needs no look-up; a class with copies is there once for each salt.
    many = classes.where(F.col("group_size") > 1).select(
        F.col("key").alias("k"), F.unhex("text_sha256").alias("s"), "keep_id", "group_size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = entries.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    found = salted.join(many, (F.col("key") == F.col("k")) & (F.col("sha") == F.col("s")) & (salted["salt"] == many["salt"]), "left")
    return found.select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.lower(F.hex("sha")).alias("text_sha256"), "text_hash",
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: that of the smallest id; without an id only if none has one."""
    rows = exact_classes(docs, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # Rows with one id may differ in their white space; one of them stays.
    first = rows.groupBy("text_sha256", F.col("doc_id").alias("id")).agg(F.min("text_hash").alias("text_hash"))
    return rows_of_keepers(docs, first, doc_id, text)


def op6(docs: DataFrame) -> DataFrame:
    """A row per document with the row that stays for it."""
    return exact_classes(docs).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


OP6_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, sha256(s) AS text_sha256
FROM t
"""
