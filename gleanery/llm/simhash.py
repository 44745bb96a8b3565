"""Near-dedup by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints that link differ in few bits, so of d + 2 segments of the 64 bits two or more are equal. The upper nodes of the
index are these shared masked patterns: for each pair of segments, the fingerprints that agree there are one node, owned by
one task. Within a node the fingerprints stand in Gray order, neighbours differing little; runs of them are factored into
groups that hold the bits on which all members agree, and runs of groups into larger ones. Pairs of groups are walked from
the top; a pair is pruned when the differences on the bits that both share exceed the limit, and needs no further look when
all its members are in one component already. A task returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import release_memory, rows_of_keepers, settled, text_batches, text_hash
from gleanery.llm.graph import components

DISTANCE = 4
SHINGLE = 4
SEED = 42
SALTS = 16
#: Members of a group of the lowest level, children of a larger group, and pairs looked at in one step.
LEAF = 16
PAIRS = 1 << 19


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it set; no words: zero."""
    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= shingle:
        hashes = xxhash.xxh64_digest(line, SEED)
    else:
        ends = list(accumulate(len(w) + 1 for w in found))
        starts = [0, *ends]
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(line[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :])])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):
        votes += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * votes > len(bits)).tobytes(), "big", signed=True)


def fingerprint_of(text: str | Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a signed long; null as the empty text."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = pa.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts], pa.int64())
        release_memory()
        return found

    return of(text)


def masks(distance: int) -> list[int]:
    """Unsigned masks of all pairs of d + 2 segments."""
    cuts = [round(64 * i / (distance + 2)) for i in range(distance + 3)]
    segments = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(segments, 2)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def gray_rank(code: Column) -> Column:
    """Place of a code in Gray order."""
    for by in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, by))
    return code


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Put the members a[i] and b[i] into one component; a label is the smallest member reached so far."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def _expand(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of pairs of groups; of a group with itself each pair once."""
    i, j = np.meshgrid(np.arange(LEAF), np.arange(LEAF), indexing="ij")
    left, right = (a[:, None] * LEAF + i.ravel()).ravel(), (b[:, None] * LEAF + j.ravel()).ravel()
    there = (left <= right) & (right < count)
    return left[there], right[there]


def link_group(codes: np.ndarray, labels: np.ndarray, distance: int) -> None:
    """Join all members of a group that are linked; ``codes`` in Gray order, ``labels`` their components so far (in place)."""
    n = len(codes)
    for step in range(1, min(LEAF, n)):
        near = np.flatnonzero(np.bitwise_count(codes[:-step] ^ codes[step:]) <= distance)
        _join(labels, near, near + step)
    if n <= LEAF:
        return
    levels = []
    ones, zeros = codes, ~codes
    while len(ones) > 1:
        at = np.arange(0, len(ones), LEAF)
        ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
        levels.append((ones, ones | zeros))
    _walk(codes, labels, levels, len(levels) - 1, np.array([0]), np.array([0]), distance)


def _walk(codes, labels, levels, level, a, b, distance) -> None:
    for at in range(0, len(a), PAIRS // LEAF**2):
        x, y = a[at : at + PAIRS // LEAF**2], b[at : at + PAIRS // LEAF**2]
        ones, shared = levels[level]
        x, y = (v[np.bitwise_count((ones[x] ^ ones[y]) & shared[x] & shared[y]) <= distance] for v in (x, y))
        edge = np.arange(0, len(codes), LEAF ** (level + 1))
        low, high = np.minimum.reduceat(labels, edge), np.maximum.reduceat(labels, edge)
        open_ = ~((low[x] == high[x]) & (low[y] == high[y]) & (low[x] == low[y]))
        x, y = _expand(x[open_], y[open_], len(levels[level - 1][0]) if level else len(codes))
        if level:
            _walk(codes, labels, levels, level - 1, x, y, distance)
        else:
            near = np.bitwise_count(codes[x] ^ codes[y]) <= distance
            _join(labels, x[near], y[near])


def _forest(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links of rows (mask, pattern, code) in the order of mask, pattern and Gray rank, as a spanning forest of each node."""
    kept = [np.empty(0, np.int64)] * 3

    def linked(mask, pattern, code) -> pa.RecordBatch:
        codes, n = code.view(np.uint64), len(code)
        labels = np.arange(n)
        same = (mask[1:] == mask[:-1]) & (pattern[1:] == pattern[:-1])
        starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
        sizes = np.diff(np.concatenate([starts, [n]]))
        group = np.repeat(np.arange(len(starts)), sizes)
        small = sizes[group] <= LEAF
        for step in range(1, min(LEAF, n)):  # all small nodes at once
            i = np.flatnonzero(small[: n - step] & (group[: n - step] == group[step:]))
            i = i[np.bitwise_count(codes[i] ^ codes[i + step]) <= distance]
            _join(labels, i, i + step)
        for g in np.flatnonzero(sizes > LEAF):
            part = slice(starts[g], starts[g] + sizes[g])
            own = np.arange(sizes[g])
            link_group(codes[part], own, distance)
            labels[part] = own + starts[g]
        from_ = np.flatnonzero(labels != np.arange(n))
        return pa.RecordBatch.from_arrays([pa.array(code[from_]), pa.array(code[labels[from_]])], ["a", "b"])

    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        kept = [np.concatenate(x) for x in zip(kept, new)]
        last = (kept[0] == kept[0][-1:]) & (kept[1] == kept[1][-1:])
        begin = int(np.argmax(last)) if len(last) else 0
        if begin:
            yield linked(*[x[:begin] for x in kept])
            kept = [x[begin:] for x in kept]
    if len(kept[0]):
        yield linked(*kept)


def links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that join all of ``codes`` (distinct longs in ``code``) that reach each other by steps of ``distance`` bits."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("code").bitwiseAND(F.lit(signed(m))).alias("pattern"), F.col("code").alias("code"))
        for i, m in enumerate(masks(distance))
    ]))
    nodes = codes.select(rows.alias("r")).select("r.*").repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", gray_rank(F.col("code")))
    return nodes.mapInArrow(lambda batches: _forest(batches, distance), "a long, b long")


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """A row per row of ``docs``: id, text_hash, code, class (a code of the component) and component_id.

    Null texts are empty texts; texts without words have the code zero, and link like any other. Copies have one code and count
    once in the search. component_id is the smallest id that is reached; rows without an id take part, but give no id. An
    empty table gives an empty table; other columns aren't read.
    """
    with text_batches(docs.sparkSession):
        rows = settled(docs.select(F.col(doc_id).alias("id"), text_hash(text).alias("text_hash"), fingerprint_of(text).alias("code")))
    codes = settled(rows.groupBy("code").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    found = components(links(codes.select("code"), distance))
    rooted = codes.join(found.select(F.col("node").alias("code"), "root"), "code", "left")
    # Rows whose code is theirs alone and unlinked are their own component; the others find theirs by code and salt.
    part = rooted.where((F.col("n") > 1) | F.col("root").isNotNull()).select("code", F.coalesce("root", "code").alias("root"), "least")
    part = settled(part)
    least = part.groupBy("root").agg(F.min("least").alias("component_id"))
    named = part.select("code", "root").join(least, "root").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return salted.join(named, ["code", "salt"], "left").select(
        "id", "text_hash", "code", F.coalesce("root", "code").alias("class"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row of each component: that of the smallest id, rows without an id last; all columns of ``docs``."""
    rows = near_classes(docs, doc_id, text, distance)
    first = rows.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"))
    return rows_of_keepers(docs, first.select("first.id", "first.text_hash"), doc_id, text)


def op9(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_classes(docs).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
