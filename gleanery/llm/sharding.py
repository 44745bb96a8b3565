"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A text's hash is its place on the ring; the arc before a virtual node belongs to the node's shard. Every shard has a bound,
and what a full shard can't take continues clockwise to the next virtual node whose shard has room. The bounds add up to the
number of rows, so the counts of any two shards are at most one apart (the law ``rows``). Which rows of an arc go where is
read off the row's rank within its arc, so the walk round the ring is done on one number per arc, never on rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import free_name, settled

SHARDS = 24
NODES = 64
SUB = 256
SALTS = 256


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the virtual nodes in order, and their shards."""
    at = [(int.from_bytes(hashlib.md5(f"shard {s} node {v}".encode()).digest()[:8], "big", signed=True), s) for s in range(shards) for v in range(nodes)]
    at.sort()
    return np.array([p for p, _ in at], dtype=np.int64), np.array([s for _, s in at], dtype=np.int32)


def flows(loads: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """(arc, count, shard, first slot) in arc order: how the rows of each arc are handed out under the bounds.

    ``loads`` has the rows of each arc, ``owners`` the shard of each arc's node. The shards with lower numbers have the
    larger bound where the rows don't divide evenly. All arcs first fill their own shards, in ring order; then what is left of
    each arc walks clockwise.
    """
    total = sum(loads)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slots, given, left = [0] * shards, [[] for _ in loads], list(loads)

    def give(arc: int, shard: int) -> None:
        n = min(left[arc], room[shard])
        if n:
            given[arc].append((arc, n, shard, slots[shard]))
            slots[shard] += n
            room[shard] -= n
            left[arc] -= n

    for arc, owner in enumerate(owners):
        give(arc, owner)
    for arc in range(len(loads)):
        step = arc
        while left[arc]:
            step = (step + 1) % len(loads)
            give(arc, owners[step])
    return [x for rows in given for x in rows]


def shard(docs: DataFrame, key: str = "key", tie: str = "doc_id", shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot``; ``key`` is a long hash that places a row on the ring.

    ``docs`` is read twice and should be narrow and settled. Rows with one key are neighbours on the ring and stay together
    unless their shard is full; they are counted by salts of ``tie``, so a key of any size is spread over tasks. Rows with
    equal key and tie are exchangeable, nulls among ties are one value. An empty table gives an empty table.
    """
    places, owners = ring(shards, nodes)
    arcs = len(places)
    arc, sub, salt, rank, to, base_n = (free_name(docs, n) for n in ("_arc", "_sub", "_salt", "_r", "_to", "_base"))

    @F.pandas_udf("int")
    def arc_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, keys.to_numpy(np.int64)) % arcs, dtype="int32")

    placed = docs.select("*", arc_of(key).alias(arc), F.col(key).bitwiseAND(SUB - 1).cast("int").alias(sub), F.pmod(F.xxhash64(tie), F.lit(SALTS)).cast("int").alias(salt))
    counts = settled(placed.groupBy(arc, sub, key, salt).agg(F.count("*").alias("_n")))
    subs = settled(counts.groupBy(arc, sub).agg(F.sum("_n").alias("_n")))
    loads = [0] * arcs
    for place, n in subs.groupBy(arc).agg(F.sum("_n")).collect():  # a row per virtual node at most
        loads[place] = n
    parts = flows(loads, owners.tolist(), shards)
    first = np.concatenate([[0], np.cumsum(loads)])[:-1]
    starts = np.concatenate([[0], np.cumsum([p[1] for p in parts])])[:-1].astype(np.int64)
    part_shard = np.array([p[2] for p in parts], dtype=np.int32)
    part_slot = np.array([p[3] for p in parts], dtype=np.int64)

    @F.pandas_udf("shard int, slot long")
    def handed_out(arcs_: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        at = first[arcs_.to_numpy()] + ranks.to_numpy(np.int64)
        part = np.searchsorted(starts, at, side="right") - 1
        return pd.DataFrame({"shard": part_shard[part], "slot": part_slot[part] + at - starts[part]})

    earlier_subs = Window.partitionBy(arc).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    earlier_keys = Window.partitionBy(arc, sub).orderBy(key, salt).rowsBetween(Window.unboundedPreceding, -1)
    sub_starts = subs.select(arc, sub, F.coalesce(F.sum("_n").over(earlier_subs), F.lit(0)).alias("_a"))
    key_starts = counts.select(arc, sub, key, salt, F.coalesce(F.sum("_n").over(earlier_keys), F.lit(0)).alias("_b"))
    base = key_starts.join(sub_starts, [arc, sub]).select(arc, sub, key, salt, (F.col("_a") + F.col("_b")).alias(base_n))
    in_key = Window.partitionBy(arc, sub, key, salt).orderBy(tie)
    ranked = placed.withColumn(rank, F.row_number().over(in_key) - 1).join(base, [arc, sub, key, salt])
    return ranked.withColumn(to, handed_out(arc, F.col(base_n) + F.col(rank))).select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{to}.shard").alias("shard"), F.col(f"{to}.slot").alias("slot"))


def op7(docs: DataFrame) -> DataFrame:
    """All documents in 24 shards; equal texts are neighbours on the ring."""
    text = F.coalesce("text", F.lit(""))
    rows = settled(docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key")))
    return shard(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
