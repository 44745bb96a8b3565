"""Prefix trie of conversations with totals of all subtrees, by depth bands.

A node is a distinct sequence of first turns. Its key is a running hash of the turns with their places, taken in runs of bounded
length, so a very long conversation is many tasks. Totals go up the trie in bands of fixed height: a node explodes to its
ancestors within its own band only, and the nodes on top of the bands, which stand for all that is below them in their band, form
a trie of their own that is a band's height lower. That trie is rolled up in the same way, and its completed totals go back into
the bands above. A node explodes at most ``BAND`` times a level, and the levels are the logarithm of the greatest depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import settled
from gleanery.operators.scans import number_within

BAND = 16
#: Turns of one running hash, and conversation ids of one text fragment.
RUN = 1024
FRAGMENT = 4096
#: Every so many conversations one lends its first turns to those that follow it, up to so many turns.
GROUP, MOST_LENT = 5, 8
NO_ENDS = hashlib.sha256(b"").hexdigest()

KEY = ["ka", "kb"]


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, turn_hash, bytes): the turns of each conversation in order, from 1.

    Turns are in the order of ``turn``, null first, equal ones in the order of their hash. Null roles and texts are empty.
    Repeated rows are turns of their own. Rows without a conversation id belong to none and are left out. Texts stay in the scan;
    from here on a turn is a 128-bit hash and its text's bytes.
    """
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    digest = F.unhex(F.md5(F.concat(F.octet_length(by).cast("string"), F.lit("|"), by, said)))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("turn_hash"), F.octet_length(said).cast("long").alias("bytes")
    )
    return number_within(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("turn_hash")], "pos").select("conv", "pos", "turn_hash", "bytes")


def lent(conv: Column) -> Column:
    """Number of turns that a conversation takes from the first one of its group."""
    return F.crc32(conv.cast("string")) % (MOST_LENT + 1)


def spliced(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of another, and all their ids (also of those left without a turn).

    Conversation c gets the first ``lent(c)`` turns of conversation c - c % 5, all if it has fewer, none if it isn't there, and
    then its own turns after its own first ``lent(c)``.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("n")).withColumn("base", F.col("conv") - F.col("conv") % GROUP).withColumn("lent", lent(F.col("conv")))
    there = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = settled(convs.join(there, "base", "left").withColumn("got", F.least("lent", F.coalesce("base_n", F.lit(0)))).select("conv", "base", "lent", "got"))
    # Only the first few turns of a conversation are lent, so none of them is hot; its own turns meet one row per conversation.
    head = turns.where(F.col("pos") <= MOST_LENT).withColumnRenamed("conv", "base").join(convs, "base").where(F.col("pos") <= F.col("lent")).select("conv", "pos", "turn_hash", "bytes")
    tail = turns.join(convs, "conv").where(F.col("pos") > F.col("lent")).select("conv", (F.col("pos") - F.col("lent") + F.col("got")).alias("pos"), "turn_hash", "bytes")
    return head.unionByName(tail), convs.select("conv")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, ka, kb, pa, pb, bytes): the node of each prefix, the node before it, and the bytes of its last turn.

    A key is the exclusive-or of two 64-bit hashes of each turn and its place. Runs of turns are hashed apart, and a run begins
    with what the runs before it come to.
    """
    placed = turns.select(
        "conv", F.col("pos").alias("depth"), "bytes", F.floor((F.col("pos") - 1) / RUN).alias("run"),
        F.xxhash64("pos", "turn_hash").alias("a"), F.xxhash64("turn_hash", "pos", F.lit(1)).alias("b"),
    )
    upto = Window.partitionBy("conv", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("conv", "run").agg(F.bit_xor("a").alias("run_a"), F.bit_xor("b").alias("run_b"))
    runs = runs.select("conv", "run", F.bit_xor("run_a").over(earlier).alias("ca"), F.bit_xor("run_b").over(earlier).alias("cb")).where("run > 0")
    whole = lambda k, c: F.bit_xor(k).over(upto).bitwiseXOR(F.coalesce(F.col(c), F.lit(0).cast("long")))
    found = placed.join(runs, ["conv", "run"], "left").select("conv", "depth", "bytes", "a", "b", whole("a", "ca").alias("ka"), whole("b", "cb").alias("kb"))
    return found.select("conv", "depth", "ka", "kb", F.col("ka").bitwiseXOR(F.col("a")).alias("pa"), F.col("kb").bitwiseXOR(F.col("b")).alias("pb"), "bytes")


def _paths(rows: DataFrame, step: int, values: Sequence[str], band: int) -> DataFrame:
    """(ka, kb, ..., aka, akb, next): the nodes of a level with their ancestors in their band.

    ``rows`` are the prefixes at depths 1, 1 + step, ... of every conversation; ``own`` marks those whose node is named by this
    conversation. A node on top of a band also comes with its path through the band above, as ``next``.
    """
    at = F.floor((F.col("depth") - 1) / step)
    group = F.floor(at / band)
    on_top = (at % band == 0) & (at > 0)
    groups = rows.withColumn("at", at).withColumn("g", F.explode(F.when(on_top, F.array(group, group - 1)).otherwise(F.array(group))))
    # At most band + 1 prefixes of one conversation; those of no node of its own are needed as ancestors only.
    held = groups.groupBy("conv", "g").agg(F.collect_list(F.struct("at", *KEY, "own", *values)).alias("held"), F.bool_or("own").alias("any")).where("any")
    nodes = held.select("g", "held", F.explode(F.filter("held", lambda x: x["own"])).alias("x"))
    is_next = F.floor(F.col("x.at") / band) > F.col("g")
    above = F.filter("held", lambda y: (y["at"] <= F.col("x.at")) & (F.floor(y["at"] / band) == F.col("g")))
    return nodes.select("x.ka", "x.kb", *[f"x.{v}" for v in values], is_next.alias("next"), F.explode(above).alias("y")).select(
        "ka", "kb", *values, "next", F.col("y.ka").alias("aka"), F.col("y.kb").alias("akb")
    )


def subtree_sums(rows: DataFrame, values: Sequence[str], depth: int, step: int = 1, band: int = BAND) -> DataFrame:
    """(ka, kb, *values): for each node the sums over its subtree, itself included, of values given with its ``own`` row.

    ``rows`` (conv, depth, ka, kb, own, *values) are the prefixes at depths 1, 1 + step, ... up to ``depth``.
    """
    paths = settled(_paths(rows, step, values, band))
    up = lambda found: found.groupBy(F.col("aka").alias("ka"), F.col("akb").alias("kb")).agg(*[F.sum(v).alias(v) for v in values])
    inside = up(paths.where("not next"))
    if depth <= step * band:
        return inside
    inside = settled(inside)
    tops = rows.where((F.col("depth") - 1) % (step * band) == 0).drop(*values).join(inside, KEY, "left")
    done = subtree_sums(tops, values, depth, step * band, band)
    below = up(paths.where("next").drop(*values).join(done, KEY))
    return up(inside.unionByName(below).withColumnsRenamed({"ka": "aka", "kb": "akb"}))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids from fragments in order, one at a time."""
    key, held = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([held.hexdigest()])], ["ka", "kb", "ends_sha256"])

    for batch in batches:
        for a, b, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (a, b) != key:
                if key is not None:
                    yield out()
                key, held = (a, b), hashlib.sha256(ids.encode())
            else:
                held.update(b"," + ids.encode())
    if key is not None:
        yield out()


def end_digests(ends: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256) from (conv, ka, kb): SHA-256 of each node's ids, ascending and joined by commas.

    Ids are joined in fragments of bounded length, so that what passes a node's one running hash is few rows.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    fragments = ends.groupBy(*KEY, F.floor(F.col("conv") / FRAGMENT).alias("at")).agg(ids.alias("ids"))
    return fragments.repartition(*KEY).sortWithinPartitions(*KEY, "at").select(*KEY, "ids").mapInArrow(_digests, "ka long, kb long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node of the trie of ``turns`` (conv, pos, turn_hash, bytes), the root among them, for all ``convs`` (conv).

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes
    in the subtree), saved_tokens (over the subtree, (n_convs - 1) times the bytes of a node's last text), ends_sha256 (of the
    members that end here). Conversations without turns end at the root. Without conversations there is no node.
    """
    rows = settled(prefixes(turns))
    zero = F.lit(0).cast("long")
    made = rows.groupBy(*KEY, "depth").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.min("pa").alias("pa"), F.min("pb").alias("pb")
    )
    root = convs.distinct().agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("ka"), zero.alias("kb"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("bytes"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb")
    )
    nodes = settled(made.unionByName(root))
    children = nodes.where("pa IS NOT NULL").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count("*").alias("n_children"))
    counted = settled(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero)))
    worth = counted.where("depth > 0").select(
        F.col("conv_id").alias("conv"), "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
        F.lit(True).alias("own"),
    )
    values = ["n_leaves", "saved_tokens"]
    named = rows.select("conv", "depth", *KEY).join(worth, ["conv", "depth"], "left").withColumn("own", F.coalesce("own", F.lit(False)))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = subtree_sums(named, values, deepest, band=band)
    all_of_it = worth.agg(F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens"))
    sums = sums.unionByName(all_of_it.select(zero.alias("ka"), zero.alias("kb"), F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens"))
    last = rows.groupBy("conv").agg(F.max_by(F.struct(*KEY), "depth").alias("last"))
    ends = convs.distinct().join(last, "conv", "left").select("conv", *[F.coalesce(f"last.{k}", zero).alias(k) for k in KEY])
    parents = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return (
        counted.join(sums, KEY).join(parents, ["pa", "pb"], "left").join(end_digests(ends), KEY, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    )


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The trie of conversations as they are; see ``turns_of`` for how rows are read."""
    turns = turns_of(conversations, **columns)
    return prefix_trie(turns, turns.select("conv").distinct())


def op13(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of its group's first one."""
    return prefix_trie(*spliced(settled(turns_of(conversations))))


OP13_SQL = r"""
WITH ordered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || '|' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, x: list_reduce(list_prepend(xor(crc, x), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
        lambda v, i: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT c FROM ordered)),
got AS (SELECT convs.*, least(h, (SELECT count(*) FROM ordered o WHERE o.c = convs.base)) AS s FROM convs),
rebuilt AS (
  SELECT g.c, o.pos, o.role, o.text FROM got g JOIN ordered o ON o.c = g.base AND o.pos <= g.h
  UNION ALL SELECT g.c, o.pos - g.h + g.s, o.role, o.text FROM got g JOIN ordered o ON o.c = g.c AND o.pos > g.h),
prefix AS (
  SELECT c, pos AS d, strlen(text) AS bytes, list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY pos) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, [] FROM convs),
keyed AS (SELECT c, d, bytes, md5(path::VARCHAR || d) AS k, CASE WHEN d > 0 THEN lag(md5(path::VARCHAR || d)) OVER (PARTITION BY c ORDER BY d) END AS parent FROM prefix),
nodes AS (SELECT k, min(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(parent) AS parent, min(bytes) AS bytes FROM keyed GROUP BY k),
children AS (SELECT parent AS k, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
worth AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM nodes LEFT JOIN children USING (k)),
above AS (
  SELECT a.k AS top, w.n_children, w.saved FROM worth w JOIN keyed x ON x.k = w.k AND x.c = w.conv_id JOIN keyed a ON a.c = x.c AND a.d <= x.d),
sums AS (SELECT top AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY 1),
ends AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(k, d) AS k FROM keyed GROUP BY c) GROUP BY k)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM worth w JOIN sums USING (k) LEFT JOIN nodes p ON p.k = w.parent LEFT JOIN ends ON ends.k = w.k
"""
