"""Mixing sources to target weights, in DataFrame functions only.

Every row gets a hash-random key. The key's range is cut into buckets beforehand, so the rows of a source are range-sorted
bucket by bucket, and a row's prefix sum is the sum of the earlier buckets plus the sum of the earlier rows in its own bucket.
A hot source is spread over all its buckets; the only tables that are sorted whole have a row per source, or per source and
bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import broadcast_if_small, settled, words

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BUCKETS = 1024


def random_key(doc_id: str | Column, seed: int = 0) -> Column:
    """60 bits of the MD5 of seed and id: the same on every run and in every engine."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, size) of one row per source, with its target and budget.

    Sources in order of code points, null last, have the weights in turn. They share the sum of all sizes; a target stops at
    ``most`` times its size and the excess goes to the others by weight. That end state is ``least(most * size, level * w)``,
    with the level read off the sources in order of ``size / w``: the largest of (what is left) / (weight left).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    filled = Window.orderBy(F.col("size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weighted = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long"))
    left = F.sum("size").over(everything) - F.coalesce(F.sum(F.col("size") * most).over(filled), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0))
    leveled = weighted.withColumn("level", left.cast("double") / weight_left)
    target = F.least((F.col("size") * most).cast("double"), F.max("level").over(everything) * F.col("weight"))
    return leveled.select("source", "size", target.alias("target"), F.round(target).cast("long").alias("budget"))


def mix(
    docs: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id", weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS, seed: int = 0, buckets: int = BUCKETS,
) -> DataFrame:
    """All rows with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_taken``, the words that the mix takes of them.

    A source whose budget is above its size is read whole as often as it fits. Of the last epoch those rows are taken whose
    prefix sum in key order lies below the rest of the budget; the row at the cut gives just the words that are missing, so
    the words taken of a source are its budget exactly.

    A null source is a source. Null ids have the key of the empty text. Rows with equal keys stand in the order of size and a
    hash of all columns; rows equal in all columns are exchangeable. Nothing is taken of a row without words. An empty table
    gives an empty table. Extra columns stay as they are, except that the four names above are replaced.
    """
    own = [c for c in docs.columns if c not in ("mix_size", "mix_source_size", "mix_target", "mix_taken")]
    # The row travels as one struct, so that no column of it meets a name used here.
    row = F.struct(*[F.col(f"`{c}`") for c in own])
    keyed = docs.select(row.alias("row"), F.col(source).alias("source"), random_key(doc_id, seed).alias("key"), size.cast("long").alias("size"))
    keyed = keyed.withColumn("place", F.struct("key", "size", F.xxhash64("row").alias("hash")))
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("at")))
    return _placed(keyed, "key", weights, most, buckets).select("row.*", F.col("size").alias("mix_size"), "mix_source_size", "mix_target", taken.alias("mix_taken"))


def _placed(keyed: DataFrame, key: str, weights: Sequence[int], most: int, buckets: int) -> DataFrame:
    """``keyed`` (source, key, size, place) with the words before each row of its source (``at``), the whole ``epochs`` taken and the ``rest``."""
    high = 1 << 60
    keyed = keyed.withColumn("bucket", F.floor(F.col(key) / F.lit(high // buckets)).cast("int"))
    sums = settled(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("size")), weights, most).withColumnRenamed("source", "of")
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .join(targets, F.col("source").eqNullSafe(F.col("of")))
        .select(F.col("source").alias("of"), F.col("bucket").alias("part"), "start", F.col("size").alias("mix_source_size"), F.col("target").alias("mix_target"), "budget")
    )
    in_bucket = Window.partitionBy("source", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("mix_source_size") > 0, F.floor(F.col("budget") / F.greatest("mix_source_size", F.lit(1)))).otherwise(0)
    return (
        keyed.withColumn("before", F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("part")))
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("mix_source_size"))
        .withColumn("at", F.col("start") + F.col("before"))
        .drop("of", "part", "start", "before", "budget", "bucket")
    )


def mixed_rows(docs: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id", weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """The rows of the mix: each as often as its words are taken, with the columns of ``docs``.

    Rows are whole: of the one row at a source's cut, a further copy is given if half of its words or more are taken. What is
    placed and summed are keys, sizes and a hash of each row. It leaves one cut per source, against which the rows are held where
    they are read, so that texts are neither sorted nor shuffled. Rows equal in all columns that lie at a cut are exchangeable:
    one of them stands for all, as often as they are taken together.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    place = F.struct(random_key(doc_id, seed).alias("key"), size.cast("long").alias("size"), F.xxhash64(whole).alias("hash"), F.xxhash64(F.lit(1), whole).alias("other"))
    rows = docs.select(whole.alias("doc"), F.col(source).alias("source"), place.alias("place"))
    narrow = rows.select("source", F.col("place.key").alias("doc_key"), F.col("place.size").alias("size"), "place")
    placed = settled(_placed(narrow, "doc_key", weights, most, buckets))
    open_ = (F.col("at") < F.col("rest")) & (F.col("size") > 0)
    last = placed.groupBy("source").agg(F.max("epochs").alias("epochs"), F.max("rest").alias("rest"), F.max(F.when(open_, F.col("place"))).alias("cut"))
    cuts = settled(last)
    same = placed.select(F.col("source").alias("of"), "place", "at").join(broadcast_if_small(cuts), F.col("of").eqNullSafe(F.col("source")) & (F.col("place") == F.col("cut")))
    tied = same.groupBy("of").agg(F.count("*").alias("tied"), F.min("at").alias("tied_at"))
    extra = F.least(F.col("tied"), F.round((F.col("rest") - F.col("tied_at")) / F.col("cut.size")).cast("long"))
    known = cuts.join(tied, F.col("source").eqNullSafe(F.col("of")), "left").select(F.col("source").alias("of"), "epochs", "cut", (F.col("tied") * F.col("epochs") + extra).alias("at_cut"))
    held = rows.join(broadcast_if_small(settled(known)), F.col("source").eqNullSafe(F.col("of")))
    empty = F.col("place.size") <= 0
    copies = F.when(empty, 0).otherwise(F.col("epochs") + F.when(F.col("place") < F.col("cut"), 1).otherwise(0)).cast("int")
    here = F.coalesce(F.col("place") == F.col("cut"), F.lit(False))
    most_rows = held.where(~here).select("doc", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    at_cut = held.where(here).dropDuplicates(["of"]).select("doc", F.explode(F.array_repeat(F.lit(0), F.col("at_cut").cast("int"))).alias("copy"))
    return most_rows.unionByName(at_cut).select("doc.*")


def op3(docs: DataFrame) -> DataFrame:
    """The mix of all documents, a row per document."""
    mixed = mix(docs.select("doc_id", "source", words("text").alias("size")), F.col("size"))
    return mixed.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER p, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS level
  FROM weighted
  WINDOW p AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, max(level) OVER () * w) AS target FROM leveled),
placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN budget // greatest(source_size, 1) * size
              + greatest(0, least(size, budget - budget // greatest(source_size, 1) * source_size - earlier)) ELSE 0 END)::BIGINT AS taken
FROM placed
"""
