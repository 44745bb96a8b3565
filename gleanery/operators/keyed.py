"""First and last row per key, row numbers and bounded grouping.

None of these sorts a whole key group in one task: reductions are aggregates with a map-side part,
and numbering works on range partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _one_per_key(df: DataFrame, keys: Sequence[str], chosen: Callable[[Column], Column]) -> DataFrame:
    """One row per key. The key columns stay those of the grouping, so a join by them moves no row again."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    found = df.groupBy(*keys).agg(chosen(F.struct(*[F.col(c) for c in others])).alias("_row"))
    return found.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``. Order columns must settle all ties."""
    return _one_per_key(df, keys, lambda row: F.min_by(row, _order(order)))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``."""
    return _one_per_key(df, keys, lambda row: F.max_by(row, _order(order)))


def first_source(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """All rows of the best (lowest) source per key.

    The winner per key is a small aggregate; rows then meet it by an equality join, where a hot key's
    rows may be split over tasks.
    """
    best = df.groupBy(*keys).agg(F.min(priority).alias("_best"))
    return (
        df.join(best, list(keys))
        .where(F.col(priority) == F.col("_best"))
        .select(*df.columns)
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where none is set, a folder in the warehouse, which all executors reach as well."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """The rows as they are now, in the checkpoint folder. This runs a job."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def with_row_index(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_index", total: str = "row_total"
) -> DataFrame:
    """Add the 0-based position of each row in the global order and the number of rows.

    The sorted rows are checkpointed (this runs a job), so a row keeps its partition and place in it
    from then on. Only one count per partition is added up centrally.
    """
    checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order).checkpoint()
    placed = ordered.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per range partition: bounded by the shuffle partition setting.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias(total),
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def assign_batches(df: DataFrame, size: int, order: Sequence[str | Column]) -> DataFrame:
    """Add ``batch_no`` and ``batch_count`` (both from 1) for fixed-size batches in the global order."""
    return (
        with_row_index(df, order, "_index", "_total")
        .withColumn("batch_no", F.floor(F.col("_index") / size).cast("bigint") + 1)
        .withColumn("batch_count", F.ceil(F.col("_total") / size).cast("bigint"))
        .drop("_index", "_total")
    )


def in_parts(df: DataFrame, keys: Sequence[str], part_size: int, max_copies: int = 1_000_000) -> DataFrame:
    """Spread each key's rows over parts of about ``part_size`` rows.

    Adds ``part_no`` and ``part_count`` (from 1) and ``copies``: equal rows are merged first and carry
    their number, in blocks of at most ``max_copies``, so copies of one row cannot swell a part. The
    result is partitioned by key and part, so a large key is spread over tasks from here on.
    """
    merged = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    others = [c for c in df.columns if c not in keys]
    blocks = F.ceil(F.col("_copies") / max_copies).cast("bigint")
    sizes = merged.groupBy(*keys).agg(F.ceil(F.sum(blocks) / part_size).cast("bigint").alias("part_count"))
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    left = F.col("_copies") - F.col("_block") * max_copies
    return (
        merged.join(sizes, list(keys))
        .select(*keys, *others, "_copies", "part_count", block.alias("_block"))
        .withColumn("part_no", F.pmod(F.xxhash64(*keys, *others, "_block"), F.col("part_count")) + 1)
        .withColumn("copies", F.least(left, F.lit(max_copies).cast("bigint")))
        .drop("_copies", "_block")
        .repartition(*keys, "part_no")
    )


def nest_in_parts(df: DataFrame, keys: Sequence[str], part_size: int, name: str) -> DataFrame:
    """One row per key and part with the part's rows as an array of structs, ordered by content."""
    rows = in_parts(df, keys, part_size)
    others = [c for c in df.columns if c not in keys]
    nested = F.array_sort(F.collect_list(F.struct(*others, "copies")))
    return rows.groupBy(*keys, "part_no", "part_count").agg(nested.alias(name))


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(by), *[F.asc(t) for t in ties]).limit(k)


def first_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def locale_order(handle: str = "handle") -> Column:
    """Ordering that ignores case first and puts lower case before upper case."""
    return F.expr(f"collate(`{handle}`, 'UNICODE')")


def locale_keys(tier: str | None = None, handle: str = "handle") -> list[Column]:
    """Sort keys: the handle, or the tier descending and then the handle."""
    keys = [locale_order(handle).asc()]
    return keys if tier is None else [locale_order(tier).desc(), *keys]


def sort_by_locale(df: DataFrame, *, tier: str | None = None, handle: str = "handle") -> DataFrame:
    return df.orderBy(*locale_keys(tier, handle))


def with_locale_position(df: DataFrame, *, tier: str | None = None, handle: str = "handle", name: str = "position") -> DataFrame:
    """The rows with their place, from 1, in that order."""
    return with_row_index(df, locale_keys(tier, handle), "_place_", "_all_").withColumn(name, F.col("_place_") + 1).drop("_place_", "_all_")
