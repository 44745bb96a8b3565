"""Scans along the rows of a key, without bringing a key to one task.

Rows are cut into sorted ranges of (key, order), which split a hot key wherever it is large. What a scan needs from the
ranges before is one short row per key and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.keyed import checkpoint_dir

PART, PLACE = "_part", "_place"


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``df`` sorted by key and order, with the range (``_part``) and the place in it (``_place``) of each row.

    The sorted rows are checkpointed (this runs a job), so a row keeps its range and place from then on.
    """
    checkpoint_dir(df.sparkSession)
    by = [*[F.col(k) for k in keys], *[F.col(o) if isinstance(o, str) else o for o in order]]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).checkpoint()
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.select("*", F.spark_partition_id().alias(PART), place.alias(PLACE))


def before_range(keys: Sequence[str]) -> Window:
    """Window over a key's range summaries (key, ``_part``, ...) before the present one."""
    return Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Add the place, from 1, of each row among those of its key in ``order``; rows equal in it stand in any order."""
    keys = list(keys)
    placed = in_ranges(df, keys, order)
    slices = placed.groupBy(*keys, PART).agg(F.min(PLACE).alias("_first"), F.count("*").alias("_n"))
    offsets = slices.withColumn("_shift", F.coalesce(F.sum("_n").over(before_range(keys)), F.lit(0)) - F.col("_first") + 1)
    return with_summary(placed, offsets, keys, "_shift").withColumn(name, F.col(PLACE) + F.col("_shift")).select(*df.columns, name)


def with_summary(placed: DataFrame, summaries: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    """Rows of ``in_ranges`` with columns of their range's summary; null keys find theirs as well."""
    named = summaries.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(PART).alias("_of"), *columns)
    found = F.col(PART) == F.col("_of")
    for k in keys:
        found = found & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return placed.join(named, found).drop("_of", *[f"_of_{k}" for k in keys])
