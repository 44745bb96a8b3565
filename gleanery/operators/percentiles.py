"""Exact percentiles without bringing all values to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A sketch's ranks are off by at most one part in so many.
ACCURACY = 100_000


def _edges(points: Sequence[float], accuracy: int) -> list[float]:
    return [e for p in points for e in (p - 2 / accuracy, p + 2 / accuracy)]


def sketch(value: Column, points: Sequence[float], accuracy: int = ACCURACY) -> Column:
    """A mergeable sketch of the values around each point, for ``bands``. NaN counts as infinity, after which it sorts."""
    return F.percentile_approx(F.nanvl(value, F.lit(float("inf"))), [min(1.0, max(0.0, e)) for e in _edges(points, accuracy)], accuracy)


def bands(found: Column, points: Sequence[float], accuracy: int = ACCURACY) -> Column:
    """Array of (low, high) for each point, from a sketch: its rank lies between these, or is the next one to them."""
    edges = _edges(points, accuracy)
    side = lambda i: F.lit(float("-inf")) if edges[i] <= 0 else F.lit(float("inf")) if edges[i] >= 1 else F.get(found, F.lit(i))
    return F.array(*[F.struct(side(2 * i).alias("low"), side(2 * i + 1).alias("high")) for i in range(len(points))])


def known_bands(rows: DataFrame, value: Column, points: Sequence[float], accuracy: int = ACCURACY) -> Column:
    """The bands of a whole table, read by the driver: two numbers a point."""
    found = rows.agg(sketch(value, points, accuracy).alias("_found")).select(bands(F.col("_found"), points, accuracy).alias("b")).first()["b"]
    if any(e is None for band in found for e in band):
        found = [(float("-inf"), float("inf"))] * len(points)  # no values at all
    return F.array(*[F.struct(F.lit(float(lo)).alias("low"), F.lit(float(hi)).alias("high")) for lo, hi in found])


def cut(value: Column, known: Column, points: Sequence[float]) -> Column:
    """(seg, inside, v): how many bands lie below a value, whether it is in one, and the value if so.

    Bands rise with their points, so this is the order of the values, and all values between two bands are one.
    """
    at = F.nanvl(value, F.lit(float("inf")))
    band = lambda i: F.get(known, F.lit(i))
    below, inside = F.lit(0), F.lit(False)
    for i in range(len(points)):
        below = below + F.when(band(i)["high"] < at, 1).otherwise(0)
        inside = inside | ((at >= band(i)["low"]) & (at <= band(i)["high"]))
    return F.struct(below.alias("seg"), inside.alias("inside"), F.when(inside, value).alias("v"))


def counted(value: Column) -> list[Column]:
    """Aggregates over each ``cut`` that ``from_counts`` reads: its number of rows, least and greatest value."""
    return [F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")]


def from_counts(counts: DataFrame, points: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Rows (*keys, point, percentile) from how often each ``cut`` occurs: (*keys, seg, inside, v, n, lo, hi).

    Only values inside of bands are sorted, a task for each key and segment. A rank beside its band is the
    first or last one between two bands. One that is neither, which the sketch rules out, would fail the job.
    """
    keys, points = list(keys), sorted(set(points))
    parts = counts.groupBy(*keys, "seg").agg(F.sum("n").alias("_sc"))
    earlier = Window.partitionBy(*keys).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(  # at most one row more than there are points
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("seg").alias("_of"),
        F.coalesce(F.sum("_sc").over(earlier), F.lit(0)).alias("_start"), F.sum("_sc").over(Window.partitionBy(*keys)).alias("_n"),
    )
    same = F.col("seg") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    in_part = Window.partitionBy(*keys, "seg").orderBy("inside", "v").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        counts.withColumn("_from", F.coalesce(F.sum("n").over(in_part), F.lit(0)))
        .join(parts if keys else F.broadcast(parts), same).withColumn("_from", F.col("_from") + F.col("_start"))
    )
    rank = lambda p: p * (F.col("_n") - 1)
    holds = lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("n"))
    number = lambda r: (
        F.when(F.col("inside"), F.col("v")).when(r == F.col("_from"), F.col("lo")).when(r == F.col("_from") + F.col("n") - 1, F.col("hi"))
        .otherwise(F.raise_error(F.lit("a rank lies outside of its band")).cast("double"))
    )
    hits = F.array_compact(F.array(*[
        F.when(holds(r), F.struct(F.lit(float(p)).alias("point"), F.lit(upper).alias("upper"), number(r).alias("value")))
        for p in points for r, upper in ((F.floor(rank(F.lit(float(p)))), 0), (F.ceil(rank(F.lit(float(p)))), 1))
    ]))
    ranked = placed.withColumn("_hit", F.explode(hits))
    side = lambda u: F.max(F.when(F.col("_hit.upper") == u, F.col("_hit.value")))
    weight = rank(F.col("point")) - F.floor(rank(F.col("point")))
    # Equal ends need no arithmetic, which would make NaN of an infinity.
    between = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") * (1 - weight) + F.col("_high") * weight)
    return (
        ranked.groupBy(*keys, F.col("_hit.point").alias("point"))
        .agg(side(0).alias("_low"), side(1).alias("_high"), F.max("_n").alias("_n"))
        .select(*keys, "point", between.alias("percentile"))
    )


def exact_percentiles(
    df: DataFrame, value: str, points: Sequence[float], keys: Sequence[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """Rows (*keys, point, percentile) with linear interpolation at ``point * (n - 1)``.

    A sketch gives for each wanted rank a band of values that holds it. A second pass counts the values
    between the bands, and keeps those inside, each value once with its count: some millionths of the rows.
    Groups without a value give no rows.
    """
    keys, points = list(keys), sorted(set(points))
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    if keys:
        found = rows.groupBy(*keys).agg(sketch(F.col("_v"), points, accuracy).alias("_found"))
        named = found.select(*[F.col(k).alias(f"_of_{k}") for k in keys], bands(F.col("_found"), points, accuracy).alias("_bands"))
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
        rows, known = rows.join(named, same), F.col("_bands")
    else:
        known = known_bands(rows, F.col("_v"), points, accuracy)
    pieces = rows.select(*keys, "_v", cut(F.col("_v"), known, points).alias("_c")).select(*keys, "_v", "_c.*")
    return from_counts(pieces.groupBy(*keys, "seg", "inside", "v").agg(*counted(F.col("_v"))), points, keys)


def approx_percentiles(
    df: DataFrame, value: str, points: Sequence[float], keys: Sequence[str] = (), accuracy: int = 100_000
) -> DataFrame:
    """Same shape as ``exact_percentiles`` from one mergeable sketch per key; values are near the rank."""
    found = F.percentile_approx(F.col(value).cast("double"), [float(p) for p in points], accuracy)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in points]).alias("point"), F.col("_f").alias("percentile"))
    return (
        df.groupBy(*keys).agg(found.alias("_f")).where("_f IS NOT NULL")
        .select(*keys, F.inline(pairs).alias("point", "percentile"))
    )


def percentiles_row(df: DataFrame, value: str, points: dict[str, float], exact: bool = True) -> DataFrame:
    """One row with a named column per point, 0 when there are no values."""
    find = exact_percentiles if exact else approx_percentiles
    return named_points(find(df, value, sorted(set(points.values()))), points)


def named_points(found: DataFrame, points: dict[str, float]) -> DataFrame:
    """One row with a named column per point from (point, percentile), 0 where there is none."""
    pick = lambda p: F.coalesce(F.max(F.when(F.col("point") == F.lit(float(p)), F.col("percentile"))), F.lit(0.0))
    return found.agg(*[pick(p).alias(name) for name, p in points.items()])
