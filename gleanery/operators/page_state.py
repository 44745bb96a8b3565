"""Page change checks against stored state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.fingerprints import SIGNATURE_PATTERNS, estimate_items, fingerprint
from gleanery.functions.scalars import url_or_template
from gleanery.operators.keyed import last_per_key
from gleanery.operators.scans import PART, PLACE, before_range, in_ranges, with_summary


def page_signatures(
    pages: DataFrame, patterns: Sequence[str] = SIGNATURE_PATTERNS, ignore: Sequence[str] = (),
    mode: str = "counts", **estimate,
) -> DataFrame:
    """Per fetched page: hash and item estimate instead of the HTML. No shuffle."""
    keep = [c for c in pages.columns if c != "html"]
    return pages.select(
        *keep,
        fingerprint("html", patterns, ignore, mode).alias("hash"),
        estimate_items("html", **estimate).alias("item_estimate"),
    )


def handle_signatures(signatures: DataFrame) -> DataFrame:
    """One signature per handle from those of its pages (handle, hash, item_estimate, error if there is one).

    A handle with one page has that page's hash. Of several, the hash is one of their number and of sums that do
    not depend on their order, so a handle with very many pages is an aggregate with a map-side part. A page
    that was not read leaves the handle without a hash, which is a failed check.
    """
    error = F.col("error") if "error" in signatures.columns else F.lit(None).cast("string")
    each = signatures.select("handle", "hash", "item_estimate", error.alias("error"), F.xxhash64("hash").alias("_a"), F.xxhash64(F.reverse("hash")).alias("_b"))
    sums = each.groupBy("handle").agg(
        F.count("*").alias("_n"), F.count("hash").alias("_read"), F.min("hash").alias("_only"), F.sum(F.col("_a").cast("decimal(20,0)")).alias("_a"),
        F.sum(F.col("_b").cast("decimal(20,0)")).alias("_b"), F.sum("item_estimate").alias("item_estimate"), F.min("error").alias("error"),
    )
    whole = F.substring(F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in ("_n", "_a", "_b")]), 256), 1, 16)
    digest = F.when(F.col("_read") == F.col("_n"), F.when(F.col("_n") == 1, F.col("_only")).otherwise(whole))
    return sums.select("handle", digest.alias("hash"), "item_estimate", "error")


def pages_of(pages: DataFrame, handles: DataFrame, most: int = 100_000) -> DataFrame:
    """The pages of some handles (settled, one row each), as they are read.

    Up to ``most`` handles are sent to the readers. More meet the pages by a hash join that builds on the
    handles: pages from a table bucketed by handle (``land_pages``) are not moved for it.
    """
    few = handles.limit(most + 1).count() <= most
    return pages.join(F.broadcast(handles) if few else handles.hint("shuffle_hash"), "handle", "left_semi")


def check_pages(
    registry: DataFrame, signatures: DataFrame, state: DataFrame | None, as_of: Column, url_template: str,
    force_all: bool = False,
) -> DataFrame:
    """One row per registered handle with its outcome and next state.

    ``signatures`` has one row per fetched handle (handle, hash, item_estimate and an optional error).
    A handle without a fetch counts as an error. On error the stored state is carried over, and handles
    no longer registered fall away. No state at all means a first run: every fetched handle has changed.
    """
    fetched = signatures.select(
        "handle", F.col("hash").alias("_hash"), F.col("item_estimate").alias("_estimate"),
        (F.col("error") if "error" in signatures.columns else F.lit(None).cast("string")).alias("_error"),
        F.lit(True).alias("_fetched"),
    )
    joined = registry.select("handle", url_or_template("url", "handle", url_template).alias("_url")).join(
        fetched, "handle", "left"
    )
    if state is None:
        none = lambda kind: F.lit(None).cast(kind)
        joined = joined.select(
            "*", none("string").alias("_old_url"), none("string").alias("_old_hash"),
            none("timestamp").alias("_old_checked"), none("timestamp").alias("_old_changed"),
            none("bigint").alias("_old_estimate"), F.lit(False).alias("_known"),
        )
    else:
        stored = state.select(
            "handle", F.col("url").alias("_old_url"), F.col("hash").alias("_old_hash"),
            F.col("last_checked").alias("_old_checked"), F.col("last_changed").alias("_old_changed"),
            F.col("item_estimate").alias("_old_estimate"), F.lit(True).alias("_known"),
        )
        joined = joined.join(stored, "handle", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    # A page without a hash was not read, whether or not the fetch says why.
    failed = F.col("_fetched").isNull() | F.col("_error").isNotNull() | F.col("_hash").isNull()
    differs = ~F.col("_known") | ~F.col("_hash").eqNullSafe(F.col("_old_hash"))
    now = as_of.cast("timestamp")
    pick = lambda fresh, old: F.when(failed, F.col(old)).otherwise(fresh)
    outcome = F.when(failed, "error").when(F.lit(force_all) | differs, "changed").otherwise("unchanged")
    return joined.select(
        "handle",
        outcome.alias("outcome"),
        F.when(failed, F.coalesce("_error", F.lit("not fetched"))).alias("error"),
        pick(F.col("_url"), "_old_url").alias("url"),
        pick(F.col("_hash"), "_old_hash").alias("hash"),
        pick(now, "_old_checked").alias("last_checked"),
        pick(F.when(differs, now).otherwise(F.col("_old_changed")), "_old_changed").alias("last_changed"),
        pick(F.col("_estimate"), "_old_estimate").alias("item_estimate"),
        (~failed | F.col("_known")).alias("has_state"),
    )


def next_state(checked: DataFrame) -> DataFrame:
    return checked.where("has_state").select("handle", "url", "hash", "last_checked", "last_changed", "item_estimate")


def changed_handles(checked: DataFrame) -> DataFrame:
    return checked.where("outcome = 'changed'").select("handle")


def check_summary(checked: DataFrame) -> DataFrame:
    """One row: checked, changed, unchanged, errors and the share of unchanged in percent."""
    kinds = {"changed": "changed", "unchanged": "unchanged", "errors": "error"}
    counts = checked.agg(
        F.count("*").alias("total_checked"), *[F.count_if(F.col("outcome") == k).alias(n) for n, k in kinds.items()]
    )
    share = F.round(F.try_divide(F.col("unchanged") * F.lit(100.0), F.col("total_checked")), 1)
    return counts.withColumn("skipped_percent", share)


def carry_last_changed(history: DataFrame, key: str, at: str, value: str, tie: Sequence[str]) -> DataFrame:
    """Add ``changed`` and ``last_changed`` to a check history.

    A check has changed when its value differs from the key's previous check (the first one always
    has). Checks are cut into sorted ranges of key and time, and a key that is large is split wherever it is,
    also within one day. One summary row per key and range carries the last value and change time on to
    the ranges that follow; only these summaries of a key meet in one place.
    """
    rows = in_ranges(history, [key], [at, *tie])
    inside = Window.partitionBy(key, PART).orderBy(PLACE)
    rows = rows.withColumn("_before", F.lag(F.struct(value)).over(inside))
    first = F.col("_before").isNull()
    moved = ~F.col(value).eqNullSafe(F.col(f"_before.{value}"))
    ranges = rows.groupBy(key, PART).agg(
        F.min_by(F.struct(value, at), PLACE).alias("_first"),
        F.max_by(F.struct(value), PLACE).alias("_last"),
        F.max(F.when(~first & moved, F.col(at))).alias("_moved_at"),
    )
    ranges = ranges.withColumn("_prior", F.lag("_last").over(Window.partitionBy(key).orderBy(PART)))
    opens = F.col("_prior").isNull() | ~F.col(f"_first.{value}").eqNullSafe(F.col(f"_prior.{value}"))
    ranges = ranges.withColumn("_opens", opens).withColumn(
        "_change", F.coalesce("_moved_at", F.when(F.col("_opens"), F.col(f"_first.{at}")))
    )
    ranges = ranges.withColumn("_carried", F.last("_change", ignorenulls=True).over(before_range([key])))
    joined = with_summary(rows, ranges, [key], "_opens", "_carried").withColumn("changed", F.when(first, F.col("_opens")).otherwise(moved))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("changed"), F.col(at)), ignorenulls=True).over(running)
    return joined.withColumn("last_changed", F.coalesce(last, F.col("_carried"))).drop(PART, PLACE, "_before", "_opens", "_carried")


def due(registry: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """Registered handles never checked, or last checked at least their interval ago."""
    checked = state.select("handle", "last_checked")
    age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_checked").cast("timestamp"))
    return (
        registry.join(checked, "handle", "left")
        .where(F.col("last_checked").isNull() | (age >= F.col("scrape_interval") * 1_000_000))
        .select(*registry.columns, "last_checked")
    )


def latest_signatures(signatures: DataFrame, order: Sequence[str]) -> DataFrame:
    """Last fetch per handle."""
    return last_per_key(signatures, ["handle"], order)
