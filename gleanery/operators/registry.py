"""Registry filters, requested handles and run outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.scalars import capitalise, fill_url, money_sum, split_handles


def active_orgs(registry: DataFrame) -> DataFrame:
    return registry.where("active")


def requested_handles(requests: DataFrame, text: str) -> DataFrame:
    """Distinct handles from rows of comma lists."""
    return requests.select(F.explode_outer(split_handles(text)).alias("handle")).where("handle IS NOT NULL").distinct()


def parse_requested(text: str) -> list[str]:
    """Handles of one comma list given as an argument; an error when none is left."""
    handles = [h.strip() for h in text.split(",") if h.strip()]
    if not handles:
        raise ValueError("no valid handles in the list")
    return handles


def select_targets(registry: DataFrame, targets: DataFrame) -> DataFrame:
    return registry.join(targets.select("handle").distinct(), "handle", "left_semi")


def missing_targets(registry: DataFrame, targets: DataFrame) -> DataFrame:
    return targets.select("handle").distinct().join(registry.select("handle").distinct(), "handle", "left_anti")


def target_report(registry: DataFrame, targets: DataFrame) -> DataFrame:
    """One row: handles requested, found and not found."""
    wanted = targets.select("handle").distinct()
    known = registry.select("handle").distinct().withColumn("_known", F.lit(True))
    return wanted.join(known, "handle", "left").agg(
        F.count("*").alias("requested"),
        F.count("_known").alias("found"),
        F.count_if(F.col("_known").isNull()).alias("not_found"),
    )


def registry_rows(
    handles: DataFrame, url_template: str, interval: int = 1800, tier: str | None = "active", name: Column | None = None
) -> DataFrame:
    """Full registry rows from bare handles."""
    return handles.select(
        "handle",
        (capitalise("handle") if name is None else name).alias("display_name"),
        fill_url(url_template, "handle").alias("url"),
        F.lit(True).alias("active"),
        F.lit(interval).cast("bigint").alias("scrape_interval"),
        F.lit(tier).cast("string").alias("tier"),
    )


def outcomes(registry: DataFrame, items: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """One row per organization: success, item count, value, duration and error.

    Items are added up per handle before the join. ``pages`` may bring (handle, error, duration_ms); an
    organization with a failed page keeps no items.
    """
    sums = items.groupBy("handle").agg(F.count("*").alias("_n"), money_sum("amount_usd").alias("_value"))
    joined = registry.select("handle").join(sums, "handle", "left")
    if pages is None:
        joined = joined.withColumns({"error": F.lit(None).cast("string"), "duration_ms": F.lit(0).cast("bigint")})
    else:
        runs = pages.groupBy("handle").agg(F.max("error").alias("error"), F.sum("duration_ms").alias("duration_ms"))
        joined = joined.join(runs, "handle", "left")
    ok = F.col("error").isNull()
    return joined.select(
        "handle",
        ok.alias("success"),
        F.when(ok, F.coalesce("_n", F.lit(0))).otherwise(F.lit(0)).alias("item_count"),
        F.when(ok, F.coalesce("_value", F.lit(0.0))).otherwise(F.lit(0.0)).alias("total_value_usd"),
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"),
        "error",
    )


def enrich(
    items: DataFrame, issues: DataFrame, keys: Sequence[str] = ("owner", "repo", "number"),
    fields: Sequence[str] = ("title", "body", "html_url"),
) -> DataFrame:
    """Items with the issue's fields where it has them, else their own.

    ``issues`` holds one row per key. Items stay on the left, so a hot issue's items may be split.
    """
    looked_up = issues.select(*keys, *[F.col(f).alias(f"_issue_{f}") for f in fields])
    joined = items.join(looked_up, list(keys), "left")
    own = lambda f: F.col(f) if f in items.columns else F.lit(None).cast("string")
    merged = {f: F.coalesce(F.nullif(F.col(f"_issue_{f}"), F.lit("")), own(f)) for f in fields}
    return joined.withColumns(merged).drop(*[f"_issue_{f}" for f in fields])


def append_results(*results: DataFrame) -> DataFrame:
    """All rows of several result tables, by column name."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out
