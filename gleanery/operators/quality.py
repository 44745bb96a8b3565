"""Data checks: value domains and completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Allowed values of the labelled fields.
ITEM_DOMAINS = {
    "status": ("open", "in_progress", "completed", "closed"),
    "type": ("standard", "premium", "featured"),
    "kind": ("dev", "design", "content", "research"),
    "visibility": ("public", "private"),
    "reward_type": ("cash", "points", "mixed"),
    "reward.currency": ("USD", "EUR", "GBP"),
    "task.status": ("open", "in_progress", "completed"),
    "task.type": ("issue", "feature", "bug", "enhancement"),
    "task.forge": ("github", "gitlab", "bitbucket"),
}
FLAT_DOMAINS = {
    "status": ("open", "claimed", "paid", "closed"),
    "difficulty": ("beginner", "intermediate", "advanced", "expert"),
}
REGISTRY_DOMAINS = {"tier": ("highly-active", "active", "emerging", "platform")}


def check_domains(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (field, value, count) for values outside their domain; NULL is allowed. One scan."""
    bad = [
        F.when(F.col(f).isNotNull() & ~F.col(f).isin(*allowed), F.struct(F.lit(f).alias("field"), F.col(f).alias("value")))
        for f, allowed in domains.items()
    ]
    return (
        df.select(F.explode_outer(F.array_compact(F.array(*bad))).alias("_bad"))
        .where("_bad IS NOT NULL")
        .groupBy("_bad.field", "_bad.value")
        .agg(F.count("*").alias("count"))
    )


def check_required(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows (field, missing, completeness in percent); NULL and '' are missing. One scan."""
    gone = lambda f: F.col(f).isNull() | (F.col(f).cast("string") == "")
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(gone(f)).alias(f"_{i}") for i, f in enumerate(fields)])
    share = lambda i: F.round(F.try_divide((F.col("_n") - F.col(f"_{i}")) * F.lit(100.0), F.col("_n")), 2)
    rows = [
        F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("missing"), share(i).alias("complete_percent"))
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
