"""Labels derived from text, amounts and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.scalars import col, let

# Tags that a repository name implies.
REPO_TAGS = {
    "zio": ("scala", "functional"),
    "react": ("javascript", "frontend"),
    "vue": ("javascript", "frontend"),
    "angular": ("javascript", "typescript", "frontend"),
    "spring": ("java", "backend"),
    "django": ("python", "backend"),
    "rails": ("ruby", "backend"),
    "express": ("javascript", "nodejs", "backend"),
}
# Terms looked for in titles.
TITLE_TERMS = (
    "api", "frontend", "backend", "database", "ui", "ux", "performance",
    "security", "testing", "documentation", "bug", "feature", "enhancement",
    "typescript", "javascript", "python", "java", "scala", "rust", "go",
    "react", "vue", "angular", "svelte", "docker", "kubernetes",
)
# Terms that raise or lower the difficulty.
COMPLEX_TERMS = ("architecture", "algorithm", "optimization", "performance", "security")
SIMPLE_TERMS = ("fix", "update", "add", "simple", "minor")
# Tag parts that count as a language.
LANGUAGE_TERMS = (
    "typescript", "javascript", "python", "rust", "go", "java", "react", "vue", "angular", "node",
)
# Upper edges of the value and age ranges with their names.
VALUE_RANGES = (
    ("under_50", 50), ("50_to_100", 100), ("100_to_250", 250),
    ("250_to_500", 500), ("500_to_1000", 1000), ("over_1000", None),
)
AGE_RANGES = (
    ("less_than_week", 7), ("week_to_month", 30), ("month_to_quarter", 90),
    ("quarter_to_year", 365), ("over_year", None),
)
# Tiers by item count with their check interval in seconds.
TIERS = (("highly-active", 10, 900), ("active", 5, 1800), ("emerging", 1, 3600), ("platform", 0, 7200))


def contains_term(lowered: Column, term: str, match: str = "substring") -> Column:
    """``match='word'`` asks for the term as a whole word instead of any substring."""
    if match == "word":
        return F.rlike(lowered, F.lit(rf"(^|[^0-9a-z_])\Q{term}\E($|[^0-9a-z_])"))
    return F.contains(lowered, F.lit(term))


def any_term(lowered: Column, terms: Sequence[str], match: str = "substring") -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | contains_term(lowered, t, match)
    return out


def matching_terms(text: Column | str, terms: Sequence[str], match: str = "substring") -> Column:
    """The terms found in the text, in list order. The text is lowered once."""
    found = lambda lowered: F.array_compact(F.array(*[F.when(contains_term(lowered, t, match), F.lit(t)) for t in terms]))
    return let(F.lower(col(text)), found)


def derive_tags(
    title: Column | str,
    repo: Column | str | None = None,
    repo_tags: Mapping[str, Sequence[str]] = REPO_TAGS,
    terms: Sequence[str] = TITLE_TERMS,
    match: str = "substring",
) -> Column:
    """Repository name, the tags it implies and the title terms; distinct, first-seen order."""
    parts = []
    if repo is not None:
        name = F.lower(col(repo))
        parts.append(F.array(name))
        for pattern, tags in repo_tags.items():
            implied = F.array(*[F.lit(t) for t in tags])
            parts.append(F.when(F.contains(name, F.lit(pattern)), implied).otherwise(F.array().cast("array<string>")))
    parts.append(matching_terms(title, terms, match))
    return F.array_distinct(F.array_compact(F.concat(*parts)))


# Amounts from which a difficulty holds whatever the title says, and the amount that lifts the others.
AMOUNT_LEVELS = ((2000, "expert"), (1000, "advanced"), (500, "intermediate"))
LIFTING_AMOUNT = 200


def infer_difficulty(amount: Column | str, title: Column | str) -> Column:
    a, t = col(amount), F.lower(col(title))
    lifted = lambda high, low: F.when(a >= LIFTING_AMOUNT, high).otherwise(low)
    by_title = (
        F.when(any_term(t, COMPLEX_TERMS), lifted("advanced", "intermediate"))
        .when(any_term(t, SIMPLE_TERMS), "beginner")
        .otherwise(lifted("intermediate", "beginner"))
    )
    return F.coalesce(*[F.when(a >= least, level) for least, level in AMOUNT_LEVELS], by_title)


def range_label(value: Column, ranges: Sequence[tuple[str, float | None]]) -> Column:
    """Name of the first range whose upper edge is above the value; NULL stays NULL."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for name, edge in ranges:
        out = out.otherwise(F.lit(name)) if edge is None else out.when(value < edge, name)
    return out


def value_range(amount: Column | str, ranges: Sequence[tuple[str, float | None]] = VALUE_RANGES) -> Column:
    return range_label(col(amount), ranges)


def age_days(created_at: Column | str, as_of: Column) -> Column:
    """Fractional days between two instants."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(as_of) - micros(col(created_at))) / F.lit(86_400_000_000.0)


def age_range(created_at: Column | str, as_of: Column) -> Column:
    return range_label(age_days(created_at, as_of), AGE_RANGES)


def assign_tier(count: Column | str) -> Column:
    """struct(tier, scrape_interval) from an item count."""
    n = col(count)
    out = None
    for name, at_least, seconds in TIERS:
        row = F.struct(F.lit(name).alias("tier"), F.lit(seconds).cast("bigint").alias("scrape_interval"))
        out = F.when(n >= at_least, row) if out is None else out.when(n >= at_least, row)
    return out.otherwise(row)


def label_or_unknown(c: Column | str) -> Column:
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit("unknown"))
