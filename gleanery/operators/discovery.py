"""Finding, checking and grading candidate handles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.grading import assign_tier
from gleanery.functions.markup import LISTING_TERMS, display_name, find_all, is_listing_page, item_count
from gleanery.functions.scalars import fill_url, utf16_length

# Words that look like handles in links but are not.
STOP_WORDS = (
    "bounties", "api", "login", "signup", "static", "assets", "about", "terms", "privacy", "help",
    "contact", "docs", "blog", "careers", "pricing", "features", "dashboard", "settings", "profile",
    "account", "admin", "support", "status", "health", "ping", "test", "dev", "staging", "production",
    "www", "cdn", "img", "images", "css", "js", "fonts", "favicon", "robots", "sitemap", "search",
    "filter", "sort", "page", "next", "prev", "first", "last", "home", "index", "main", "popular",
    "trending", "featured", "recent", "latest", "top", "best", "new", "all", "public", "open", "closed",
    "completed", "active", "inactive", "leaderboard", "explore", "discover", "browse", "categories",
    "tags", "topics",
)
HANDLE = "[a-zA-Z0-9_-]+"


def link_patterns(site_host: str, extended: bool = False) -> tuple[str, ...]:
    """Handle patterns for pages of one site; ``extended`` adds the forge links and drops the loose path."""
    host = site_host.replace(".", r"\.")
    # Where handles appear in a page.
    local = (rf'href="/({HANDLE})/bounties"', rf'href="/({HANDLE})"', rf"@({HANDLE})")
    if extended:
        return (
            rf"{host}/({HANDLE})/bounties", rf"{host}/({HANDLE})", rf'href="[^"]*/({HANDLE})/bounties[^"]*"',
            *local, rf"github\.com/({HANDLE})",
        )
    return (rf"/({HANDLE})/bounties", rf"{host}/({HANDLE})", *local)


def listing_pattern(site_host: str) -> str:
    host = site_host.replace(".", r"\.")
    return rf"{host}/({HANDLE})/bounties"


def extract_handles(
    pages: DataFrame, patterns: Sequence[str], stop: Sequence[str] | DataFrame = STOP_WORDS, text: str = "html",
    stop_column: str = "word", fold: bool = True,
) -> DataFrame:
    """Distinct handles (2 to 50 characters) mentioned in a corpus.

    Matches are made distinct per page before they leave the scan. Stop words are a literal list, or a
    table for an anti join. With ``fold`` they are compared without case.
    """
    per_page = F.array_distinct(F.concat(*[find_all(text, p) for p in patterns]))
    key = F.lower("handle") if fold else F.col("handle")
    found = (
        pages.select(F.explode_outer(per_page).alias("handle"))
        .where("handle IS NOT NULL")
        .where(F.length("handle").between(2, 50))
        .distinct()
    )
    if isinstance(stop, DataFrame):
        words = stop.select(F.col(stop_column).alias("_stop")).distinct()
        return found.join(words, key == F.col("_stop"), "left_anti")
    return found.where(~key.isin(*stop)) if stop else found


def affix_candidates(bases: DataFrame, prefixes: Sequence[str], suffixes: Sequence[str], base: str = "handle") -> DataFrame:
    """Each base with each affix, joined plainly and with a hyphen. Affixes are arguments, so no join."""
    b = F.col(base)
    made = [F.concat(F.lit(p + sep), b) for p in prefixes for sep in ("", "-")]
    made += [F.concat(b, F.lit(sep + s)) for s in suffixes for sep in ("", "-")]
    return bases.select(F.explode(F.array(*made)).alias("handle"))


def letter_number_candidates(letters: DataFrame, upto: int = 99, letter: str = "handle") -> DataFrame:
    """Each letter alone and followed by 0 up to ``upto``."""
    numbers = F.transform(F.sequence(F.lit(0), F.lit(upto)), lambda n: F.concat(F.col(letter), n.cast("string")))
    return letters.select(F.explode(F.concat(F.array(letter), numbers)).alias("handle"))


def number_candidates(spark, first_year: int, last_year: int, upto: int, prefixes: Sequence[str] = ("", "v", "x")) -> DataFrame:
    """Years, then 1 up to ``upto`` plain and behind each prefix. ``pos`` gives the order."""
    years = spark.range(first_year, last_year + 1).select(
        (F.col("id") - first_year).alias("pos"), F.col("id").cast("string").alias("handle")
    )
    shift, width = last_year - first_year + 1, len(prefixes)
    forms = F.array(*[F.concat(F.lit(p), F.col("id").cast("string")) for p in prefixes])
    numbers = spark.range(1, upto + 1).select("id", F.posexplode(forms).alias("_i", "handle"))
    return years.unionByName(numbers.select((shift + (F.col("id") - 1) * width + F.col("_i")).alias("pos"), "handle"))


def page_candidates(templates: DataFrame, pages: int, template: str = "template") -> DataFrame:
    """Listing URLs: each template for page 1 up to ``pages``."""
    numbered = F.transform(
        F.sequence(F.lit(1), F.lit(pages)), lambda n: F.concat(F.col(template), n.cast("string"))
    )
    return templates.select(F.posexplode(numbered).alias("page", "url")).withColumn("page", F.col("page") + 1)


def new_candidates(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct candidates of 2 to 50 characters that are not known yet."""
    fits = utf16_length("handle").between(2, 50)
    return candidates.select("handle").where(fits).distinct().join(known.select("handle").distinct(), "handle", "left_anti")


def classify_candidates(candidates: DataFrame, probes: DataFrame) -> DataFrame:
    """Candidates with outcome valid, invalid or error from one landed probe row per handle."""
    outcome = (
        F.when(F.coalesce("error", F.lit("")) != "", "error").when(F.col("status") == 200, "valid").otherwise("invalid")
    )
    return candidates.join(probes.select("handle", "status", "error"), "handle", "left").select(
        "handle", outcome.alias("outcome")
    )


def candidate_totals(classified: DataFrame) -> DataFrame:
    return classified.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("valid", "invalid", "error")],
    )


def merge_handles(*sources: tuple[str, DataFrame]) -> DataFrame:
    """Distinct handles with the method of the first source that has them. Sources come in order."""
    tagged = [df.select("handle", F.lit(i).alias("_rank")) for i, (_, df) in enumerate(sources)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    names = F.array(*[F.lit(name) for name, _ in sources])
    # The least of a number is found by hashing; a struct or a text would have to be sorted first.
    return out.groupBy("handle").agg(F.min("_rank").alias("_rank")).select("handle", F.get(names, F.col("_rank")).alias("discovery_method"))


def page_facts(
    pages: DataFrame, terms: Sequence[str] = LISTING_TERMS, at_least: int = 3, text: str = "html", count: Column | None = None
) -> DataFrame:
    """Per page: whether it is a listing, its item count and name. The text is dropped."""
    keep = [c for c in pages.columns if c != text]
    return pages.select(
        *keep,
        is_listing_page(text, terms, at_least).alias("is_listing"),
        (item_count(text) if count is None else count).alias("item_count"),
        display_name(text).alias("page_name"),
        F.col(text).isNotNull().alias("loaded"),
    )


def validate_orgs(discovered: DataFrame, facts: DataFrame, min_items: int = 1) -> DataFrame:
    """Discovered rows checked against their page: validated, active, item count and name.

    A page that was landed without a text did not load, and validates nothing.
    """
    found = facts.select(
        "handle", F.col("is_listing").alias("_listing"), F.col("item_count").alias("_n"), F.col("page_name").alias("_name"),
        (F.col("loaded") if "loaded" in facts.columns else F.lit(True)).alias("_seen"),
    )
    seen = F.coalesce("_seen", F.lit(False))
    own = F.nullif("display_name", F.lit(""))
    unnamed = own.isNull() | (own == F.col("handle"))
    rest = [c for c in discovered.columns if c not in ("handle", "display_name", "item_count", "active", "validated")]
    return discovered.join(found, "handle", "left").select(
        "handle",
        F.when(seen & unnamed, F.coalesce(F.nullif("_name", F.lit("")), "display_name")).otherwise(F.col("display_name")).alias("display_name"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("item_count"),
        F.coalesce(seen & F.col("_listing") & (F.col("_n") >= min_items), F.lit(False)).alias("active"),
        seen.alias("validated"),
        *rest,
    )


def graded_registry(discovered: DataFrame, url_template: str) -> DataFrame:
    """Registry rows of the active, validated organizations with tier and interval."""
    return (
        discovered.where("active AND validated")
        .withColumn("_tier", assign_tier("item_count"))
        .select(
            "handle", "display_name", fill_url(url_template, "handle").alias("url"), F.lit(True).alias("active"),
            F.col("_tier.scrape_interval").alias("scrape_interval"), F.col("_tier.tier").alias("tier"),
        )
    )


def count_by_method(discovered: DataFrame) -> DataFrame:
    return discovered.groupBy("discovery_method").agg(F.count("*").alias("count"))


def count_by_tier(registry: DataFrame) -> DataFrame:
    return registry.groupBy("tier").agg(F.count("*").alias("count"))


def registry_summary(discovered: DataFrame) -> DataFrame:
    """Rows (section, key, count): totals and counts by discovery method."""
    totals = discovered.agg(
        F.count("*").alias("total_discovered"), F.count_if(F.col("active") & F.col("validated")).alias("active_organizations")
    ).withColumn("inactive_organizations", F.col("total_discovered") - F.col("active_organizations"))
    names = ("total_discovered", "active_organizations", "inactive_organizations")
    rows = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("count")) for n in names])
    sections = lambda df, name: df.select(F.lit(name).alias("section"), "key", "count")
    by_method = count_by_method(discovered).withColumnRenamed("discovery_method", "key")
    return sections(totals.select(F.inline(rows)), "totals").unionByName(sections(by_method, "discovery_methods"))
