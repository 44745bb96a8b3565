"""Totals, histograms, rankings and the statistics report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.grading import (
    AGE_RANGES,
    LANGUAGE_TERMS,
    VALUE_RANGES,
    age_range,
    any_term,
    label_or_unknown,
    value_range,
)
from gleanery.functions.markup import forge_links, is_issue_link
from gleanery.functions.scalars import money_sum
from gleanery.operators.keyed import checkpoint_dir, nest_in_parts, top_k
from gleanery.operators.percentiles import counted, cut, exact_percentiles, from_counts, known_bands, named_points, percentiles_row

# The points of the value distribution.
DISTRIBUTION = {
    "min": 0.0, "max": 1.0,
    "percentile_25": 0.25, "percentile_75": 0.75, "percentile_90": 0.90, "percentile_95": 0.95,
}


def totals(items: DataFrame) -> DataFrame:
    """One row: items, value and organizations."""
    return items.agg(
        F.count("*").alias("total_items"),
        money_sum("amount_usd").alias("total_value_usd"),
        F.countDistinct("handle").alias("total_organizations"),
    )


def rollup_by_org(items: DataFrame, name: str = "display_name") -> DataFrame:
    """One flat row per organization."""
    return items.groupBy("handle").agg(
        F.min(name).alias("display_name"),
        F.count("*").alias("item_count"),
        money_sum("amount_usd").alias("total_value_usd"),
    )


def nested_by_org(items: DataFrame, part_size: int = 10_000) -> DataFrame:
    """Rollup with nested items. Large organizations span several rows, numbered by part."""
    fields = [c for c in items.columns if c != "display_name"]
    parts = nest_in_parts(items.select(*fields), ["handle"], part_size, "items")
    return rollup_by_org(items).join(parts, "handle")


def value_by(items: DataFrame, *keys: str) -> DataFrame:
    return items.groupBy(*keys).agg(money_sum("amount_usd").alias("total_value_usd"))


def average_value(items: DataFrame) -> DataFrame:
    return items.agg(F.coalesce(money_sum("amount_usd") / F.nullif(F.count("amount_usd"), F.lit(0)), F.lit(0.0)).alias("average_value"))


def median_value(items: DataFrame, exact: bool = True) -> DataFrame:
    return percentiles_row(items, "amount_usd", {"median_value": 0.5}, exact)


def value_distribution(items: DataFrame, exact: bool = True) -> DataFrame:
    """One row: min, max and four percentiles, 0 on empty input."""
    return percentiles_row(items, "amount_usd", DISTRIBUTION, exact)


def _range_counts(label: Column, ranges: Sequence[tuple[str, float | None]]) -> list[Column]:
    return [F.count_if(label == name).alias(name) for name, _ in ranges]


def _histogram(items: DataFrame, label: Column, ranges, key: str, skip_empty: bool) -> DataFrame:
    counts = items.agg(F.count("*").alias("_n"), *_range_counts(label, ranges))
    if skip_empty:
        counts = counts.where("_n > 0")
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias(key), F.col(n).alias("count")) for n, _ in ranges])))


def value_histogram(
    items: DataFrame, amount: str = "amount_usd", ranges=VALUE_RANGES, skip_empty: bool = False
) -> DataFrame:
    """Counts per value range; empty ranges are kept as 0. One pass, one final row.

    ``skip_empty`` gives no rows at all when there are no items.
    """
    return _histogram(items, value_range(amount, ranges), ranges, "value_range", skip_empty)


def age_histogram(
    items: DataFrame, as_of: Column, created_at: str = "created_at", skip_empty: bool = False
) -> DataFrame:
    """Counts per age range at ``as_of``; rows without a creation time are left out."""
    return _histogram(items, age_range(created_at, as_of), AGE_RANGES, "age_range", skip_empty)


def count_by_label(df: DataFrame, label: str) -> DataFrame:
    """Counts per label; missing and empty count as 'unknown'."""
    return df.groupBy(label_or_unknown(label).alias(label)).agg(F.count("*").alias("count"))


def _exploded_tags(items: DataFrame, tags: str) -> DataFrame:
    return (
        items.select(F.explode_outer(tags).alias("tag"), "amount_usd")
        .where("tag IS NOT NULL")
        .select(F.lower("tag").alias("tag"), "amount_usd")
    )


def tag_counts(items: DataFrame, tags: str = "tags") -> DataFrame:
    """Count and value per lower-cased tag."""
    return _exploded_tags(items, tags).groupBy("tag").agg(
        F.count("*").alias("count"), money_sum("amount_usd").alias("total_value_usd")
    )


def language_counts(
    items: DataFrame, terms: Sequence[str] = LANGUAGE_TERMS, tags: str = "tags", match: str = "substring"
) -> DataFrame:
    """Tag counts for tags that contain a language term. Filtered on the few distinct tags."""
    return tag_counts(items, tags).where(any_term(F.col("tag"), terms, match))


def top_tags(items: DataFrame, k: int = 10, tags: str = "tags") -> DataFrame:
    return top_k(tag_counts(items, tags), "count", k, ["tag"])


def distinct_tags(items: DataFrame, tags: str = "tags", exact: bool = True) -> DataFrame:
    count = F.countDistinct if exact else F.approx_count_distinct
    return _exploded_tags(items, tags).agg(count("tag").alias("total_tags"))


def top_orgs(items: DataFrame, k: int = 10) -> DataFrame:
    """The k organizations with the most value, flat."""
    return top_k(rollup_by_org(items), "total_value_usd", k, ["handle"])


def top_org_items(items: DataFrame, k: int = 10) -> DataFrame:
    """The items of the k top organizations, one row each, with the organization's totals."""
    best = top_orgs(items, k).drop("display_name")
    return items.join(F.broadcast(best), "handle")  # k rows


def org_health(outcomes: DataFrame) -> DataFrame:
    """Organizations with items and with errors."""
    return outcomes.agg(
        F.count_if(F.col("item_count") > 0).alias("organizations_with_items"),
        F.count_if(F.coalesce(F.nullif("error", F.lit("")), F.lit(None)).isNotNull()).alias("organizations_with_errors"),
    )


def run_health(outcomes: DataFrame) -> DataFrame:
    """Organizations that succeeded and that failed, whatever their items."""
    return outcomes.agg(
        F.count_if("success").alias("organizations_with_items"), F.count_if(~F.col("success")).alias("organizations_with_errors")
    )


def success_rate(df: DataFrame, success: Column, *keys: str) -> DataFrame:
    """Share of successful rows; NULL when there are none."""
    return df.groupBy(*keys).agg(F.try_divide(F.count_if(success).cast("double"), F.count("*")).alias("success_rate"))


def link_counts(links: DataFrame, key: str = "page_id", embedded: str | None = None) -> DataFrame:
    """Per page: forge links, issue links among them and the rest, and the rows of its embedded state. Row-local.

    ``embedded`` names the column with the candidates of the page's state (see ``items.candidates``).
    """
    forge = forge_links(F.col("links"))
    rows = F.lit(0) if embedded is None else F.greatest(F.coalesce(F.size(embedded), F.lit(0)), F.lit(0))
    return (
        links.select(key, forge.alias("_forge"), rows.cast("bigint").alias("embedded"))
        .select(
            key,
            F.size("_forge").cast("bigint").alias("total"),
            F.size(F.filter("_forge", is_issue_link)).cast("bigint").alias("issues"),
            "embedded",
        )
        .withColumn("other", F.col("total") - F.col("issues"))
    )


def link_totals(counts: DataFrame) -> DataFrame:
    """One row over all pages of ``link_counts``: pages, their links of each kind, and pages without a link and without an issue link."""
    summed = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "issues", "other", "embedded")]
    return counts.agg(
        F.count("*").alias("pages"), *summed, F.count_if(F.col("total") == 0).alias("pages_without_links"), F.count_if(F.col("issues") == 0).alias("pages_without_issues")
    )


#: 2**14 registers: a standard error below 1 %, and at most 16 kB a sketch.
SKETCH_BITS = 14


def daily_sketches(log: DataFrame, component: str, at: str, value: str) -> DataFrame:
    """Entries and a mergeable sketch of the distinct values per component and day, to be stored."""
    days = log.withColumn("day", F.to_date(at))
    return days.groupBy(component, "day").agg(F.count("*").alias("entries"), F.hll_sketch_agg(value, SKETCH_BITS).alias("sketch"))


def distinct_over_days(sketches: DataFrame, *keys: str) -> DataFrame:
    """Entries and about how many distinct values there are, over all days of stored sketches; nothing is scanned again."""
    merged = sketches.groupBy(*keys).agg(F.sum("entries").alias("entries"), F.hll_union_agg("sketch").alias("_sketch"))
    return merged.select(*keys, "entries", F.hll_sketch_estimate("_sketch").alias("distinct_values"))


def run_metrics(log: DataFrame, component: str, at: str, duration: str, success: Column) -> DataFrame:
    """Volume, success rate and processing time per component and day."""
    days = log.withColumn("day", F.to_date(at)).withColumn("_ok", success)
    keys = [component, "day"]
    shares = days.groupBy(*keys).agg(
        F.count("*").alias("entries"),
        F.try_divide(F.count_if("_ok").cast("double"), F.count("*")).alias("success_rate"),
        F.try_divide(money_sum(duration), F.count(duration)).alias("avg_duration"),
    )
    p95 = exact_percentiles(days, duration, [0.95], keys).select(*keys, F.col("percentile").alias("p95_duration"))
    return shares.join(p95, keys, "left")


def _report_rows(
    row: DataFrame, entries: Sequence[tuple[str, str, str]], filled: Sequence[tuple[str, str, str]] = ()
) -> DataFrame:
    """Turn a one-row table into report rows; entries are (section, column, 'count' or 'value').

    ``filled`` entries appear only when the row's ``_n`` is above 0.
    """
    none = {"count": F.lit(None).cast("bigint"), "value": F.lit(None).cast("double")}
    one = lambda section, name, kind: F.struct(
        F.lit(section).alias("section"), F.lit(name).alias("key"),
        (F.col(name).cast("bigint") if kind == "count" else none["count"]).alias("count"),
        (F.col(name).cast("double") if kind == "value" else none["value"]).alias("value"),
    )
    rows = F.array(*[one(*e) for e in entries])
    if filled:
        rows = F.when(F.col("_n") > 0, F.concat(rows, F.array(*[one(*e) for e in filled]))).otherwise(rows)
    return row.select(F.inline(rows))


def stats_report(
    items: DataFrame, outcomes: DataFrame, as_of: Column, full: bool = True, k: int = 10,
    terms: Sequence[str] = LANGUAGE_TERMS, exact: bool = True,
) -> DataFrame:
    """The statistics report as rows (section, key, count, value).

    Beside a sketch of the amounts, the items are read once: each is expanded to an entry for every section it
    counts in, its amount among them as the percentiles need it, and one aggregate with a map-side part counts
    them all. Its result is checkpointed (one job), as every section reads it.
    ``full=False`` keeps the average, the median and the organizations that succeeded and failed. With no items every breakdown is empty and every number is 0.
    """
    health = ("organizations_with_items", "organizations_with_errors")
    by_org = _report_rows((org_health if full else run_health)(outcomes), [("summary", n, "value") for n in health])
    names = {"median_value": 0.5, **(DISTRIBUTION if full else {})}
    points = sorted(set(names.values()))
    amount = F.col("amount_usd").cast("double")
    no_value = F.struct(F.lit(None).cast("int").alias("seg"), F.lit(None).cast("boolean").alias("inside"), F.lit(None).cast("double").alias("v"))
    entry = lambda section, key=F.lit(None).cast("string"), value=no_value: F.struct(F.lit(section).alias("section"), key.alias("key"), value.alias("value"))
    entries = [entry("all")]
    if exact:
        known = known_bands(items.where("amount_usd IS NOT NULL"), amount, points)
        entries.append(F.when(amount.isNotNull(), entry("amount", value=cut(amount, known, points))))
    if full:
        entries += [
            entry("by_difficulty", label_or_unknown("difficulty")), entry("by_status", label_or_unknown("status")),
            entry("by_amount", value_range("amount_usd")), entry("age_distribution", age_range("created_at", as_of)),
        ]
    listed = F.array_compact(F.array(*entries))
    if full:
        listed = F.concat(listed, F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: entry("tag", F.lower(t))))
    checkpoint_dir(items.sparkSession)
    table = (
        items.select(F.explode(listed).alias("_e"), "amount_usd").select("_e.section", "_e.key", "_e.value.*", "amount_usd")
        .groupBy("section", "key", "seg", "inside", "v")
        .agg(F.count("*").alias("count"), money_sum("amount_usd").alias("value"), *counted(amount))
        .checkpoint()
    )
    average = F.coalesce(F.max("value") / F.nullif(F.max("n"), F.lit(0)), F.lit(0.0))
    whole = table.where("section = 'all'").agg(average.alias("average_value"), F.coalesce(F.max("count"), F.lit(0)).alias("_n"))
    if exact:
        found = from_counts(table.where("section = 'amount'").select("seg", "inside", "v", "n", "lo", "hi"), points)
        at_points = named_points(found, names)
    else:
        at_points = percentiles_row(items, "amount_usd", names, exact)
    shown = [("summary", "median_value", "value"), *([("value_distribution", n, "value") for n in DISTRIBUTION] if full else [])]
    report = _report_rows(at_points, shown).unionByName(by_org)
    if not full:
        return report.unionByName(_report_rows(whole, [("summary", "average_value", "value")]))
    in_range = lambda section, ranges: [F.coalesce(F.max(F.when((F.col("section") == section) & (F.col("key") == n), F.col("count"))), F.lit(0)).alias(n) for n, _ in ranges]
    ranged = table.where("section IN ('by_amount', 'age_distribution', 'all', 'tag')").agg(
        F.coalesce(F.max(F.when(F.col("section") == "all", F.col("count"))), F.lit(0)).alias("_n"),
        F.coalesce(F.max(F.when(F.col("section") == "all", F.col("value") / F.nullif(F.col("n"), F.lit(0)))), F.lit(0.0)).alias("average_value"),
        F.count(F.when((F.col("section") == "tag") & F.col("key").isNotNull(), 1)).alias("total_tags"),
        *in_range("by_amount", VALUE_RANGES), *in_range("age_distribution", AGE_RANGES),
    )
    ranges = [("by_amount", n, "count") for n, _ in VALUE_RANGES] + [("age_distribution", n, "count") for n, _ in AGE_RANGES]
    is_tag = F.col("section") == "tag"
    tags = table.where(is_tag & F.col("key").isNotNull())
    rows = table.where("section IN ('by_difficulty', 'by_status') OR section = 'tag' AND key IS NOT NULL").where(~is_tag | any_term(F.col("key"), terms))
    return (
        report.unionByName(_report_rows(ranged, [("summary", "average_value", "value"), ("summary", "total_tags", "value")], ranges))
        .unionByName(rows.select(F.when(is_tag, "by_language").otherwise(F.col("section")).alias("section"), "key", "count", F.when(is_tag, F.col("value")).alias("value")))
        .unionByName(top_k(tags.select("key", "count", "value"), "count", k, ["key"]).withColumn("section", F.lit("top_tags")))
    )
