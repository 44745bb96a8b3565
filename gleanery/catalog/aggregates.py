"""Totals, histograms, percentiles, rankings and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleanery.catalog.core import query
from gleanery.catalog.joins import customer_outcomes
from gleanery.catalog.rows import state_pages
from gleanery.catalog.tables import ITEMS, LISTINGS, PARTS_TAGGED, AS_OF, as_of, items, listings, parts_tagged, table, text, with_ctes
from gleanery.functions import markup
from gleanery.operators import discovery, items as item_ops, keyed, percentiles, registry, stats
from gleanery.plans import runs

_USD = "CAST(sum(CAST(round({0} * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE"
_TERMS = ("urgent", "high", "spec")
_PART_TERMS = ("ring", "red", "old", "econ")


@query(with_ctes(ITEMS) + f"SELECT handle, min(display_name) AS display_name, count(*) AS item_count, {_USD.format('amount_usd')} AS total_value_usd FROM items GROUP BY handle")
def rollup_by_org(spark, sf):
    return stats.rollup_by_org(items(spark, sf))


@query(with_ctes(ITEMS) + f"SELECT count(*) AS total_items, {_USD.format('amount_usd')} AS total_value_usd, count(DISTINCT handle) AS total_organizations FROM items")
def global_totals(spark, sf):
    return stats.totals(items(spark, sf))


@query(with_ctes(LISTINGS) + r""", amounts AS (SELECT page_id, handle, unnest(regexp_extract_all(html, '\$(\d+(?:,\d{3})*(?:\.\d{2})?)', 1)) AS a FROM listings)
SELECT page_id, CAST(sum(CAST(round(CAST(replace(a, ',', '') AS DOUBLE) * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE AS total_value_usd FROM amounts GROUP BY page_id""")
def value_per_page(spark, sf):
    found = listings(spark, sf).select("page_id", F.explode_outer(markup.extract_amounts("html")).alias("amount_usd"))
    return stats.value_by(found, "page_id")


@query(with_ctes(ITEMS) + f"SELECT {_USD.format('amount_usd')} / count(*) AS average_value FROM items")
def average_value(spark, sf):
    return stats.average_value(items(spark, sf))


@query(with_ctes(ITEMS) + "SELECT median(amount_usd) AS median_value FROM items")
def median_value(spark, sf):
    return stats.median_value(items(spark, sf))


_DISTRIBUTION = """min(amount_usd) AS min, max(amount_usd) AS max, round(quantile_cont(amount_usd, 0.25), 6) AS percentile_25,
round(quantile_cont(amount_usd, 0.75), 6) AS percentile_75, round(quantile_cont(amount_usd, 0.9), 6) AS percentile_90,
round(quantile_cont(amount_usd, 0.95), 6) AS percentile_95"""


@query(with_ctes(ITEMS) + f"SELECT {_DISTRIBUTION} FROM items")
def value_distribution(spark, sf):
    row = stats.value_distribution(items(spark, sf))
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@query("""SELECT event_type, p AS point, round(CASE p WHEN 0.5 THEN q[1] ELSE q[2] END, 6) AS percentile
FROM (SELECT event_type, quantile_cont(value, [0.5, 0.95]) AS q FROM events GROUP BY 1), unnest([0.5::DOUBLE, 0.95::DOUBLE]) AS t(p)""")
def grouped_percentiles(spark, sf):
    found = percentiles.exact_percentiles(table(spark, sf, "events"), "value", [0.5, 0.95], ["event_type"])
    return found.withColumn("percentile", F.round("percentile", 6))


_RANGES = """(VALUES ('under_50', -1e18, 50), ('50_to_100', 50, 100), ('100_to_250', 100, 250), ('250_to_500', 250, 500),
('500_to_1000', 500, 1000), ('over_1000', 1000, 1e18)) AS r(value_range, lo, hi)"""
_AGES = """(VALUES ('less_than_week', -1e18, 7), ('week_to_month', 7, 30), ('month_to_quarter', 30, 90), ('quarter_to_year', 90, 365),
('over_year', 365, 1e18)) AS r(age_range, lo, hi)"""
_AGE = f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(created_at)) / 86400000000.0::DOUBLE"
_VALUE_HISTOGRAM = f"SELECT value_range, count(id) AS count FROM {_RANGES} LEFT JOIN items ON amount_usd >= lo AND amount_usd < hi GROUP BY 1"
_AGE_HISTOGRAM = f"SELECT age_range, count(id) AS count FROM {_AGES} LEFT JOIN items ON {_AGE} >= lo AND {_AGE} < hi GROUP BY 1"


@query(with_ctes(ITEMS) + _VALUE_HISTOGRAM)
def value_histogram(spark, sf):
    return stats.value_histogram(items(spark, sf))


@query(with_ctes(ITEMS) + _AGE_HISTOGRAM)
def age_histogram(spark, sf):
    return stats.age_histogram(items(spark, sf), as_of())


@query(with_ctes(ITEMS) + "SELECT coalesce(CASE WHEN difficulty <> '5-LOW' THEN difficulty END, 'unknown') AS difficulty, count(*) AS count FROM items GROUP BY 1")
def count_by_difficulty(spark, sf):
    some = F.when(F.col("difficulty") != "5-LOW", F.col("difficulty"))
    return stats.count_by_label(items(spark, sf).withColumn("difficulty", some), "difficulty")


@query(with_ctes(ITEMS) + "SELECT coalesce(nullif(status, ''), 'unknown') AS status, count(*) AS count FROM items GROUP BY 1")
def count_by_status(spark, sf):
    return stats.count_by_label(items(spark, sf), "status")


_TAGS = "(SELECT lower(unnest(tags)) AS tag, amount_usd FROM parts_tagged)"
_TAG_COUNTS = f"SELECT tag, count(*) AS count, {_USD.format('amount_usd')} AS total_value_usd FROM {_TAGS}"


@query(with_ctes(PARTS_TAGGED) + f"{_TAG_COUNTS} WHERE contains(tag, 'ring') OR contains(tag, 'red') OR contains(tag, 'old') OR contains(tag, 'econ') GROUP BY tag")
def language_counts(spark, sf):
    """Tags with a term as a part: 'old' also finds 'cold'."""
    return stats.language_counts(parts_tagged(spark, sf), _PART_TERMS)


@query(with_ctes(PARTS_TAGGED) + f"{_TAG_COUNTS} WHERE tag IN ('ring', 'red', 'old', 'econ') GROUP BY tag")
def language_counts_by_word(spark, sf):
    return stats.language_counts(parts_tagged(spark, sf), _PART_TERMS, match="word")


@query(with_ctes(PARTS_TAGGED) + f"{_TAG_COUNTS} GROUP BY tag")
def tag_counts(spark, sf):
    return stats.tag_counts(parts_tagged(spark, sf))


@query(with_ctes(PARTS_TAGGED) + f"SELECT count(DISTINCT tag) AS total_tags FROM {_TAGS}")
def distinct_tags(spark, sf):
    return stats.distinct_tags(parts_tagged(spark, sf))


@query(with_ctes(PARTS_TAGGED) + f"{_TAG_COUNTS} GROUP BY tag ORDER BY count DESC, tag LIMIT 10")
def top_tags(spark, sf):
    return stats.top_tags(parts_tagged(spark, sf))


_OUTCOMES = """
outcomes AS (SELECT c_custkey AS handle, c_acctbal > 0 AS success, CASE WHEN c_acctbal > 0 THEN coalesce(n, 0) ELSE 0 END AS item_count
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


@query(with_ctes(_OUTCOMES) + "SELECT count_if(item_count > 0)::BIGINT AS organizations_with_items, count_if(NOT success)::BIGINT AS organizations_with_errors FROM outcomes")
def organization_health(spark, sf):
    return stats.org_health(customer_outcomes(spark, sf))


@query("SELECT count_if(event_type <> 'error')::DOUBLE / count(*) AS success_rate FROM events")
def success_rate(spark, sf):
    return stats.success_rate(table(spark, sf, "events"), F.col("event_type") != "error")


_METHODS = """(SELECT c_custkey AS handle, lower(c_mktsegment) AS discovery_method, c_acctbal > 0 AS active, c_acctbal > -500 AS validated FROM customer)"""


def _discovered(spark, sf):
    return table(spark, sf, "customer").select(
        text("c_custkey").alias("handle"), F.lower("c_mktsegment").alias("discovery_method"),
        (F.col("c_acctbal") > 0).alias("active"), (F.col("c_acctbal") > -500).alias("validated"),
    )


@query(f"SELECT discovery_method, count(*) AS count FROM {_METHODS} GROUP BY 1")
def count_by_method(spark, sf):
    return discovery.count_by_method(_discovered(spark, sf))


@query(f"""SELECT 'totals' AS section, unnest(['total_discovered', 'active_organizations', 'inactive_organizations']) AS key,
unnest([n, a, n - a]) AS count FROM (SELECT count(*) AS n, count_if(active AND validated)::BIGINT AS a FROM {_METHODS})
UNION ALL SELECT 'discovery_methods', discovery_method, count(*) FROM {_METHODS} GROUP BY 2""")
def registry_summary(spark, sf):
    return discovery.registry_summary(_discovered(spark, sf))


_TIERED = """(SELECT CASE WHEN n >= 10 THEN 'highly-active' WHEN n >= 5 THEN 'active' WHEN n >= 1 THEN 'emerging' ELSE 'platform' END AS tier,
CAST(CASE WHEN n >= 10 THEN 900 WHEN n >= 5 THEN 1800 WHEN n >= 1 THEN 3600 ELSE 7200 END AS BIGINT) AS scrape_interval, handle
FROM (SELECT CAST(c_custkey AS VARCHAR) AS handle, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey))"""


def _graded(spark, sf):
    found = customer_outcomes(spark, sf).select(
        "handle", F.col("handle").alias("display_name"), F.lit(True).alias("active"), F.lit(True).alias("validated")
    )
    counts = table(spark, sf, "orders").groupBy(text("o_custkey").alias("handle")).agg(F.count("*").alias("_n"))
    counted = found.join(counts, "handle", "left").withColumn("item_count", F.coalesce("_n", F.lit(0)))
    return discovery.graded_registry(counted, "https://listings.example/{handle}/bounties")


@query(f"SELECT handle, tier, scrape_interval FROM {_TIERED}")
def graded_registry(spark, sf):
    return _graded(spark, sf).select("handle", "tier", "scrape_interval")


@query(f"SELECT tier, count(*) AS count FROM {_TIERED} GROUP BY 1")
def count_by_tier(spark, sf):
    return discovery.count_by_tier(_graded(spark, sf))


_REPORT_SUMMARY = f"""
SELECT 'summary' AS section, k AS key, CAST(NULL AS BIGINT) AS count, round(v, 6) AS value FROM (
  SELECT unnest(['average_value', 'median_value']) AS k, unnest([{_USD.format('amount_usd')} / count(*), median(amount_usd)]) AS v FROM items
  UNION ALL
  SELECT unnest(['organizations_with_items', 'organizations_with_errors']), unnest([count_if(item_count > 0)::DOUBLE, count_if(NOT success)::DOUBLE]) FROM outcomes)"""
_ITEM_TAGS = f"(SELECT tag, count(*) AS count, {_USD.format('amount_usd')} AS value FROM (SELECT lower(unnest(tags)) AS tag, amount_usd FROM items) GROUP BY tag)"
_REPORT = with_ctes(ITEMS, _OUTCOMES) + f"""{_REPORT_SUMMARY}
UNION ALL SELECT 'summary', 'total_tags', NULL, count(*)::DOUBLE FROM {_ITEM_TAGS}
UNION ALL SELECT 'value_distribution', k, NULL, v FROM (UNPIVOT (SELECT {_DISTRIBUTION} FROM items) ON COLUMNS(*) INTO NAME k VALUE v)
UNION ALL SELECT 'by_difficulty', difficulty, count(*), NULL FROM items GROUP BY 2
UNION ALL SELECT 'by_status', status, count(*), NULL FROM items GROUP BY 2
UNION ALL SELECT 'by_amount', value_range, count, NULL FROM ({_VALUE_HISTOGRAM})
UNION ALL SELECT 'age_distribution', age_range, count, NULL FROM ({_AGE_HISTOGRAM})
UNION ALL SELECT 'by_language', tag, count, value FROM {_ITEM_TAGS} WHERE contains(tag, 'urgent') OR contains(tag, 'high') OR contains(tag, 'spec')
UNION ALL SELECT 'top_tags', tag, count, value FROM (SELECT * FROM {_ITEM_TAGS} ORDER BY count DESC, tag LIMIT 10)"""


@query(_REPORT)
def stats_report(spark, sf):
    report = stats.stats_report(items(spark, sf), customer_outcomes(spark, sf), as_of(), terms=_TERMS)
    return report.withColumn("value", F.round("value", 6))


@query(with_ctes(ITEMS, _OUTCOMES) + _REPORT_SUMMARY.replace("count_if(item_count > 0)", "count_if(success)"))
def stats_short_report(spark, sf):
    report = stats.stats_report(items(spark, sf), customer_outcomes(spark, sf), as_of(), full=False)
    return report.withColumn("value", F.round("value", 6))


@query(with_ctes(ITEMS) + f""", kept AS (SELECT count(*) AS n, {_USD.format('amount_usd')} AS v FROM items WHERE handle IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0))
SELECT (SELECT count(*) FROM customer) AS total_organizations, n AS total_items, round(v, 2) AS total_value_usd,
(SELECT count_if(c_acctbal > 0)::DOUBLE / count(*) FROM customer) AS success_rate FROM kept""")
def snapshot_totals(spark, sf):
    """Totals and success rate of a full run; items of failed organizations do not count."""
    snapshot = runs.build_snapshot(items(spark, sf), customer_outcomes(spark, sf), as_of())
    rate = snapshot.metadata.select("success_rate")
    both = registry.append_results(snapshot.totals, rate)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query(with_ctes(LISTINGS) + r""", links AS (SELECT page_id, list_filter(regexp_extract_all(html, '(?i)<a\b[^>]*href="([^"]*)"', 1), lambda l: contains(l, 'github.com')) AS f FROM listings)
SELECT page_id, len(f) AS total, len(list_filter(f, lambda l: contains(l, '/issues/') OR contains(l, '/pull/'))) AS issues,
len(f) - len(list_filter(f, lambda l: contains(l, '/issues/') OR contains(l, '/pull/'))) AS other, 0::BIGINT AS embedded FROM links""")
def link_statistics(spark, sf):
    links = listings(spark, sf).select("page_id", markup.extract_links("html").alias("links"))
    return stats.link_counts(links)


@query(with_ctes(LISTINGS) + r""", links AS (SELECT list_filter(regexp_extract_all(html, '(?i)<a\b[^>]*href="([^"]*)"', 1), lambda l: contains(l, 'github.com')) AS f FROM listings),
counts AS (SELECT len(f) AS total, len(list_filter(f, lambda l: contains(l, '/issues/') OR contains(l, '/pull/'))) AS issues, 0 AS embedded FROM links
  UNION ALL SELECT 0, 0, 1 FROM orders)
SELECT count(*) AS pages, sum(total)::BIGINT AS total, sum(issues)::BIGINT AS issues, sum(total - issues)::BIGINT AS other, sum(embedded)::BIGINT AS embedded,
count_if(total = 0)::BIGINT AS pages_without_links, count_if(issues = 0)::BIGINT AS pages_without_issues FROM counts""")
def link_totals(spark, sf):
    """Links of all listing pages and rows of all embedded states."""
    pages = listings(spark, sf).select("page_id", "html").unionByName(state_pages(spark, sf).select("page_id", "html"))
    found = pages.select("page_id", markup.extract_links("html").alias("links"), item_ops.candidates(item_ops.embedded_state("html")).alias("rows"))
    return stats.link_totals(stats.link_counts(found, embedded="rows"))


@query("""SELECT event_type AS component, count(*) AS entries, count(DISTINCT user_id) AS users, true AS close FROM events GROUP BY 1""")
def distinct_from_daily_sketches(spark, sf):
    """Distinct users of all days from sketches stored per day, against the exact number: less than 2 % apart."""
    path = f"{keyed.checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    events = table(spark, sf, "events").withColumnRenamed("event_type", "component")
    stats.daily_sketches(events, "component", "ts", "user_id").write.parquet(path)
    merged = stats.distinct_over_days(spark.read.schema("component STRING, day DATE, entries BIGINT, sketch BINARY").parquet(path), "component")
    exact = events.groupBy("component").agg(F.countDistinct("user_id").alias("users"))
    return merged.join(exact, "component").select("component", "entries", "users", (F.abs(F.col("distinct_values") - F.col("users")) < 0.02 * F.col("users")).alias("close"))


@query("""SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS entries, count_if(value < 50)::DOUBLE / count(*) AS success_rate,
CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE / count(value) AS avg_duration, round(quantile_cont(value, 0.95), 6) AS p95_duration
FROM events GROUP BY 1, 2""")
def run_metrics(spark, sf):
    found = stats.run_metrics(table(spark, sf, "events"), "event_type", "ts", "value", F.col("value") < 50)
    return found.withColumns({"day": F.date_format("day", "yyyy-MM-dd"), "p95_duration": F.round("p95_duration", 6)})


# --- rankings --------------------------------------------------------------------------------------

_TOP_ORGS = f"(SELECT handle, count(*) AS item_count, {_USD.format('amount_usd')} AS total_value_usd FROM items GROUP BY handle ORDER BY total_value_usd DESC, handle LIMIT 10)"


@query(with_ctes(ITEMS) + f"SELECT * FROM {_TOP_ORGS}")
def top_organizations(spark, sf):
    return stats.top_orgs(items(spark, sf)).drop("display_name")


@query(with_ctes(ITEMS) + f"SELECT handle, id, amount_usd, item_count, total_value_usd FROM items JOIN {_TOP_ORGS} USING (handle)")
def top_organization_items(spark, sf):
    """Items of the ten top organizations; the ranking is done on flat totals."""
    return stats.top_org_items(items(spark, sf)).select("handle", "id", "amount_usd", "item_count", "total_value_usd")


@query("""SELECT handle, row_number() OVER (ORDER BY lower(handle), handle DESC) AS position
FROM (SELECT unnest([lower(c_name), upper(c_name)]) AS handle FROM customer)""")
def handles_by_locale(spark, sf):
    """Handles in both cases with their place in the locale's order."""
    names = table(spark, sf, "customer").select(F.explode(F.array(F.lower("c_name"), F.upper("c_name"))).alias("handle"))
    return keyed.with_locale_position(names)


@query(f"SELECT handle, tier, row_number() OVER (ORDER BY tier DESC, handle) AS position FROM {_TIERED}")
def registry_by_tier(spark, sf):
    return keyed.with_locale_position(_graded(spark, sf).select("handle", "tier"), tier="tier")


@query("SELECT o_orderkey, o_orderdate::VARCHAR AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def first_candidates(spark, sf):
    rows = keyed.first_n(table(spark, sf, "orders"), 100, ["o_orderdate", "o_orderkey"])
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"))
