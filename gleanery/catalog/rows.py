"""Scans, filters, projections, nested items and landed documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleanery import schemas
from gleanery.catalog.core import query
from gleanery.catalog.tables import (
    ITEMS, LISTINGS, URL_TEMPLATE, as_of, items, listings, table, text, with_ctes,
)
from gleanery.functions import markup, scalars
from gleanery.operators import items as item_ops
from gleanery.operators import discovery, keyed, registry, stats
from gleanery.sources import readers, writers


@query("SELECT page_id, url, CAST(length(html) AS BIGINT) AS chars FROM pages")
def pages_scan(spark, sf):
    pages = readers.read_pages(spark, f"{sf}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def registry_active(spark, sf):
    orgs = table(spark, sf, "customer").withColumn("active", F.col("c_acctbal") > 0)
    return registry.active_orgs(orgs).select("c_custkey", "c_name")


@query("SELECT o_orderkey, 'open' AS status FROM orders WHERE o_orderstatus <> 'F'")
def listing_active_status(spark, sf):
    """Only active rows of a listing become items, and these are open."""
    return _listing_items(spark, sf).select(F.col("task.number").alias("o_orderkey"), "status")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def positive_amounts(spark, sf):
    """Dollar amounts in a text; those of zero don't count."""
    said = F.concat(F.lit("<p>worth $"), F.format_number(F.greatest("c_acctbal", F.lit(0.0)), 2), F.lit("</p>"))
    found = table(spark, sf, "customer").select("c_custkey", F.explode_outer(markup.extract_amounts(said)).alias("c_acctbal"))
    return found.where("c_acctbal IS NOT NULL")


@query(with_ctes(LISTINGS) + r"""
SELECT page_id, l AS link FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*href="([^"]*)"', 1)) AS l FROM listings)
WHERE regexp_matches(l, 'github\.com/([^/]+)/([^/]+)/issues/(\d+)')""")
def issue_links(spark, sf):
    links = listings(spark, sf).select("page_id", F.explode_outer(markup.extract_links("html")).alias("link"))
    return links.where(F.rlike("link", F.lit(markup.ISSUE_REFERENCE)))


@query("""SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 AND s_nationkey IN (SELECT n_nationkey FROM nation)""")
def validated_active(spark, sf):
    """Discovered organizations that their page confirms; suppliers of a nation have a page, and a balance makes it a listing."""
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"))
    suppliers = table(spark, sf, "supplier").withColumn("handle", text("s_suppkey"))
    found = suppliers.select("handle", F.col("s_name").alias("display_name"), F.lit("given").alias("discovery_method"))
    facts = suppliers.join(nations, "s_nationkey", "left_semi").select(
        "handle", (F.col("s_acctbal") > 0).alias("is_listing"), F.lit(1).cast("bigint").alias("item_count"), F.lit(None).cast("string").alias("page_name"), F.lit(True).alias("loaded")
    )
    graded = discovery.graded_registry(discovery.validate_orgs(found, facts), URL_TEMPLATE)
    return graded.select(F.col("handle").cast("bigint").alias("s_suppkey"), F.col("display_name").alias("s_name"))


@query(r"""SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE AS amount_usd,
'$' || CAST(round(CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE) AS BIGINT) AS reward_formatted,
'$' || regexp_replace(CAST(CAST(CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE AS DECIMAL(30,10)) AS VARCHAR), '\.?0+$', '') AS amount_formatted
FROM orders""")
def money_formats(spark, sf):
    cents = F.round("o_totalprice").cast("bigint")
    usd = scalars.cents_to_usd(cents)
    return table(spark, sf, "orders").select(
        "o_orderkey", usd.alias("amount_usd"), scalars.format_reward(cents).alias("reward_formatted"),
        scalars.format_usd(usd).alias("amount_formatted"),
    )


@query("""SELECT lower(n_name) AS handle, upper(substr(lower(n_name), 1, 1)) || substr(lower(n_name), 2) AS display_name,
'https://listings.example/' || lower(n_name) || '/bounties?status=open' AS url, true AS active,
CAST(1800 AS BIGINT) AS scrape_interval, 'active' AS tier FROM nation""")
def registry_from_handles(spark, sf):
    handles = table(spark, sf, "nation").select(F.lower("n_name").alias("handle"))
    return registry.registry_rows(handles, URL_TEMPLATE)


@query("""SELECT page_id, CASE WHEN url LIKE '%?%' THEN 'https://listings.example/' || page_id || '/bounties?status=open' ELSE url END AS url FROM pages""")
def url_defaults(spark, sf):
    blank = F.when(~F.contains("url", F.lit("?")), F.col("url")).otherwise("")
    pages = table(spark, sf, "pages")
    return pages.select("page_id", scalars.url_or_template(blank, text("page_id"), URL_TEMPLATE).alias("url"))


@query("""SELECT DISTINCT trim(h) AS handle FROM (
SELECT unnest(string_split(' ' || p_brand || ' ,, ' || p_type || ',' || replace(p_name, ' ', ', '), ',')) AS h FROM part) WHERE trim(h) <> ''""")
def requested_from_lists(spark, sf):
    lists = table(spark, sf, "part").select(
        F.concat(F.lit(" "), "p_brand", F.lit(" ,, "), "p_type", F.lit(","), F.replace("p_name", F.lit(" "), F.lit(", "))).alias("orgs")
    )
    return registry.requested_handles(lists, "orgs")


@query("""SELECT l_suppkey || '#' || l_orderkey AS item_id, 'task-' || l_suppkey || '#' || l_orderkey AS task_id,
l_suppkey || '/' || l_partkey || '#' || l_orderkey AS hash FROM lineitem""")
def derived_keys(spark, sf):
    key = scalars.item_key(text("l_suppkey"), "l_orderkey")
    return table(spark, sf, "lineitem").select(
        key.alias("item_id"), F.concat(F.lit("task-"), key).alias("task_id"),
        scalars.issue_hash(text("l_suppkey"), text("l_partkey"), "l_orderkey").alias("hash"),
    )


@query("""SELECT event_id, coalesce(nullif(CASE WHEN event_type = 'view' THEN '' ELSE event_type END, ''), 'none') AS kind,
coalesce(nullif(CASE WHEN event_type = 'error' THEN 0.0::DOUBLE WHEN event_type = 'view' THEN NULL ELSE value END, 0), 100.0::DOUBLE) AS amount,
coalesce(CASE WHEN event_type = 'click' THEN NULL ELSE value > 50 END, false) AS flag FROM events""")
def falsy_defaults(spark, sf):
    kind = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    amount = F.when(F.col("event_type") == "error", 0.0).when(F.col("event_type") != "view", F.col("value"))
    flag = F.when(F.col("event_type") != "click", F.col("value") > 50)
    return table(spark, sf, "events").select(
        "event_id", scalars.text_or(kind, "none").alias("kind"), scalars.number_or(amount, 100.0).alias("amount"),
        scalars.flag_or_false(flag).alias("flag"),
    )


def listing_bodies(spark, sf):
    """Landed listing bodies: one JSON document per order, with the registry columns beside it."""
    user = F.struct(F.col("o_custkey").alias("id"), F.concat(F.lit("user"), text("o_custkey")).alias("login"))
    issue = F.struct(
        F.col("o_orderkey").alias("number"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat("o_orderpriority", F.lit(" task"))).alias("title"),
        F.concat(F.lit("https://github.com/org/repo/issues/"), text("o_orderkey")).alias("html_url"), user.alias("user"),
    )
    row = F.struct(
        F.concat(F.lit("i"), text("o_orderkey")).alias("id"),
        F.when(F.col("o_orderstatus") != "F", "active").otherwise("done").alias("status"),
        F.round("o_totalprice").cast("bigint").alias("amount"), F.lit("org").alias("repo_owner"), F.lit("repo").alias("repo_name"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"), issue.alias("issue"),
    )
    return table(spark, sf, "orders").select(
        text("o_custkey").alias("handle"), F.concat(F.lit("Customer "), text("o_custkey")).alias("display_name"),
        F.lit(None).cast("string").alias("description"), F.lit(None).cast("array<string>").alias("org_tech"),
        F.to_json(F.struct(F.array(row).alias("items"))).alias("body"),
    )


def _listing_items(spark, sf):
    keep = ["handle", "display_name", "description", "org_tech"]
    documents = readers.parse_documents(listing_bodies(spark, sf), "body", schemas.LISTING, keep)
    return item_ops.items_from_listing(readers.listing_rows(documents), as_of())


_LISTING_SQL = r"""
SELECT CAST(o_custkey AS VARCHAR) AS handle, 'Customer ' || o_custkey AS display_name, 'i' || o_orderkey AS id,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority || ' task' ELSE 'Issue #' || o_orderkey END AS title,
  CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE AS amount_usd, 'https://github.com/org/repo/issues/' || o_orderkey AS url,
  'open' AS status, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at
FROM orders WHERE o_orderstatus <> 'F'"""


def _flat(nested):
    flat = item_ops.flatten_items(nested)
    return flat.select("handle", "display_name", "id", "title", "amount_usd", "url", "status", scalars.iso_millis("created_at").alias("created_at"))


@query(_LISTING_SQL)
def items_from_listing(spark, sf):
    return _flat(_listing_items(spark, sf))


@query(_LISTING_SQL)
def items_through_envelopes(spark, sf):
    """Listing items written as paged envelopes and read back."""
    envelopes = writers.as_envelopes(_listing_items(spark, sf))
    return _flat(readers.envelope_rows(readers.parse_documents(envelopes, "value", schemas.ENVELOPE)))


@query(_LISTING_SQL)
def items_through_cursor_chain(spark, sf):
    """Envelopes of about two items each, whose cursors are followed from the first page to the last."""
    landed = f"{keyed.checkpoint_dir(spark)}/envelopes_{uuid.uuid4().hex}"
    writers.land_envelopes(_listing_items(spark, sf), landed, 2)
    # The chain is read more than once, from landed envelopes and without their items.
    cursor = F.get_json_object("value", "$.result.data.json.next_cursor").alias("next_cursor")
    envelopes = spark.read.parquet(landed).select("*", cursor)
    pages = readers.parse_documents(envelopes, "value", schemas.ENVELOPE, ["handle", "page", "next_cursor"])
    chained = readers.chained_pages(pages, ["handle"], "page")
    return _flat(readers.envelope_rows(chained.where("page_no >= 1")))


@query(r"""SELECT 'i' || o_orderkey AS id, 'task-i' || o_orderkey AS task_id, 'org/repo#' || o_orderkey AS hash,
'$' || CAST(round(CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE) AS BIGINT) AS reward_formatted,
'user' || o_custkey AS login, o_custkey AS user_id, 'Customer ' || o_custkey AS company,
'https://avatars.githubusercontent.com/u/' || o_custkey || '?v=4' AS avatar_url, 'source-i' || o_orderkey AS source_id
FROM orders WHERE o_orderstatus <> 'F'""")
def nested_item_parts(spark, sf):
    nested = _listing_items(spark, sf)
    user = lambda path, kind: F.try_variant_get("task.source.data.user", path, kind)
    return nested.select(
        "id", F.col("task.id").alias("task_id"), F.col("task.hash").alias("hash"), "reward_formatted",
        user("$.login", "string").alias("login"), user("$.id", "bigint").alias("user_id"), user("$.company", "string").alias("company"),
        user("$.avatar_url", "string").alias("avatar_url"), F.col("task.source.data.id").alias("source_id"),
    )


@query(r"""SELECT 'i' || o_orderkey AS id, 'open' AS status, 'standard' AS type, 'dev' AS kind, 'public' AS visibility, 'cash' AS reward_type, 'USD' AS currency,
CAST(round(o_totalprice) AS BIGINT) AS cents, false AS autopay_disabled, false AS is_external, false AS manual_assignments, false AS timeouts_disabled, NULL::BIGINT AS point_reward,
0::BIGINT AS tech, 0::BIGINT AS bids, 0::BIGINT AS tiers, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at, '2001-09-01T00:00:00.000Z' AS updated_at,
CAST(o_custkey AS VARCHAR) AS org_handle, 'generated-' || o_custkey AS org_id, 'Customer ' || o_custkey AS org_name, 'Customer ' || o_custkey AS org_display_name, '' AS org_description,
'org' AS org_forge_handle, 0::BIGINT AS org_stars, '' AS org_website, 'https://avatars.githubusercontent.com/u/' || o_custkey || '?v=4' AS org_avatar, 0::BIGINT AS org_members,
false AS org_sponsors, NULL::BIGINT AS org_days, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS org_created_at, 0::BIGINT AS org_tech,
'open' AS task_status, 'issue' AS task_type, 'github' AS task_forge, 'repo' AS task_repo, 'org' AS task_owner, '' AS task_body, o_orderkey AS task_number,
'https://github.com/org/repo/issues/' || o_orderkey AS task_url, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority || ' task' ELSE 'Issue #' || o_orderkey END AS task_title,
'github' AS source_type, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority || ' task' ELSE 'Issue #' || o_orderkey END AS source_title, '' AS source_body,
'https://github.com/org/repo/issues/' || o_orderkey AS source_url, 'user' || o_custkey AS user_name, '' AS user_location, '' AS user_twitter,
'https://github.com/' || o_custkey || '-team' AS user_url FROM orders WHERE o_orderstatus <> 'F'""")
def listing_item_fields(spark, sf):
    """Nested items of listing rows, all fields beside those of ``nested_item_parts``."""
    nested = _listing_items(spark, sf)
    size = lambda c: F.size(c).cast("bigint")
    user = lambda path: F.try_variant_get("task.source.data.user", path, "string")
    org = {"handle": "handle", "id": "id", "name": "name", "display_name": "display_name", "description": "description", "forge_handle": "github_handle", "stars": "stargazers_count",
           "website": "website_url", "avatar": "avatar_url", "sponsors": "accepts_sponsorships", "days": "days_until_timeout"}
    task = {"status": "status", "type": "type", "forge": "forge", "repo": "repo_name", "owner": "repo_owner", "body": "body", "number": "number", "url": "url", "title": "title"}
    return nested.select(
        "id", "status", "type", "kind", "visibility", "reward_type", "reward.currency", F.col("reward.amount").alias("cents"), "autopay_disabled", "is_external", "manual_assignments",
        "timeouts_disabled", "point_reward", size("tech").alias("tech"), size("bids").alias("bids"), size("reward_tiers").alias("tiers"), scalars.iso_millis("created_at").alias("created_at"),
        scalars.iso_millis("updated_at").alias("updated_at"), *[F.col(f"org.{c}").alias(f"org_{n}") for n, c in org.items()], size("org.members").alias("org_members"),
        scalars.iso_millis("org.created_at").alias("org_created_at"), size("org.tech").alias("org_tech"), *[F.col(f"task.{c}").alias(f"task_{n}") for n, c in task.items()],
        F.col("task.source.type").alias("source_type"), F.col("task.source.data.title").alias("source_title"), F.col("task.source.data.body").alias("source_body"),
        F.col("task.source.data.html_url").alias("source_url"), user("$.name").alias("user_name"), user("$.location").alias("user_location"), user("$.twitter_username").alias("user_twitter"),
        user("$.html_url").alias("user_url"),
    )


def state_pages(spark, sf):
    """Pages whose embedded state lists one order; places, names and defaults vary with the order."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    link = F.concat(F.lit("https://github.com/org"), text("o_custkey"), F.lit("/repo/issues/"), text("o_orderkey"))
    title = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("")
    task = F.to_json(F.struct(link.alias("url"), title.alias("title")))
    cents = text(F.round("o_totalprice").cast("bigint"))
    reward = F.when(status == "P", F.lit('{"amount":0}')).otherwise(F.concat(F.lit('{"amount":'), cents, F.lit("}")))
    item = F.concat(F.lit('{"id":"n'), text("o_orderkey"), F.lit('","reward":'), reward, F.lit(',"task":'), task, F.lit("}"))
    elsewhere = F.lit('{"id":"x","url":"https://example.com/none"}')
    listed = F.concat(F.lit("["), item, F.lit(","), elsewhere, F.lit("]"))
    props = (
        F.when(status == "F", F.concat(F.lit('{"bounties":null,"items":'), listed, F.lit("}")))
        .when(status == "P", F.concat(F.lit('{"bounties":'), listed, F.lit(',"items":[]}')))
        .otherwise(F.concat(F.lit('{"items":0,"data":{"items":'), listed, F.lit("}}")))
    )
    html = F.concat(
        F.lit('<html><body><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":'), props, F.lit("}}</script></body></html>")
    )
    return table(spark, sf, "orders").select(key.alias("page_id"), text("o_custkey").alias("handle"), html.alias("html"))


@query("""SELECT o_orderkey AS page_id, CAST(0 AS BIGINT) AS pos, 'n' || o_orderkey AS id,
CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '' END AS title,
CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(round(o_totalprice) AS BIGINT) END AS cents, 'USD' AS currency,
'org' || o_custkey AS owner, o_orderkey AS number FROM orders""")
def embedded_candidates(spark, sf):
    state = state_pages(spark, sf).withColumn("state", item_ops.embedded_state("html")).drop("html")
    found = item_ops.embedded_candidates(state)
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "id", "title", "cents", "currency", "owner", "number")


@query("""SELECT o_orderkey AS page_id, 'n' || o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE 'Issue #' || o_orderkey END AS title,
CASE WHEN o_orderstatus = 'P' THEN 10000 ELSE CAST(round(o_totalprice) AS BIGINT) END AS cents, 'USD' AS currency, 'task-' || o_custkey || '#' || o_orderkey AS task_id,
'repo' AS repo_name, 'org' || o_custkey AS repo_owner, 'org' || o_custkey || '/repo#' || o_orderkey AS hash, o_orderkey AS number, 'source-' || o_custkey || '#' || o_orderkey AS source_id,
'https://github.com/org' || o_custkey || '/repo/issues/' || o_orderkey AS url, 'open' AS status, 'standard' AS type, 'dev' AS kind, 'public' AS visibility, 'cash' AS reward_type,
'generated-' || o_custkey AS org_id, 'org' || o_custkey AS github_handle, 'Customer ' || o_custkey AS display_name, 'some' AS description, o_custkey || '-team' AS login,
'Customer ' || o_custkey || ' Team' AS author, false AS is_external, 0::BIGINT AS bids, 'github' AS forge, 'issue' AS task_type, '' AS body FROM orders""")
def candidate_item_fields(spark, sf):
    """Nested items of pre-extracted candidates, most of their fields."""
    state = state_pages(spark, sf).withColumn("state", item_ops.embedded_state("html")).drop("html")
    rows = item_ops.embedded_candidates(state).withColumns(
        {"display_name": F.concat(F.lit("Customer "), "handle"), "description": F.lit("some"), "org_tech": F.lit(None).cast("array<string>")}
    )
    nested = item_ops.items_from_candidates(rows, as_of(), keep=["page_id"])
    user = lambda path: F.try_variant_get("task.source.data.user", path, "string")
    return nested.select(
        "page_id", "id", F.col("task.title").alias("title"), F.col("reward.amount").alias("cents"), F.col("reward.currency").alias("currency"), F.col("task.id").alias("task_id"),
        "task.repo_name", "task.repo_owner", "task.hash", "task.number", F.col("task.source.data.id").alias("source_id"), F.col("task.url").alias("url"), "status", "type", "kind",
        "visibility", "reward_type", F.col("org.id").alias("org_id"), "org.github_handle", "org.display_name", "org.description", user("$.login").alias("login"),
        user("$.name").alias("author"), "is_external", F.size("bids").cast("bigint").alias("bids"), "task.forge", F.col("task.type").alias("task_type"), F.col("task.body").alias("body"),
    )


@query("""SELECT o_orderkey AS page_id, 'n' || o_orderkey AS id,
CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE 'Issue #' || o_orderkey END AS title,
'org' || o_custkey AS github_handle FROM orders WHERE o_orderstatus <> 'O'""")
def embedded_raw_items(spark, sf):
    """Raw objects; the nested ``data.items`` place is not searched for these."""
    pages = state_pages(spark, sf)
    state = pages.withColumn("state", item_ops.embedded_state("html")).drop("html")
    rows = item_ops.embedded_raw_rows(state).withColumns(
        {"display_name": F.col("handle"), "description": F.lit(None).cast("string"), "org_tech": F.lit(None).cast("array<string>")}
    )
    nested = item_ops.items_from_embedded(rows, as_of(), keep=["page_id"])
    return nested.select("page_id", "id", F.col("task.title").alias("title"), F.col("org.github_handle").alias("github_handle"))


def _raw_pages(spark, sf):
    """Pages whose embedded state has one raw object: with all fields, with hardly any, or with empty ones."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 3
    pick = lambda full, empty: F.when(kind == 0, full).when(kind == 2, empty)
    say = lambda value: pick(F.lit(value), F.lit(""))
    flag = pick(F.lit(True), F.lit(False))
    words = lambda *w: pick(F.array(*[F.lit(x) for x in w]), F.array().cast("array<string>"))
    link = F.concat(F.lit("https://github.com/org"), text("o_custkey"), F.lit("/repo/issues/"), text("o_orderkey"))
    task = F.struct(
        pick(F.concat(F.lit("t"), text("o_orderkey")), F.lit("")).alias("id"), say("closed").alias("status"), say("pull").alias("type"),
        pick(F.col("o_orderpriority"), F.lit("")).alias("title"), say("Some text.").alias("body"), link.alias("html_url"), words("rust").alias("tech"),
    )
    reward = F.struct(say("EUR").alias("currency"), pick(F.round("o_totalprice").cast("bigint"), F.lit(0).cast("bigint")).alias("amount"))
    item = F.struct(
        pick(F.concat(F.lit("r"), text("o_orderkey")), F.lit("")).alias("id"), say("paid").alias("status"), say("contest").alias("type"), say("design").alias("kind"),
        say("2020-01-02T03:04:05Z").alias("created_at"), say("2020-02-03T04:05:06Z").alias("updated_at"), say("private").alias("visibility"), flag.alias("autopay_disabled"),
        words("go", "ui").alias("tech"), flag.alias("is_external"), flag.alias("manual_assignments"), pick(F.lit(5), F.lit(0)).alias("point_reward"), F.when(kind != 1, reward).alias("reward"),
        say("points").alias("reward_type"), flag.alias("timeouts_disabled"), task.alias("task"),
    )
    state = F.to_json(F.struct(F.struct(F.struct(F.array(item).alias("bounties")).alias("pageProps")).alias("props")))
    html = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), state, F.lit("</script>"))
    return table(spark, sf, "orders").select(key.alias("page_id"), text("o_custkey").alias("handle"), html.alias("html"))


_FULL = "CASE WHEN o_orderkey % 3 = 0 THEN {0} ELSE {1} END"


@query("SELECT o_orderkey AS page_id, " + ", ".join(f"{_FULL.format(full, other)} AS {name}" for name, full, other in (
    ("id", "'r' || o_orderkey", "o_custkey || '#' || o_orderkey"), ("status", "'paid'", "'open'"), ("type", "'contest'", "'standard'"), ("kind", "'design'", "'dev'"),
    ("created_at", "'2020-01-02T03:04:05.000Z'", "'2001-09-01T00:00:00.000Z'"), ("updated_at", "'2020-02-03T04:05:06.000Z'", "'2001-09-01T00:00:00.000Z'"),
    ("visibility", "'private'", "'public'"), ("autopay_disabled", "true", "false"), ("tech", "'go,ui'", "''"), ("is_external", "true", "false"),
    ("manual_assignments", "true", "false"), ("point_reward", "5::BIGINT", "NULL"), ("currency", "'EUR'", "'USD'"), ("cents", "CAST(round(o_totalprice) AS BIGINT)", "10000"),
    ("reward_type", "'points'", "'cash'"), ("timeouts_disabled", "true", "false"), ("task_id", "'t' || o_orderkey", "'task-' || o_custkey || '#' || o_orderkey"),
    ("task_status", "'closed'", "'open'"), ("task_type", "'pull'", "'issue'"), ("title", "o_orderpriority", "'Issue #' || o_orderkey"), ("body", "'Some text.'", "''"), ("task_tech", "'rust'", "''"),
)) + """, '$' || CAST(round(CASE WHEN o_orderkey % 3 = 0 THEN CAST(round(o_totalprice) AS BIGINT) ELSE 10000 END / 100.0::DOUBLE) AS BIGINT) AS reward_formatted,
'https://github.com/org' || o_custkey || '/repo/issues/' || o_orderkey AS url, 'org' || o_custkey || '/repo#' || o_orderkey AS hash, o_orderkey AS number,
'repo' AS repo_name, 'org' || o_custkey AS repo_owner, 'github' AS forge, 'generated-' || o_custkey AS org_id, 0::BIGINT AS bids, 0::BIGINT AS tiers,
'source-' || o_custkey || '#' || o_orderkey AS source_id FROM orders""")
def raw_item_fields(spark, sf):
    """Nested items of raw embedded objects: given fields stay, absent and empty ones take their defaults."""
    state = _raw_pages(spark, sf).withColumn("state", item_ops.embedded_state("html")).drop("html")
    rows = item_ops.embedded_raw_rows(state).withColumns(
        {"display_name": F.col("handle"), "description": F.lit(None).cast("string"), "org_tech": F.lit(None).cast("array<string>")}
    )
    nested = item_ops.items_from_embedded(rows, as_of(), keep=["page_id"])
    joined = lambda c: F.array_join(c, ",")
    return nested.select(
        "page_id", "id", "status", "type", "kind", scalars.iso_millis("created_at").alias("created_at"), scalars.iso_millis("updated_at").alias("updated_at"), "visibility",
        "autopay_disabled", joined("tech").alias("tech"), "is_external", "manual_assignments", "point_reward", "reward.currency", F.col("reward.amount").alias("cents"), "reward_type",
        "timeouts_disabled", F.col("task.id").alias("task_id"), F.col("task.status").alias("task_status"), F.col("task.type").alias("task_type"), "task.title", "task.body",
        joined("task.tech").alias("task_tech"), "reward_formatted", "task.url", "task.hash", "task.number", "task.repo_name", "task.repo_owner", "task.forge", F.col("org.id").alias("org_id"),
        F.size("bids").cast("bigint").alias("bids"), F.size("reward_tiers").cast("bigint").alias("tiers"), F.col("task.source.data.id").alias("source_id"),
    )


@query("""SELECT CAST(o_custkey AS VARCHAR) AS handle, 'n' || o_orderkey AS id,
CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE 'Issue #' || o_orderkey END AS title,
CASE WHEN o_orderstatus = 'P' THEN 100.0::DOUBLE ELSE CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE END AS amount_usd
FROM orders
UNION ALL
SELECT handle, handle || '#' || issue, 'Issue #' || issue, 100.0::DOUBLE
FROM (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS handle, l_partkey AS issue FROM lineitem UNION SELECT CAST(l_suppkey AS VARCHAR), l_orderkey FROM lineitem)
WHERE handle NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders)""")
def items_from_best_source(spark, sf):
    """Pages with embedded state and pages with only text, one per line item; each organization has its best source.

    A part sold twice is named by two pages of one organization, and is one item. Organizations with both kinds of pages have the
    items of the first kind only.
    """
    link = lambda c: F.concat(F.lit("<p>see github.com/o/r/issues/"), text(c), F.lit("</p>"))
    text_pages = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("page_id"), text("l_suppkey").alias("handle"), F.concat(link("l_partkey"), link("l_orderkey")).alias("html")
    )
    pages = item_ops.pages_of_best_source(state_pages(spark, sf).unionByName(text_pages))
    rows = item_ops.organization_rows(item_ops.best_source_rows(pages), ["page_id"]).withColumns(
        {"display_name": F.col("handle"), "description": F.lit(None).cast("string"), "org_tech": F.lit(None).cast("array<string>")}
    )
    flat = item_ops.flatten_items(item_ops.items_from_best_source(rows, as_of()))
    return flat.select("handle", "id", "title", "amount_usd")


@query(with_ctes(ITEMS) + """SELECT handle, id, title, amount_usd, status FROM items""")
def items_through_index(spark, sf):
    """Items nested by organization in bounded parts, written as JSON and read back."""
    flat = items(spark, sf).select("handle", "display_name", "id", "title", "amount_usd", "status")
    nested = stats.nested_by_org(flat, part_size=5)
    org = F.struct(F.col("display_name"), F.col("items").alias("bounties"))
    bodies = nested.select(F.to_json(F.struct(F.create_map("handle", org).alias("organizations"))).alias("body"))
    found = readers.index_items(readers.parse_documents(bodies, "body", schemas.INDEX))
    return found.select("handle", "id", "title", "amount_usd", "status")


@query("""SELECT CAST(page_id AS VARCHAR) AS handle, url, md5(html) AS hash, CAST(length(html) AS BIGINT) AS item_estimate FROM pages""")
def state_through_document(spark, sf):
    entry = F.struct("url", F.md5("html").alias("hash"), F.length("html").alias("bounty_count_estimate"))
    bodies = table(spark, sf, "pages").select(
        F.to_json(F.struct(F.create_map(text("page_id"), entry).alias("organizations"))).alias("body")
    )
    rows = readers.state_rows(readers.parse_documents(bodies, "body", schemas.STATE_DOCUMENT))
    return rows.select("handle", "url", "hash", "item_estimate")
