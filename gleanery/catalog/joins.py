"""Snapshot diffs, page checks, lookups, candidates, first/last rows and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.catalog.core import query
from gleanery.catalog.tables import (
    ITEMS, LISTINGS, REPOS, SIGNATURE, SIGNATURES, SNAPSHOTS, URL_TEMPLATE, as_of, items, line_items, listings, order_heads,
    page_check_state, page_checks, table, text, with_ctes,
)
from gleanery.functions.scalars import iso_millis
from gleanery.operators import changes, discovery, items as item_ops, keyed, page_state, registry, stats

# --- snapshots -------------------------------------------------------------------------------------

_SEEN = ["seen_at", "tie"]


def _forward(spark, sf):
    """Orders before, line items now: current ids repeat."""
    return changes.diff_snapshots(order_heads(spark, sf), line_items(spark, sf), order=["seen_at"])


def _backward(spark, sf):
    """Line items before, orders now: previous ids repeat and their last row counts."""
    return changes.diff_snapshots(line_items(spark, sf), order_heads(spark, sf), order=_SEEN)


_NUM = r"regexp_replace(CAST(CAST({0}.amount_usd AS DECIMAL(30,10)) AS VARCHAR), '\.?0+$', '')"
_CHANGES = rf"""concat_ws(' ; ',
  CASE WHEN p.title IS DISTINCT FROM c.title THEN 'title: "' || p.title || '" → "' || c.title || '"' END,
  CASE WHEN p.amount_usd IS DISTINCT FROM c.amount_usd THEN 'amount: $' || {_NUM.format('p')} || ' → $' || {_NUM.format('c')} END,
  CASE WHEN p.status IS DISTINCT FROM c.status THEN 'status: ' || p.status || ' → ' || c.status END,
  CASE WHEN p.url IS DISTINCT FROM c.url THEN 'url: ' || p.url || ' → ' || c.url END,
  CASE WHEN p.difficulty IS DISTINCT FROM c.difficulty
    THEN 'difficulty: ' || coalesce(p.difficulty, 'undefined') || ' → ' || coalesce(c.difficulty, 'undefined') END,
  CASE WHEN len(list_filter(c.tags, lambda t: NOT list_contains(p.tags, t))) > 0
    THEN 'tags added: ' || array_to_string(list_filter(list_distinct_kept(c.tags), lambda t: NOT list_contains(p.tags, t)), ', ') END,
  CASE WHEN len(list_filter(p.tags, lambda t: NOT list_contains(c.tags, t))) > 0
    THEN 'tags removed: ' || array_to_string(list_filter(list_distinct_kept(p.tags), lambda t: NOT list_contains(c.tags, t)), ', ') END)""".replace(
    "list_distinct_kept(c.tags)", "list_filter(c.tags, lambda t, i: list_position(c.tags, t) = i)"
).replace("list_distinct_kept(p.tags)", "list_filter(p.tags, lambda t, i: list_position(p.tags, t) = i)")


@query(with_ctes(SNAPSHOTS) + """
SELECT c.id, c.handle, c.amount_usd FROM line_items c ANTI JOIN order_heads p USING (id)""")
def diff_added(spark, sf):
    return _forward(spark, sf).where("change_type = 'added'").select("id", "new.handle", "new.amount_usd")


@query(with_ctes(SNAPSHOTS) + """
SELECT p.id, p.handle, p.amount_usd FROM line_items p ANTI JOIN order_heads c USING (id)""")
def diff_removed(spark, sf):
    return _backward(spark, sf).where("change_type = 'removed'").select("id", "old.handle", "old.amount_usd")


@query(with_ctes(SNAPSHOTS) + f"""
SELECT id, changes FROM (SELECT c.id, {_CHANGES} AS changes FROM line_items c JOIN order_heads p USING (id)) WHERE changes <> ''""")
def diff_updated(spark, sf):
    """Readable field changes, one row per repeat of a current id."""
    rows = _forward(spark, sf).where("change_type = 'updated'")
    return rows.select("id", F.array_join("changes", " ; ").alias("changes"))


@query(with_ctes(SNAPSHOTS) + f"""
SELECT id, changes FROM (SELECT c.id, {_CHANGES} AS changes FROM order_heads c JOIN last_lines p USING (id)) WHERE changes <> ''""")
def diff_updated_from_last(spark, sf):
    rows = _backward(spark, sf).where("change_type = 'updated'")
    return rows.select("id", F.array_join("changes", " ; ").alias("changes"))


@query(with_ctes(SNAPSHOTS) + f"""
SELECT id, CASE WHEN p.seen_at IS NULL THEN 'added' WHEN c.seen_at IS NULL THEN 'removed' ELSE 'updated' END AS change_type
FROM order_heads c FULL JOIN last_lines p USING (id)
WHERE p.seen_at IS NULL OR c.seen_at IS NULL OR {_CHANGES} <> ''""")
def diff_unique_keys(spark, sf):
    """Snapshots with unique ids: nothing is numbered."""
    previous = keyed.last_per_key(line_items(spark, sf), ["id"], _SEEN)
    return changes.diff_snapshots(previous, order_heads(spark, sf)).select("id", "change_type")


_REPEATED = """,
before AS (SELECT id, title, amount_usd, status, url, difficulty, tags FROM line_items),
after AS (SELECT id, title, CASE WHEN l_quantity > 40 THEN amount_usd + 1 ELSE amount_usd END AS amount_usd, status, url, difficulty, tags FROM line_items WHERE l_tax > 0.01),
gone AS (SELECT *, row_number() OVER r AS place FROM (FROM before EXCEPT ALL FROM after) WINDOW r AS (PARTITION BY id ORDER BY title, amount_usd, status, url, difficulty NULLS FIRST, tags)),
come AS (SELECT *, row_number() OVER r AS place FROM (FROM after EXCEPT ALL FROM before) WINDOW r AS (PARTITION BY id ORDER BY title, amount_usd, status, url, difficulty NULLS FIRST, tags))
SELECT id, CASE WHEN g.place IS NULL THEN 'added' WHEN c.place IS NULL THEN 'removed' ELSE 'updated' END AS change_type,
  g.amount_usd AS old_usd, c.amount_usd AS new_usd, CAST(coalesce(g.difficulty <> c.difficulty, (g.difficulty IS NULL) <> (c.difficulty IS NULL)) AS BOOLEAN) AS moved
FROM gone g FULL JOIN come c USING (id, place)"""


@query(with_ctes(SNAPSHOTS) + _REPEATED)
def diff_repeated_keys(spark, sf):
    """Snapshots without an order whose ids repeat: what both say cancels out, the rest is paired by content."""
    before = line_items(spark, sf)
    dearer = F.when(F.col("tie.l_quantity") > 40, F.col("amount_usd") + 1).otherwise(F.col("amount_usd"))
    found = changes.diff_snapshots(before, before.where("tie.l_tax > 0.01").withColumn("amount_usd", dearer))
    moved = F.coalesce(F.col("old.difficulty") != F.col("new.difficulty"), F.col("old.difficulty").isNull() != F.col("new.difficulty").isNull())
    return found.select("id", "change_type", F.col("old.amount_usd").alias("old_usd"), F.col("new.amount_usd").alias("new_usd"), moved.alias("moved"))


@query(with_ctes(SNAPSHOTS) + """
SELECT handle, CASE WHEN p IS NULL THEN 'added' ELSE 'removed' END AS change_type
FROM (SELECT DISTINCT handle, 1 AS p FROM order_heads) FULL JOIN (SELECT DISTINCT handle, 1 AS c FROM line_items) USING (handle)
WHERE p IS NULL OR c IS NULL""")
def diff_organizations(spark, sf):
    return changes.diff_keys(order_heads(spark, sf), line_items(spark, sf))


@query(with_ctes(SNAPSHOTS) + f""", counts AS (SELECT
  (SELECT count(*) FROM line_items c ANTI JOIN order_heads p USING (id)) AS added,
  (SELECT count(*) FROM order_heads p ANTI JOIN line_items c USING (id)) AS removed,
  (SELECT count(*) FROM (SELECT {_CHANGES} AS changes FROM line_items c JOIN order_heads p USING (id)) WHERE changes <> '') AS updated,
  (SELECT count(*) FROM (SELECT handle FROM line_items EXCEPT SELECT handle FROM order_heads)) AS orgs_added,
  (SELECT count(*) FROM (SELECT handle FROM order_heads EXCEPT SELECT handle FROM line_items)) AS orgs_removed)
SELECT *, added + removed + updated + orgs_added + orgs_removed > 0 AS has_changes, coalesce(nullif(concat_ws(', ',
  CASE WHEN added > 0 THEN added || ' bounties added' END, CASE WHEN removed > 0 THEN removed || ' bounties removed' END,
  CASE WHEN updated > 0 THEN updated || ' bounties updated' END,
  CASE WHEN orgs_added > 0 THEN orgs_added || ' organizations added' END,
  CASE WHEN orgs_removed > 0 THEN orgs_removed || ' organizations removed' END), ''), 'No changes detected') AS summary FROM counts""")
def diff_summary(spark, sf):
    prev, cur = order_heads(spark, sf), line_items(spark, sf)
    return changes.diff_counts(_forward(spark, sf), changes.diff_keys(prev, cur))


@query(with_ctes(ITEMS) + """
SELECT 'added' AS change_type, CAST(count(*) AS BIGINT) AS items, CAST(sum(cents) AS BIGINT) AS cents FROM items""")
def diff_first_snapshot(spark, sf):
    """Against an empty snapshot everything is added."""
    cur = items(spark, sf)
    rows = changes.diff_snapshots(cur.limit(0), cur)
    return rows.groupBy("change_type").agg(F.count("*").alias("items"), F.sum("new.cents").alias("cents"))


@query(with_ctes(ITEMS) + """
SELECT count(*) AS added, count(DISTINCT handle) AS orgs_added,
  'Initial scan: ' || count(*) || ' bounties across ' || count(DISTINCT handle) || ' organizations' AS summary FROM items""")
def diff_initial_summary(spark, sf):
    return changes.initial_summary(items(spark, sf))


# --- page checks -----------------------------------------------------------------------------------

_CHECK_CTES = r"""
state AS (
  SELECT CAST(page_id AS VARCHAR) AS handle, url AS old_url, CASE WHEN contains(url, '/fr/') THEN 'stale' ELSE hash END AS old_hash
  FROM signed WHERE starts_with(url, 'https:')
),
checked AS (
  SELECT CAST(page_id AS VARCHAR) AS handle,
    CASE WHEN contains(url, '#top') THEN 'error' WHEN old_hash IS NULL OR old_hash <> hash THEN 'changed' ELSE 'unchanged' END AS outcome,
    CASE WHEN contains(url, '?') THEN 'https://listings.example/' || page_id || '/bounties?status=open' ELSE url END AS new_url,
    hash, item_estimate, old_hash, old_url
  FROM signed LEFT JOIN state ON CAST(page_id AS VARCHAR) = handle
)"""


def _checked(spark, sf, force_all=False):
    registry_table, fetched, pages = page_checks(spark, sf)
    sign = lambda df: page_state.page_signatures(df, SIGNATURE, marker="<nav>")
    state = page_check_state(sign(pages))
    return page_state.check_pages(registry_table, sign(fetched), state, as_of(), URL_TEMPLATE, force_all)


@query(with_ctes(SIGNATURES, _CHECK_CTES) + """SELECT handle, outcome FROM checked""")
def page_check_outcomes(spark, sf):
    return _checked(spark, sf).select("handle", "outcome")


@query(with_ctes(SIGNATURES, _CHECK_CTES) + """
SELECT handle, CASE WHEN outcome = 'error' THEN old_url ELSE new_url END AS url,
  CASE WHEN outcome = 'error' THEN old_hash ELSE hash END AS hash,
  CASE WHEN outcome = 'error' THEN '2001-08-01T00:00:00.000Z' ELSE '2001-09-01T00:00:00.000Z' END AS last_checked,
  CASE outcome WHEN 'changed' THEN '2001-09-01T00:00:00.000Z' ELSE '2001-07-01T00:00:00.000Z' END AS last_changed,
  CASE WHEN outcome = 'error' THEN 7 ELSE item_estimate END AS item_estimate
FROM checked WHERE outcome <> 'error' OR old_hash IS NOT NULL""")
def page_check_state_after(spark, sf):
    """Next state: fresh rows for fetched pages, carried rows for failed ones."""
    state = page_state.next_state(_checked(spark, sf))
    return state.withColumns({c: iso_millis(c) for c in ("last_checked", "last_changed")})


@query(with_ctes(SIGNATURES, _CHECK_CTES) + """
SELECT count(*) AS total_checked, count_if(outcome = 'changed')::BIGINT AS changed, count_if(outcome = 'unchanged')::BIGINT AS unchanged,
  count_if(outcome = 'error')::BIGINT AS errors, round(count_if(outcome = 'unchanged') * 100.0::DOUBLE / count(*), 1) AS skipped_percent FROM checked""")
def page_check_summary(spark, sf):
    return page_state.check_summary(_checked(spark, sf))


@query(with_ctes(SIGNATURES, _CHECK_CTES) + """SELECT handle FROM checked WHERE outcome <> 'error'""")
def page_check_forced(spark, sf):
    """Force all: every page that could be fetched counts as changed."""
    return page_state.changed_handles(_checked(spark, sf, force_all=True))


@query(with_ctes(SIGNATURES) + """SELECT CAST(page_id AS VARCHAR) AS handle, hash FROM signed WHERE NOT contains(url, '#top')""")
def page_check_first_run(spark, sf):
    """No state yet: every fetched page has changed."""
    registry_table, fetched, _ = page_checks(spark, sf)
    signed = page_state.page_signatures(fetched, SIGNATURE, marker="<nav>")
    return page_state.check_pages(registry_table, signed, None, as_of(), URL_TEMPLATE).where("outcome = 'changed'").select("handle", "hash")


# --- targets and lookups ---------------------------------------------------------------------------

_REGISTRY = "(SELECT CAST(c_custkey AS VARCHAR) AS handle FROM customer)"
_TARGETS = "(SELECT DISTINCT CAST(o_custkey * 2 AS VARCHAR) AS handle FROM orders)"


def _registry_and_targets(spark, sf):
    known = table(spark, sf, "customer").select(text("c_custkey").alias("handle"), "c_name")
    return known, table(spark, sf, "orders").select(text(F.col("o_custkey") * 2).alias("handle"))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS handle, c_name FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT handle FROM {_TARGETS})")
def targets_selected(spark, sf):
    return registry.select_targets(*_registry_and_targets(spark, sf))


@query(f"SELECT handle FROM {_TARGETS} EXCEPT SELECT handle FROM {_REGISTRY}")
def targets_missing(spark, sf):
    return registry.missing_targets(*_registry_and_targets(spark, sf))


@query(f"""SELECT count(*) AS requested, count(r.handle) AS found, count_if(r.handle IS NULL)::BIGINT AS not_found
FROM {_TARGETS} t LEFT JOIN {_REGISTRY} r USING (handle)""")
def targets_report(spark, sf):
    return registry.target_report(*_registry_and_targets(spark, sf))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '' END, ''),
'Line ' || l_linenumber) AS title, coalesce(CASE WHEN o_orderstatus <> 'P' THEN 'body ' || o_custkey END, 'none') AS body
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND CAST(o_orderkey % 3 AS VARCHAR) = CAST(l_orderkey % 3 AS VARCHAR)""")
def enriched_items(spark, sf):
    """Line items looking up their order by three keys, with their own values as the fallback."""
    repo = lambda key: F.concat(F.lit("repo"), text(F.col(key) % 3))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit("o").alias("owner"), repo("l_orderkey").alias("repo"),
        F.col("l_orderkey").alias("number"), F.concat(F.lit("Line "), text("l_linenumber")).alias("title"), F.lit("none").alias("body"),
    )
    issues = table(spark, sf, "orders").select(
        F.lit("o").alias("owner"), repo("o_orderkey").alias("repo"), F.col("o_orderkey").alias("number"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("").alias("title"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("body "), text("o_custkey"))).alias("body"),
    )
    found = registry.enrich(lines, issues, fields=("title", "body"))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "title", "body")


# --- candidates ------------------------------------------------------------------------------------

_AFFIXED = """(SELECT unnest(['open' || b, 'open-' || b, 'the' || b, 'the-' || b, b || 'js', b || '-js', b || 'kit', b || '-kit']) AS handle
FROM (SELECT DISTINCT replace(p_name, ' ', '') AS b FROM part))"""


def _affixed(spark, sf):
    bases = table(spark, sf, "part").select(F.replace("p_name", F.lit(" "), F.lit("")).alias("handle")).distinct()
    return discovery.affix_candidates(bases, ("open", "the"), ("js", "kit"))


@query(f"SELECT handle FROM {_AFFIXED}")
def affix_candidates(spark, sf):
    return _affixed(spark, sf)


@query("""SELECT h AS handle FROM (SELECT DISTINCT lower(substr(n_name, 1, 1)) || n_nationkey AS l FROM nation), unnest(list_prepend(l, list_transform(range(100), lambda i: l || i))) AS t(h)""")
def letter_number_candidates(spark, sf):
    letters = table(spark, sf, "nation").select(F.concat(F.lower(F.substring("n_name", 1, 1)), text("n_nationkey")).alias("handle")).distinct()
    return discovery.letter_number_candidates(letters)


@query("""SELECT CAST(i AS INTEGER) AS page, u || i AS url FROM (
SELECT DISTINCT 'https://listings.example/bounties?from=' || p_brand || '&page=' AS u FROM part), range(1, 21) AS t(i)""")
def page_candidates(spark, sf):
    templates = table(spark, sf, "part").select(
        F.concat(F.lit("https://listings.example/bounties?from="), "p_brand", F.lit("&page=")).alias("template")
    ).distinct()
    return discovery.page_candidates(templates, 20)


_WORDS = "(SELECT DISTINCT w AS handle FROM (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS w FROM documents))"


def _words(spark, sf):
    words = F.split("text", "[^A-Za-z]+")
    return table(spark, sf, "documents").select(F.explode(F.array_distinct(words)).alias("handle"))


@query(f"""SELECT handle FROM {_WORDS} WHERE length(handle) BETWEEN 2 AND 50
AND handle NOT IN (SELECT w FROM (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS w FROM benchmark))""")
def new_candidates(spark, sf):
    """Words of all documents that the benchmark texts do not hold."""
    known = table(spark, sf, "benchmark").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("handle"))
    return discovery.new_candidates(_words(spark, sf), known)


_PROBED = """(SELECT c_custkey AS handle, CASE WHEN worst = 'F' AND n > 12 THEN 'error' WHEN n >= 10 THEN 'valid' ELSE 'invalid' END AS outcome
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderstatus) AS worst FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


def _probed(spark, sf):
    probes = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("handle")).agg(
        F.count("*").alias("n"), F.min("o_orderstatus").alias("worst")
    ).select(
        "handle", F.when(F.col("n") >= 10, 200).otherwise(404).alias("status"),
        F.when((F.col("worst") == "F") & (F.col("n") > 12), "timeout").otherwise("").alias("error"),
    )
    return discovery.classify_candidates(table(spark, sf, "customer").select(F.col("c_custkey").alias("handle")), probes)


@query(f"SELECT handle, outcome FROM {_PROBED}")
def classified_candidates(spark, sf):
    return _probed(spark, sf)


@query(f"""SELECT count(*) AS total, count_if(outcome = 'valid')::BIGINT AS valid, count_if(outcome = 'invalid')::BIGINT AS invalid,
count_if(outcome = 'error')::BIGINT AS error FROM {_PROBED}""")
def candidate_totals(spark, sf):
    return discovery.candidate_totals(_probed(spark, sf))


# --- sources, positions, outcomes ------------------------------------------------------------------

_SOURCES = """(SELECT o_custkey AS handle, 1 AS source, o_orderkey AS k FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
UNION ALL SELECT o_custkey, 2, o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'
UNION ALL SELECT o_custkey, 3, o_orderkey FROM orders)"""


@query(f"SELECT handle, source, k FROM {_SOURCES} QUALIFY source = min(source) OVER (PARTITION BY handle)")
def first_source_rows(spark, sf):
    """Per organization the rows of its first non-empty source."""
    orders = table(spark, sf, "orders")
    rows = lambda df, i: df.select(F.col("o_custkey").alias("handle"), F.lit(i).alias("source"), F.col("o_orderkey").alias("k"))
    sources = registry.append_results(
        rows(orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"), 1),
        rows(orders.where("o_orderpriority = '2-HIGH'"), 2), rows(orders, 3),
    )
    return keyed.first_source(sources, ["handle"], "source")


_POSITIONAL = r"""
found AS (
  SELECT page_id, handle, url, list_filter(list_transform(regexp_extract_all(html, '\$(\d+(?:,\d{3})*(?:\.\d{2})?)', 1),
      lambda a: CAST(replace(a, ',', '') AS DOUBLE)), lambda a: a > 0) AS amounts,
    regexp_extract_all(html, 'phx-value-id="([^"]+)"', 1) AS raw_ids,
    regexp_extract_all(html, 'github\.com/[^/]+/[^/]+/issues/\d+') AS refs,
    list_filter(list_transform(list_concat(regexp_extract_all(html, '<title>([^<]+)</title>', 1),
      regexp_extract_all(html, 'class="[^"]*title[^"]*"[^>]*>([^<]+)<', 1),
      regexp_extract_all(html, 'href="[^"]*github\.com[^"]*"[^>]*>([^<]+)<', 1)), lambda t: trim(t)), lambda t: length(t) > 10) AS titles
  FROM listings
),
distinct_ids AS (SELECT *, list_filter(raw_ids, lambda x, i: list_position(raw_ids, x) = i) AS ids FROM found),
zipped AS (
  SELECT page_id, handle, url, unnest(range(len(amounts))) AS pos, amounts, ids, refs, titles FROM distinct_ids
),
by_position AS (
  SELECT page_id, handle, pos, coalesce(ids[pos + 1], 'unknown-' || pos) AS id, amounts[pos + 1] AS amount_usd,
    coalesce(titles[pos + 1], 'Bounty ' || (pos + 1)) AS raw_title,
    coalesce('https://' || refs[pos + 1], url) AS item_url,
    CAST(nullif(regexp_extract(refs[pos + 1], '/issues/(\d+)', 1), '') AS BIGINT) AS issue_number,
    nullif(regexp_extract(refs[pos + 1], 'github\.com/[^/]+/([^/]+)/', 1), '') AS repo
  FROM zipped
)"""


@query(with_ctes(LISTINGS, _POSITIONAL) + r"""
SELECT page_id, handle, CAST(pos AS INTEGER) AS pos, id, amount_usd, trim(regexp_replace(regexp_replace(raw_title, '^\s*\[.*?\]\s*', ''), '\s*\|\s*.*$', '')) AS title,
  '$' || regexp_replace(CAST(CAST(amount_usd AS DECIMAL(30,10)) AS VARCHAR), '\.?0+$', '') AS amount_formatted, item_url, issue_number
FROM by_position""")
def positional_items(spark, sf):
    """Items of all listing pages, paired by position in one pass over the HTML."""
    found = item_ops.positional_items(listings(spark, sf))
    return found.select("page_id", "handle", "pos", "id", "amount_usd", "title", "amount_formatted", "item_url", "issue_number")


@query(with_ctes(LISTINGS, _POSITIONAL) + r"""
SELECT handle, count(*) AS item_count, CAST(sum(CAST(round(amount_usd * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE AS total_value_usd
FROM by_position GROUP BY handle""")
def listing_rollup(spark, sf):
    """Pages to items to organization totals."""
    found = item_ops.positional_items(listings(spark, sf)).withColumn("display_name", F.col("handle"))
    return stats.rollup_by_org(found).drop("display_name")


@query(with_ctes(LISTINGS, _POSITIONAL) + r"""
SELECT page_id, p.pos::INTEGER AS pos, coalesce(nullif(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority || ' real title' ELSE '' END, ''),
  trim(regexp_replace(regexp_replace(raw_title, '^\s*\[.*?\]\s*', ''), '\s*\|\s*.*$', ''))) AS title
FROM by_position p LEFT JOIN orders ON o_orderkey * 10 = issue_number""")
def positional_items_with_issues(spark, sf):
    """Positional items that take the title of the landed issue when there is one."""
    repo = F.element_at(F.array(*[F.lit(r) for r in REPOS]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    issues = table(spark, sf, "orders").select(
        F.concat(F.lit("org"), text("o_custkey")).alias("owner"), repo.alias("repo"), (F.col("o_orderkey") * 10).alias("number"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat("o_orderpriority", F.lit(" real title"))).otherwise("").alias("title"),
    )
    return item_ops.positional_items(listings(spark, sf), issues).select("page_id", "pos", "title")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS handle, c_acctbal > 0 AS success, CASE WHEN c_acctbal > 0 THEN coalesce(n, 0) ELSE 0 END AS item_count,
CASE WHEN c_acctbal > 0 THEN coalesce(cents / 100.0::DOUBLE, 0) ELSE 0 END AS total_value_usd, CAST(length(c_name) AS BIGINT) AS duration_ms,
CASE WHEN NOT c_acctbal > 0 THEN 'HTTP 404' END AS error
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1)
ON o_custkey = c_custkey""")
def organization_outcomes(spark, sf):
    return customer_outcomes(spark, sf)


def customer_outcomes(spark, sf):
    orgs = table(spark, sf, "customer").select(
        text("c_custkey").alias("handle"), F.when(~(F.col("c_acctbal") > 0), "HTTP 404").alias("error"),
        F.length("c_name").cast("bigint").alias("duration_ms"),
    )
    return registry.outcomes(orgs, items(spark, sf), orgs)


# --- first, last and batches -----------------------------------------------------------------------


@query("""SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def first_per_key(spark, sf):
    return keyed.first_per_key(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def last_per_key(spark, sf):
    return keyed.last_per_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("""SELECT event_id, changed, strftime(max(CASE WHEN changed THEN ts END) OVER w, '%Y-%m-%d %H:%M:%S.%f') AS last_changed FROM (
SELECT *, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> event_type, true) AS changed FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def carried_last_changed(spark, sf):
    """Change flag and time of last change over each user's events, worked out per sorted range of users and times."""
    checks = page_state.carry_last_changed(table(spark, sf, "events"), "user_id", "ts", "event_type", ["event_id"])
    return checks.select("event_id", "changed", F.date_format("last_changed", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_changed"))


@query("""SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 50 + 1 AS batch_no,
CAST(ceil(count(*) OVER () / 50.0::DOUBLE) AS BIGINT) AS batch_count FROM orders""")
def fixed_batches(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return keyed.assign_batches(rows, 50, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "batch_no", "batch_count")
