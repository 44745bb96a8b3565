"""Extraction over whole page, listing and document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.catalog.core import query
from gleanery.catalog.tables import LISTINGS, SIGNATURE, SIGNATURES, listings, parts_tagged, PARTS_TAGGED, table, text, with_ctes
from gleanery.functions import context, fingerprints, grading, markup, scalars
from gleanery.operators import discovery, items as item_ops, page_state

_JS_SPACE = scalars.WHITESPACE
_DOT = scalars.NOT_NEWLINE


@query(r"""SELECT page_id, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ' ') AS hrefs
FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS a FROM pages)""")
def attribute_values(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.array_join(markup.extract_attr("html", "href"), " ").alias("hrefs"))


@query(with_ctes(LISTINGS) + r"""
SELECT page_id, pos::INTEGER AS pos, a AS amount FROM (SELECT page_id, unnest(f) AS a, unnest(range(len(f))) AS pos FROM (
  SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '\$(\d+(?:,\d{3})*(?:\.\d{2})?)', 1), lambda a: CAST(replace(a, ',', '') AS DOUBLE)), lambda a: a > 0) AS f FROM listings))""")
def page_amounts(spark, sf):
    found = listings(spark, sf).select("page_id", F.posexplode_outer(markup.extract_amounts("html")).alias("pos", "amount"))
    return found.where("pos IS NOT NULL")


@query(with_ctes(LISTINGS) + r"""
SELECT page_id, regexp_extract(m, 'github\.com/([^/]+)/', 1) AS owner, regexp_extract(m, 'github\.com/[^/]+/([^/]+)/', 1) AS repo,
  CAST(regexp_extract(m, '(\d+)$', 1) AS BIGINT) AS number
FROM (SELECT page_id, unnest(regexp_extract_all(html, 'github\.com/[^/]+/[^/]+/issues/\d+')) AS m FROM listings)""")
def issue_references(spark, sf):
    found = listings(spark, sf).select("page_id", F.explode_outer(markup.extract_issues("html")).alias("_i"))
    return found.where("_i IS NOT NULL").select("page_id", "_i.*")


@query(rf"""SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, '<title>([^<]+)</title>', 1),
  lambda t: regexp_replace(t, '^{_JS_SPACE}+|{_JS_SPACE}+$', '', 'g')), lambda t: length(t) > 10 AND NOT contains(t, 'Nicht')), ' ; ') AS titles FROM pages""")
def page_titles(spark, sf):
    found = markup.extract_titles("html", site_name="Nicht")
    return table(spark, sf, "pages").select("page_id", F.array_join(found, " ; ").alias("titles"))


_RAW_TITLES = """(SELECT o_orderkey, ' [' || o_orderstatus || ']  ' || o_orderpriority || ' task · Site page' || CASE WHEN o_orderstatus = 'P' THEN ' | more text' ELSE '' END AS title FROM orders)"""


@query(rf"""SELECT o_orderkey, trim(regexp_replace(regexp_replace(regexp_replace(title, '^\s*\[.*?\]\s*', ''), '\s*·\s*Site.*$', ''), '\s*\|\s*.*$', '')) AS title FROM {_RAW_TITLES}""")
def clean_titles(spark, sf):
    tail = F.when(F.col("o_orderstatus") == "P", " | more text").otherwise("")
    raw = F.concat(F.lit(" ["), "o_orderstatus", F.lit("]  "), "o_orderpriority", F.lit(" task · Site page"), tail)
    return table(spark, sf, "orders").select("o_orderkey", markup.clean_title(raw, "Site").alias("title"))


_REPO_TAG_SQL = " ".join(
    f"|| CASE WHEN contains(lower(repo), '{k}') THEN [{', '.join(repr(t) for t in v)}] ELSE [] END" for k, v in grading.REPO_TAGS.items()
)
_TITLE_TAG_SQL = " ".join(f"|| CASE WHEN contains(lower(title), '{t}') THEN ['{t}'] ELSE [] END" for t in grading.TITLE_TERMS)
_TITLED = r"""
titled AS (
  SELECT page_id, m, regexp_extract(m, '/([^/]+)/issues/', 1) AS repo, regexp_extract(m, '>([^<]+)<', 1) AS title
  FROM (SELECT page_id, unnest(regexp_extract_all(html, 'github\.com/[^/]+/[^/]+/issues/\d+">[^<]+<')) AS m FROM listings)
)"""


def _titled(spark, sf):
    found = listings(spark, sf).select(
        "page_id", F.explode_outer(F.regexp_extract_all("html", F.lit(r'github\.com/[^/]+/[^/]+/issues/\d+">[^<]+<'), F.lit(0))).alias("m")
    ).where("m IS NOT NULL")
    return found.select("page_id", "m", F.regexp_extract("m", "/([^/]+)/issues/", 1).alias("repo"), F.regexp_extract("m", ">([^<]+)<", 1).alias("title"))


@query(with_ctes(LISTINGS, _TITLED) + f"""
SELECT page_id, m, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') AS tags
FROM (SELECT page_id, m, [lower(repo)] {_REPO_TAG_SQL} {_TITLE_TAG_SQL} AS a FROM titled)""")
def derived_tags(spark, sf):
    """Tags of every issue link from its repository name and title."""
    return _titled(spark, sf).select("page_id", "m", F.array_join(grading.derive_tags("title", "repo"), ",").alias("tags"))


_ANY = lambda terms: " OR ".join(f"contains(lower(title), '{t}')" for t in terms)
_DIFFICULTY = f"""CASE WHEN amount >= 2000 THEN 'expert' WHEN amount >= 1000 THEN 'advanced' WHEN amount >= 500 THEN 'intermediate'
WHEN {_ANY(grading.COMPLEX_TERMS)} THEN CASE WHEN amount >= 200 THEN 'advanced' ELSE 'intermediate' END
WHEN {_ANY(grading.SIMPLE_TERMS)} THEN 'beginner' WHEN amount >= 200 THEN 'intermediate' ELSE 'beginner' END"""


@query(f"""SELECT o_orderkey, {_DIFFICULTY} AS difficulty FROM (SELECT o_orderkey, round(o_totalprice) / 100 AS amount,
o_orderpriority || CASE o_orderstatus WHEN 'F' THEN ' minor fix' WHEN 'O' THEN ' security' ELSE ' plain' END AS title FROM orders)""")
def inferred_difficulty(spark, sf):
    suffix = F.when(F.col("o_orderstatus") == "F", " minor fix").when(F.col("o_orderstatus") == "O", " security").otherwise(" plain")
    amount = F.round("o_totalprice") / 100
    return table(spark, sf, "orders").select(
        "o_orderkey", grading.infer_difficulty(amount, F.concat("o_orderpriority", suffix)).alias("difficulty")
    )


def _markdown_sql(column: str, tags=("script", "style")) -> str:
    out = column
    step = lambda pattern, to, flags="gi": f"regexp_replace({out}, '{pattern}', {to}, '{flags}')"
    for tag in tags:
        out = step(rf"(?s)<{tag}\b.*?</{tag}>", "''")
    for level in range(1, 7):
        out = step(rf"<h{level}[^>]*>({_DOT}*?)</h{level}>", "'" + "#" * level + r" \1' || chr(10)")
    out = step(rf'<a[^>]*href="([^"]*)"[^>]*>({_DOT}*?)</a>', r"'[\2](\1)'")
    out = step(rf"<p[^>]*>({_DOT}*?)</p>", r"'\1' || chr(10) || chr(10)")
    out = step(rf"<br{_JS_SPACE}*/?>", "chr(10)")
    out = step(r"<[^>]+>", "''", "g")
    for entity, char in markup.ENTITIES:
        quoted = "''''" if char == "'" else f"'{char}'"
        out = f"replace({out}, '{entity}', {quoted})"
    out = step(r"\n{3,}", "chr(10) || chr(10)", "g")
    return step(rf"^{_JS_SPACE}+|{_JS_SPACE}+$", "''", "g")


@query(f"SELECT page_id, {_markdown_sql('html')} AS markdown FROM pages")
def page_markdown(spark, sf):
    return table(spark, sf, "pages").select("page_id", markup.html_to_markdown("html").alias("markdown"))


_MAIN_ONLY = ("script", "style", "nav", "footer", "aside")


@query(f"SELECT page_id, {_markdown_sql('html', _MAIN_ONLY)} AS markdown FROM pages")
def page_markdown_main_only(spark, sf):
    return table(spark, sf, "pages").select("page_id", markup.html_to_markdown("html", _MAIN_ONLY).alias("markdown"))


_CONTEXT = """
lined AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
hit AS (SELECT doc_id, lines, list_position(list_transform(lines, lambda l: contains(l, ' de ')), true) AS hit_at FROM lined)"""


@query(with_ctes(_CONTEXT) + """
SELECT doc_id, array_to_string(lines[greatest(1, hit_at - 5):hit_at + 4], chr(10)) AS context FROM hit WHERE hit_at > 0""")
def context_windows(spark, sf):
    """Lines around the first line with a phrase, over whole documents."""
    docs = table(spark, sf, "documents").select("doc_id", context.text_lines("text").alias("lines"))
    found = docs.select("doc_id", context.context_lines(F.col("lines"), F.lit(" de ")).alias("c"))
    return found.select("doc_id", F.array_join("c", "\n").alias("context")).where("context IS NOT NULL")


@query("SELECT doc_id, substr(text, 1, 200) AS head FROM documents")
def text_heads(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.substring("text", 1, 200).alias("head"))


_TECH_SQL = "list_filter([" + ", ".join(f"'{t}'" for t in context.CONTEXT_TERMS) + "], lambda t: contains(lower(joined), t))"
_MENTIONS = rf"""
marked AS (SELECT page_id, {_markdown_sql('html')} AS md FROM listings),
refs AS (
  SELECT page_id, md, m FROM (SELECT page_id, md, regexp_extract_all(md, 'github\.com/[^/]+/[^/]+/issues/\d+') AS ms FROM marked),
    unnest(list_distinct(ms)) AS t(m)
),
near AS (
  SELECT page_id, m, lines[greatest(1, hit_at - 5):hit_at + 4] AS ctx FROM (
    SELECT page_id, m, lines, list_position(list_transform(lines, lambda l: contains(l, m)), true) AS hit_at
    FROM (SELECT page_id, m, string_split(md, chr(10)) AS lines FROM refs))
),
read AS (SELECT page_id, m, array_to_string(ctx, ' ') AS joined,
  list_filter(ctx, lambda l: regexp_matches(l, '^#|^\*\*|^\[') AND length(l) > 10 AND length(l) < 100)[1] AS line FROM near)"""


@query(with_ctes(LISTINGS, _MENTIONS) + rf"""
SELECT page_id, m AS ref_url, trim(regexp_replace(regexp_replace(line, '^[#\*\[]+\s*', ''), '\]{_DOT}*$', '')) AS title,
  CAST(round(TRY_CAST(replace(nullif(regexp_extract(joined, '\$(\d+(?:,\d{{3}})*(?:\.\d{{2}})?)', 1), ''), ',', '') AS DOUBLE) * 100) AS BIGINT) AS cents,
  coalesce(array_to_string({_TECH_SQL}, ','), '') AS tech, substr(joined, 1, 200) AS context
FROM read""")
def text_mentions(spark, sf):
    """Issue references in listing markdown with the title, amount and terms around them."""
    pages = listings(spark, sf).select("page_id", markup.html_to_markdown("html").alias("text"))
    found = item_ops.text_items(pages)
    return found.select("page_id", "ref_url", "title", "cents", F.coalesce(F.array_join("tech", ","), F.lit("")).alias("tech"), "context")


@query(r"""SELECT p_partkey, CAST(1234 * p_partkey + 1 AS BIGINT) AS fixed,
CAST(regexp_extract(replace_once, '^\d+(\.\d+)?') AS DOUBLE)::BIGINT * 100 AS legacy FROM (
SELECT p_partkey, regexp_replace(format('{:,}', 1234567 + p_partkey), ',', '') AS replace_once FROM part)""".replace(
    "CAST(1234 * p_partkey + 1 AS BIGINT)", "CAST(1234567 + p_partkey AS BIGINT) * 100"))
def amount_comma_modes(spark, sf):
    """Context amounts with all commas dropped, and with only the first one dropped."""
    amount = F.concat(F.lit("pays $"), F.format_number(F.col("p_partkey") + 1234567, 0))
    lines = table(spark, sf, "part").select("p_partkey", F.array(amount).alias("lines"))
    return lines.select(
        "p_partkey", context.context_cents(F.col("lines")).alias("fixed"),
        context.context_cents(F.col("lines"), legacy_commas=True).alias("legacy"),
    )


# --- handles ---------------------------------------------------------------------------------------

_SITE = "example.com"


def _handles_sql(source: str, patterns, stop, fold: bool = True) -> str:
    found = " UNION ALL ".join(f"SELECT unnest(regexp_extract_all(html, '{p}', 1)) AS handle FROM {source}" for p in patterns)
    words = ", ".join(f"'{w}'" for w in stop)
    key = "lower(handle)" if fold else "handle"
    return f"SELECT DISTINCT handle FROM ({found}) WHERE length(handle) BETWEEN 2 AND 50 AND {key} NOT IN ({words})"


@query(_handles_sql("pages", discovery.link_patterns(_SITE), discovery.STOP_WORDS))
def page_handles(spark, sf):
    return discovery.extract_handles(table(spark, sf, "pages"), discovery.link_patterns(_SITE))


@query(with_ctes(LISTINGS) + _handles_sql("listings", discovery.link_patterns("listings.example", extended=True), discovery.STOP_WORDS).replace(
    "NOT IN (", "NOT IN (SELECT 'org' || s_suppkey FROM supplier UNION ALL SELECT unnest([").replace("'topics')", "'topics']))"))
def listing_handles_with_stop_table(spark, sf):
    """Handles of all listing pages, less a stop list held in a table."""
    words = F.explode(F.array(*[F.lit(w) for w in discovery.STOP_WORDS]))
    suppliers = table(spark, sf, "supplier").select(F.concat(F.lit("org"), text("s_suppkey")).alias("word"))
    stop = suppliers.unionByName(table(spark, sf, "region").select(words.alias("word")).distinct())
    return discovery.extract_handles(listings(spark, sf), discovery.link_patterns("listings.example", extended=True), stop)


@query(_handles_sql("(SELECT url || '/bounties' AS html FROM pages)", [r"example\.com/([a-zA-Z0-9_-]+)/"], ("bounties",), fold=False))
def url_path_handles(spark, sf):
    urls = table(spark, sf, "pages").select(F.concat("url", F.lit("/bounties")).alias("html"))
    return discovery.extract_handles(urls, [r"example\.com/([a-zA-Z0-9_-]+)/"], ("bounties",), fold=False)


@query(_handles_sql("(SELECT 'https://listings.example/' || o_custkey || '/bounties?page=' || o_orderkey AS html FROM orders)", [discovery.listing_pattern("listings.example")], ("bounties",)))
def listing_address_handles(spark, sf):
    """Handles in the addresses of listing pages."""
    urls = listings(spark, sf).select(F.col("url").alias("html"))
    return discovery.extract_handles(urls, [discovery.listing_pattern("listings.example")], ("bounties",))


# --- page facts ------------------------------------------------------------------------------------

_TERMS = ("reward", "que ", " the ", "sch", "attion", "de ")
_COUNTS = (r"(?i)track\((\d+)\)", r"(?i)page (\d+)")
_HITS = " + ".join(f"CAST(contains(lower(html), '{t}') AS INTEGER)" for t in _TERMS)


@query(f"SELECT page_id, {_HITS} >= 3 AS is_listing FROM pages")
def listing_page_check(spark, sf):
    return table(spark, sf, "pages").select("page_id", markup.is_listing_page("html", _TERMS).alias("is_listing"))


@query(r"""SELECT doc_id, coalesce(TRY_CAST(nullif(regexp_extract(text, '(?i)(\d+)\s*bounties?', 1), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(text, '(?i)(\d+)\s*open', 1), '') AS BIGINT),
TRY_CAST(nullif(regexp_extract(text, '(?i)(\d+)\s*active', 1), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(text, '(?i)(\d+)\s*tasks?', 1), '') AS BIGINT), 0) AS item_count
FROM (SELECT doc_id, text || CASE lang WHEN 'en' THEN n_chars || ' open' WHEN 'fr' THEN doc_id || ' Tasks and ' || n_chars || '  bounty, 3 BOUNTIES' ELSE '' END AS text FROM documents)""")
def item_counts(spark, sf):
    tail = (
        F.when(F.col("lang") == "en", F.concat(text("n_chars"), F.lit(" open")))
        .when(F.col("lang") == "fr", F.concat(text("doc_id"), F.lit(" Tasks and "), text("n_chars"), F.lit("  bounty, 3 BOUNTIES")))
        .otherwise("")
    )
    return table(spark, sf, "documents").select("doc_id", markup.item_count(F.concat("text", tail)).alias("item_count"))


_NAME = rf"""regexp_replace(coalesce(nullif(regexp_extract(html, '(?i)<title>([^-]+)', 1), ''), nullif(regexp_extract(html, '(?i)<h1[^>]*>([^<]+)', 1), ''),
nullif(regexp_extract(html, '(?i)organization:{_JS_SPACE}*([^\n]+)', 1), '')), '^{_JS_SPACE}+|{_JS_SPACE}+$', '', 'g')"""


@query(f"SELECT page_id, {_NAME} AS name FROM pages")
def page_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", markup.display_name("html").alias("name"))


@query(with_ctes(SIGNATURES) + "SELECT page_id, hash, item_estimate FROM signed")
def page_fingerprints(spark, sf):
    signed = page_state.page_signatures(table(spark, sf, "pages"), SIGNATURE, marker="<nav>")
    return signed.select("page_id", "hash", "item_estimate")


@query(r"""SELECT page_id, substr(sha256(regexp_replace(html, 'track\(\d+\)', '', 'g')), 1, 16) AS hash FROM pages""")
def page_content_fingerprints(spark, sf):
    """Hash of the text itself, without a counter that changes on each visit."""
    return table(spark, sf, "pages").select(
        "page_id", fingerprints.fingerprint("html", ignore=[r"track\(\d+\)"], mode="content").alias("hash")
    )


@query(r"""SELECT page_id, CASE WHEN len(regexp_extract_all(html, '<li>')) > 0 THEN len(regexp_extract_all(html, '<li>')) ELSE len(regexp_extract_all(html, '\$\d+')) END AS items FROM pages""")
def item_estimates(spark, sf):
    return table(spark, sf, "pages").select("page_id", fingerprints.estimate_items("html", marker="<li>").alias("items"))


@query(rf"""SELECT doc_id, text || chr(10) || chr(10) || source || chr(10) || chr(10) || lang AS combined FROM documents""")
def combined_texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", scalars.combine_text("text", "source", "lang").alias("combined"))


@query(with_ctes(LISTINGS) + r"""
SELECT page_id, array_to_string(CASE WHEN len(i) > 0 THEN i ELSE a END, ' ') AS links FROM (
  SELECT page_id, a, list_filter(a, lambda l: contains(l, '/issues/') OR contains(l, '/pull/')) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a\b[^>]*href="([^"]*)"', 1) AS a FROM
    (SELECT page_id, html FROM listings UNION ALL SELECT -1 - page_id, html FROM pages)))""")
def preferred_links(spark, sf):
    both = listings(spark, sf).select("page_id", "html").unionByName(
        table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("page_id"), "html")
    )
    return both.select("page_id", F.array_join(markup.prefer_issue_links(markup.extract_links("html")), " ").alias("links"))


@query(f"""SELECT CAST(page_id AS VARCHAR) AS handle, CASE WHEN url LIKE 'https:%' THEN 'Known ' || page_id ELSE coalesce(nullif({_NAME}, ''), CAST(page_id AS VARCHAR)) END AS display_name,
coalesce(TRY_CAST(nullif(regexp_extract(html, '(?i)track\\((\\d+)\\)', 1), '') AS BIGINT), 0) AS item_count,
({_HITS} >= 3) AND coalesce(TRY_CAST(nullif(regexp_extract(html, '(?i)track\\((\\d+)\\)', 1), '') AS BIGINT), 0) >= 5 AS active, true AS validated FROM pages""".replace("\\\\", "\\"))
def validated_organizations(spark, sf):
    """Discovered handles checked against their pages; unnamed ones take the page's name."""
    pages = table(spark, sf, "pages").withColumn("handle", text("page_id"))
    facts = discovery.page_facts(pages, _TERMS, count=markup.first_number("html", _COUNTS[:1]))
    named = F.when(F.startswith("url", F.lit("https:")), F.concat(F.lit("Known "), "handle")).otherwise(F.col("handle"))
    return discovery.validate_orgs(pages.select("handle", named.alias("display_name")), facts, 5)


@query(r"""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, strftime(ts, '%Y-%m-%d') AS day,
CAST(floor((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts)) / 1000.0::DOUBLE) AS BIGINT) AS age_ms FROM events""")
def time_formats(spark, sf):
    later = F.lit("2024-02-01 00:00:00").cast("timestamp")
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id", scalars.iso_millis(ts).alias("iso"), F.date_format(ts, "yyyy-MM-dd").alias("day"),
        scalars.elapsed_ms("ts", later).alias("age_ms"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS BIGINT) AS low, CAST(ceil(l_extendedprice) AS BIGINT) AS high,
CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_extendedprice * (1 - l_discount) + l_quantity * l_discount AS blend FROM lineitem""")
def number_helpers(spark, sf):
    p, d = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.floor(p).cast("bigint").alias("low"), F.ceil(p).cast("bigint").alias("high"),
        scalars.usd_to_cents(p).alias("cents"), (p * (1 - d) + F.col("l_quantity") * d).alias("blend"),
    )


@query(with_ctes(PARTS_TAGGED) + """
SELECT id, array_to_string(tags[1:2], '/') AS first_two, len(list_filter(tags, lambda t: contains(t, 'o'))) > 0 AS some_o,
  array_to_string(list_concat(tags, [handle]), ',') AS flat, handle || '=' || title AS entry FROM parts_tagged""")
def collection_helpers(spark, sf):
    entries = F.map_entries(F.create_map("handle", "title"))
    return parts_tagged(spark, sf).select(
        "id", F.array_join(F.slice("tags", 1, 2), "/").alias("first_two"),
        F.exists("tags", lambda t: F.contains(t, F.lit("o"))).alias("some_o"),
        F.array_join(F.flatten(F.array(F.col("tags"), F.array("handle"))), ",").alias("flat"),
        F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("entry"),
    )


@query(r"""SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host, nullif(regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1), '') AS handle FROM pages""")
def url_parts(spark, sf):
    return table(spark, sf, "pages").select("page_id", scalars.url_host("url").alias("host"), scalars.url_handle("url").alias("handle"))
