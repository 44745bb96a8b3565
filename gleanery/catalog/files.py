"""Round trips through files: what a writer lands, its reader gives back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleanery.catalog.aggregates import customer_outcomes
from gleanery.catalog.core import query
from gleanery.catalog.rows import listing_bodies
from gleanery.catalog.tables import ITEMS, as_of, items, table, text, with_ctes
from gleanery.operators import discovery, keyed, stats
from gleanery.plans import runs
from gleanery.sources import readers, writers


def _folder(spark, name):
    """A new folder beside the checkpoints, which all executors reach."""
    return f"{keyed.checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _flat(spark, sf):
    return items(spark, sf).select("handle", "display_name", "id", "title", "amount_usd", "status")


@query("""SELECT lower(n_name) AS handle, n_name AS display_name, 'https://listings.example/' || lower(n_name) AS url, n_regionkey % 2 = 0 AS active,
CAST(900 * (n_nationkey + 1) AS BIGINT) AS scrape_interval FROM nation""")
def registry_through_documents(spark, sf):
    """A registry document per region, written and read back."""
    row = F.struct(
        F.lower("n_name").alias("handle"), F.col("n_name").alias("display_name"), F.concat(F.lit("https://listings.example/"), F.lower("n_name")).alias("url"),
        (F.col("n_regionkey") % 2 == 0).alias("active"), ((F.col("n_nationkey") + 1) * 900).alias("scrape_interval"),
    )
    documents = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.collect_list(row).alias("organizations"))
    path = _folder(spark, "registry")
    body = F.to_json(F.struct(F.lit("1.0").alias("version"), "organizations"))
    documents.select("n_regionkey", body.alias("value")).write.partitionBy("n_regionkey").text(path)
    found = readers.read_registry(spark, f"{path}/*")
    return found.select("handle", "display_name", "url", "active", "scrape_interval")


@query("SELECT lower(n_name) AS handle, true AS active FROM nation")
def registry_default(spark, sf):
    """Without a registry file the default rows count."""
    default = table(spark, sf, "nation").select(F.lower("n_name").alias("handle"), F.lit(True).alias("active"))
    return readers.read_registry(spark, _folder(spark, "nothing"), default)


@query("""SELECT 'org' || o_custkey AS owner, 'repo' AS repo, o_orderkey AS number, o_orderpriority AS title, 'user' || o_custkey AS login,
'https://github.com/org' || o_custkey || '/repo/issues/' || o_orderkey AS html_url FROM orders""")
def issues_through_files(spark, sf):
    """Landed issue records, one JSON object per line."""
    owner = F.concat(F.lit("org"), text("o_custkey"))
    user = F.struct(F.concat(F.lit("user"), text("o_custkey")).alias("login"), F.col("o_custkey").alias("id"))
    link = F.concat(F.lit("https://github.com/"), owner, F.lit("/repo/issues/"), text("o_orderkey"))
    path = _folder(spark, "issues")
    table(spark, sf, "orders").select(
        owner.alias("owner"), F.lit("repo").alias("repo"), F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("title"),
        F.lit("").alias("body"), link.alias("html_url"), user.alias("user"),
    ).write.json(path)
    found = readers.read_issues(spark, path)
    return found.select("owner", "repo", "number", "title", F.try_variant_get("user", "$.login", "string").alias("login"), "html_url")


@query(with_ctes(ITEMS) + "SELECT d AS day, handle, id, title, amount_usd FROM items, (VALUES ('2001-09-01'), ('2001-09-02')) AS days(d)")
def index_through_files(spark, sf):
    """The index of two days, each organization's items nested in bounded parts, written and read back."""
    path = _folder(spark, "index")
    nested = stats.nested_by_org(_flat(spark, sf), part_size=5)
    for day in ("2001-09-01", "2001-09-02"):
        writers.write_index(nested, path, F.lit(day).cast("date"))
    found = readers.read_index_rows(spark, path)
    return found.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("day"), "handle", "id", "title", "amount_usd")


@query(with_ctes(ITEMS) + """SELECT '2001-09-01' AS day, id, 'first' AS title FROM items
UNION ALL SELECT '2001-09-02', id, 'second' FROM items WHERE status = 'O'""")
def archived_items(spark, sf):
    """A dated archive: a day that is there is skipped, another one is replaced."""
    path = _folder(spark, "archive")
    first = _flat(spark, sf).select("id", F.lit("first").alias("title"), "status")
    second = first.withColumn("title", F.lit("second")).where("status = 'O'")
    one, two = (F.lit(d).cast("date") for d in ("2001-09-01", "2001-09-02"))
    writers.archive(first, path, one, "skip")
    writers.archive(second, path, one, "skip")
    writers.archive(first, path, two)
    writers.archive(second, path, two)
    found = spark.read.schema("id STRING, title STRING, status STRING, snapshot_date DATE").parquet(path)
    return found.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("day"), "id", "title")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS handle, CASE WHEN c_custkey % 10 = 3 THEN 'moved' ELSE c_name END AS hash, c_custkey AS item_estimate
FROM customer WHERE c_custkey % 10 <> 7""")
def state_through_versions(spark, sf):
    """State written as a full copy and two versions of what differs: some handles moved, some are gone, one came back."""
    path = _folder(spark, "state")
    key = F.col("c_custkey")
    blank = F.lit("u")
    state = table(spark, sf, "customer").select(
        text("c_custkey").alias("handle"), blank.alias("url"), F.col("c_name").alias("hash"), as_of().alias("last_checked"), as_of().alias("last_changed"), key.alias("item_estimate")
    )
    kind = F.col("item_estimate") % 10
    writers.write_state(state, path)
    writers.write_state(state.where(~kind.isin(7, 9)), path)
    writers.write_state(state.where(kind != 7).withColumn("hash", F.when(kind == 3, "moved").otherwise(F.col("hash"))), path)
    return writers.read_state(spark, path).select("handle", "hash", "item_estimate")


@query(with_ctes(ITEMS) + """SELECT 'items' AS name, count(*) AS row_count FROM items UNION ALL SELECT 'organizations', count(*) FROM customer
UNION ALL SELECT 'totals', 1 UNION ALL SELECT 'metadata', 1 UNION ALL SELECT 'top_organizations', least(10, count(DISTINCT handle)) FROM items
UNION ALL SELECT 'total_items', count(*) FROM items WHERE handle IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)""")
def published_snapshot(spark, sf):
    """A whole snapshot published as one version, twice, and read back: the rows of its tables, and the items that its totals count."""
    path = _folder(spark, "snapshot")
    snapshot = runs.build_snapshot(items(spark, sf), customer_outcomes(spark, sf), as_of())
    tables = {n: t for n, t in snapshot.tables(full=False).items() if n != "stats"}
    writers.publish_snapshot(tables, path)
    writers.publish_snapshot(tables, path, changes=tables["items"])
    read = lambda name: writers.read_snapshot(spark, path, name)
    parts = [read(n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("name"), "row_count") for n in tables]
    parts.append(read("totals").select(F.lit("total_items").alias("name"), F.col("total_items").alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""SELECT event_type AS component, strftime(ts, '%Y-%m-%d') AS day, count(*) AS entries, CAST(sum(user_id) AS BIGINT) AS duration_ms FROM events GROUP BY 1, 2""")
def run_log_through_files(spark, sf):
    """Log entries appended under component and day, in two batches, and read back."""
    path = _folder(spark, "log")
    entries = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit("info").alias("level"), F.lit("m").alias("message"), text("user_id").alias("organization"),
        F.col("user_id").cast("bigint").alias("duration_ms"), F.col("event_type").alias("component"),
    )
    for part in (F.col("level") == "info", F.col("level") != "info"):
        writers.append_run_log(entries.where(part), path)
    log = readers.read_run_log(spark, path)
    found = log.groupBy("component", F.date_format("log_date", "yyyy-MM-dd").alias("day"))
    return found.agg(F.count("*").alias("entries"), F.sum("duration_ms").alias("duration_ms"))


# --- documents, one per line -----------------------------------------------------------------------


def _landed(bodies, spark, name):
    path = _folder(spark, name)
    bodies.select("body").write.text(path)
    return path


@query("""SELECT 'i' || o_orderkey AS id, CASE WHEN o_orderstatus <> 'F' THEN 'active' ELSE 'done' END AS status, CAST(round(o_totalprice) AS BIGINT) AS amount,
'org' AS repo_owner, o_orderkey AS number FROM orders""")
def listing_through_files(spark, sf):
    """Landed listing bodies."""
    found = readers.read_listing(spark, _landed(listing_bodies(spark, sf), spark, "listing"), lines=True)
    return found.select("id", "status", "amount", "repo_owner", F.col("issue.number").alias("number"))


@query("SELECT CAST(page_id AS VARCHAR) AS handle, url, md5(html) AS hash FROM pages")
def state_document_through_files(spark, sf):
    """Landed page-state documents, keyed by handle."""
    entry = F.struct("url", F.md5("html").alias("hash"), F.length("html").alias("bounty_count_estimate"))
    bodies = table(spark, sf, "pages").select(F.to_json(F.struct(F.create_map(text("page_id"), entry).alias("organizations"))).alias("body"))
    return readers.read_state_document(spark, _landed(bodies, spark, "state"), lines=True).select("handle", "url", "hash")


@query(with_ctes(ITEMS) + """SELECT handle, min(display_name) AS display_name, count(*) AS bounty_count FROM items GROUP BY handle""")
def index_organizations_through_files(spark, sf):
    """Organizations of landed index documents, which are keyed by handle."""
    rows = stats.rollup_by_org(_flat(spark, sf))
    org = F.struct("display_name", F.col("item_count").alias("bounty_count"), "total_value_usd")
    bodies = rows.select(F.to_json(F.struct(F.create_map("handle", org).alias("organizations"))).alias("body"))
    return readers.read_index_orgs(spark, _landed(bodies, spark, "index"), lines=True).select("handle", "display_name", "bounty_count")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS handle, CASE WHEN c_custkey % 7 = 0 THEN 'error' WHEN c_acctbal > 0 THEN 'valid' ELSE 'invalid' END AS outcome FROM customer""")
def probes_through_files(spark, sf):
    """Candidates classified by landed probe rows."""
    path = _folder(spark, "probes")
    customers = table(spark, sf, "customer").select(text("c_custkey").alias("handle"), "c_custkey", "c_acctbal")
    customers.select(
        "handle", F.when(F.col("c_acctbal") > 0, 200).otherwise(404).alias("status"), F.when(F.col("c_custkey") % 7 == 0, "timeout").alias("error")
    ).write.json(path)
    return discovery.classify_candidates(customers.select("handle"), readers.read_probes(spark, path))
