"""Streams and their batch twins, refresh, due selection and data checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleanery.catalog.core import query
from gleanery.catalog.rows import state_pages
from gleanery.catalog.tables import SIGNATURE, SIGNATURES, SNAPSHOTS, URL_TEMPLATE, as_of, line_items, order_heads, table, text, with_ctes
from gleanery.functions.scalars import url_host
from gleanery.operators import changes, keyed, page_state, quality
from gleanery.plans import runs
from gleanery.sources import readers, writers
from gleanery.streaming import change_batches, page_changes

_HOST_CHANGES = with_ctes(SIGNATURES) + r""",
checks AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS handle, page_id, hash FROM signed),
moved AS (SELECT *, lag(hash) OVER (PARTITION BY handle ORDER BY page_id) AS before FROM checks)
SELECT handle, page_id AS checked_at, hash FROM moved WHERE before IS NULL OR before <> hash"""


def _at(page_id):
    return F.timestamp_seconds(page_id)


def _streamed(spark, sf, **options):
    """(handle, checked_at, hash) from a stateful stream over the page files, run to its end."""
    folder = f"{keyed.checkpoint_dir(spark)}/page-changes-{uuid.uuid4().hex}"
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, page_changes.STATE_STORE)
    try:
        pages = readers.stream_pages(spark, f"{sf}/page[s].parquet").select(
            url_host("url").alias("handle"), _at("page_id").alias("checked_at"), "html"
        )
        run = (
            page_changes.stream_page_changes(pages, SIGNATURE, **options).writeStream.format("parquet")
            .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
        )
        run.awaitTermination()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    found = spark.read.schema(page_changes.OUTPUT).parquet(f"{folder}/out")
    return found.select("handle", F.unix_seconds("checked_at").alias("checked_at"), "hash")


def _host_checks(spark, sf):
    pages = table(spark, sf, "pages").select(url_host("url").alias("handle"), _at("page_id").alias("checked_at"), "html")
    return page_state.page_signatures(pages, SIGNATURE)


@query(_HOST_CHANGES)
def stream_page_changes(spark, sf):
    """Page changes per host, found by a stateful stream over the page files."""
    return _streamed(spark, sf)


@query(_HOST_CHANGES.replace("WHERE before IS NULL", "WHERE page_id > (SELECT max(page_id) // 2 FROM pages) AND (before IS NULL") + ")")
def stream_changes_since_state(spark, sf):
    """The same stream begun from stored state, which knows each host's last check in the first half: only later changes come out."""
    checks = page_state.carry_last_changed(_host_checks(spark, sf), "handle", "checked_at", "hash", ["hash", "item_estimate"])
    half = checks.agg(F.unix_seconds(F.max("checked_at"))).first()[0] or 0
    known = checks.where(F.unix_seconds("checked_at") <= half // 2)
    last = page_state.latest_signatures(known, ["checked_at"])
    state = last.select("handle", F.lit(None).cast("string").alias("url"), "hash", F.col("checked_at").alias("last_checked"), "last_changed", "item_estimate")
    path = f"{keyed.checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
    writers.write_state(state, path)
    return _streamed(spark, sf, state=writers.read_state(spark, path))


@query(_HOST_CHANGES)
def batch_page_changes(spark, sf):
    """The same changes from the whole history in one batch."""
    found = page_changes.batch_page_changes(_host_checks(spark, sf))
    return found.select("handle", F.unix_seconds("checked_at").alias("checked_at"), "hash")


_WINDOWS = """(SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M') AS window_start, CAST(user_id AS VARCHAR) AS handle, count(*) AS events
FROM events GROUP BY 1, 2)"""


def _changes(spark, sf):
    events = table(spark, sf, "events").select(text("user_id").alias("handle"), F.col("ts").cast("timestamp").alias("at"))
    return change_batches.changes_per_window(events, "1 hour")


def _minute(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm")


@query(f"SELECT window_start, handle, events FROM {_WINDOWS}")
def changes_per_window(spark, sf):
    """Changed handles per hour, each once."""
    return _changes(spark, sf).select(_minute("window_start").alias("window_start"), "handle", "events")


@query(f"SELECT window_start, count(*) AS batch_size, CAST(sum(events) AS BIGINT) AS events FROM {_WINDOWS} GROUP BY 1")
def change_batch_sizes(spark, sf):
    return change_batches.batch_sizes(_changes(spark, sf)).select(_minute("window_start").alias("window_start"), "batch_size", "events")


@query(f"SELECT window_start, string_agg(handle, ',' ORDER BY handle) AS changed_orgs, count(*) AS batch_size FROM {_WINDOWS} GROUP BY 1")
def change_payloads(spark, sf):
    """Messages per hour; with so few handles each hour is one message."""
    sent = change_batches.change_payloads(_changes(spark, sf), 1_000_000)
    return sent.select(_minute("window_start").alias("window_start"), F.array_join("changed_orgs", ",").alias("changed_orgs"), "batch_size")


@query(f"""SELECT window_start, (place - 1) // 3 + 1 AS part_no, string_agg(handle, ',' ORDER BY handle) AS changed_orgs, count(*) AS batch_size
FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY handle) AS place FROM {_WINDOWS}) GROUP BY 1, 2""")
def change_payload_parts(spark, sf):
    """Messages of three handles each, the last of an hour with what is left."""
    sent = change_batches.change_payloads(_changes(spark, sf), 3)
    return sent.select(_minute("window_start").alias("window_start"), "part_no", F.array_join("changed_orgs", ",").alias("changed_orgs"), "batch_size")


@query(f"SELECT DISTINCT handle FROM {_WINDOWS} WHERE handle IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)")
def targets_of_changes(spark, sf):
    """Registered organizations among the handles that changed in any hour."""
    orgs = table(spark, sf, "customer").where("c_acctbal > 0").select(text("c_custkey").alias("handle"))
    return change_batches.targets_of(_changes(spark, sf), orgs).select("handle")


@query("""SELECT 'org' || user_id AS handle, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at, CAST(CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS VARCHAR) AS snapshot_id FROM events""".replace("\\\\", "\\"))
def parsed_webhooks(spark, sf):
    """Webhook bodies read from JSON, the handle from the watched URL."""
    body = F.to_json(F.struct(
        F.concat(F.lit("https://listings.example/org"), text("user_id"), F.lit("/bounties?status=open")).alias("watch_url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.get_json_object("props", "$.k").alias("snapshot_id"),
    ))
    found = readers.parse_webhooks(table(spark, sf, "events").select(body.alias("value")))
    return found.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


@query(with_ctes(SNAPSHOTS) + """, fresh_orgs AS (SELECT CAST(s_suppkey AS VARCHAR) AS handle FROM supplier WHERE s_acctbal > 0)
SELECT id, handle, amount_usd FROM line_items WHERE handle NOT IN (SELECT handle FROM fresh_orgs)
UNION ALL SELECT id, handle, amount_usd FROM order_heads WHERE handle IN (SELECT handle FROM fresh_orgs)""")
def refreshed_snapshot(spark, sf):
    """Items of changed organizations replaced, the rest kept."""
    changed = table(spark, sf, "supplier").where("s_acctbal > 0").select(text("s_suppkey").alias("handle"))
    keep = ["id", "handle", "amount_usd"]
    return changes.apply_changes(line_items(spark, sf).select(keep), order_heads(spark, sf).select(keep), changed)


@query("""SELECT CAST(o_custkey AS VARCHAR) AS handle, 'n' || o_orderkey AS id,
CASE WHEN o_custkey % 3 = 0 THEN 'before' WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE 'Issue #' || o_orderkey END AS title,
CASE WHEN o_custkey % 3 = 0 THEN 1.0::DOUBLE WHEN o_orderstatus = 'P' THEN 100.0::DOUBLE ELSE CAST(round(o_totalprice) AS BIGINT) / 100.0::DOUBLE END AS amount_usd,
CASE WHEN o_custkey % 3 = 0 THEN NULL WHEN o_custkey % 3 = 1 THEN 'updated' ELSE 'added' END AS change_type
FROM orders
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'gone' || c_custkey, 'before', 1.0::DOUBLE, NULL FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'gone' || c_custkey, NULL, NULL, 'removed' FROM customer WHERE c_custkey % 3 = 1 AND c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'gone' || c_custkey, 'before', 1.0::DOUBLE, NULL FROM customer WHERE c_custkey % 3 = 1 AND c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def refreshed_from_pages(spark, sf):
    """A targeted refresh that starts from the pages: customers, each with a page per order, in a table bucketed by handle.

    Every third customer's pages are as the stored state knows them, the next one's have changed, and the last one is new. Each item of
    the new snapshot comes with its change against the last one; removed items come without the rest.
    """
    name = f"landed_pages_{uuid.uuid4().hex}"
    pages = writers.land_pages(state_pages(spark, sf), name, 16, f"{keyed.checkpoint_dir(spark)}/{name}")
    kind = F.col("handle").cast("bigint") % 3
    known = page_state.handle_signatures(page_state.page_signatures(pages.select("handle", "html"), SIGNATURE)).where(kind < 2)
    state = known.select(
        "handle", F.lit("u").alias("url"), F.when(kind == 0, F.col("hash")).otherwise("other").alias("hash"), as_of().alias("last_checked"),
        as_of().alias("last_changed"), "item_estimate",
    )
    blank = F.lit(None).cast("string")
    orgs = table(spark, sf, "customer").select(
        text("c_custkey").alias("handle"), blank.alias("url"), blank.alias("display_name"), blank.alias("description"), F.lit(None).cast("array<string>").alias("org_tech")
    )
    before = F.lit("before").alias("title"), F.lit(1.0).alias("amount_usd"), F.lit("open").alias("status"), blank.alias("url")
    link = F.concat(F.lit("https://github.com/org"), text("o_custkey"), F.lit("/repo/issues/"), text("o_orderkey"))
    listed = table(spark, sf, "orders").select(text("o_custkey").alias("handle"), F.concat(F.lit("n"), text("o_orderkey")).alias("id"), *before[:3], link.alias("url")).where(kind < 2)
    gone = orgs.where(kind < 2).select("handle", F.concat(F.lit("gone"), "handle").alias("id"), *before)
    done = runs.refresh(orgs, pages, state, listed.unionByName(gone), as_of(), URL_TEMPLATE, patterns=SIGNATURE)
    changed = done.diff.select("id", "change_type", F.col("old.handle").alias("_handle"))
    found = done.snapshot.join(changed, "id", "full_outer")
    return found.select(F.coalesce("handle", "_handle").alias("handle"), "id", "title", "amount_usd", "change_type")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS handle FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS seen FROM orders GROUP BY 1) ON o_custkey = c_custkey
WHERE seen IS NULL OR seen + to_seconds(CASE c_mktsegment WHEN 'BUILDING' THEN 864000 ELSE 8640000 END) <= TIMESTAMP '2001-09-01 00:00:00'""")
def due_organizations(spark, sf):
    """Customers whose last order is longer ago than their interval, or who have none."""
    interval = F.when(F.col("c_mktsegment") == "BUILDING", 864000).otherwise(8640000).cast("bigint")
    orgs = table(spark, sf, "customer").select(text("c_custkey").alias("handle"), interval.alias("scrape_interval"))
    state = table(spark, sf, "orders").groupBy(text("o_custkey").alias("handle")).agg(F.max("o_orderdate").alias("last_checked"))
    return page_state.due(orgs, state, F.lit("2001-09-01 00:00:00").cast("timestamp_ntz")).select("handle")


# --- data checks -----------------------------------------------------------------------------------


@query("""SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS count FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 2""")
def domain_violations(spark, sf):
    domains = {"o_orderstatus": ("O", "F"), "o_orderpriority": ("1-URGENT", "2-HIGH")}
    return quality.check_domains(table(spark, sf, "orders"), domains)


@query(with_ctes(SNAPSHOTS) + """
SELECT unnest(['id', 'title', 'difficulty', 'status']) AS field, unnest([0, 0, gone, 0]) AS missing,
  unnest([100.0::DOUBLE, 100.0::DOUBLE, round((n - gone) * 100.0::DOUBLE / n, 2), 100.0::DOUBLE]) AS complete_percent
FROM (SELECT count(*) AS n, count_if(difficulty IS NULL)::BIGINT AS gone FROM line_items)""")
def field_completeness(spark, sf):
    return quality.check_required(line_items(spark, sf), ["id", "title", "difficulty", "status"])
