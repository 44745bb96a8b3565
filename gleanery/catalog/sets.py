"""Unions, array sets and published change lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.catalog.core import query
from gleanery.catalog.joins import _CHECK_CTES, _checked
from gleanery.catalog.tables import SIGNATURES, SNAPSHOTS, line_items, order_heads, table, text, with_ctes
from gleanery.operators import changes, discovery, registry
from gleanery.sources import writers


@query("""SELECT handle, min_by(method, rank) AS discovery_method FROM (
SELECT CAST(c_custkey AS VARCHAR) AS handle, 0 AS rank, 'existing' AS method FROM customer
UNION ALL SELECT CAST(o_custkey * 2 AS VARCHAR), 1, 'orders' FROM orders
UNION ALL SELECT CAST(l_partkey AS VARCHAR), 2, 'lines' FROM lineitem) GROUP BY handle""")
def merged_handles(spark, sf):
    handles = lambda name, c: table(spark, sf, name).select(text(c).alias("handle"))
    return discovery.merge_handles(
        ("existing", handles("customer", F.col("c_custkey"))), ("orders", handles("orders", F.col("o_custkey") * 2)),
        ("lines", handles("lineitem", F.col("l_partkey"))),
    )


@query("""SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT p_partkey, p_name FROM part""")
def appended_results(spark, sf):
    rows = lambda name, k, n: table(spark, sf, name).select(F.col(k).alias("key"), F.col(n).alias("name"))
    return registry.append_results(rows("customer", "c_custkey", "c_name"), rows("supplier", "s_suppkey", "s_name"), rows("part", "p_partkey", "p_name"))


@query("""SELECT doc_id, array_to_string(list_filter(ws, lambda w, i: list_position(ws, w) = i), ' ') AS distinct_words
FROM (SELECT doc_id, string_split(lower(text), ' ') AS ws FROM documents)""")
def distinct_in_row(spark, sf):
    words = F.array_distinct(F.split(F.lower("text"), " "))
    return table(spark, sf, "documents").select("doc_id", F.array_join(words, " ").alias("distinct_words"))


@query(with_ctes(SNAPSHOTS) + """
SELECT c.id, array_to_string(list_filter(c.tags, lambda t, i: list_position(c.tags, t) = i AND NOT list_contains(p.tags, t)), ',') AS added,
  array_to_string(list_filter(p.tags, lambda t, i: list_position(p.tags, t) = i AND NOT list_contains(c.tags, t)), ',') AS removed
FROM line_items c JOIN order_heads p USING (id)""")
def tag_differences(spark, sf):
    prev = order_heads(spark, sf).select("id", F.col("tags").alias("old_tags"))
    cur = line_items(spark, sf).select("id", F.col("tags").alias("new_tags"))
    return cur.join(prev, "id").select(
        "id", F.array_join(F.array_except("new_tags", "old_tags"), ",").alias("added"),
        F.array_join(F.array_except("old_tags", "new_tags"), ",").alias("removed"),
    )


@query("""SELECT 'added' AS change_type, o_custkey AS key FROM (SELECT o_custkey FROM orders EXCEPT SELECT l_partkey FROM lineitem)
UNION ALL SELECT 'removed', l_partkey FROM (SELECT l_partkey FROM lineitem EXCEPT SELECT o_custkey FROM orders)""")
def key_differences(spark, sf):
    keys = lambda name, c: table(spark, sf, name).select(F.col(c).alias("key"))
    return changes.diff_keys(keys("lineitem", "l_partkey"), keys("orders", "o_custkey"), "key")


@query(with_ctes(SIGNATURES, _CHECK_CTES) + """
SELECT b AS batch_no, string_agg(handle, ',' ORDER BY handle) AS handles, count(*) AS handle_count
FROM (SELECT handle, (row_number() OVER (ORDER BY handle) - 1) // 40 + 1 AS b FROM checked WHERE outcome = 'changed') GROUP BY b""")
def changed_comma_lists(spark, sf):
    """Changed handles as comma lists of at most forty."""
    return writers.comma_batches(_checked(spark, sf).where("outcome = 'changed'"), 40)
