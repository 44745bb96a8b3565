"""Shape of physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from gleanery.catalog import QUERIES
from gleanery.catalog.tables import items
from gleanery.operators import changes, stats

SKIP = {"stream_page_changes", "stream_changes_since_state"}  # run a stream with a Python state processor


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "Python" not in text and "ArrowEval" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_k_does_not_sort_all(spark, sf):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_tags"](spark, sf))
    assert "TakeOrderedAndProject" in plan(QUERIES["top_organizations"](spark, sf))


def test_scans_read_only_what_they_need(spark, sf):
    text = plan(stats.totals(items(spark, sf)))
    assert "o_orderpriority" not in text and "o_orderstatus" not in text
    text = plan(QUERIES["registry_active"](spark, sf))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,0.0)]" in text


def test_html_is_not_shuffled(spark, sf):
    from gleanery.catalog.joins import _checked

    text = plan(_checked(spark, sf))
    for line in re.findall(r"Exchange hashpartitioning\([^)]*\)", text):
        assert "html" not in line
    assert text.count("Exchange") <= 6


def test_hot_values_are_merged_before_the_exchange(spark):
    df = spark.range(0, 100000, 1, 4).select(F.lit(1.0).alias("amount_usd"), F.lit("h").alias("handle"))
    text = plan(stats.median_value(df))
    assert "partial_count" in text


@pytest.fixture
def small_limits(spark):
    """Limits small enough that test data counts as large and skewed."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=60000):
    """A third of the rows share one key; many map tasks, so their blocks can be divided."""
    key = F.when(F.col("n") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("n").cast("string")))
    return spark.range(0, n, 1, 32).select(
        F.col("id").alias("n")
    ).select(key.alias("id"), F.lit("org").alias("handle"), F.sha2(F.col("n").cast("string"), 256).alias("title"), (F.col("n") / 1.0).alias("amount_usd"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_current_id_is_split_in_the_diff(spark, small_limits):
    cur = hot_rows(spark)
    prev = hot_rows(spark, 300).withColumn("amount_usd", F.col("amount_usd") + 1)
    diff = changes.diff_snapshots(prev, cur, order=["amount_usd"], fields=("title", "amount_usd"), tags=None)
    text = final_plan(diff)
    assert "skew=true" in text
    counts = {r["change_type"]: r["count"] for r in diff.groupBy("change_type").count().collect()}
    assert counts == {"added": 40000 - 200, "updated": 20000 + 200}


def test_hot_key_is_known_by_its_share(spark):
    assert changes.has_hot_key(hot_rows(spark), "id")
    assert not changes.has_hot_key(hot_rows(spark, 3000), "id")  # a third of the rows, but few
    many = spark.range(0, 2000000, 1, 8).select(F.when(F.col("id") < 1989000, F.col("id")).otherwise(-1).alias("id"))
    assert not changes.has_hot_key(many, "id")  # 11,000 rows, but less than a hundredth, also with what the sketch may be off
    assert changes.has_hot_key(many.select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("id")), "id")  # keys that are null are one key
    assert not changes.has_hot_key(many.limit(0), "id")


def test_hot_source_rows_are_split(spark, small_limits):
    from gleanery.operators import keyed

    df = hot_rows(spark).withColumn("source", F.when(F.col("amount_usd") < 30000, 1).otherwise(2))
    found = keyed.first_source(df, ["id"], "source")
    assert "skew=true" in final_plan(found)
    assert found.count() == 10000 + 40000


def test_hot_organization_is_spread_over_parts(spark, small_limits):
    from gleanery.operators import keyed

    parts = keyed.in_parts(hot_rows(spark).select(F.col("id").alias("handle"), "title"), ["handle"], 500)
    hot = parts.where("handle = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) >= 8 and max(r["count"] for r in hot) < 6000 and sum(r["count"] for r in hot) == 20000


def test_diff_without_order_splits_a_hot_key(spark, small_limits):
    rows = spark.range(0, 20000, 1, 8).select(F.lit("hot").alias("id"), F.col("id").cast("double").alias("amount_usd"), F.lit("x").alias("title"))
    diff = changes.diff_snapshots(rows, rows.withColumn("amount_usd", F.col("amount_usd") + 0.5), fields=("title", "amount_usd"), tags=None)
    tasks = diff.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 20000


@pytest.mark.parametrize("most", [100, 0])
def test_refresh_reads_the_changed_pages_without_moving_html(spark, tmp_path, most):
    """The handles meet the pages below the extraction; beyond the limit they go to the buckets of the pages."""
    from gleanery.operators import items as item_ops, page_state
    from gleanery.sources import writers

    schema = "handle STRING, html STRING"
    rows = [(f"h{i}", f"<p>github.com/o/r/issues/{i}</p>") for i in range(50)]
    pages = writers.land_pages(spark.createDataFrame(rows, schema), f"pages_by_handle_{most}", 4, str(tmp_path / "pages"))
    handles = spark.createDataFrame([("h3",), ("h7",), ("none",)], "handle STRING")
    found = item_ops.best_source_rows(page_state.pages_of(pages, handles, most))
    text = plan(found)
    below = text[text.index("Generate"):]
    assert "LeftSemi" in below and ("BroadcastHashJoin" if most else "ShuffledHashJoin") in below
    scan = below[below.index("LeftSemi"):]
    assert "Exchange" not in scan[: scan.index("FileScan")]  # the pages are the left side, and come straight from their files
    assert sorted(r["number"] for r in found.collect()) == [3, 7]


def test_one_hot_host_is_cut_by_ranges(spark, small_limits):
    from gleanery.operators import page_state

    rows = spark.range(0, 20000, 1, 8).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("at"), (F.col("id") % 7 > 3).cast("string").alias("h"), "id"
    )
    checks = page_state.carry_last_changed(rows, "k", "at", "h", ["id"])
    tasks = checks.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 20000


def test_pages_are_extracted_before_any_join(spark, small_limits, tmp_path):
    from gleanery.plans import runs

    schema = "handle STRING, html STRING"
    spark.createDataFrame([("a", "<p>github.com/o/r/issues/1</p>")], schema).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.schema(schema).parquet(str(tmp_path / "pages"))
    orgs = spark.sql("SELECT 'a' handle, 'A' display_name, '' description, array('x') org_tech")
    listing = spark.sql(
        "SELECT 'b' handle, '1' id, 'active' status, 5L amount, 'USD' currency, 'o' repo_owner, 'r' repo_name, "
        "now() created_at, now() updated_at, CAST(NULL AS STRUCT<number: BIGINT, title: STRING, body: STRING, "
        "html_url: STRING, user: STRUCT<id: BIGINT, login: STRING, avatar_url: STRING, html_url: STRING>>) issue"
    )
    text = plan(runs.collect_items(orgs, pages, F.lit("2025-01-01").cast("timestamp"), listing=listing))
    # Plans print from the top: the join comes first, and below the extraction there is only the scan.
    below = text[text.index("Generate posexplode"):]
    below = below[: below.index("FileScan")]
    assert text.index("LeftAnti") < text.index("Generate posexplode")
    assert "html" in below and "Exchange" not in below and "Join" not in below
