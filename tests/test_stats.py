"""Statistics on small known inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import percentiles, registry, stats

NOW = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "id STRING, handle STRING, amount_usd DOUBLE, tags ARRAY<STRING>, difficulty STRING, status STRING, created_at TIMESTAMP"
OUTCOMES = "handle STRING, success BOOLEAN, item_count BIGINT, total_value_usd DOUBLE, duration_ms BIGINT, error STRING"


def make(spark, *rows, handle="org"):
    data = []
    for i, (amount, tags, days) in enumerate(rows):
        data.append((f"b{i}", handle, float(amount), tags, "medium", "open", NOW - dt.timedelta(days=days)))
    return spark.createDataFrame(data, SCHEMA)


def report(spark, items, full=True, outcomes=()):
    orgs = spark.createDataFrame(list(outcomes), OUTCOMES)
    rows = stats.stats_report(items, orgs, F.lit(NOW), full=full).collect()
    return {(r["section"], r["key"]): r for r in rows}


def test_empty(spark):
    found = report(spark, spark.createDataFrame([], SCHEMA))
    summary = {k[1]: r["value"] for k, r in found.items() if k[0] == "summary"}
    assert summary == {
        "average_value": 0, "median_value": 0, "organizations_with_items": 0, "organizations_with_errors": 0, "total_tags": 0,
    }
    assert {k[0] for k in found} == {"summary", "value_distribution"}


def test_basic(spark):
    items = make(spark, (40, ["sql", "spark"], 1), (90, ["sql"], 2), (700, ["zig", "wasm", "sql"], 9), (18, ["perl"], 3))
    found = report(spark, items)
    assert found["summary", "average_value"]["value"] == 212
    assert found["summary", "median_value"]["value"] == 65
    assert found["summary", "total_tags"]["value"] == 5


def test_value_ranges(spark):
    items = make(spark, *[(a, [], 1) for a in (3, 49, 51, 101, 499, 999, 1001, 80_000)])
    assert [r["count"] for r in stats.value_histogram(items).collect()] == [2, 1, 1, 1, 1, 2]


def test_languages(spark):
    items = make(spark, (100, ["typescript"], 1), (200, ["typescript"], 1), (150, ["javascript", "react"], 1), (300, ["python"], 1))
    found = {r["tag"]: (r["count"], r["total_value_usd"]) for r in stats.language_counts(items).collect()}
    assert found == {"typescript": (2, 300), "javascript": (1, 150), "react": (1, 150), "python": (1, 300)}


def test_top_tags_ignore_case(spark):
    items = make(spark, (100, ["TypeScript", "a"], 1), (200, ["typescript", "b"], 1), (300, ["TYPESCRIPT"], 1))
    first = stats.top_tags(items).first()
    assert (first["tag"], first["count"], first["total_value_usd"]) == ("typescript", 3, 600)
    assert stats.distinct_tags(items).first()[0] == 3


def test_infinite_amounts_stay_infinite(spark):
    row = stats.value_distribution(make(spark, (5, [], 1), (float("inf"), [], 1))).first()
    assert row["max"] == float("inf") and row["min"] == 5


def test_ages(spark):
    items = make(spark, *[(1, [], d) for d in (3, 15, 60, 180, 400)])
    missing = make(spark, (1, [], 0)).withColumn("created_at", F.lit(None).cast("timestamp"))
    rows = stats.age_histogram(items.unionByName(missing), F.lit(NOW)).collect()
    assert [r["count"] for r in rows] == [1] * 5


@pytest.mark.parametrize("exact", [True, False])
def test_percentiles(spark, exact):
    items = make(spark, *[(a, [], 1) for a in (50, 100, 150, 200, 250, 300, 400, 500, 750, 1000)])
    row = stats.value_distribution(items, exact=exact).first().asDict()
    assert (row["min"], row["max"]) == (50, 1000)
    if exact:
        assert [row[f"percentile_{p}"] for p in (25, 75, 90, 95)] == pytest.approx([162.5, 475, 775, 887.5])


@pytest.mark.parametrize("values,median", [((100, 200, 300), 200), ((100, 200, 300, 400), 250), ((7,), 7)])
def test_median(spark, values, median):
    assert stats.median_value(make(spark, *[(v, [], 1) for v in values])).first()[0] == median


def test_percentiles_of_epoch_micros_and_few_values(spark):
    """Values that lie close together far from zero, and groups of one, two and equal values."""
    df = spark.range(30_000).select((F.col("id") % 7).alias("k"), (F.lit(1.7e15) + (F.col("id") * 7919 % 30_011)).cast("double").alias("v"))
    few = spark.createDataFrame([(100, 1.0), (101, 1.0), (101, 2.0), (102, 5.0), (102, 5.0), (102, 5.0), (None, 3.0)], "k BIGINT, v DOUBLE")
    df, points = df.unionByName(few), [0.0, 0.001, 0.25, 0.5, 0.9999, 1.0]
    got = {(r["k"], r["point"]): r["percentile"] for r in percentiles.exact_percentiles(df, "v", points, ["k"], accuracy=50).collect()}
    for row in df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in points])).alias("p")).collect():
        for p, value in zip(points, row["p"]):
            assert got[row["k"], p] == pytest.approx(value)
    whole = {r["point"]: r["percentile"] for r in percentiles.exact_percentiles(df, "v", points, accuracy=50).collect()}
    expected = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in points])).alias("p")).first()["p"]
    assert [whole[p] for p in points] == pytest.approx(expected)
    assert percentiles.exact_percentiles(df.where("false"), "v", points).count() == 0


def test_percentiles_match_builtin_on_odd_values(spark):
    rng = random.Random(3)
    values = [rng.choice([0.0, -1.0, 1e-9, 1e12]) if rng.random() < 0.3 else rng.gauss(0, 1000) for _ in range(3000)]
    values += [42.0] * 2000  # a hot value
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k INT, v DOUBLE")
    points = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {(r["k"], r["point"]): r["percentile"] for r in percentiles.exact_percentiles(df, "v", points, ["k"]).collect()}
    for row in df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in points])).alias("p")).collect():
        for point, value in zip(points, row["p"]):
            assert got[row["k"], point] == pytest.approx(value, rel=1e-9, abs=1e-9)


def test_outcomes_and_health(spark):
    items = make(spark, (100, [], 1), handle="good").unionByName(make(spark, (50, [], 1), handle="bad"))
    orgs = spark.createDataFrame([("good", None, 5), ("bad", "HTTP 500", 7), ("none", None, 1)], "handle STRING, error STRING, duration_ms BIGINT")
    rows = {r["handle"]: r for r in registry.outcomes(orgs, items, orgs).collect()}
    assert (rows["bad"]["success"], rows["bad"]["item_count"], rows["bad"]["total_value_usd"]) == (False, 0, 0)
    assert (rows["good"]["success"], rows["good"]["total_value_usd"]) == (True, 100)
    health = stats.org_health(registry.outcomes(orgs, items, orgs)).first()
    assert (health["organizations_with_items"], health["organizations_with_errors"]) == (1, 1)


def test_success_rate_of_nothing_is_null(spark):
    assert stats.success_rate(spark.createDataFrame([], OUTCOMES), F.col("success")).first()[0] is None


def test_top_org_items_keep_all_items_of_a_hot_org(spark):
    items = make(spark, *[(10, [], 1)] * 500, handle="hot").unionByName(make(spark, (20, [], 1), handle="cold"))
    items = items.withColumn("display_name", F.col("handle"))
    assert stats.top_org_items(items, 1).count() == 500
    nested = stats.nested_by_org(items.drop("created_at"), part_size=40).collect()
    sizes = [sum(i["copies"] for i in r["items"]) for r in nested if r["handle"] == "hot"]
    assert sum(sizes) == 500 and len(sizes) > 5
