"""Snapshot diffs, page checks and carried change times."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from gleanery.catalog import QUERIES
from gleanery.operators import changes, keyed, page_state
from gleanery.plans import runs

ITEM = "id STRING, handle STRING, title STRING, amount_usd DOUBLE, url STRING, status STRING, tags ARRAY<STRING>, difficulty STRING, seen INT"
T0 = dt.datetime(2025, 1, 1)


@pytest.fixture
def restored(spark):
    """Session options for one test."""
    before = {}

    def put(options):
        for k, v in options.items():
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def item(spark, *rows):
    full = []
    for i, (id_, amount, *rest) in enumerate(rows):
        handle, tags, title = (list(rest) + [None] * 3)[:3]
        full.append((id_, handle or "org", title or f"Title {id_}", float(amount), f"u/{id_}", "open", tags or ["a"], "medium", i))
    return spark.createDataFrame(full, ITEM)


def kinds(diff):
    out = {}
    for r in diff.collect():
        out.setdefault(r["change_type"], []).append(r["id"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("order", [None, ["seen"]])
def test_every_kind(spark, order):
    prev = item(spark, ("stays", 12), ("rises", 80), ("goes", 5), ("falls", 900))
    cur = item(spark, ("comes", 61), ("rises", 95, "org", ["a", "c"]), ("stays", 12), ("falls", 890))
    diff = changes.diff_snapshots(prev, cur, order=order)
    assert kinds(diff) == {"added": ["comes"], "removed": ["goes"], "updated": ["falls", "rises"]}
    lines = diff.where("id = 'rises'").first()["changes"]
    assert lines == ["amount: $80 → $95", "tags added: c"]


def test_repeated_ids_against_itself(spark):
    same = item(spark, *[("unknown-0", n) for n in range(40)])
    assert changes.diff_snapshots(same, same).isEmpty()


def test_repeated_ids_without_an_order(spark):
    """Every row of a repeated id counts: what both sides say cancels out, the rest is paired."""
    prev = item(spark, ("unknown-0", 1, "org", None, "A"), ("unknown-0", 9, "org", None, "Z"), ("unknown-0", 9, "org", None, "Z"), ("b", 1), (None, 4))
    cur = item(spark, ("unknown-0", 500, "org", None, "A"), ("unknown-0", 9, "org", None, "Z"), ("b", 1), ("b", 1), (None, 4), (None, 6))
    found = sorted((r.change_type, r.id, r.changes) for r in changes.diff_snapshots(prev, cur).where("id IS NOT NULL").collect())
    assert found == [("added", "b", []), ("removed", "unknown-0", []), ("updated", "unknown-0", ["amount: $1 → $500"])]
    assert kinds(changes.diff_snapshots(prev, cur).where("id IS NULL")) == {"added": [None]}


def test_many_rows_of_one_id(spark):
    """As many rows are left over as the multisets differ by, on a key that holds all rows."""
    rows = spark.range(4000).select(F.lit("hot").alias("id"), (F.col("id") % 1500).cast("double").alias("amount_usd"), F.col("id").alias("seen"))
    cur = rows.select("id", F.when(F.col("seen") % 100 == 0, F.col("amount_usd") + 0.5).otherwise(F.col("amount_usd")).alias("amount_usd"), F.col("seen") + 1)
    diff = changes.diff_snapshots(rows, cur.withColumnRenamed("(seen + 1)", "seen"), fields=("amount_usd",), tags=None)
    assert {r.change_type: r["count"] for r in diff.groupBy("change_type").count().collect()} == {"updated": 40}


def test_nothing_changed(spark):
    prev = item(spark, ("b1", 100), ("b2", 200))
    assert changes.diff_snapshots(prev, prev).isEmpty()
    summary = changes.diff_counts(changes.diff_snapshots(prev, prev), changes.diff_keys(prev, prev)).first()
    assert (summary["has_changes"], summary["summary"]) == (False, "No changes detected")


def test_summary_and_first_snapshot(spark):
    prev, cur = item(spark, ("b1", 1)), item(spark, ("b1", 2, "new"), ("b2", 3, "new"))
    row = changes.diff_counts(changes.diff_snapshots(prev, cur), changes.diff_keys(prev, cur)).first()
    assert row["summary"] == "1 bounties added, 1 bounties updated, 1 organizations added, 1 organizations removed"
    assert changes.initial_summary(cur).first()["summary"] == "Initial scan: 2 bounties across 1 organizations"
    assert kinds(changes.diff_snapshots(prev.limit(0), cur)) == {"added": ["b1", "b2"]}


def test_repeats(spark):
    prev = item(spark, ("a", 1), ("a", 2), ("gone", 1), ("gone", 2))
    cur = item(spark, ("a", 2), ("a", 3), ("new", 1), ("new", 1))
    diff = changes.diff_snapshots(prev, cur, order=["seen"])
    assert kinds(diff) == {"added": ["new", "new"], "removed": ["gone", "gone"], "updated": ["a"]}


def test_absent_fields(spark):
    prev = item(spark, ("a", 1)).withColumn("difficulty", F.lit(None).cast("string"))
    assert changes.diff_snapshots(prev, prev).isEmpty()
    lines = changes.diff_snapshots(prev, item(spark, ("a", 1))).first()["changes"]
    assert lines == ["difficulty: undefined → medium"]


def test_diff_applied_to_previous_gives_current(spark):
    prev, cur = item(spark, ("a", 1), ("b", 2), ("c", 3)), item(spark, ("b", 5), ("c", 3), ("d", 4))
    diff = changes.diff_snapshots(prev, cur)
    touched = diff.select("id")
    rebuilt = prev.join(touched, "id", "left_anti").unionByName(diff.where("new IS NOT NULL").select("new.*"))
    assert sorted(rebuilt.drop("seen").collect()) == sorted(cur.drop("seen").collect())


def _state(spark, *rows):
    schema = "handle STRING, url STRING, hash STRING, last_checked TIMESTAMP, last_changed TIMESTAMP, item_estimate BIGINT"
    return spark.createDataFrame([(h, f"u/{h}", digest, T0, T0, 3) for h, digest in rows], schema)


def test_page_check(spark):
    registry = spark.createDataFrame([(h, "") for h in ("same", "diff", "new", "fail", "failnew", "unfetched")], "handle STRING, url STRING")
    state = _state(spark, ("same", "h1"), ("diff", "h0"), ("fail", "h2"), ("dropped", "h9"), ("unfetched", "h5"))
    signed = spark.createDataFrame(
        [("same", "h1", 1, None), ("diff", "h1", 2, None), ("new", "h7", 3, None), ("fail", None, None, "HTTP 500"), ("failnew", None, None, "timeout")],
        "handle STRING, hash STRING, item_estimate BIGINT, error STRING",
    )
    as_of = F.lit(dt.datetime(2025, 2, 1))
    checked = page_state.check_pages(registry, signed, state, as_of, "https://x/{handle}/list")
    assert {r["handle"]: r["outcome"] for r in checked.collect()} == {
        "same": "unchanged", "diff": "changed", "new": "changed", "fail": "error", "failnew": "error", "unfetched": "error",
    }
    after = {r["handle"]: r for r in page_state.next_state(checked).collect()}
    assert set(after) == {"same", "diff", "new", "fail", "unfetched"}
    assert after["same"]["last_changed"] == T0 and after["same"]["last_checked"] > T0
    assert after["fail"]["last_checked"] == T0 and after["fail"]["hash"] == "h2"
    assert after["new"]["url"] == "https://x/new/list"
    summary = page_state.check_summary(checked).first()
    assert (summary["changed"], summary["unchanged"], summary["errors"], summary["skipped_percent"]) == (2, 1, 3, 16.7)
    first = page_state.check_pages(registry, signed, None, as_of, "https://x/{handle}")
    assert page_state.check_summary(first).first()["changed"] == 3
    forced = page_state.check_pages(registry, signed, state, as_of, "https://x/{handle}", force_all=True)
    assert sorted(r[0] for r in page_state.changed_handles(forced).collect()) == ["diff", "new", "same"]


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_last_changed_is_carried_over_ranges(spark, restored, partitions):
    restored({"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}", T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 9)), rng.choice("AAB"), i) for i in range(1500)]
    rows += [("nulls", T0, None, 9001), ("nulls", T0 + dt.timedelta(days=2), None, 9002), ("nulls", T0 + dt.timedelta(days=3), "A", 9003)]
    history = spark.createDataFrame(rows, "k STRING, at TIMESTAMP, hash STRING, n INT")
    w = Window.partitionBy("k").orderBy("at", "n")
    before = F.lag(F.struct("hash")).over(w)
    plain = history.withColumn("changed", before.isNull() | ~F.col("hash").eqNullSafe(before["hash"])).withColumn(
        "last_changed", F.last(F.when(F.col("changed"), F.col("at")), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    got = page_state.carry_last_changed(history, "k", "at", "hash", ["n"])
    key = lambda df: sorted((r["n"], r["changed"], r["last_changed"]) for r in df.collect())
    assert key(got) == key(plain)


def test_a_key_with_a_million_checks_in_a_day_is_split(spark, restored):
    restored({"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    history = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 80_000).alias("at"), F.floor(F.col("id") / 1000).alias("hash"), "id")
    got = page_state.carry_last_changed(history, "k", "at", "hash", ["id"])
    tasks = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_if("changed").alias("c")).collect()
    assert len(tasks) >= 8 and max(t["n"] for t in tasks) < 500_000
    assert sum(t["n"] for t in tasks) == 1_000_000 and sum(t["c"] for t in tasks) == 1000
    wrong = got.where(F.unix_micros("last_changed") != F.floor(F.col("id") / 1000) * 80_000_000)
    assert wrong.isEmpty()


def test_due(spark):
    orgs = spark.createDataFrame([("never", 10), ("late", 60), ("exact", 100), ("early", 1000)], "handle STRING, scrape_interval BIGINT")
    state = _state(spark, ("late", ""), ("exact", ""), ("early", ""))
    found = page_state.due(orgs, state, F.lit(T0 + dt.timedelta(seconds=100)))
    assert sorted(r["handle"] for r in found.collect()) == ["exact", "late", "never"]


def test_refresh(spark):
    prev = item(spark, ("a", 1, "x"), ("b", 2, "y"))
    fresh = item(spark, ("a", 9, "x"), ("c", 3, "x"), ("b", 100, "y"))
    registry = spark.createDataFrame([("x", "u"), ("y", "u")], "handle STRING, url STRING")
    signed = spark.createDataFrame([("x", "new", 1), ("y", "old", 1)], "handle STRING, hash STRING, item_estimate BIGINT")
    done = runs.refresh_from_items(registry, signed, _state(spark, ("x", "old"), ("y", "old")), prev, fresh, F.lit(T0), "https://x/{handle}")
    assert kinds(done.diff) == {"added": ["c"], "updated": ["a"]}
    assert done.snapshot.where("id = 'b'").first()["amount_usd"] == 2


def test_refresh_from_pages(spark):
    """Only pages of changed organizations give items; an issue that two pages name is one item, and a failed page changes nothing."""
    link = lambda *n: "".join(f"<p>github.com/o/r/issues/{i} for $5</p>" for i in n)
    pages = [("same", link(1), 1), ("moved", link(2, 3), 1), ("moved", link(3, 4), 2), ("new", link(9), 1), ("failed", link(7), 1), ("failed", None, 2)]
    page_rows = spark.createDataFrame(pages, "handle STRING, html STRING, page_id INT")
    orgs = spark.createDataFrame([(h, "u", h, None, None) for h in ("same", "moved", "new", "failed", "unseen")], "handle STRING, url STRING, display_name STRING, description STRING, org_tech ARRAY<STRING>")
    signed = {r["handle"]: r["hash"] for r in page_state.handle_signatures(page_state.page_signatures(page_rows)).collect()}
    assert signed["failed"] is None and signed["moved"] is not None
    state = _state(spark, ("same", signed["same"]), ("moved", "h"), ("failed", "h"))
    flat = "id STRING, handle STRING, title STRING, amount_usd DOUBLE, url STRING, status STRING"
    previous = spark.createDataFrame([("same#1", "same", "old", 1.0, "u", "open"), ("moved#2", "moved", "old", 1.0, "u", "open"), ("moved#5", "moved", "old", 1.0, "u", "open"), ("failed#7", "failed", "old", 1.0, "u", "open")], flat)
    done = runs.refresh(orgs, page_rows, state, previous, F.lit(T0), "https://x/{handle}")
    assert sorted(r["id"] for r in done.snapshot.collect()) == ["failed#7", "moved#2", "moved#3", "moved#4", "new#9", "same#1"]
    assert kinds(done.diff) == {"added": ["moved#3", "moved#4", "new#9"], "removed": ["moved#5"], "updated": ["moved#2"]}
    assert {r["handle"]: r["outcome"] for r in done.checked.collect()} == {"same": "unchanged", "moved": "changed", "new": "changed", "failed": "error", "unseen": "error"}
    assert {r["handle"]: r["hash"] for r in done.state.collect()}["failed"] == "h"


def test_batches_are_exact_and_complete(spark):
    rows = spark.range(1003).select((F.col("id") % 5).alias("hot"), F.col("id"))
    got = keyed.assign_batches(rows, 10, ["hot", "id"])
    sizes = [r["count"] for r in got.groupBy("batch_no").count().orderBy("batch_no").collect()]
    assert sizes == [10] * 100 + [3] and got.select("batch_count").distinct().first()[0] == 101
    ordered = [(r["hot"], r["id"]) for r in got.orderBy("batch_no", "hot", "id").collect()]
    assert ordered == sorted(ordered)


def test_first_last_and_source(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "k STRING, n INT, v STRING")
    assert sorted(r["v"] for r in keyed.first_per_key(df, ["k"], ["n"]).collect()) == ["x", "z"]
    assert sorted(r["v"] for r in keyed.last_per_key(df, ["k"], ["n"]).collect()) == ["y", "z"]
    assert sorted(r["v"] for r in keyed.first_source(df, ["k"], "n").collect()) == ["x", "z"]


def test_parts_hold_copies(spark):
    df = spark.range(900).select(F.lit("k").alias("k"), F.when(F.col("id") < 600, -1).otherwise(F.col("id")).alias("v"))
    rows = keyed.in_parts(df, ["k"], 50).collect()
    assert sum(r["copies"] for r in rows) == 900 and max(r["copies"] for r in rows) == 600
    assert len(rows) == 301 and {r["part_count"] for r in rows} == {7}
    blocks = keyed.in_parts(df, ["k"], 50, max_copies=100).collect()
    assert sum(r["copies"] for r in blocks) == 900 and max(r["copies"] for r in blocks) == 100
    assert len(blocks) == 306 and len({r["part_no"] for r in blocks if r["v"] == -1}) > 1


def test_locale_order(spark):
    df = spark.createDataFrame([(h,) for h in ("ZIO", "b", "zio", "A", "a", "Mudlet", "mudlet")], "handle STRING")
    assert [r[0] for r in keyed.sort_by_locale(df).collect()] == ["a", "A", "b", "mudlet", "Mudlet", "zio", "ZIO"]


def _leaves(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_snapshots_of_unique_keys_are_read_once(spark):
    rows = [("a", "x", 1.0, "open"), ("b", "x", 1.0, "open"), ("c", None, 2.0, "open")]
    schema = "id string, title string, amount_usd double, status string"
    prev = spark.createDataFrame(rows, schema)
    cur = spark.createDataFrame([("a", "x", 1.0, "open"), ("b", "y", 1.0, "open"), ("d", "x", 2.0, "open")], schema)
    fields = ("title", "amount_usd", "status")
    found = changes.diff_snapshots(prev, cur, fields=fields, tags=None)
    assert sorted((r.id, r.change_type) for r in found.collect()) == [("b", "updated"), ("c", "removed"), ("d", "added")]
    assert _leaves(found) == 2


def test_repeated_keys_are_dealt_out_once_and_hot_ones_agree(spark, monkeypatch):
    schema = "id string, title string, amount_usd double, status string, seen int"
    side = lambda seed: [
        (None if i % 7 == 0 else f"k{i % 7}", None if (i * seed) % 3 == 0 else f"t{i % 2}", float((i * seed) % 4), "open", i) for i in range(60)
    ]
    prev, cur = spark.createDataFrame(side(3), schema), spark.createDataFrame(side(5)[:50], schema)
    fields = ("title", "amount_usd", "status")
    say = lambda df: sorted(map(repr, df.collect()))
    by_key = changes.paired_rows(prev, cur, "id", fields, None)
    assert _leaves(by_key) == 2
    monkeypatch.setattr(changes, "HOT_KEY", 7)
    hot = changes.paired_rows(prev, cur, "id", fields, None)
    assert say(by_key) == say(hot) != []
    count = lambda rows: len([r for r in rows if r])
    assert count(by_key.select("old").toPandas()["old"]) - count(by_key.select("new").toPandas()["new"]) == 10


def test_last_row_of_a_key_is_joined_where_it_was_found(spark):
    rows = spark.range(100).selectExpr("cast(id % 10 as string) AS id", "id AS seen", "cast(id as string) AS title")
    last = keyed.last_per_key(rows, ["id"], ["seen"])
    assert last.columns == ["id", "seen", "title"] and sorted(r.seen for r in last.collect()) == list(range(90, 100))
    joined = rows.select("id").hint("merge").join(last, "id")._jdf.queryExecution().executedPlan().toString()
    assert joined.count("Exchange hashpartitioning") == 2


def test_cursor_chain_reads_landed_envelopes(spark, sf):
    read = QUERIES["items_through_cursor_chain"](spark, sf).inputFiles()
    assert read and all("envelopes_" in name for name in read)
