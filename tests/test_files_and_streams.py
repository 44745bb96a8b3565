"""Readers, writers, state versions and streams."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gleanery.functions.scalars import iso_millis
from gleanery.operators import items, page_state, quality, registry, stats
from gleanery.sources import readers, writers
from gleanery.streaming import change_batches, page_changes

T0 = dt.datetime(2025, 1, 1, 12)


def write(path, text):
    path.write_text(text)
    return str(path)


def nested(spark, n=7):
    rows = spark.range(n).select(
        F.lit("org").alias("handle"), F.lit("Org").alias("display_name"), F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("array<string>").alias("org_tech"), F.lit("o").alias("owner"), F.lit("r").alias("repo"),
        F.col("id").alias("number"), F.lit("").alias("title"), F.lit(None).cast("bigint").alias("cents"),
        F.lit(None).cast("array<string>").alias("tech"), F.lit("ctx").alias("context"), F.lit("github.com/o/r").alias("ref_url"),
    )
    return items.items_from_text(rows, F.lit(T0))


def test_registry(spark, tmp_path):
    good = write(tmp_path / "good.json", '{"version":"1","organizations":[{"handle":"zio","active":true},{"handle":"ZIO","active":false}]}')
    assert [r["handle"] for r in readers.read_registry(spark, good).collect()] == ["zio", "ZIO"]
    assert registry.active_orgs(readers.read_registry(spark, good)).count() == 1
    bad = write(tmp_path / "bad.json", '{"version":"1"}')
    with pytest.raises(PySparkException):
        readers.read_registry(spark, bad).collect()
    default = spark.createDataFrame([("d",)], "handle STRING")
    assert readers.read_registry(spark, str(tmp_path / "none.json"), default).collect() == default.collect()
    with pytest.raises(ValueError):
        registry.parse_requested(" , ")
    assert registry.parse_requested("a, b") == ["a", "b"]


def test_index_keeps_both_spellings(spark, tmp_path):
    path = write(tmp_path / "i.json", '{"organizations":{"zio":{"display_name":"z","bounties":[{"id":"1","amount_usd":5}]},"ZIO":{"bounties":[{"id":"2"}]}}}')
    assert sorted((r["handle"], r["id"]) for r in readers.read_index(spark, path).collect()) == [("ZIO", "2"), ("zio", "1")]


def test_items_and_envelopes_survive(spark, tmp_path):
    made = nested(spark)
    flat = lambda df: sorted(map(str, items.flatten_items(df).collect()))
    writers.write_items(made, str(tmp_path / "items"))
    assert flat(readers.read_items(spark, str(tmp_path / "items"))) == flat(made)
    twice = made.unionByName(made)
    writers.write_envelopes(twice, str(tmp_path / "env"), 3)
    back = readers.read_envelope(spark, str(tmp_path / "env"), lines=True)
    assert flat(back) == flat(twice)
    pages = writers.as_envelopes(twice, 3).collect()
    assert len(pages) <= 3 and sum('"next_cursor":null' in p["value"] for p in pages) <= 1


def chain(spark, *pages):
    rows = spark.createDataFrame([(h, c, n, i) for i, (h, c, n) in enumerate(pages)], "handle STRING, cursor STRING, next_cursor STRING, i INT")
    return {(r["handle"], r["cursor"]): r["page_no"] for r in readers.chained_pages(rows, ["handle"]).collect()}


def test_cursor_chains(spark):
    long = [("long", str(i * 7 % 101), str((i + 1) * 7 % 101) if i < 100 else None) for i in range(101)]
    found = chain(spark, *long, ("one", "x", None), ("two", "b", None), ("two", "a", "b"))
    assert found["one", "x"] == 1 and found["two", "a"] == 1 and found["two", "b"] == 2
    assert [found["long", str(i * 7 % 101)] for i in range(101)] == list(range(1, 102))


@pytest.mark.parametrize("pages, fault", [
    ([("a", "1", "2"), ("a", "3", None)], "missing"),
    ([("a", "1", "2"), ("a", "2", None), ("a", "2", None)], "one cursor"),
    ([("a", "1", "3"), ("a", "2", "3"), ("a", "3", None)], "lead to one"),
    ([("a", "1", None), ("a", "2", "3"), ("a", "3", "4"), ("a", "4", "2")], "loop"),
    ([("a", "1", "2"), ("a", "2", "1")], "not one last page"),
    ([("a", "1", None), ("a", "2", None)], "not one last page"),
])
def test_broken_chains_fail(spark, pages, fault):
    with pytest.raises(PySparkException, match=fault):
        chain(spark, ("fine", "1", None), *pages)


def test_index_rows_and_archive(spark, tmp_path):
    flat = items.flatten_items(nested(spark))
    rows = stats.nested_by_org(flat, 3)
    day = F.lit(dt.date(2025, 1, 1))
    writers.write_index(rows, str(tmp_path / "index"), day)
    writers.write_index(rows, str(tmp_path / "index"), F.lit(dt.date(2025, 1, 2)))
    assert spark.read.json(str(tmp_path / "index")).select("snapshot_date").distinct().count() == 2
    path = str(tmp_path / "archive")
    first, second = flat.limit(3), flat.limit(5)
    writers.archive(first, path, day, "skip")
    writers.archive(second, path, day, "skip")
    assert spark.read.parquet(path).count() == 3
    writers.archive(second, path, day)
    assert spark.read.parquet(path).count() == 5
    writers.archive(second, path, F.lit(dt.date(2025, 1, 2)), "skip")
    assert spark.read.parquet(path).count() == 10
    # A date that is there is skipped by its folder: none of the files is opened, not even a damaged one.
    damaged = tmp_path / "archive/snapshot_date=2025-01-03"
    damaged.mkdir()
    (damaged / "part-0.parquet").write_text("not parquet")
    writers.archive(second, path, F.lit(dt.date(2025, 1, 3)), "skip")
    by_row = second.withColumn("d", F.when(F.col("id") > "", F.lit(dt.date(2025, 1, 3))))
    writers.archive(by_row, path, F.col("d"), "skip")
    assert (damaged / "part-0.parquet").read_text() == "not parquet"


def test_state_versions(spark, tmp_path):
    path = str(tmp_path / "state")
    assert writers.read_state(spark, path) is None
    one = spark.createDataFrame([("a", "u", "h", T0, T0, 1)], "handle STRING, url STRING, hash STRING, last_checked TIMESTAMP, last_changed TIMESTAMP, item_estimate BIGINT")
    assert writers.write_state(one, path) == 1
    state = writers.read_state(spark, path)
    assert writers.write_state(state.withColumn("hash", F.lit("h2")), path) == 2
    assert writers.read_state(spark, path).first()["hash"] == "h2"


def test_publish(spark, tmp_path):
    checked = spark.createDataFrame([(f"h{i}", "changed" if i < 5 else "unchanged", None) for i in range(8)], "handle STRING, outcome STRING, error STRING")
    read = lambda name: sorted(r[0] for r in spark.read.text(str(tmp_path / name)).collect())
    writers.publish_changes(checked, str(tmp_path / "lines"))
    assert read("lines") == [f"h{i}" for i in range(5)]
    writers.publish_changes(checked, str(tmp_path / "commas"), "commas", 3)
    assert read("commas") == ["h0,h1,h2", "h3,h4"]
    writers.publish_changes(checked, str(tmp_path / "json"), "json")
    assert spark.read.json(str(tmp_path / "json")).count() == 8


def _state_of(spark, *rows):
    return spark.createDataFrame([(h, "u", digest, T0, T0, 1) for h, digest in rows], "handle STRING, url STRING, hash STRING, last_checked TIMESTAMP, last_changed TIMESTAMP, item_estimate BIGINT")


def test_state_versions_hold_what_differs(spark, tmp_path):
    path = str(tmp_path / "state")
    hashes = lambda version=None: {r["handle"]: r["hash"] for r in writers.read_state(spark, path, version).collect()}
    writers.write_state(_state_of(spark, ("a", "1"), ("b", "1"), ("c", "1")), path)
    writers.write_state(_state_of(spark, ("a", "1"), ("b", "2"), ("d", None)), path)
    last = writers.versions(spark, path)[-1]
    assert not last["is_full"]
    written = spark.read.parquet(f"{path}/{last['folder']}").collect()
    assert sorted((r["handle"], r["hash"], r["_gone"]) for r in written) == [("b", "2", False), ("c", "1", True), ("d", None, False)]
    writers.write_state(_state_of(spark, ("a", "1"), ("b", "2"), ("c", "9")), path)
    assert hashes() == {"a": "1", "b": "2", "c": "9"} and hashes(1) == {"a": "1", "b": "1", "c": "1"} and hashes(2) == {"a": "1", "b": "2", "d": None}


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "state")
    for n in range(1, 8):
        writers.write_state(_state_of(spark, ("a", str(n)), ("b", "x")), path, keep=2, full_every=2)
    left = [(v["version"], v["is_full"]) for v in writers.versions(spark, path)]
    assert left == [(5, True), (6, False), (7, True)]
    assert len(list((tmp_path / "state/versions").iterdir())) == 3
    assert writers.read_state(spark, path, 6).where("handle = 'a'").first()["hash"] == "6" and writers.read_state(spark, path, 2) is None


def test_two_writers_cannot_both_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    writers.write_state(_state_of(spark, ("a", "1")), path)
    behind = writers.versions(spark, path)
    writers.write_state(_state_of(spark, ("a", "2")), path)
    monkeypatch.setattr(writers, "versions", lambda spark, path: behind)
    with pytest.raises(writers.Conflict):
        writers.write_state(_state_of(spark, ("a", "3")), path)
    monkeypatch.undo()
    assert writers.read_state(spark, path).first()["hash"] == "2"


def test_a_snapshot_is_published_whole_or_not(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    tables = {"items": spark.range(5), "totals": spark.range(1)}
    assert writers.read_snapshot(spark, path, "items") is None
    assert writers.publish_snapshot(tables, path, spark.range(0)) is None
    assert writers.publish_snapshot(tables, path) == 1
    broken = {"items": spark.range(9), "totals": spark.range(1).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))}
    with pytest.raises(Exception, match="broken"):
        writers.publish_snapshot(broken, path)
    assert writers.read_snapshot(spark, path, "items").count() == 5
    for _ in range(3):
        writers.publish_snapshot(tables, path, spark.range(1))
    assert [v["version"] for v in writers.versions(spark, path)] == [3, 4]


def test_run_log(spark, tmp_path):
    entries = spark.sql("SELECT timestamp'2025-01-01 10:00:00' timestamp, 'info' level, 'm' message, 'Crawl' component, parse_json('{\"n\":3}') metadata, 5L duration_ms")
    writers.append_run_log(entries, str(tmp_path / "log"))
    writers.append_run_log(entries, str(tmp_path / "log"))
    log = readers.read_run_log(spark, str(tmp_path / "log"))
    assert log.count() == 2 and log.select(F.try_variant_get("metadata", "$.n", "int")).first()[0] == 3
    metrics = stats.run_metrics(log, "component", "timestamp", "duration_ms", F.col("level") != "error").first()
    assert (metrics["entries"], metrics["success_rate"], metrics["p95_duration"]) == (2, 1.0, 5.0)


def test_registry_document(spark, tmp_path):
    found = spark.createDataFrame([("a", True, True, "x"), ("b", False, True, "y")], "handle STRING, active BOOLEAN, validated BOOLEAN, discovery_method STRING")
    writers.write_registry(found.select("handle"), found, str(tmp_path / "reg"))
    rows = {(r["section"], r["key"]): r["count"] for r in spark.read.json(str(tmp_path / "reg/summary")).collect()}
    assert rows["totals", "active_organizations"] == 1 and rows["discovery_methods", "y"] == 1


def test_quality(spark):
    made = nested(spark, 2)
    assert quality.check_domains(made, quality.ITEM_DOMAINS).isEmpty()
    odd = quality.check_domains(made.withColumn("kind", F.lit("odd")), quality.ITEM_DOMAINS).first()
    assert (odd["field"], odd["value"], odd["count"]) == ("kind", "odd", 2)
    rows = {r["field"]: r for r in quality.check_required(spark.createDataFrame([("a", ""), (None, "x")], "p STRING, q STRING"), ["p", "q"]).collect()}
    assert (rows["p"]["missing"], rows["q"]["complete_percent"]) == (1, 50.0)


def _checks(spark):
    rows = []
    for i in range(40):
        for h in ("hot", f"k{i % 4}"):
            rows.append((h, T0 + dt.timedelta(hours=i), "open " * ((i // 3) % 2 + (h == "hot") * (i % 2))))
    return spark.createDataFrame(rows, "handle STRING, checked_at TIMESTAMP, html STRING")


@pytest.mark.parametrize("held", [3, 10_000])
def test_stream_equals_batch(spark, tmp_path, held):
    """Several micro-batches, with more checks of a handle in one than are held in memory, and two at one time."""
    twice = spark.createDataFrame([("hot", T0 + dt.timedelta(hours=3), "open open"), ("hot", T0 + dt.timedelta(hours=3), "open")], "handle STRING, checked_at TIMESTAMP, html STRING")
    checks = _checks(spark).unionByName(twice)
    # Files in time order, one per micro-batch.
    for day, cut in enumerate((T0, T0 + dt.timedelta(hours=12), T0 + dt.timedelta(hours=25))):
        end = cut + dt.timedelta(hours=(12, 13, 99)[day])
        checks.where((F.col("checked_at") >= F.lit(cut)) & (F.col("checked_at") < F.lit(end))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(checks.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = (
        page_changes.stream_page_changes(stream, held=held).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("handle", "checked_at", "hash")
    batch = page_changes.batch_page_changes(page_state.page_signatures(checks)).select("handle", "checked_at", "hash")
    assert sorted(got.collect()) == sorted(batch.collect()) and got.count() > 10


def test_change_windows_stream(spark, tmp_path):
    rows = [(h, T0 + dt.timedelta(seconds=s)) for s in range(0, 600, 7) for h in ("a", "b", f"h{s}")]
    events = spark.createDataFrame(rows, "handle STRING, at TIMESTAMP")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    run = change_batches.stream_payloads(
        change_batches.changes_per_window(stream, "2 minutes", "1 minute"), str(tmp_path / "out"), str(tmp_path / "log"), 10
    )
    run.awaitTermination()
    sent = spark.read.json(str(tmp_path / "out" / "messages"))
    got = sent.select(F.to_timestamp("window_start").alias("w"), F.explode("changed_orgs").alias("h"))
    batch = change_batches.changes_per_window(events, "2 minutes").where(F.col("window_end") <= F.lit(T0 + dt.timedelta(seconds=535)))
    expected = batch.select(F.col("window_start").alias("w"), F.col("handle").alias("h"))
    assert sorted(got.collect()) == sorted(expected.collect()) and got.count() > 30
    assert sent.agg(F.max("batch_size")).first()[0] == 10
    sizes = {r["batch_size"] for r in change_batches.batch_sizes(batch).collect()}
    assert sizes <= {19, 20}


def test_messages_have_a_true_maximum(spark):
    rows = spark.range(1000).select(F.lit(T0).alias("window_start"), F.lit(T0).alias("window_end"), F.concat(F.lit("h"), F.col("id")).alias("handle"))
    sent = change_batches.change_payloads(rows.unionByName(rows.limit(7).withColumn("window_end", F.lit(None).cast("timestamp"))), 100).collect()
    assert sorted(r["batch_size"] for r in sent) == [7] + [100] * 10
    assert len({h for r in sent for h in r["changed_orgs"]}) == 1000


def test_repeats_within_delay(spark, tmp_path):
    rows = [("a", T0), ("a", T0 + dt.timedelta(seconds=5)), ("b", T0)]
    events = spark.createDataFrame(rows, "handle STRING, at TIMESTAMP")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = change_batches.once_per_delay(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), "1 minute")
    run = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    assert sorted(r["handle"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_webhooks(spark):
    raw = spark.createDataFrame([('{"watch_url":"https://s/acme/bounties?status=open","timestamp":"2025-11-01T12:34:56Z","snapshot_id":"x"}',), ("junk",)], "value STRING")
    rows = readers.parse_webhooks(raw).select("handle", iso_millis("at").alias("at"), "snapshot_id").collect()
    assert [tuple(r) for r in rows] == [("acme", "2025-11-01T12:34:56.000Z", "x")]
