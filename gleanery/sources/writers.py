"""DataFrames to published files.

Every write is one distributed job. Nothing gathers a whole table into one row: documents that nest
items come in parts of bounded size.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from gleanery import schemas
from gleanery.operators.discovery import registry_summary
from gleanery.operators.keyed import assign_batches, in_parts
from gleanery.sources.readers import path_exists

MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _json(df: DataFrame, path: str, mode: str = "overwrite", *partitions: str, dynamic: bool = False) -> None:
    writer = df.write.mode(mode).option("timestampFormat", MILLIS).option("ignoreNullFields", "false")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.json(path)


def write_items(items: DataFrame, path: str) -> None:
    """Nested items, one per line."""
    _json(items, path)


def as_envelopes(items: DataFrame, page_size: int = 100) -> DataFrame:
    """API envelopes per organization, paged: (handle, page, value) with the JSON body as text.

    ``next_cursor`` names the following page that there is, and is null on the last. Pages are filled by
    a hash, so sizes vary around ``page_size``, and numbers of pages that stayed empty are left out.
    Equal items are merged first and carry ``copies`` when repeated.
    """
    options = {"timestampFormat": MILLIS, "ignoreNullFields": "false"}
    bodies = items.select(F.col("org.handle").alias("handle"), F.to_json(F.struct(*items.columns), options).alias("_body"))
    counted = F.concat(
        F.substr("_body", F.lit(1), F.length("_body") - 1), F.lit(',"copies":'), F.col("copies").cast("string"), F.lit("}")
    )
    paged = in_parts(bodies, ["handle"], page_size)
    listed = F.array_sort(F.collect_list(F.when(F.col("copies") > 1, counted).otherwise(F.col("_body"))))
    following = F.col("_next").cast("string")
    cursor = F.when(following.isNull(), "null").otherwise(F.concat(F.lit('"'), following, F.lit('"')))
    head, middle, tail = '{"result":{"data":{"json":{"items":[', '],"next_cursor":', "}}}}"
    value = F.concat(F.lit(head), F.array_join("_listed", ","), F.lit(middle), cursor, F.lit(tail))
    # Page numbers without their items: a few bytes for each page of an organization.
    there = paged.select("handle", "part_no").distinct()
    numbered = there.withColumn("_next", F.lead("part_no").over(Window.partitionBy("handle").orderBy("part_no")))
    return (
        paged.groupBy("handle", "part_no").agg(listed.alias("_listed"))
        .join(numbered, ["handle", "part_no"])
        .select("handle", F.col("part_no").alias("page"), value.alias("value"))
    )


def write_envelopes(items: DataFrame, path: str, page_size: int = 100) -> None:
    """One envelope per line."""
    as_envelopes(items, page_size).select("value").write.mode("overwrite").text(path)


def land_envelopes(items: DataFrame, path: str, page_size: int = 100) -> None:
    """Envelopes with their handle and page, to be read several times."""
    as_envelopes(items, page_size).write.mode("overwrite").parquet(path)


def write_index(nested: DataFrame, path: str, snapshot_date: Column) -> None:
    """Index rows (see ``nested_by_org``) under their date; large organizations span several rows."""
    _json(nested.withColumn("snapshot_date", snapshot_date), path, "overwrite", "snapshot_date", dynamic=True)


def _dates(df: DataFrame, snapshot_date: Column) -> list:
    """The dates that a snapshot is written under: one, unless the date depends on the rows."""
    spark = df.sparkSession
    try:
        return [spark.range(1).select(snapshot_date.cast("date").alias("d")).first()["d"]]
    except AnalysisException:
        return [r["d"] for r in df.select(snapshot_date.cast("date").alias("d")).distinct().collect()]


def archive(df: DataFrame, path: str, snapshot_date: Column, on_exists: str = "overwrite") -> None:
    """Dated copy. A date that is already there is replaced, or left alone with ``on_exists='skip'``.

    Whether a date is there is asked of its folder alone; no file of the archive is opened.
    """
    dated = df.withColumn("snapshot_date", snapshot_date.cast("date"))
    if on_exists == "skip":
        days = _dates(df, snapshot_date)
        present = [d for d in days if path_exists(df.sparkSession, f"{path}/snapshot_date={d}")]
        if len(present) == len(days):
            return
        if present:
            dated = dated.where(~F.col("snapshot_date").isin(present))
    elif on_exists != "overwrite":
        raise ValueError(f"unknown on_exists: {on_exists}")
    mode = "overwrite" if on_exists == "overwrite" else "append"
    dated.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


# --- versions --------------------------------------------------------------------------------------

#: Versions from one full copy to the next, and full copies that are kept.
FULL_EVERY, KEEP = 16, 2


class Conflict(RuntimeError):
    """Another writer has committed the same version first."""


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there, jvm


def _commit(spark: SparkSession, path: str, version: int, folder: str, full: bool) -> None:
    """Record a version: a file that only one writer can create, named by its number, with the folder that holds its rows."""
    files, _, jvm = _files(spark, path)
    record = jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{version:012d}.json")
    try:
        out = files.create(record, False)
    except Py4JJavaError as e:
        raise Conflict(f"version {version} of {path} is there already") from e
    out.write(bytearray(json.dumps({"version": version, "folder": folder, "is_full": full}).encode()))
    out.close()


def versions(spark: SparkSession, path: str) -> list[Row]:
    """The committed versions (version, folder, is_full) that can still be read, in order: those since the oldest full copy kept."""
    if not path_exists(spark, f"{path}/commits"):
        return []
    return spark.read.schema("version BIGINT, folder STRING, is_full BOOLEAN").json(f"{path}/commits").orderBy("version").collect()


def current_version(spark: SparkSession, path: str) -> int | None:
    """Number of the last committed version."""
    done = versions(spark, path)
    return done[-1]["version"] if done else None


def _drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Remove what lies before the oldest of the last ``keep`` full copies: the records first, then their rows."""
    done = versions(spark, path)
    full = [v["version"] for v in done if v["is_full"]]
    if len(full) <= keep:
        return
    files, _, jvm = _files(spark, path)
    old = [v for v in done if v["version"] < full[-keep]]
    for v in old:
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{v['version']:012d}.json"), False)
    for v in old:
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{v['folder']}"), True)


def write_state(state: DataFrame, path: str, keep: int = KEEP, full_every: int = FULL_EVERY) -> int:
    """Write the next version of a state (one row per handle) and record it; readers see the last one until then.

    A version holds the rows that differ from the version before and the handles that are gone; every
    ``full_every`` versions it is a full copy, and copies older than the last ``keep`` are removed. Two writers
    cannot both commit a version: the later one fails with ``Conflict`` and leaves a folder that nothing names.
    """
    spark = state.sparkSession
    done = versions(spark, path)
    version = done[-1]["version"] + 1 if done else 1
    since = next((i for i, v in enumerate(reversed(done)) if v["is_full"]), None)
    full = since is None or since + 1 >= full_every
    folder = f"versions/{version:012d}-{uuid.uuid4().hex}"
    rows = state.withColumn("_gone", F.lit(False))
    if not full:
        before = read_state(spark, path)
        names = state.columns
        differs = F.lit(False)
        for c in names:
            differs = differs | ~F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}"))
        both = state.select("handle", F.struct(*names).alias("_new")).join(before.select(F.col("handle").alias("_h"), F.struct(*names).alias("_old")), F.col("handle") == F.col("_h"), "full_outer")
        gone = F.col("_new").isNull()
        kept = [F.when(gone, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c) for c in names]
        rows = both.where(gone | F.col("_old").isNull() | differs).select(*kept, gone.alias("_gone"))
    rows.write.mode("errorifexists").parquet(f"{path}/{folder}")
    _commit(spark, path, version, folder, full)
    _drop_old(spark, path, keep)
    return version


def read_state(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The last state, or that of a version still kept; None when there is none yet, which means a first run. Damaged state fails.

    A handle's row is its last one since the full copy that the version builds on.
    """
    done = [v for v in versions(spark, path) if version is None or v["version"] <= version]
    if not done or version is not None and done[-1]["version"] != version:
        return None
    start = max(i for i, v in enumerate(done) if v["is_full"])
    read = lambda v: spark.read.schema(f"{schemas.STATE}, _gone BOOLEAN").parquet(f"{path}/{v['folder']}").withColumn("_version", F.lit(v["version"]))
    parts = [read(v) for v in done[start:]]
    if len(parts) == 1:
        return parts[0].drop("_gone", "_version")
    rows = reduce(DataFrame.unionByName, parts)
    names = [c for c in rows.columns if c != "_version"]
    last = rows.groupBy("handle").agg(F.max_by(F.struct(*names), "_version").alias("_r"))
    return last.select("_r.*").where("NOT _gone").drop("_gone")


def publish_snapshot(tables: dict[str, DataFrame], path: str, changes: DataFrame | None = None, keep: int = KEEP) -> int | None:
    """Write all tables of a snapshot and then record them as one version, so that readers see all or none of them.

    Without a row in ``changes`` nothing is written. Versions older than the last ``keep`` are removed.
    """
    if changes is not None and changes.isEmpty():
        return None
    spark = next(iter(tables.values())).sparkSession
    done = versions(spark, path)
    version = done[-1]["version"] + 1 if done else 1
    folder = f"versions/{version:012d}-{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{path}/{folder}/{name}")
    _commit(spark, path, version, folder, True)
    _drop_old(spark, path, keep)
    return version


def read_snapshot(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A table of the last published snapshot; None before the first one."""
    done = versions(spark, path)
    return spark.read.parquet(f"{path}/{done[-1]['folder']}/{name}") if done else None


def comma_batches(handles: DataFrame, size: int = 1000) -> DataFrame:
    """Handles as comma lists of at most ``size`` in handle order: (batch_no, handles, handle_count)."""
    batches = assign_batches(handles.select("handle"), size, ["handle"])
    listed = F.array_join(F.array_sort(F.collect_list("handle")), ",")
    return batches.groupBy("batch_no").agg(listed.alias("handles"), F.count("*").alias("handle_count"))


def publish_changes(checked: DataFrame, path: str, fmt: str = "lines", size: int = 1000) -> None:
    """Changed handles: one per line (``lines``), comma lists of bounded length (``commas``), or all outcomes (``json``)."""
    changed = checked.where("outcome = 'changed'").select("handle")
    if fmt == "lines":
        changed.write.mode("overwrite").text(path)
    elif fmt == "commas":
        comma_batches(changed, size).select("handles").write.mode("overwrite").text(path)
    elif fmt == "json":
        _json(checked.select("handle", "outcome", "error"), path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def land_pages(pages: DataFrame, name: str, buckets: int = 256, path: str | None = None) -> DataFrame:
    """Pages as a table bucketed by handle, replacing one of that name; at ``path``, or where the warehouse puts it.

    Later joins by handle leave the pages where they are: only the other side is moved, to as many buckets.
    """
    writer = pages.write.mode("overwrite").format("parquet").bucketBy(buckets, "handle")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return pages.sparkSession.table(name)


def append_run_log(entries: DataFrame, path: str) -> None:
    """Log entries as JSON lines under component and day."""
    dated = entries.withColumn("log_date", F.to_date("timestamp"))
    _json(dated, path, "append", "component", "log_date")


def write_registry(registry: DataFrame, discovered: DataFrame, path: str) -> None:
    """Graded registry rows and, beside them, totals and counts by discovery method."""
    _json(registry, f"{path}/organizations")
    _json(registry_summary(discovered), f"{path}/summary")
