"""Landed files to DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery import schemas
from gleanery.functions.scalars import url_handle
from gleanery.operators.keyed import checkpoint_dir


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table path holds anything, by asking Spark's own file listing."""
    try:
        spark.read.format("text").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_registry(spark: SparkSession, path: str | Sequence[str], default: DataFrame | None = None) -> DataFrame:
    """Registry documents to one row per organization.

    A missing file gives ``default`` when there is one. A document without an ``organizations`` array
    fails when its rows are read.
    """
    if default is not None and not path_exists(spark, path):
        return default
    documents = spark.read.schema(schemas.REGISTRY).json(path, multiLine=True)
    checked = F.coalesce("organizations", F.raise_error(F.lit("registry has no organizations array")))
    return documents.select(F.explode(checked).alias("_o")).select("_o.*")


def _documents(spark: SparkSession, schema: str, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    return spark.read.schema(schema).json(paths, multiLine=not lines)


def parse_documents(raw: DataFrame, column: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Landed JSON bodies in a text column to document columns."""
    return raw.select(*keep, F.from_json(F.col(column), schema).alias("_d")).select(*keep, "_d.*")


def listing_rows(documents: DataFrame) -> DataFrame:
    """Listing bodies to one row per listed item; other columns stay."""
    keep = [c for c in documents.columns if c != "items"]
    return documents.select(*keep, F.explode("items").alias("_i")).select(*keep, "_i.*")


def read_listing(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    """Landed listing bodies to one row per listed item. ``lines`` reads one body per line and splits large files."""
    return listing_rows(_documents(spark, schemas.LISTING, paths, lines))


def _expand_copies(rows: DataFrame) -> DataFrame:
    """Repeat rows that a writer merged."""
    times = F.sequence(F.lit(1), F.greatest(F.coalesce("copies", F.lit(1)), F.lit(1)).cast("int"))
    return rows.select(*[c for c in rows.columns if c != "copies"], F.explode(times).alias("_time")).drop("_time")


def envelope_rows(documents: DataFrame) -> DataFrame:
    """API envelopes to nested items."""
    return _expand_copies(documents.select(F.explode("result.data.json.items").alias("_i")).select("_i.*"))


def chained_pages(pages: DataFrame, keys: Sequence[str], cursor: str = "cursor", following: str = "next_cursor") -> DataFrame:
    """Pages with their place (``page_no``, from 1) in the chain of cursors of their key.

    A page is named by ``cursor`` and names the next one by ``following``; the last names none. A chain that is
    broken fails when its rows are read: a page that is named and not there, two pages of one name, two
    that lead to one page, more or less than one last page, or pages that lead round in a loop.

    Places are found by doubling: in each round a page learns how far the end is by asking the page that it
    can already see, so a chain of n pages takes about log2(n) joins on unique keys.
    """
    keys = list(keys)
    checkpoint_dir(pages.sparkSession)
    links = pages.select(*keys, F.col(cursor).cast("string").alias("_c"), F.col(following).cast("string").alias("_next")).checkpoint()
    named = links.where("_next IS NOT NULL").select(*keys, F.col("_next").alias("_c"), F.lit(1).alias("_named"))
    both = links.groupBy(*keys, "_c").agg(F.count("*").alias("_pages")).join(named.groupBy(*keys, "_c").agg(F.sum("_named").alias("_named")), [*keys, "_c"], "full_outer")
    faults = both.groupBy(*keys).agg(
        F.count_if(F.col("_pages").isNull()).alias("_missing"), F.count_if(F.col("_pages") > 1).alias("_twice"), F.count_if(F.col("_named") > 1).alias("_joined")
    )
    ends = links.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(F.col("_next").isNull()).alias("_ends"))
    most = ends.agg(F.max("_n")).first()[0] or 1
    far = links.withColumn("_left", F.when(F.col("_next").isNull(), 0).otherwise(1).cast("bigint"))
    for _ in range(max(1, (most - 1).bit_length())):
        seen = far.select(*keys, F.col("_c").alias("_next"), F.col("_left").alias("_more"), F.col("_next").alias("_beyond"))
        far = far.join(seen, [*keys, "_next"], "left").select(*keys, "_c", F.col("_beyond").alias("_next"), (F.col("_left") + F.coalesce("_more", F.lit(0))).alias("_left")).checkpoint()
    loops = far.groupBy(*keys).agg(F.count("_next").alias("_looped"))
    said = F.concat_ws(", ", *[
        F.when(F.col(c) > 0, F.lit(text)) for c, text in (("_missing", "a page is missing"), ("_twice", "two pages have one cursor"), ("_joined", "two pages lead to one"), ("_looped", "pages lead round in a loop"))
    ], F.when(F.col("_ends") != 1, F.lit("there is not one last page")))
    checked = ends.join(faults, keys).join(loops, keys).withColumn("_fault", F.nullif(said, F.lit("")))
    message = F.concat(F.lit("broken chain of "), F.concat_ws("/", *keys), F.lit(": "), "_fault")
    place = F.when(F.col("_fault").isNotNull(), F.raise_error(message).cast("bigint")).otherwise(F.col("_n") - F.col("_left"))
    placed = far.select(*keys, F.col("_c").alias("_cursor"), "_left").join(checked.select(*keys, "_n", "_fault"), keys).select(*keys, "_cursor", place.alias("page_no"))
    return pages.withColumn("_cursor", F.col(cursor).cast("string")).join(placed, [*keys, "_cursor"]).drop("_cursor")


def read_envelope(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    """API envelopes to nested items. ``lines`` reads one envelope per line and splits large files."""
    return envelope_rows(_documents(spark, schemas.ENVELOPE, paths, lines))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Nested items, one per line, as ``write_items`` leaves them."""
    return spark.read.schema(schemas.ITEM).json(path)


def index_orgs(documents: DataFrame) -> DataFrame:
    """Keyed index documents to one row per organization with its nested items."""
    return documents.select(F.explode("organizations").alias("handle", "_o")).select("handle", "_o.*")


def index_items(documents: DataFrame) -> DataFrame:
    """Keyed index documents to flat items with their handle."""
    rows = index_orgs(documents).select("handle", "display_name", F.explode("bounties").alias("_b"))
    return _expand_copies(rows.select("handle", "display_name", "_b.*"))


def read_index_orgs(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    return index_orgs(_documents(spark, schemas.INDEX, paths, lines))


def read_index(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    return index_items(_documents(spark, schemas.INDEX, paths, lines))


def read_index_rows(spark: SparkSession, path: str) -> DataFrame:
    """Flat items of all dates of an index as ``write_index`` leaves it: snapshot_date, handle, display_name and the item."""
    rows = spark.read.schema(schemas.INDEX_ROW).json(path)
    found = rows.select("snapshot_date", "handle", "display_name", F.explode("items").alias("_b"))
    return _expand_copies(found.select("snapshot_date", "handle", "display_name", "_b.*"))


def state_rows(documents: DataFrame) -> DataFrame:
    """Keyed page-state documents to state rows."""
    return documents.select(F.explode("organizations").alias("handle", "_s")).select(
        "handle", "_s.url", "_s.hash", "_s.last_checked", "_s.last_changed",
        F.col("_s.bounty_count_estimate").alias("item_estimate"),
    )


def read_state_document(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    return state_rows(_documents(spark, schemas.STATE_DOCUMENT, paths, lines))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def stream_pages(spark: SparkSession, path: str, schema: str = schemas.PAGES, max_files: int = 64) -> DataFrame:
    """Landed page files as a stream. The files per batch bound what one busy handle can bring at once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """Landed issue records, one JSON object per line."""
    return spark.read.schema(schemas.ISSUES).json(path)


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PROBES).json(path)


def parse_webhooks(raw: DataFrame, body: str = "value") -> DataFrame:
    """Webhook bodies to (handle, at, snapshot_id); the handle is the first path part of the watched URL."""
    parsed = raw.select(F.from_json(F.col(body), schemas.WEBHOOK).alias("_w"))
    return parsed.select(
        url_handle("_w.watch_url").alias("handle"), F.col("_w.timestamp").alias("at"), F.col("_w.snapshot_id").alias("snapshot_id")
    ).where("handle IS NOT NULL")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Run-log entries with their component and date folders."""
    return spark.read.schema(f"{schemas.RUN_LOG}, component STRING, log_date DATE").json(path)
