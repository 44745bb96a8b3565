"""Windows of change events: each handle once per window, sent on in bounded batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.registry import select_targets
from gleanery.operators.scans import number_within


def changes_per_window(events: DataFrame, width: str = "2 minutes", watermark: str | None = None, at: str = "at") -> DataFrame:
    """(window_start, window_end, handle, events): a handle counts once per window.

    With a watermark this runs on a stream in append mode; events later than it are dropped.
    """
    if watermark is not None:
        events = events.withWatermark(at, watermark)
    counted = events.groupBy(F.window(at, width).alias("_w"), "handle").agg(F.count("*").alias("events"))
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "handle", "events"
    )


def batch_sizes(changes: DataFrame) -> DataFrame:
    """Distinct handles and events per window."""
    return changes.groupBy("window_start", "window_end").agg(
        F.count("*").alias("batch_size"), F.sum("events").alias("events")
    )


def change_payloads(changes: DataFrame, handles: int = 1000) -> DataFrame:
    """Messages of ``handles`` handles, the last of a window with what is left: (window_start, window_end, part_no, changed_orgs, batch_size).

    Handles are numbered within their window over sorted ranges, so a busy window is more than one task.
    """
    window = ["window_start", "window_end"]
    placed = number_within(changes.select(*window, "handle"), window, ["handle"], "_place")
    parts = placed.withColumn("part_no", F.floor((F.col("_place") - 1) / handles) + 1)
    return parts.groupBy(*window, "part_no").agg(
        F.array_sort(F.collect_list("handle")).alias("changed_orgs"), F.count("*").alias("batch_size")
    )


def once_per_delay(events: DataFrame, delay: str, at: str = "at") -> DataFrame:
    """Stream of events with repeats of a handle within the watermark delay dropped."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(["handle"])


def stream_payloads(changes: DataFrame, path: str, checkpoint: str, handles: int = 1000):
    """Write the changes of finished windows and, from them, their messages.

    Each batch replaces its own folders under ``changes`` and ``messages``, so a retry does no harm. The
    changes are written before they are used twice, so the stateful part runs once per batch.
    """
    kinds = changes.schema

    def send(batch: DataFrame, batch_id: int) -> None:
        rows = f"{path}/changes/batch={batch_id}"
        batch.write.mode("overwrite").parquet(rows)
        landed = batch.sparkSession.read.schema(kinds).parquet(rows)
        change_payloads(landed, handles).write.mode("overwrite").json(f"{path}/messages/batch={batch_id}")

    return (
        changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(send).start()
    )


def targets_of(changes: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered organizations among the changed handles."""
    return select_targets(registry, changes.select("handle"))

