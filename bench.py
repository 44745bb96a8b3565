"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

``BENCH_ALL=1`` times every registered query and prints each on stderr.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from gleanery.catalog import QUERIES

HEADLINE = (
    "stats_report", "rollup_by_org", "value_distribution", "grouped_percentiles", "top_organization_items", "tag_counts",
    "positional_items", "text_mentions", "derived_tags", "page_markdown", "page_fingerprints", "page_handles",
    "items_from_best_source", "items_from_listing", "diff_updated", "diff_removed", "diff_summary", "page_check_outcomes",
    "enriched_items", "carried_last_changed", "change_batch_sizes", "fixed_batches", "refreshed_snapshot",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot does not compile longer methods; beyond this Spark splits the projection instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = os.environ.get("BENCH_ALL") == "1"
    names = list(QUERIES) if every else [n for n in HEADLINE if n in QUERIES]
    QUERIES["global_totals"](spark, sf_dir).collect()  # start-up is not part of any query
    took: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        if every:
            print(name, took[name], file=sys.stderr, flush=True)
    total = round(sum(took.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
