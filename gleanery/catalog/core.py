"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ZONE = "spark.sql.session.timeZone"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL of the same result if there is one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # NTZ columns are read as UTC instants, as the SQL does. A plan takes the zone when it is built; the session keeps its own.
            before = spark.conf.get(ZONE)
            spark.conf.set(ZONE, "UTC")
            try:
                return fn(spark, sf_dir)
            finally:
                spark.conf.set(ZONE, before)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add
