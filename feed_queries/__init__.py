"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feed_queries import flattening, runs, scalars, scans, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Query, str]] = {
    **scans.QUERIES,
    **flattening.QUERIES,
    **scalars.QUERIES,
    **sinks.QUERIES,
    **tables.QUERIES,
    **runs.QUERIES,
}
