"""Spark-native lake for dated GeoJSON event feeds."""

from feedlake.operators import flatten
from feedlake.plans import (
    RunReport,
    load_silver,
    load_warehouse,
    run_backfill,
    run_daily,
    run_silver,
    to_silver,
)
from feedlake.schemas import FLAT, SILVER, WAREHOUSE, document_schema
from feedlake.session import feed_session
from feedlake.sources import read_documents, read_run, read_silver, split_documents
from feedlake.streaming import run_daily_stream, start_daily_stream

__all__ = [
    "FLAT",
    "SILVER",
    "WAREHOUSE",
    "RunReport",
    "document_schema",
    "feed_session",
    "flatten",
    "load_silver",
    "load_warehouse",
    "read_documents",
    "read_run",
    "read_silver",
    "run_backfill",
    "run_daily",
    "run_daily_stream",
    "run_silver",
    "split_documents",
    "start_daily_stream",
    "to_silver",
]
