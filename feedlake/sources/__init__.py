"""Scans of the landing zone and of the silver layer."""

from feedlake.sources.landing import (
    BACKFILL,
    DAILY,
    FAILFAST,
    FRAMES,
    PERMISSIVE,
    TEXT,
    parse_documents,
    read_chosen_runs,
    read_documents,
    read_run,
    read_split_documents,
    read_text_documents,
    run_file_glob,
    run_path,
)
from feedlake.sources.silver import read_autodetect, read_rejected, read_silver
from feedlake.sources.split import split_documents

__all__ = [
    "BACKFILL",
    "DAILY",
    "FAILFAST",
    "FRAMES",
    "PERMISSIVE",
    "TEXT",
    "parse_documents",
    "read_autodetect",
    "read_chosen_runs",
    "read_documents",
    "read_rejected",
    "read_run",
    "read_silver",
    "read_split_documents",
    "read_text_documents",
    "run_file_glob",
    "run_path",
    "split_documents",
]
