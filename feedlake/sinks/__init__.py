"""Sinks: landing text, silver files, catalog tables."""

from feedlake.sinks.connector import read_warehouse, register_warehouse
from feedlake.sinks.files import (
    land_documents,
    write_documents_framed,
    write_documents_text,
    write_jsonl,
    write_parquet,
    write_silver,
)
from feedlake.sinks.tables import (
    ensure_database,
    load_append,
    load_autodetected,
    load_direct,
    load_overwrite,
    read_table,
    recover,
    table_count,
    table_rows,
)

__all__ = [
    "ensure_database",
    "land_documents",
    "load_append",
    "load_autodetected",
    "load_direct",
    "load_overwrite",
    "read_table",
    "read_warehouse",
    "recover",
    "register_warehouse",
    "table_count",
    "table_rows",
    "write_documents_framed",
    "write_documents_text",
    "write_jsonl",
    "write_parquet",
    "write_silver",
]
