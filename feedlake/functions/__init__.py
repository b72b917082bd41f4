"""Column expressions of the feed; all of them run inside the JVM."""

from feedlake.functions.clock import (
    STAMP_FORMAT,
    epoch_guarded,
    epoch_session,
    ingest_stamp,
    ingest_stamp_text,
    run_date,
    run_tag,
    stamp_text,
)
from feedlake.functions.text import (
    area_positional,
    area_regex,
    of_position,
    strip,
    text_length,
)
from feedlake.functions.values import null_safe_float, row_json, whole_number

__all__ = [
    "STAMP_FORMAT",
    "area_positional",
    "area_regex",
    "epoch_guarded",
    "epoch_session",
    "ingest_stamp",
    "ingest_stamp_text",
    "null_safe_float",
    "of_position",
    "row_json",
    "run_date",
    "run_tag",
    "stamp_text",
    "strip",
    "text_length",
    "whole_number",
]
