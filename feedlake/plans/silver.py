"""Flat rows to silver rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from feedlake.functions import (
    area_positional,
    area_regex,
    epoch_guarded,
    epoch_session,
    ingest_stamp,
    ingest_stamp_text,
)
from feedlake.schemas import STAMP_TEXT, STAMP_TIMESTAMP

_AREAS = {"regex": area_regex, "positional": area_positional}
_STAMPS = {
    "timestamp": (STAMP_TIMESTAMP, ingest_stamp),
    "text": (STAMP_TEXT, ingest_stamp_text),
}


def _choice(name: str, value: str, allowed) -> str:
    if value not in allowed:
        raise ValueError(f"{name} is one of {sorted(allowed)}, not {value!r}")
    return value


def to_silver(
    flat: DataFrame,
    *,
    area: str = "regex",
    epoch: str = "guarded",
    stamp: str = "timestamp",
    as_of: datetime | None = None,
) -> DataFrame:
    """Replace ``time`` and ``updated`` by text and add the area and the stamp.

    ``area``: ``regex`` or ``positional``.  ``epoch``: ``guarded`` (UTC, bad values
    NULL) or ``session`` (session zone).  ``stamp``: ``timestamp`` adds
    ``injection_date``, ``text`` adds ``insert_date``.
    """
    area_of = _AREAS[_choice("area", area, _AREAS)]
    stamp_name, stamp_of = _STAMPS[_choice("stamp", stamp, _STAMPS)]
    if _choice("epoch", epoch, {"guarded", "session"}) == "guarded":
        time, updated = epoch_guarded("time", "updated")
    else:
        time, updated = epoch_session("time"), epoch_session("updated")
    return flat.withColumns(
        {"time": time, "updated": updated, "area": area_of("place"), stamp_name: stamp_of(as_of)}
    )
