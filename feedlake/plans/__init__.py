"""User-level compositions of sources, operators and sinks."""

from feedlake.plans.runs import (
    RunReport,
    load_silver,
    load_warehouse,
    run_backfill,
    run_daily,
    run_silver,
)
from feedlake.plans.silver import to_silver

__all__ = [
    "RunReport",
    "load_silver",
    "load_warehouse",
    "run_backfill",
    "run_daily",
    "run_silver",
    "to_silver",
]
