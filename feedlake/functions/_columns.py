from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def once(column: Column) -> Column:
    """``column``, computed where it stands and nowhere else.

    The optimizer infers filters from an explode and pushes them below it, with copies
    of what they look at.  It leaves alone what is not deterministic, as a row number is not.
    """
    return F.when(F.monotonically_increasing_id() < 0, F.lit(None)).otherwise(column)
