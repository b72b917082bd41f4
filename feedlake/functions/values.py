"""Casts and row rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions._columns import as_column


def null_safe_float(value: Column | str, *, strict: bool = True) -> Column:
    """32-bit float of any number or number text; NULL stays NULL.

    Dirty text is an error, or NULL with ``strict=False``.
    """
    value = as_column(value)
    return (value.cast("double") if strict else value.try_cast("double")).cast("float")


def whole_number(value: Column | str, dtype: str = "int") -> Column:
    """Integer of a number (``43.0`` gives 43); NULL where it does not fit."""
    return as_column(value).try_cast(dtype)


def row_json(frame: DataFrame, *, ignore_null_fields: bool = True) -> Column:
    """Each row of ``frame`` as one JSON object; NULL fields are left out."""
    fields = F.struct(*[F.col(f"`{name}`") for name in frame.columns])
    return F.to_json(fields, {"ignoreNullFields": str(ignore_null_fields).lower()})
