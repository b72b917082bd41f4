"""Schemas of the feed: landing document, flat row, silver row, warehouse row.

The landing document is a GeoJSON ``FeatureCollection``.  Every number is read as
the text it is written in, so that ``5``, ``5.0``, ``43.0`` and ``"4.5"`` are all
accepted and keep their value; the flat projection casts to the final type.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The 29 flat columns, in output order, with their types.
FLAT_COLUMNS = (
    ("mag", "float"),
    ("place", "string"),
    ("time", "string"),
    ("updated", "string"),
    ("tz", "string"),
    ("url", "string"),
    ("detail", "string"),
    ("felt", "int"),
    ("cdi", "float"),
    ("mmi", "float"),
    ("alert", "string"),
    ("status", "string"),
    ("tsunami", "int"),
    ("sig", "int"),
    ("net", "string"),
    ("code", "string"),
    ("ids", "string"),
    ("sources", "string"),
    ("types", "string"),
    ("nst", "int"),
    ("dmin", "float"),
    ("rms", "float"),
    ("gap", "float"),
    ("magType", "string"),
    ("type", "string"),
    ("title", "string"),
    ("longitude", "float"),
    ("latitude", "float"),
    ("depth", "float"),
)

# The columns that come from ``geometry.coordinates``, by position.
COORDINATES = ("longitude", "latitude", "depth")

# Names of the ingestion stamp, as a timestamp and as text.
STAMP_TIMESTAMP = "injection_date"
STAMP_TEXT = "insert_date"

CORRUPT = "_corrupt_record"

# What a run did with a document: the partition column of silver that was dealt by it, its
# two values, and the column with the whole text of a rejected one.
DISPOSITION = "disposition"
ACCEPTED, REJECTED = "accepted", "rejected"
REJECTED_TEXT = "value"

_FLAT_TYPES = {"float": T.FloatType(), "int": T.IntegerType(), "string": T.StringType()}
_WAREHOUSE_TYPES = {"float": T.DoubleType(), "int": T.LongType(), "string": T.StringType()}


def _struct(fields: Iterable[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


FLAT = _struct((name, _FLAT_TYPES[kind]) for name, kind in FLAT_COLUMNS)

SILVER = T.StructType(
    [
        *FLAT.fields,
        T.StructField("area", T.StringType(), True),
        T.StructField(STAMP_TIMESTAMP, T.TimestampType(), True),
    ]
)

# The time zone offset is text in the feed and a number in the warehouse; the
# ingestion stamp is a timestamp in silver and text in the warehouse.
WAREHOUSE = _struct(
    [
        *(
            (name, T.LongType() if name == "tz" else _WAREHOUSE_TYPES[kind])
            for name, kind in FLAT_COLUMNS
        ),
        ("area", T.StringType()),
        (STAMP_TIMESTAMP, T.StringType()),
    ]
)


def flat_schema(columns: Iterable[str] | None = None) -> T.StructType:
    """The flat schema, or the part of it named by ``columns`` in flat order."""
    if columns is None:
        return FLAT
    wanted = set(columns)
    unknown = wanted.difference(FLAT.names)
    if unknown:
        raise ValueError(f"not flat columns: {sorted(unknown)}")
    return T.StructType([field for field in FLAT.fields if field.name in wanted])


def document_schema(
    columns: Iterable[str] | None = None,
    *,
    keep_id: bool = True,
) -> T.StructType:
    """Read schema of a landing document.

    Spark prunes JSON only at the top level, so the nested fields that a query
    needs are declared here: name the flat ``columns`` and the parser skips the
    rest of each feature.
    """
    wanted = flat_schema(columns).names
    properties = _struct(
        (name, T.StringType())
        for name, _ in FLAT_COLUMNS
        if name in wanted and name not in COORDINATES
    )
    feature = []
    if properties.fields:
        feature.append(("properties", properties))
    if any(name in wanted for name in COORDINATES):
        feature.append(("geometry", _struct([("coordinates", T.ArrayType(T.StringType()))])))
    if keep_id:
        feature.append(("id", T.StringType()))
    return _struct([("features", T.ArrayType(_struct(feature)))])
