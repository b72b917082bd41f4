"""From documents to one flat, typed row per feature.  Map-only throughout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.schemas import COORDINATES, flat_schema

# How a column gets its flat type.  43.0 is 43 in an INT column, and what fits no
# INT is NULL; text that is no number is an error in a FLOAT column.
_TYPED = {
    "float": "cast(cast({0} AS double) AS float) AS {0}",
    "int": "try_cast(try_cast({0} AS double) AS int) AS {0}",
    "string": "cast({0} AS string) AS {0}",
}


def _quoted(names: Iterable[str]) -> list[str]:
    return [f"`{name}`" for name in names]


def explode_features(
    documents: DataFrame, *, strict: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per feature, in column ``f``; ``keep`` names document columns to carry.

    Documents with no features give no rows.  With ``strict`` a document without
    a ``features`` member is an error.
    """
    features = F.col("features")
    if strict:
        missing = F.raise_error(F.lit("document has no features member"))
        features = F.when(features.isNull(), missing).otherwise(features)
    return documents.select(*keep, F.explode(features).alias("f"))


def _coordinate_sql(positions: str) -> list[str]:
    return [f"get({positions}, {i}) AS {name}" for i, name in enumerate(COORDINATES)]


def coordinates(positions: str) -> list[Column]:
    """Longitude, latitude and depth of a coordinate array; NULL where it is short.

    ``positions`` names the array column.
    """
    return [F.expr(sql) for sql in _coordinate_sql(positions)]


def properties_flatten(
    features: DataFrame, *, keep: Sequence[str] = (), keep_id: bool = False
) -> DataFrame:
    """Lift the members of ``f.properties`` and the coordinates to columns.

    The geometry wins over a property of the same name.
    """
    feature = features.schema["f"].dataType
    columns = _quoted(keep)
    if "properties" in feature.names:
        columns += [
            f"f.properties.`{name}` AS `{name}`"
            for name in feature["properties"].dataType.names
            if name not in COORDINATES
        ]
    if "geometry" in feature.names:
        columns += _coordinate_sql("f.geometry.coordinates")
    if keep_id:
        columns.append("f.id AS id")
    return features.selectExpr(*columns)


def typed_projection(
    rows: DataFrame, columns: Iterable[str] | None = None, *, keep: Sequence[str] = ()
) -> DataFrame:
    """The flat columns in order with their types; extras dropped, absent ones NULL."""
    present = set(rows.columns)
    typed = []
    for field in flat_schema(columns).fields:
        kind = field.dataType.simpleString()
        if field.name in present:
            typed.append(_TYPED[kind].format(f"`{field.name}`"))
        else:
            typed.append(f"cast(NULL AS {kind}) AS `{field.name}`")
    return rows.selectExpr(*_quoted(keep), *typed)


def flatten(
    documents: DataFrame,
    columns: Iterable[str] | None = None,
    *,
    strict: bool = False,
    keep: Sequence[str] = (),
    keep_id: bool = False,
) -> DataFrame:
    """Documents to flat rows: explode, lift, type.

    ``keep`` carries document columns (such as ``ingest_date``) and ``keep_id``
    the feature id in front of the flat columns.
    """
    features = explode_features(documents, strict=strict, keep=keep)
    rows = properties_flatten(features, keep=keep, keep_id=keep_id)
    return typed_projection(rows, columns, keep=[*keep, *(["id"] if keep_id else [])])
