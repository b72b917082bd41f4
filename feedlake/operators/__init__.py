"""DataFrame operators: flattening, typed projections, user rows, file layout."""

from feedlake.operators.casts import to_warehouse
from feedlake.operators.flatten import (
    coordinates,
    explode_features,
    flatten,
    properties_flatten,
    typed_projection,
)
from feedlake.operators.layout import counted, laid_out, record_count
from feedlake.operators.rows import flat_map_rows, map_rows

__all__ = [
    "coordinates",
    "counted",
    "explode_features",
    "flat_map_rows",
    "flatten",
    "laid_out",
    "map_rows",
    "properties_flatten",
    "record_count",
    "to_warehouse",
    "typed_projection",
]
