"""Silver rows to warehouse types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions import STAMP_FORMAT
from feedlake.schemas import WAREHOUSE


def to_warehouse(silver: DataFrame, *, keep: Sequence[Column] = ()) -> DataFrame:
    """The 31 silver columns with warehouse types, and the columns of ``keep``.

    A 32-bit float goes through its text, as it would through a JSON file: 1.1
    stays 1.1, where a direct cast gives 1.100000023841858.
    """

    def loaded(target: T.StructField) -> str:
        have = silver.schema[target.name].dataType
        name = f"`{target.name}`"
        if isinstance(target.dataType, T.DoubleType) and isinstance(have, T.FloatType):
            return f"cast(cast({name} AS string) AS double) AS {name}"
        if isinstance(target.dataType, T.LongType):
            return f"try_cast({name} AS bigint) AS {name}"
        if isinstance(have, T.TimestampType):
            return f'date_format({name}, "{STAMP_FORMAT}") AS {name}'
        return f"cast({name} AS {target.dataType.simpleString()}) AS {name}"

    return silver.select(*[F.expr(loaded(field)) for field in WAREHOUSE.fields], *keep)
