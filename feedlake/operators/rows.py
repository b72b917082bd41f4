"""User code over rows, the only place where Python sees the data.

Functions get pandas frames in Arrow batches, partition by partition.  Integers and
booleans have pandas' nullable types, so a NULL beside them changes no value.  Prefer
built-in expressions; use these for what they cannot say.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_NULLABLE = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
    pa.bool_(): pd.BooleanDtype(),
}


def map_rows(
    frame: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply ``fn`` batch by batch; it returns one row per row."""

    def checked(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        result = fn(batch)
        if len(result) != len(batch):
            raise ValueError(f"map_rows got {len(batch)} rows and gave {len(result)}")
        yield result

    return flat_map_rows(frame, checked, schema)


def flat_map_rows(
    frame: DataFrame,
    fn: Callable[[pd.DataFrame], Iterable[pd.DataFrame]],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply the generator ``fn`` batch by batch; it yields frames of any length."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kinds)
    nullable = _NULLABLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for result in fn(batch.to_pandas(types_mapper=nullable.get)):
                yield pa.RecordBatch.from_pandas(result, schema=arrow, preserve_index=False)

    return frame.mapInArrow(run, kinds)
