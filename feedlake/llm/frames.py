"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(frame: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``frame`` begins with it."""
    while any(column.lower().startswith(name.lower()) for column in frame.columns):
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def once(sql: str) -> str:
    """SQL whose value is computed where it stands, once per row.

    The optimizer inlines a column into its users and pushes filters below it, also
    into functions over array elements, where it would be computed per element.  It
    leaves alone what is not deterministic, as a row number is not.
    """
    return f"if(monotonically_increasing_id() < 0, NULL, {sql})"


def written(frame: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: a cut of its lineage."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.options(**(options or {})).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def with_column_in_arrow(
    frame: DataFrame,
    name: str,
    kind: T.DataType | str,
    values: Callable[[pa.RecordBatch], pa.Array],
    rows: int = 256,
) -> DataFrame:
    """``frame`` and one more column, computed in Arrow for ``rows`` rows at a time."""
    kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    schema = T.StructType([*frame.schema.fields, T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), rows):
                batch = whole.slice(begin, rows)
                columns = [*batch.columns, values(batch)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    return frame.mapInArrow(run, schema)


def share_of(hashed: Column, rows: int, total: int) -> Column:
    """Whether a uniform 64-bit hash is among the lowest, so that about ``rows`` of ``total`` are.

    A condition on each row alone: nothing is sorted, and no task sees the rows of others.
    """
    if total <= rows:
        return F.lit(True)
    return hashed < int(rows / total * (1 << 64)) - (1 << 63)


# Steps of a count histogram in each doubling; counts below this are told apart.
_STEPS = 16


def most_frequent(counts: DataFrame, most: int, key: str, n: str = "n") -> DataFrame:
    """Nearly ``most`` rows, those of the largest counts ``n``; of the last ones, a share by hash of ``key``.

    The counts that make the choice come from a histogram of at most 1,024 rows, so no task
    gathers the rows of others.
    """
    step = F.floor(F.log2(F.col(n)) * _STEPS)
    bars = counts.filter(F.col(n) > 0).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"), F.min(n).alias("least"))
    chosen, above, taken = F.lit(False), None, 0
    for row in sorted(bars.collect(), reverse=True):
        chosen = F.col(n) >= above if above is not None else F.lit(False)
        if taken + row["rows"] > most:
            # Less than there is room for, by four times what chance adds.
            room = most - taken
            some = share_of(F.xxhash64(key), max(int(room - 4 * room**0.5), 0), row["rows"])
            chosen = chosen | ((F.col(n) >= row["least"]) & some)
            break
        taken, above = taken + row["rows"], row["least"]
        chosen = F.col(n) >= above
    return counts.filter(chosen)


def remainder(column: str, modulus: int):
    """crc32 of a column as text, modulo ``modulus``; a null counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus
