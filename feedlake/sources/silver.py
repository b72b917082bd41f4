"""Scans of the silver layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions import whole_number
from feedlake.operators.casts import to_warehouse
from feedlake.schemas import ACCEPTED, DISPOSITION, REJECTED_TEXT, SILVER, WAREHOUSE


# Folder of the types of JSON lines, beside them; readers skip names that begin like this.
TYPES = "_types"


def read_silver(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    fmt: str = "json",
    base_path: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Silver files with the 31 warehouse columns and types; absent ones are NULL.

    Of silver that was dealt by disposition only the folder of accepted rows is read.
    ``keep`` names folder columns below ``base_path`` that are kept, as text.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    kept = [F.col(name).cast("string").alias(name) for name in keep]
    if fmt == "parquet":
        rows = _accepted(reader.schema(SILVER).parquet(*paths))
        return to_warehouse(rows, keep=kept)
    if fmt != "json":
        raise ValueError(f"silver is 'json' or 'parquet', not {fmt!r}")
    # The offset is JSON text in silver; read straight as a number it would be NULL.
    on_disk = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == "tz" else f for f in WAREHOUSE.fields]
    )
    rows = _accepted(reader.schema(on_disk).option("mode", "FAILFAST").json(paths))
    return rows.withColumn("tz", whole_number("tz", "bigint")).select(*WAREHOUSE.names, *kept)


def _accepted(rows: DataFrame) -> DataFrame:
    """Rows without those of rejected documents, whose files are not opened."""
    if DISPOSITION not in rows.columns:
        return rows
    return rows.filter(F.col(DISPOSITION) == ACCEPTED).drop(DISPOSITION)


def accepted_folder(path: str) -> str:
    """Where the accepted rows of silver that was dealt by disposition lie."""
    return f"{path.rstrip('/')}/{DISPOSITION}={ACCEPTED}"


def _lines_of(spark: SparkSession, path: str) -> str:
    """The folder of the accepted rows of silver; folders are listed, no file is opened."""
    dealt = DISPOSITION in spark.read.schema(f"{REJECTED_TEXT} string").text(path).columns
    return accepted_folder(path) if dealt else path


def _written_types(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """What inference would say of folders whose types were written with them, else None."""
    kinds: dict[str, str] = {}
    for path in paths:
        try:
            rows = spark.read.schema("name string, kind string").json(f"{path.rstrip('/')}/{TYPES}").collect()
        except AnalysisException:  # written by others
            return None
        for name, kind in rows:
            before = kinds.get(name, kind)
            # Whole numbers and others are numbers; any other two types are text.
            kinds[name] = kind if before == kind else "double" if {before, kind} == {"bigint", "double"} else "string"
    if not kinds:
        return None
    return T.StructType([T.StructField(name, T._parse_datatype_string(kinds[name])) for name in sorted(kinds)])


def read_rejected(spark: SparkSession, path: str, *, fmt: str = "json") -> DataFrame:
    """The whole texts, in ``value``, of the documents that a run set aside in ``path``."""
    return spark.read.schema(f"{REJECTED_TEXT} string").format(fmt).load(path)


def read_autodetect(
    spark: SparkSession, paths: str | Sequence[str], *, infer_timestamps: bool = False
) -> DataFrame:
    """JSON lines with types inferred from all of the data.

    Folders that :func:`feedlake.sinks.write_jsonl` wrote have their types beside them, and
    are read once.  For others, and to find timestamps, inference is one more pass over the
    files, so prefer :func:`read_silver` where the schema is known.  With ``infer_timestamps`` texts such as
    ``2024-10-21 08:08:33`` become timestamps.
    """
    reader = spark.read.option("inferTimestamp", infer_timestamps)
    if infer_timestamps:
        reader = reader.option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    paths = [paths] if isinstance(paths, str) else list(paths)
    folders = [_lines_of(spark, path) for path in paths]
    types = None if infer_timestamps else _written_types(spark, folders)
    return (reader if types is None else reader.schema(types)).json(folders)
