"""File sinks.  Every executor writes its own part; nothing passes the driver.

A run owns one folder per layer (``run_kind=.../ingest_date=...``) and replaces
it as a whole, so a rerun of the same day leaves no stale files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from feedlake.schemas import ACCEPTED, DISPOSITION, REJECTED_TEXT
from feedlake.sources.landing import FRAMES, TEXT, checked_layout, run_path
from feedlake.sources.silver import TYPES, accepted_folder

# Text in one frame of a landed file, before compression.
FRAME_BYTES = 32 << 20


def _one_line(column: str) -> Column:
    """A document on one line; one with a bare line break inside a string is broken."""
    text = F.col(column)
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<struct<type: string>>")
    broken = F.raise_error(F.lit("malformed document: a line break inside a string, or no JSON"))
    one_line = F.when(parsed.isNotNull(), F.translate(text, "\r\n", "  ")).otherwise(broken)
    return F.when(text.rlike(r"[\r\n]"), one_line).otherwise(text).alias("value")


def write_documents_text(
    documents: DataFrame, path: str, column: str = "value", *, compression: str = "none"
) -> str:
    """Documents as text, one line each.

    Line breaks between JSON tokens become blanks; inside a JSON string a line break
    must be escaped, so no text changes.  A document with a bare one there is broken;
    it stops the write, as a blank in its place would hide that.  ``gzip`` makes files
    about a tenth of the size, each of which one task reads as a whole; see
    :func:`write_documents_framed` for files that are small and split.
    """
    documents.select(_one_line(column)).write.mode("overwrite").text(path, compression=compression)
    return path


def write_documents_framed(
    documents: DataFrame,
    path: str,
    column: str = "value",
    *,
    compression: str = "zstd",
    frame_bytes: int = FRAME_BYTES,
) -> str:
    """Documents as rows of Parquet files whose row groups are frames of bounded size.

    Each frame is compressed alone and found through the footer of its file, so a landed
    file of any size is read by as many tasks as its compressed size asks for.
    """
    writer = documents.select(_one_line(column)).write.mode("overwrite")
    # Text does not repeat, so a dictionary would only be tried and thrown away.
    writer = writer.option("parquet.block.size", frame_bytes).option("parquet.enable.dictionary", "false")
    # Rows are counted before a writer first looks at the size of its frame.
    writer = writer.option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1)
    writer.parquet(path, compression=compression)
    return path


def land_documents(
    documents: DataFrame,
    landing: str,
    run_kind: str,
    run_date: str,
    *,
    column: str = "value",
    compression: str = "none",
    layout: str = TEXT,
) -> str:
    """Keep the raw documents of one run; returns the folder.

    ``layout`` is ``text`` (a line per document) or ``frames`` (rows in compressed frames).
    """
    path = run_path(landing, run_kind, run_date)
    if checked_layout(layout) == FRAMES:
        return write_documents_framed(documents, path, column)
    return write_documents_text(documents, path, column, compression=compression)


def write_jsonl(
    rows: DataFrame, path: str, *, compression: str = "none", records_per_file: int = 0
) -> str:
    """One JSON object per line; NULL fields are left out.

    What type a reader would infer for each column is counted on the way and written below
    ``_types``, so :func:`feedlake.sources.read_autodetect` need not read the lines for it.
    """
    dealt = DISPOSITION in rows.columns
    columns = [f for f in rows.schema.fields if not (dealt and f.name in (DISPOSITION, REJECTED_TEXT))]
    kinds = [_INFERRED.get(f.dataType.simpleString()) for f in columns]
    plain = None not in kinds
    seen = Observation()
    if plain:
        rows = rows.observe(seen, *_type_counts(columns, kinds, dealt))
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", records_per_file)
    if dealt:
        writer = writer.partitionBy(DISPOSITION)
    writer.json(path, compression=compression)
    if plain:
        found = seen.get
        types = [
            (field.name, "string" if found.get(f"odd{i}") else kind)
            for i, (field, kind) in enumerate(zip(columns, kinds))
            if found[f"n{i}"]
        ]
        lines = rows.sparkSession.createDataFrame(types, "name string, kind string").coalesce(1)
        lines.write.mode("overwrite").json(f"{accepted_folder(path) if dealt else path}/{TYPES}")
    return path


# What inference makes of the JSON of a type; a number with a point or exponent is a double.
_INFERRED = {
    "tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint", "float": "double",
    "double": "double", "boolean": "boolean", "string": "string", "date": "string", "timestamp": "string",
    "timestamp_ntz": "string",
}


def _type_counts(columns: list[StructField], kinds: list[str], dealt: bool) -> list[Column]:
    """For each column how many accepted rows have a value, and one that is no plain number."""
    taken = F.col(DISPOSITION) == ACCEPTED if dealt else F.lit(True)
    counts = []
    for i, (field, kind) in enumerate(zip(columns, kinds)):
        value = F.col("`" + field.name.replace("`", "``") + "`")
        counts.append(F.count_if(taken & value.isNotNull()).alias(f"n{i}"))
        if kind == "double":  # written as text
            counts.append(F.count_if(taken & (F.isnan(value) | (F.abs(value) == float("inf")))).alias(f"odd{i}"))
    return counts


def write_parquet(rows: DataFrame, path: str, *, records_per_file: int = 0) -> str:
    """Columnar files; with ``records_per_file`` none has more rows than that."""
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", records_per_file)
    if DISPOSITION in rows.columns:
        writer = writer.partitionBy(DISPOSITION)
    writer.parquet(path)
    return path


def write_silver(
    rows: DataFrame,
    silver: str,
    run_kind: str,
    run_date: str,
    *,
    fmt: str = "parquet",
    compression: str = "none",
    records_per_file: int = 0,
) -> str:
    """Silver rows of one run as ``parquet`` or ``json`` lines; returns the folder.

    ``compression`` is that of JSON lines; Parquet compresses its own pages.  Rows that
    have a ``disposition`` are dealt by it: one write makes a folder of accepted rows and
    one of rejected documents below that of the run.
    """
    if fmt not in ("json", "parquet"):
        raise ValueError(f"silver is 'json' or 'parquet', not {fmt!r}")
    path = run_path(silver, run_kind, run_date)
    if fmt == "json":
        return write_jsonl(rows, path, compression=compression, records_per_file=records_per_file)
    return write_parquet(rows, path, records_per_file=records_per_file)
