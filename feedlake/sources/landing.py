"""Scans of raw ``FeatureCollection`` documents.

Two shapes of landing data are read:

* *delivered* files, one document per file, possibly spread over many lines.
  ``read_documents(multi_line=True)`` gives each file to one task;
  :func:`read_split_documents` lets many tasks share a large one;
* *landed* files, one single-line document per row, many rows per file, as
  :func:`feedlake.sinks.land_documents` writes them.  They split at line ends.

All of them read text and go through :func:`parse_documents`, which parses each text
once, as a list of one document: whatever stands before or after the document makes
the text malformed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions._columns import once
from feedlake.schemas import CORRUPT, document_schema
from feedlake.sources.split import split_documents

# The two kinds of run, and the file name prefix of each.
BACKFILL = "backfill"
DAILY = "daily"
_FILE_PREFIX = {BACKFILL: "", DAILY: "daily"}

_JSON_BLANKS = " \t\r\n"

# How landed documents lie: a text line each, or rows of compressed frames.
TEXT, FRAMES = "text", "frames"

FAILFAST = "FAILFAST"
PERMISSIVE = "PERMISSIVE"


def _checked_kind(run_kind: str) -> str:
    if run_kind not in _FILE_PREFIX:
        raise ValueError(f"run_kind is {BACKFILL!r} or {DAILY!r}, not {run_kind!r}")
    return run_kind


def checked_layout(layout: str) -> str:
    if layout not in (TEXT, FRAMES):
        raise ValueError(f"layout is {TEXT!r} or {FRAMES!r}, not {layout!r}")
    return layout


def run_path(root: str, run_kind: str, run_date: str) -> str:
    """Folder of one run below a landing or silver root."""
    return f"{root.rstrip('/')}/run_kind={_checked_kind(run_kind)}/ingest_date={run_date}"


def run_file_glob(run_kind: str, run_date: str) -> str:
    """Name of the delivered file of one run, for ``read_documents(glob=...)``."""
    return f"{_FILE_PREFIX[_checked_kind(run_kind)]}{run_date}.json"


def read_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    multi_line: bool = False,
    mode: str = FAILFAST,
    columns: Iterable[str] | None = None,
    keep_text: bool = False,
    glob: str | None = None,
    base_path: str | None = None,
    layout: str = TEXT,
) -> DataFrame:
    """Documents as ``features`` (an array of structs), one row each.

    ``layout`` is that of landed documents, ``text`` or ``frames``; frames are dealt to
    tasks like lines.  ``columns`` limits the parse to the named flat columns.  A malformed document
    stops the read; with ``mode="PERMISSIVE"`` its text is kept in
    ``_corrupt_record`` instead and its ``features`` are NULL.  Blank lines are no
    documents.
    """
    reader = spark.read
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    paths = [paths] if isinstance(paths, str) else list(paths)
    if checked_layout(layout) == FRAMES:
        texts = reader.schema("value string").parquet(*paths)
    else:
        texts = reader.text(paths, wholetext=multi_line)
    parse = parse_documents if multi_line else parse_lines
    return parse(texts, mode=mode, columns=columns, keep_text=keep_text)


def read_split_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    mode: str = FAILFAST,
    columns: Iterable[str] | None = None,
    keep_text: bool = False,
    **options,
) -> DataFrame:
    """:func:`split_documents` parsed: ``features`` of one feature per row."""
    texts = split_documents(spark, paths, **options)
    return parse_documents(texts, mode=mode, columns=columns, keep_text=keep_text)


def read_run(
    spark: SparkSession,
    landing: str,
    run_kind: str,
    run_dates: str | Sequence[str],
    **options,
) -> DataFrame:
    """Documents of the named runs, with ``run_kind`` and ``ingest_date``.

    Only the folders of these runs are listed, however many the landing zone has.
    """
    dates = [run_dates] if isinstance(run_dates, str) else list(run_dates)
    paths = [run_path(landing, run_kind, date) for date in dates]
    documents = read_documents(spark, paths, base_path=landing, **options)
    # Spark reads the folder name as a number; the run date is text.
    return documents.withColumn("ingest_date", F.col("ingest_date").cast("string"))


def read_chosen_runs(
    spark: SparkSession, landing: str, run_kind: str, runs: DataFrame, *, layout: str = TEXT, **options
) -> DataFrame:
    """Documents of the runs whose ``ingest_date`` is in the table ``runs``.

    The days are not known when the scan is planned: they come from the table as it runs
    and prune its folders, so files of other days are not opened.
    """
    place = f"{landing.rstrip('/')}/run_kind={_checked_kind(run_kind)}"
    if checked_layout(layout) == FRAMES:
        texts = spark.read.schema("value string, ingest_date string").parquet(place)
    else:
        texts = spark.read.schema("value string, ingest_date string").text(place)
    # Spark prunes by a table that a condition has chosen from; all dates fulfil this one.
    days = runs.select(F.col("ingest_date").cast("string").alias("ingest_date")).filter("ingest_date > ''")
    return parse_lines(texts.join(days, "ingest_date", "left_semi"), **options)


def read_text_documents(
    spark: SparkSession, paths: str | Sequence[str], *, whole_text: bool = False
) -> DataFrame:
    """One string ``value`` per line, or per file with ``whole_text=True``."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=whole_text)


def parse_lines(lines: DataFrame, **options) -> DataFrame:
    """:func:`parse_documents` of text lines in ``value``; blank ones are no documents."""
    return parse_documents(lines.filter(F.trim(F.col("value"), F.lit(_JSON_BLANKS)) != ""), **options)


def parse_documents(
    texts: DataFrame,
    column: str = "value",
    *,
    mode: str = FAILFAST,
    columns: Iterable[str] | None = None,
    keep_text: bool = False,
) -> DataFrame:
    """JSON strings to ``features``, next to the other columns of ``texts``.

    Every string is one document and is parsed once.  A malformed one is an error, or
    with ``mode="PERMISSIVE"`` has NULL ``features`` and its text in ``_corrupt_record``.
    A NULL string has NULL ``features``.  ``keep_text`` keeps the string beside them.
    """
    if mode not in (FAILFAST, PERMISSIVE):
        raise ValueError(f"mode is {FAILFAST!r} or {PERMISSIVE!r}, not {mode!r}")
    text = F.trim(F.col(f"`{column}`"), F.lit(_JSON_BLANKS))
    # A list of one: text after the document would make a second member, or an error.
    listed = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(document_schema(columns)), {"mode": mode}
    )
    whole = F.size("documents").eqNullSafe(1) & text.endswith("}") & F.get("documents", F.lit(0)).isNotNull()
    others = [F.col(f"`{name}`") for name in texts.columns if keep_text or name != column]
    parsed = texts.withColumn("documents", once(listed))
    features = F.get("documents", F.lit(0))["features"]
    if mode == PERMISSIVE:
        bad = text.isNotNull() & ~whole
        return parsed.select(
            *others, F.when(~bad, features).alias("features"), F.when(bad, F.col(f"`{column}`")).alias(CORRUPT)
        )
    wrong = F.raise_error(F.concat(F.lit("malformed document: "), F.substring(text, -80, 80)))
    return parsed.select(
        *others, once(F.when(text.isNull() | whole, features).otherwise(wrong)).alias("features")
    )
