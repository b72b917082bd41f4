"""The runs: backfill, daily increment, raw to silver, silver to warehouse.

Each stage reads what the stage before it wrote, so a lost executor only costs
the tasks it ran.  No stage shuffles and none collects; the row count of a run
comes from the write itself.

A document that cannot be parsed stops a run, and so does one without a
``features`` member.  With ``mode="PERMISSIVE"`` the first kind, and with
``strict=False`` the second, is set aside whole: the write that makes silver deals its rows
by disposition, so both folders and both counts come from one parse and one job.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import run_tag
from feedlake.operators.flatten import flatten
from feedlake.operators.layout import counted, laid_out
from feedlake.plans.silver import to_silver
from feedlake.schemas import ACCEPTED, CORRUPT, DISPOSITION, REJECTED, REJECTED_TEXT
from feedlake.sinks.files import land_documents, write_silver
from feedlake.sinks.tables import (
    load_append,
    load_autodetected,
    load_overwrite,
    table_rows,
)
from feedlake.sources.landing import (
    BACKFILL,
    DAILY,
    FAILFAST,
    PERMISSIVE,
    TEXT,
    parse_documents,
    read_documents,
    read_split_documents,
    read_text_documents,
    run_path,
)
from feedlake.sources.silver import read_silver

OVERWRITE = "overwrite"
APPEND = "append"
_LOADS = {OVERWRITE: load_overwrite, APPEND: load_append}
_MODE_OF = {BACKFILL: OVERWRITE, DAILY: APPEND}


@dataclass(frozen=True)
class RunReport:
    """What a run did: rows it wrote to silver, documents it set aside (and where), and
    rows of the table after it."""

    run_kind: str
    run_date: str
    silver_path: str
    records: int
    rejected: int = 0
    rejected_path: str | None = None
    table: str | None = None
    table_rows: int | None = None


def lenient(strict: bool, mode: str) -> bool:
    """Whether a run sets documents aside."""
    return not strict or mode == PERMISSIVE


def dealt(raw: DataFrame, *, strict: bool, mode: str) -> DataFrame:
    """Parsed documents, with their text, as features of accepted ones and one row per rejected one.

    A rejected document gets one empty feature, so that it comes through the flattening as
    a row of its own, with its text in ``value``.
    """
    unfit = F.lit(False)
    if mode == PERMISSIVE:
        unfit = unfit | F.col(CORRUPT).isNotNull()
    if not strict:
        unfit = unfit | F.col("features").isNull()
    kind = raw.schema["features"].dataType.simpleString()
    nothing = F.array(F.lit(None)).cast(kind)
    return raw.select(
        F.when(unfit, REJECTED).otherwise(ACCEPTED).alias(DISPOSITION),
        F.when(unfit, F.col("value")).alias(REJECTED_TEXT),
        F.when(unfit, nothing).otherwise(F.col("features")).alias("features"),
    )


def silver_rows(raw: DataFrame, *, strict: bool, mode: str, **derive) -> DataFrame:
    """Parsed documents to silver rows; those of a lenient run with their disposition."""
    if not lenient(strict, mode):
        return to_silver(flatten(raw, strict=strict), **derive)
    rows = dealt(raw, strict=strict, mode=mode)
    return to_silver(flatten(rows, strict=strict, keep=[DISPOSITION, REJECTED_TEXT]), **derive)


def rejected_path(silver_path: str) -> str:
    """Folder of the documents that the run of a silver folder set aside, if it did."""
    return f"{silver_path}/{DISPOSITION}={REJECTED}"


def run_feed(
    spark: SparkSession,
    run_kind: str,
    *,
    landing: str,
    silver: str,
    table: str,
    documents: DataFrame | None = None,
    as_of: datetime | None = None,
    run_date: str | None = None,
    area: str = "regex",
    epoch: str = "guarded",
    silver_format: str = "parquet",
    compression: str = "none",
    files: int | None = None,
    records_per_file: int = 0,
    multi_line: bool = False,
    split: bool = False,
    layout: str = TEXT,
    strict: bool = True,
    mode: str = FAILFAST,
    load_id: str | None = None,
    count_table: bool = True,
) -> RunReport:
    """Land, scan, flatten, derive, write silver, load the table.

    ``documents`` (strings in ``value``) are landed first; without them the run
    takes what lies in its landing folder already: one document per line, or per
    file with ``multi_line``, or per file and shared by many tasks with ``split``.
    Large delivered files are landed as pieces by
    ``documents=split_documents(spark, paths)``.  ``layout`` is that of landed
    documents, ``text`` or ``frames`` (small, and split at any size).
    ``run_date`` defaults to the day of ``as_of``.  ``area`` and ``epoch`` are
    those of :func:`feedlake.plans.to_silver`.  ``compression`` is that of landed
    text and JSON-lines silver.  Every scan task writes its own silver file;
    ``records_per_file`` bounds files and ``files`` their number.  The row report comes
    from the counts that loads keep with the table; ``count_table=False`` does without.
    """
    run_date = run_date or run_tag(as_of)
    if documents is not None:
        landed = land_documents(
            documents, landing, run_kind, run_date, compression=compression, layout=layout
        )
        multi_line = split = False
    else:
        landed = run_path(landing, run_kind, run_date)
    options = {"mode": mode, "keep_text": lenient(strict, mode)}
    if split:
        raw = read_split_documents(spark, landed, check=mode == FAILFAST, **options)
    else:
        raw = read_documents(spark, landed, multi_line=multi_line, layout=layout, **options)
    rows = silver_rows(raw, strict=strict, mode=mode, area=area, epoch=epoch, as_of=as_of)
    rows, observation = counted(rows, f"{run_kind}-{run_date}")
    silver_path = write_silver(
        rows if files is None else laid_out(rows, files),
        silver,
        run_kind,
        run_date,
        fmt=silver_format,
        compression=compression,
        records_per_file=records_per_file,
    )
    table_rows = load_silver(
        spark,
        silver=silver,
        table=table,
        run_date=run_date,
        run_kind=run_kind,
        silver_format=silver_format,
        load_id=load_id,
        count_table=count_table,
        records=observation.get["records"],
    )
    return RunReport(
        run_kind=run_kind,
        run_date=run_date,
        silver_path=silver_path,
        **observation.get,
        rejected_path=rejected_path(silver_path) if lenient(strict, mode) else None,
        table=table,
        table_rows=table_rows,
    )


def load_silver(
    spark: SparkSession,
    *,
    silver: str,
    table: str,
    run_date: str,
    run_kind: str = DAILY,
    mode: str | None = None,
    silver_format: str = "parquet",
    load_id: str | None = None,
    count_table: bool = True,
    records: int | None = None,
) -> int | None:
    """Load the silver folder of one run with the explicit schema; rows of the table after it.

    ``mode`` is ``overwrite`` or ``append``, by default what the kind of run does.  A load
    that failed is repeated by this alone.  ``records``, if known, are not counted again.
    """
    mode = mode or _MODE_OF[run_kind]
    if mode not in _LOADS:
        raise ValueError(f"mode is one of {sorted(_LOADS)}, not {mode!r}")
    rows = read_silver(spark, run_path(silver, run_kind, run_date), fmt=silver_format)
    _LOADS[mode](rows, table, load_id=load_id, records=records)
    return table_rows(spark, table) if count_table else None


def run_backfill(spark: SparkSession, **options) -> RunReport:
    """:func:`run_feed` that **replaces** the table."""
    return run_feed(spark, BACKFILL, **options)


def run_daily(spark: SparkSession, **options) -> RunReport:
    """:func:`run_feed` that **appends** to the table.

    A second run of the same day replaces its landing and silver folders and
    appends its rows again; give a ``load_id`` to make it replace them.
    """
    return run_feed(spark, DAILY, **options)


def run_silver(
    spark: SparkSession,
    *,
    landing: str,
    silver: str,
    run_kind: str = DAILY,
    as_of: datetime | None = None,
    run_date: str | None = None,
    area: str = "regex",
    epoch: str = "guarded",
    stamp: str = "text",
    silver_format: str = "json",
    compression: str = "none",
    strict: bool = True,
    mode: str = FAILFAST,
) -> RunReport:
    """Raw text lines to silver, without a table load."""
    run_date = run_date or run_tag(as_of)
    texts = read_text_documents(spark, run_path(landing, run_kind, run_date))
    raw = parse_documents(texts, mode=mode, keep_text=lenient(strict, mode))
    rows = silver_rows(raw, strict=strict, mode=mode, area=area, epoch=epoch, stamp=stamp, as_of=as_of)
    rows, observation = counted(rows, f"silver-{run_date}")
    silver_path = write_silver(
        rows, silver, run_kind, run_date, fmt=silver_format, compression=compression
    )
    return RunReport(
        run_kind=run_kind,
        run_date=run_date,
        silver_path=silver_path,
        **observation.get,
        rejected_path=rejected_path(silver_path) if lenient(strict, mode) else None,
    )


def load_warehouse(
    spark: SparkSession,
    *,
    silver: str,
    table: str,
    run_date: str,
    run_kind: str = DAILY,
    infer_timestamps: bool = False,
) -> int:
    """Replace ``table`` by the JSON-lines silver of one run, types inferred."""
    path = run_path(silver, run_kind, run_date)
    load_autodetected(spark, path, table, infer_timestamps=infer_timestamps)
    return table_rows(spark, table)
