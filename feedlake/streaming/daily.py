"""Daily increment that takes the landing folders whose files are new.

The checkpoint remembers which files were seen.  A micro-batch does not read the new files
alone: it loads each day that they belong to as a whole, into a silver folder and a table
partition named after the stream, its checkpoint and the day.  So a day that is landed
again replaces itself, a day that gets more files is loaded once more with all of them, and
a batch that is run again after a failure between the writes and the checkpoint changes
nothing.  A file is seen whenever it comes, however old it is.

Documents that the batches of a stream set aside lie beside the silver rows of their day.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlake.operators.layout import counted
from feedlake.plans.runs import lenient, rejected_path, silver_rows
from feedlake.schemas import DISPOSITION
from feedlake.sinks.tables import LOAD_ID, load_append_each
from feedlake.sources.landing import DAILY, FAILFAST, TEXT, read_documents, run_path
from feedlake.sources.silver import read_silver

# The file source forgets files that are older than the newest one by its limit, a
# week by default, and never reads them; this one is beyond the age of any file.
_ANY_AGE = "36500d"

# Days of one batch whose silver is written at a time; each is a job of its own.
_DAYS_AT_A_TIME = 8


@dataclass(frozen=True)
class DayLoad:
    """What a stream did with one day: rows it wrote to silver and documents it set aside."""

    batch_id: int
    run_date: str
    load_id: str
    silver_path: str
    records: int
    rejected: int = 0
    rejected_path: str | None = None


def start_daily_stream(
    spark: SparkSession,
    *,
    landing: str,
    silver: str,
    table: str,
    checkpoint: str,
    stream_name: str | None = None,
    as_of: datetime | None = None,
    area: str = "regex",
    epoch: str = "guarded",
    silver_format: str = "parquet",
    layout: str = TEXT,
    strict: bool = True,
    mode: str = FAILFAST,
    max_files_per_batch: int | None = None,
    max_bytes_per_batch: int | None = None,
    on_load: Callable[[DayLoad], None] | None = None,
) -> StreamingQuery:
    """Start taking the days of all landing files that are there now and not yet seen.

    Loads are named after ``stream_name``, if any, a digest of the checkpoint folder and the
    day.  ``layout``, ``strict`` and ``mode`` are those of a batch run.  A large backlog is
    taken in several batches with ``max_files_per_batch`` or ``max_bytes_per_batch`` (one of
    them); a day whose files fall into several is loaded in each.  ``on_load`` is told of
    every day once its rows are in the table.
    """
    name = "-".join(filter(None, [stream_name, hashlib.sha256(checkpoint.encode()).hexdigest()[:12]]))
    root = f"{silver.rstrip('/')}/run_kind={DAILY}"

    def silver_of_day(session: SparkSession, batch_id: int, day: str) -> DayLoad:
        load_id = f"{name}-{day}"
        path = f"{root}/{LOAD_ID}={load_id}"
        folder = run_path(landing, DAILY, day)
        raw = read_documents(session, folder, mode=mode, keep_text=lenient(strict, mode), layout=layout)
        rows = silver_rows(raw, strict=strict, mode=mode, area=area, epoch=epoch, as_of=as_of)
        rows, seen = counted(rows, f"{load_id}-{batch_id}")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if DISPOSITION in rows.columns:
            writer = writer.partitionBy(DISPOSITION)
        writer.format(silver_format).save(path)
        aside = rejected_path(path) if lenient(strict, mode) else None
        return DayLoad(batch_id, day, load_id, path, **seen.get, rejected_path=aside)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # One row per day that is new, at most as many as there are folders.
        days = sorted(row["day"] for row in batch.distinct().collect())
        if not days:
            return
        with ThreadPoolExecutor(_DAYS_AT_A_TIME) as pool:
            loads = list(pool.map(lambda day: silver_of_day(session, batch_id, day), days))
        rows = read_silver(
            session, [one.silver_path for one in loads], fmt=silver_format, base_path=root, keep=[LOAD_ID]
        )
        # The session of a stream is its own, so this holds for its loads alone.
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        load_append_each(rows, table, {one.load_id: one.records for one in loads})
        # The session that started the stream may remember files that are gone.
        spark.catalog.refreshTable(table)
        for one in loads:
            if on_load is not None:
                on_load(one)

    # Only the names of the files are taken: their content is not read here.
    reader = spark.readStream.format("binaryFile").option("maxFileAge", _ANY_AGE)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if max_bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = reader.schema(schema).load(f"{landing.rstrip('/')}/run_kind={DAILY}/*/*")
    day = F.regexp_extract("path", "/ingest_date=([^/]+)/", 1)
    return (
        files.select(day.alias("day"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_daily_stream(
    spark: SparkSession, *, timeout: int | None = None, on_load: Callable[[DayLoad], None] | None = None, **options
) -> list[DayLoad]:
    """:func:`start_daily_stream`, then wait until it is through; the loads it made.

    ``timeout`` is in seconds; a stream that is not through by then is stopped
    and reported, and the next call goes on where it stood.
    """
    loads: list[DayLoad] = []

    def told(load: DayLoad) -> None:
        loads.append(load)
        if on_load is not None:
            on_load(load)

    query = start_daily_stream(spark, on_load=told, **options)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"daily stream not through after {timeout} s")
    return loads
