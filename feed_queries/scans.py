"""Scans: landing documents, text lines, silver lines, inferred types, one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feed_queries.feed import (
    AS_OF,
    COMPRESSION,
    FLAT_SQL,
    WAREHOUSE_SQL,
    day_documents,
    landing,
    prepared,
    table,
)
from feedlake.operators import flatten
from feedlake.plans import to_silver
from feedlake.sinks import write_jsonl
from feedlake.sources import (
    DAILY,
    parse_documents,
    read_autodetect,
    read_chosen_runs,
    read_documents,
    read_run,
    read_silver,
    read_split_documents,
    read_text_documents,
)

_COLUMNS = ("mag", "place", "time", "tz", "felt", "longitude", "depth")
_WITH_ID = f"SELECT CAST(event_id AS VARCHAR) AS id, {', '.join(_COLUMNS)} FROM flat"


def delivered(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """All events as files with one document each; returns the folder."""

    def write(path: str) -> None:
        docs = day_documents(spark, sf_dir, 5000).select("value")
        docs.write.option("maxRecordsPerFile", 1).text(path, compression=compression)

    return prepared(spark, sf_dir, f"delivered-{compression}", write)


def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered files, each read by one task; several lines allowed.

    A file that one task reads may be compressed; those to be split may not.
    """
    path = delivered(spark, sf_dir, COMPRESSION)
    raw = read_documents(spark, path, multi_line=True, columns=_COLUMNS)
    return flatten(raw, _COLUMNS, keep_id=True)


def split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered files, each shared by as many tasks as its size asks for."""
    raw = read_split_documents(spark, delivered(spark, sf_dir), columns=_COLUMNS)
    return flatten(raw, _COLUMNS, keep_id=True)


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files: one document per line, parsed from the string."""
    lines = read_text_documents(spark, landing(spark, sf_dir)).select("value")
    return flatten(parse_documents(lines, columns=_COLUMNS), _COLUMNS, keep_id=True)


def dated_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of one daily run out of all that are in the landing zone."""
    raw = read_run(spark, landing(spark, sf_dir), DAILY, "20240115", columns=_COLUMNS)
    return flatten(raw, _COLUMNS, keep=["ingest_date"], keep_id=True)


def chosen_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the days whose number of purchases is a multiple of three."""
    by_day = """SELECT date_format(ts, 'yyyyMMdd') AS ingest_date FROM {events}
                WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) % 3 = 0"""
    runs = spark.sql(by_day, events=table(spark, sf_dir, "events"))
    raw = read_chosen_runs(spark, landing(spark, sf_dir), DAILY, runs, columns=_COLUMNS)
    return flatten(raw, _COLUMNS, keep=["ingest_date"], keep_id=True)


def silver_lines(spark: SparkSession, sf_dir: str) -> str:
    """All events as JSON-lines silver; returns the folder."""

    def write(path: str) -> None:
        rows = to_silver(flatten(read_documents(spark, landing(spark, sf_dir))), as_of=AS_OF)
        write_jsonl(rows, path, compression=COMPRESSION)

    return prepared(spark, sf_dir, "silver", write)


def silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, silver_lines(spark, sf_dir))


def autodetect_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_autodetect(spark, silver_lines(spark, sf_dir))


# Columns without any value do not appear, and the zone offset stays text.
AUTODETECT_SQL = f"""
WITH {WAREHOUSE_SQL}
SELECT w.* EXCLUDE (tz, detail, mmi), s.tz
FROM warehouse w JOIN (SELECT code, tz FROM silver) s USING (code)
"""

QUERIES = {
    "q_landing_scan": (landing_scan, f"WITH {FLAT_SQL} {_WITH_ID}"),
    "q_split_scan": (split_scan, f"WITH {FLAT_SQL} {_WITH_ID}"),
    "q_text_scan": (text_scan, f"WITH {FLAT_SQL} {_WITH_ID}"),
    "q_silver_scan": (silver_scan, f"WITH {WAREHOUSE_SQL} SELECT * FROM warehouse"),
    "q_autodetect_scan": (autodetect_scan, AUTODETECT_SQL),
    "q_chosen_scan": (
        chosen_scan,
        f"""WITH {FLAT_SQL}
        SELECT ingest_date, CAST(event_id AS VARCHAR) AS id, {', '.join(_COLUMNS)} FROM flat
        WHERE ingest_date IN (
          SELECT ingest_date FROM flat WHERE status = 'purchase' GROUP BY ingest_date HAVING count(*) % 3 = 0)""",
    ),
    "q_dated_scan": (
        dated_scan,
        f"WITH {FLAT_SQL} SELECT ingest_date, CAST(event_id AS VARCHAR) AS id, "
        f"{', '.join(_COLUMNS)} FROM flat WHERE ingest_date = '20240115'",
    ),
}
