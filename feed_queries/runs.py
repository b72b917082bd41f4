"""Whole runs over all events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feed_queries.feed import (
    AS_OF,
    COMPRESSION,
    EARLY,
    FLAT_SQL,
    LATE,
    RUN_DATE,
    SILVER_SQL,
    WAREHOUSE_SQL,
    documents,
    landing,
)
from feed_queries.scans import delivered
from feed_queries.tables import fresh_table
from feedlake.operators import flatten
from feedlake.plans import load_silver, run_backfill, run_daily, run_silver, to_silver
from feedlake.schemas import FLAT
from feedlake.session import scratch_path
from feedlake.sinks import land_documents, write_silver
from feedlake.sources import BACKFILL, DAILY, parse_documents, read_documents, read_rejected, split_documents
from feedlake.streaming import run_daily_stream


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to silver in one plan: parse, explode, flatten, derive."""
    rows = to_silver(flatten(parse_documents(documents(spark, sf_dir))), as_of=AS_OF)
    return rows.withColumn("injection_date", F.col("injection_date").cast("timestamp_ntz"))


def positional_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the positional area and the epoch in the session zone."""
    flat = flatten(parse_documents(documents(spark, sf_dir)))
    rows = to_silver(flat, area="positional", epoch="session", as_of=AS_OF)
    return rows.select("code", "time", "updated", "area")


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two backfills of all events; the second replaces the first."""
    name = fresh_table(spark, "backfill")
    root = scratch_path(spark, "backfill")
    for docs in (documents(spark, sf_dir), None):
        run_backfill(
            spark,
            landing=f"{root}/landing",
            silver=f"{root}/silver",
            table=name,
            documents=docs,
            as_of=AS_OF,
            layout="frames",
        )
    return spark.table(name)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of the first half of the month and a daily run of the rest."""
    return _in_two_runs(spark, sf_dir, "daily", silver_format="json")


def _in_two_runs(spark: SparkSession, sf_dir: str, label: str, **options) -> DataFrame:
    name = fresh_table(spark, label)
    root = scratch_path(spark, label)
    for run, part in ((run_backfill, EARLY), (run_daily, LATE)):
        run(
            spark,
            landing=f"{root}/landing",
            silver=f"{root}/silver",
            table=name,
            documents=documents(spark, sf_dir, where=part),
            as_of=AS_OF,
            compression=COMPRESSION,
            **options,
        )
    return spark.table(name)


def daily_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both runs with the positional area and the epoch in the session zone."""
    return _in_two_runs(spark, sf_dir, "daily_positional", area="positional", epoch="session")


def backfill_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of what lies in the landing zone as one run, the same way."""
    name = fresh_table(spark, "backfill_positional")
    root = scratch_path(spark, "backfill_positional")
    run_backfill(
        spark,
        landing=f"{root}/landing",
        silver=f"{root}/silver",
        table=name,
        documents=split_documents(spark, delivered(spark, sf_dir)),
        as_of=AS_OF,
        area="positional",
        epoch="session",
        compression=COMPRESSION,
    )
    return spark.table(name)


def silver_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver that is there already, loaded alone: over the table, then on top of it."""
    name = fresh_table(spark, "load_silver")
    root = scratch_path(spark, "load_silver")
    rows = to_silver(flatten(read_documents(spark, landing(spark, sf_dir))), as_of=AS_OF)
    for kind, fmt in ((BACKFILL, "parquet"), (DAILY, "json")):
        write_silver(rows, root, kind, RUN_DATE, fmt=fmt, compression=COMPRESSION)
        load_silver(
            spark, silver=root, table=name, run_date=RUN_DATE, run_kind=kind, silver_format=fmt
        )
    return spark.table(name)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one event; every seventh is cut off, every eleventh has no features."""
    root = scratch_path(spark, "quarantine")
    name = fresh_table(spark, "quarantine")
    whole = documents(spark, sf_dir, features_per_document=1)
    event = F.regexp_extract("value", '"code":"([0-9]+)"', 1).cast("long")
    broken = F.when(event % 7 == 0, F.expr("left(value, length(value) - 9)"))
    broken = broken.when(event % 11 == 0, F.expr("concat('{\"code\":\"', event, '\"}')"))
    docs = whole.withColumn("event", event).select(broken.otherwise(F.col("value")).alias("value"))
    report = run_backfill(
        spark,
        landing=f"{root}/landing",
        silver=f"{root}/silver",
        table=name,
        documents=docs,
        as_of=AS_OF,
        mode="PERMISSIVE",
        strict=False,
        layout="frames",
    )
    code = F.regexp_extract("value", '"code":"([0-9]+)"', 1).alias("code")
    aside = read_rejected(spark, report.rejected_path, fmt="parquet").select(code, F.lit(False).alias("taken"))
    taken = spark.table(name).select("code", F.lit(True).alias("taken"))
    counted = F.lit(report.records).cast("long"), F.lit(report.rejected).cast("long")
    return taken.unionAll(aside).select("*", counted[0].alias("n_records"), counted[1].alias("n_rejected"))


def daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing zone as a stream, run twice; the second run finds nothing new."""
    name = fresh_table(spark, "stream")
    root = scratch_path(spark, "stream")
    for _ in range(2):
        run_daily_stream(
            spark,
            landing=landing(spark, sf_dir),
            silver=f"{root}/silver",
            table=name,
            checkpoint=f"{root}/checkpoint",
            stream_name="feed",
            as_of=AS_OF,
        )
    return spark.table(name).drop("load_id")


def raw_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines to silver lines, with the ingestion time as text."""
    root = scratch_path(spark, "raw")
    land_documents(
        documents(spark, sf_dir), f"{root}/landing", DAILY, RUN_DATE, compression=COMPRESSION
    )
    report = run_silver(
        spark,
        landing=f"{root}/landing",
        silver=f"{root}/silver",
        as_of=AS_OF,
        compression=COMPRESSION,
    )
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in FLAT.fields)
    return spark.read.schema(f"{schema}, area string, insert_date string").json(report.silver_path)


# Silver and warehouse rows with the positional area and the epoch in the session zone.
POSITIONAL_SQL = (
    FLAT_SQL
    + """,
silver AS (
  SELECT * REPLACE (
    CASE WHEN status = 'error' THEN '1970-01-01 00:00:00'
      ELSE strftime(make_timestamp((CAST(time AS BIGINT) // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')
    END AS time,
    CASE status
      WHEN 'click' THEN '1969-12-31 23:59:59'
      WHEN 'signup' THEN NULL
      ELSE strftime(make_timestamp((CAST(updated AS BIGINT) // 1000) * 1000000),
                    '%Y-%m-%d %H:%M:%S')
    END AS updated
  ),
  substring(place, instr(place, 'of') + 3,
            greatest(length(place) - instr(place, 'of') - 2, 0)) AS area
  FROM flat
),
"""
    + WAREHOUSE_SQL[len(SILVER_SQL) :].lstrip().removeprefix(",")
)

_POSITIONAL_SQL = f"WITH {POSITIONAL_SQL} SELECT code, time, updated, area FROM silver"

_SILVER_ROWS_SQL = f"""
WITH {SILVER_SQL}
SELECT {', '.join(FLAT.names)}, area, TIMESTAMP '2024-02-01 12:30:45.678' AS injection_date
FROM silver
"""

QUERIES = {
    "q_silver_rows": (silver_rows, _SILVER_ROWS_SQL),
    "q_silver_positional": (positional_rows, _POSITIONAL_SQL),
    "q_backfill": (backfill, f"WITH {WAREHOUSE_SQL} SELECT * FROM warehouse"),
    "q_daily": (daily, f"WITH {WAREHOUSE_SQL} SELECT * FROM warehouse"),
    "q_daily_stream": (daily_stream, f"WITH {WAREHOUSE_SQL} SELECT * FROM warehouse"),
    "q_backfill_positional": (backfill_positional, f"WITH {POSITIONAL_SQL} SELECT * FROM warehouse"),
    "q_daily_positional": (daily_positional, f"WITH {POSITIONAL_SQL} SELECT * FROM warehouse"),
    "q_load_silver": (
        silver_loads,
        f"WITH {WAREHOUSE_SQL} SELECT * FROM warehouse UNION ALL SELECT * FROM warehouse",
    ),
    "q_quarantine": (
        quarantine,
        """SELECT code, taken, count(*) FILTER (taken) OVER () AS n_records,
                  count(*) FILTER (NOT taken) OVER () AS n_rejected
           FROM (SELECT CAST(event_id AS VARCHAR) AS code,
                        event_id % 7 <> 0 AND event_id % 11 <> 0 AS taken FROM events)""",
    ),
    "q_raw_to_silver": (
        raw_to_silver,
        f"""WITH {SILVER_SQL}
        SELECT {', '.join(FLAT.names)}, area, '2024-02-01 12:30:45' AS insert_date
        FROM silver""",
    ),
}
