"""The ``events`` table as a feed of documents, and the SQL of the same rows.

Every event becomes one feature; a document holds up to a fixed number of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import flat_map_rows
from feedlake.session import scratch_path
from feedlake.sources import DAILY

AS_OF = datetime(2024, 2, 1, 12, 30, 45, 678000)
RUN_DATE = "20240201"

FEATURES_PER_DOCUMENT = 500

# Events of the first half of the month, and all others.
EARLY = "ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'"
LATE = f"NOT coalesce({EARLY}, false)"

# The queries leave what they write in the scratch folder, so text is compressed.
COMPRESSION = "gzip"

# The event fields in the names of the feed; plain SQL.  Per event type:
# error has time 0, click a negative update time, signup one past the year 9999;
# purchase has no place and a time zone that is no number; click has no depth.
# The magnitude is a number given as text.
_FEED = """
SELECT
  event_id,
  date_format(ts, 'yyyyMMdd') AS ingest_date,
  struct(
    cast(value AS string) AS mag,
    CASE event_type
      WHEN 'view' THEN concat(user_id, ' km N of ', event_type, ', Zone ', user_id)
      WHEN 'click' THEN concat('off the coast of ', event_type)
      WHEN 'signup' THEN concat(event_type, ' of  area ', user_id, '  ')
      WHEN 'error' THEN event_type
    END AS place,
    CASE WHEN event_type = 'error' THEN 0 ELSE ms END AS time,
    CASE event_type
      WHEN 'click' THEN -1500
      WHEN 'signup' THEN 99999999999999999
      ELSE ms + user_id * 1000
    END AS updated,
    CASE WHEN event_type = 'purchase' THEN 'UTC' ELSE cast(user_id AS string) END AS tz,
    concat('/event/', event_id) AS url,
    CASE WHEN event_type <> 'view' THEN cast(user_id AS double) END AS felt,
    value AS cdi,
    CASE WHEN event_type = 'view' THEN 'green' END AS alert,
    event_type AS status,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS tsunami,
    cast(get_json_object(props, '$.k') AS double) AS sig,
    'ev' AS net,
    cast(event_id AS string) AS code,
    concat(',', event_id, ',') AS ids,
    ',ev,' AS sources,
    ',origin,' AS types,
    cast(user_id AS double) AS nst,
    value / 100 AS dmin,
    value AS rms,
    value * 2 AS gap,
    'mb' AS magType,
    event_type AS type,
    concat('E ', event_id) AS title,
    user_id AS not_in_the_schema
  ) AS properties,
  CASE
    WHEN event_type = 'click' THEN array(user_id - 75.5D, value)
    ELSE array(user_id - 75.5D, value, 10.0D)
  END AS coordinates
FROM (SELECT *, unix_millis(cast(ts AS timestamp)) AS ms FROM {events})
"""

# The rows of the feed after flattening.
FLAT_SQL = """
feed AS (
  SELECT *, epoch_us(ts) // 1000 AS ms FROM events
),
flat AS (
  SELECT
    event_id,
    strftime(ts, '%Y%m%d') AS ingest_date,
    CAST(value AS FLOAT) AS mag,
    CASE event_type
      WHEN 'view' THEN user_id || ' km N of view, Zone ' || user_id
      WHEN 'click' THEN 'off the coast of click'
      WHEN 'signup' THEN 'signup of  area ' || user_id || '  '
      WHEN 'error' THEN 'error'
    END AS place,
    CAST(CASE WHEN event_type = 'error' THEN 0 ELSE ms END AS VARCHAR) AS time,
    CAST(CASE event_type
      WHEN 'click' THEN -1500
      WHEN 'signup' THEN 99999999999999999
      ELSE ms + user_id * 1000 END AS VARCHAR) AS updated,
    CASE WHEN event_type = 'purchase' THEN 'UTC' ELSE CAST(user_id AS VARCHAR) END AS tz,
    '/event/' || event_id AS url,
    CAST(NULL AS VARCHAR) AS detail,
    CASE WHEN event_type <> 'view' THEN CAST(user_id AS INTEGER) END AS felt,
    CAST(value AS FLOAT) AS cdi,
    CAST(NULL AS FLOAT) AS mmi,
    CASE WHEN event_type = 'view' THEN 'green' END AS alert,
    event_type AS status,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS tsunami,
    CAST(props ->> '$.k' AS INTEGER) AS sig,
    'ev' AS net,
    CAST(event_id AS VARCHAR) AS code,
    ',' || event_id || ',' AS ids,
    ',ev,' AS sources,
    ',origin,' AS types,
    CAST(user_id AS INTEGER) AS nst,
    CAST(value / 100 AS FLOAT) AS dmin,
    CAST(value AS FLOAT) AS rms,
    CAST(value * 2 AS FLOAT) AS gap,
    'mb' AS magType,
    event_type AS type,
    'E ' || event_id AS title,
    CAST(user_id - CAST(75.5 AS DOUBLE) AS FLOAT) AS longitude,
    CAST(value AS FLOAT) AS latitude,
    CASE WHEN event_type <> 'click' THEN CAST(10.0 AS FLOAT) END AS depth
  FROM feed
)
"""

# The flat rows with the guarded epoch and the regular-expression area.
SILVER_SQL = (
    FLAT_SQL
    + """,
parsed AS (
  SELECT *, CAST(time AS BIGINT) AS time_ms, CAST(updated AS BIGINT) AS updated_ms
  FROM flat
),
guarded AS (
  SELECT *, greatest(time_ms, updated_ms) > 253402300799999 AS beyond FROM parsed
),
silver AS (
  SELECT * EXCLUDE (time_ms, updated_ms, beyond) REPLACE (
    CASE WHEN NOT beyond AND time_ms > 0
      THEN strftime(make_timestamp(time_ms * 1000), '%Y-%m-%d %H:%M:%S') END AS time,
    CASE WHEN NOT beyond AND updated_ms > 0
      THEN strftime(make_timestamp(updated_ms * 1000), '%Y-%m-%d %H:%M:%S') END AS updated
  ),
  CASE status
    WHEN 'view' THEN 'view, Zone ' || nst
    WHEN 'click' THEN 'click'
    WHEN 'signup' THEN 'area ' || nst
  END AS area
  FROM guarded
)
"""
)

# The silver rows with warehouse types: floats by way of their text.
WAREHOUSE_SQL = (
    SILVER_SQL
    + """,
warehouse AS (
  SELECT
    CAST(CAST(mag AS VARCHAR) AS DOUBLE) AS mag, place, time, updated,
    TRY_CAST(tz AS BIGINT) AS tz, url, detail, CAST(felt AS BIGINT) AS felt,
    CAST(CAST(cdi AS VARCHAR) AS DOUBLE) AS cdi,
    CAST(CAST(mmi AS VARCHAR) AS DOUBLE) AS mmi,
    alert, status, CAST(tsunami AS BIGINT) AS tsunami, CAST(sig AS BIGINT) AS sig,
    net, code, ids, sources, types, CAST(nst AS BIGINT) AS nst,
    CAST(CAST(dmin AS VARCHAR) AS DOUBLE) AS dmin,
    CAST(CAST(rms AS VARCHAR) AS DOUBLE) AS rms,
    CAST(CAST(gap AS VARCHAR) AS DOUBLE) AS gap,
    magType, type, title,
    CAST(CAST(longitude AS VARCHAR) AS DOUBLE) AS longitude,
    CAST(CAST(latitude AS VARCHAR) AS DOUBLE) AS latitude,
    CAST(CAST(depth AS VARCHAR) AS DOUBLE) AS depth,
    area, '2024-02-01T12:30:45.678Z' AS injection_date
  FROM silver
)
"""
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables.  Times are compared in UTC, so the zone is set here."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(
    spark: SparkSession,
    sf_dir: str,
    *,
    where: str = "true",
    features_per_document: int = FEATURES_PER_DOCUMENT,
) -> DataFrame:
    """Events as documents: ``ingest_date`` and the JSON text ``value``.

    ``where`` chooses events, in the scan.  Spark renders each feature; the features of
    one day that come in one Arrow batch are then strung together.  Neither a busy day
    nor a busy user makes a document any larger, and nothing is shuffled.
    """
    return _packed(_features(spread_events(spark, sf_dir).filter(where)), features_per_document)


# The given table is one row group, which one task would read, render and pack.  A feed
# comes in many files, so the events are dealt to this many, by their id, as set-up.
_EVENT_FILES = 32


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, in many files."""

    def write(path: str) -> None:
        table(spark, sf_dir, "events").repartition(_EVENT_FILES, "event_id").write.parquet(path)

    return spark.read.parquet(prepared(spark, sf_dir, "events", write))


def _features(events: DataFrame) -> DataFrame:
    """One rendered feature per event, with its day."""
    rows = events.sparkSession.sql(_FEED, events=events)
    feature = F.struct(
        F.lit("Feature").alias("type"),
        "properties",
        F.struct(F.lit("Point").alias("type"), "coordinates").alias("geometry"),
        F.col("event_id").cast("string").alias("id"),
    )
    return rows.select("ingest_date", "event_id", F.to_json(feature).alias("feature"))


def _packed(features: DataFrame, features_per_document: int) -> DataFrame:
    def collections(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        packed = []
        for day, members in batch.groupby("ingest_date", dropna=False)["feature"]:
            day = None if pd.isna(day) else day
            for start in range(0, len(members), features_per_document):
                part = ",".join(members.iloc[start : start + features_per_document])
                packed.append((day, f'{{"type":"FeatureCollection","features":[{part}]}}'))
        yield pd.DataFrame(packed, columns=["ingest_date", "value"])

    return flat_map_rows(
        features.select("ingest_date", "feature"), collections, "ingest_date string, value string"
    )


_prepared: dict[tuple[str, str, str], str] = {}


def prepared(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], object]) -> str:
    """Folder of an input that scan queries read: part of their set-up, like the tables.

    It is written by the first query of an application that needs it, and again if it
    is gone; its content depends on ``sf_dir`` and ``label`` alone.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label)
    path = _prepared.get(key)
    if path is not None:
        try:
            spark.read.format("binaryFile").load(path)
            return path
        except AnalysisException:
            pass
    path = scratch_path(spark, label)
    write(path)
    _prepared[key] = path
    return path


# Shares that the landing zone cuts each day into, so that no day is left to one task.
_SHARES = 4


def day_documents(spark: SparkSession, sf_dir: str, features_per_document: int) -> DataFrame:
    """Every day's events gathered, then rendered and packed into full documents.

    A rendered feature is many times its event, so events are shuffled and sorted.
    """
    day = F.date_format("ts", "yyyyMMdd")
    share = F.col("event_id") % _SHARES
    gathered = spread_events(spark, sf_dir).repartition(day, share).sortWithinPartitions(day)
    return _packed(_features(gathered), features_per_document)


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing root with the documents of every day as daily runs.

    Days are gathered before they are packed, in a fixed number of shares each: a day
    becomes a few files of full documents, however many tasks read the events.
    """

    def write(root: str) -> None:
        by_day = day_documents(spark, sf_dir, FEATURES_PER_DOCUMENT).write.partitionBy("ingest_date")
        by_day.text(f"{root}/run_kind={DAILY}", compression=COMPRESSION)

    return prepared(spark, sf_dir, "landing", write)
