"""Scalar expressions over whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feed_queries.feed import AS_OF, table
from feedlake.functions import (
    area_positional,
    area_regex,
    epoch_guarded,
    epoch_session,
    ingest_stamp,
    ingest_stamp_text,
    of_position,
    row_json,
    run_date,
    strip,
    text_length,
)


def _text(expression):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name, value = expression
        return table(spark, sf_dir, "documents").select("doc_id", value("text").alias(name))

    return run


def area_regex_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", area_regex("text").alias("area")
    )


def strip_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text between white space of several kinds, stripped again."""
    padded = F.concat(F.lit(" \t　"), F.col("text"), F.lit(" \r\n "))
    return table(spark, sf_dir, "documents").select("doc_id", strip(padded).alias("text"))


def _millis() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def epoch_in_session_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, negative, fractional and dirty text, by event type."""
    kind, millis = F.col("event_type"), _millis()
    text = (
        F.when(kind == "click", (-millis).cast("string"))
        .when(kind == "view", F.concat(millis.cast("string"), F.lit(".5")))
        .when(kind == "error", F.lit("bad"))
        .when(kind != "signup", millis.cast("string"))
    )
    return table(spark, sf_dir, "events").select("event_id", epoch_session(text).alias("time"))


def epoch_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fields with defects, by event type and by user."""
    kind, user, millis = F.col("event_type"), F.col("user_id"), _millis()
    time = (
        F.when(kind == "error", F.lit("bad"))
        .when(kind == "signup", F.lit("0"))
        .when(kind != "purchase", millis.cast("string"))
    )
    updated = (
        F.when(user < 10, F.lit("99999999999999999"))
        .when(user < 20, F.lit("-1500"))
        .when(user < 30, F.lit("nan"))
        .when(user < 40, F.lit("12 ms"))
        .when(user < 60, F.concat(millis.cast("string"), F.lit(".25")))
        .when(user < 80, F.lit(None))
        .otherwise(millis.cast("string"))
    )
    events = table(spark, sf_dir, "events").select(
        "event_id", time.alias("time"), updated.alias("updated")
    )
    time_text, updated_text = epoch_guarded("time", "updated")
    return events.select("event_id", time_text.alias("time"), updated_text.alias("updated"))


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's timestamp on every row, compared without a zone."""
    stamp = ingest_stamp(AS_OF).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select("event_id", stamp.alias("injection_date"))


def stamped_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", ingest_stamp_text(AS_OF).alias("insert_date")
    )


def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's date tag next to the date tag of each order."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        run_date(AS_OF).alias("run_date"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("order_date"),
    )


def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON text and back; the rendered NULL balance leaves no key."""
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    )
    text = customers.select("c_custkey", row_json(customers).alias("row"))
    return text.select(
        "c_custkey",
        F.get_json_object("row", "$.c_name").alias("c_name"),
        F.get_json_object("row", "$.c_nationkey").cast("int").alias("c_nationkey"),
        F.get_json_object("row", "$.c_acctbal").cast("double").alias("c_acctbal"),
        F.get_json_object("row", "$.c_mktsegment").alias("c_mktsegment"),
        F.size(F.json_object_keys("row")).alias("n_keys"),
    )


# White space as in feedlake.functions.text, for a regular expression.
_WS = (
    r"[\t\n\v\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_AREA_RX = f"of{_WS}+([^\\n]+)\\n?$"


def _area_sql(source: str, keys: str) -> str:
    stripped = (
        f"regexp_replace(regexp_replace(regexp_extract(text, '{_AREA_RX}', 1), "
        f"'^{_WS}+', ''), '{_WS}+$', '')"
    )
    return (
        f"SELECT {keys}, CASE WHEN regexp_matches(text, '{_AREA_RX}') THEN {stripped} END AS area "
        f"FROM {source}"
    )


_SESSION_SQL = """
WITH input AS (
  SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms FROM events
)
SELECT event_id, CASE
    WHEN event_type IN ('view', 'purchase')
      THEN strftime(make_timestamp((ms // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')
    WHEN event_type = 'click'
      THEN strftime(make_timestamp(-(ms // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')
  END AS time
FROM input
"""

_PAIR_SQL = """
WITH input AS (
  SELECT event_id, event_type, user_id, epoch_us(ts) // 1000 AS ms FROM events
),
judged AS (
  SELECT *,
    event_type = 'error' OR user_id < 10 OR (user_id >= 30 AND user_id < 40) AS both_null,
    strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS text
  FROM input
)
SELECT event_id,
  CASE WHEN NOT both_null AND event_type NOT IN ('signup', 'purchase') THEN text END AS time,
  CASE WHEN NOT both_null AND ((user_id >= 40 AND user_id < 60) OR user_id >= 80)
    THEN text END AS updated
FROM judged
"""

QUERIES = {
    "q_instr": (
        _text(("of_position", of_position)),
        "SELECT doc_id, instr(text, 'of') AS of_position FROM documents",
    ),
    "q_length": (
        _text(("length", text_length)),
        "SELECT doc_id, length(text) AS length FROM documents",
    ),
    "q_area_positional": (
        _text(("area", area_positional)),
        """SELECT doc_id, substring(text, instr(text, 'of') + 3,
             greatest(length(text) - instr(text, 'of') - 2, 0)) AS area FROM documents""",
    ),
    "q_area_regex": (_text(("area", area_regex)), _area_sql("documents", "doc_id")),
    "q_area_regex_turns": (area_regex_turns, _area_sql("conversations", "conv_id, turn")),
    "q_strip": (
        strip_padded,
        f"""SELECT doc_id, regexp_replace(regexp_replace(text, '^{_WS}+', ''), '{_WS}+$', '')
              AS text FROM documents""",
    ),
    "q_epoch_session": (epoch_in_session_zone, _SESSION_SQL),
    "q_epoch_guarded": (epoch_pair, _PAIR_SQL),
    "q_ingest_stamp": (
        stamped,
        "SELECT event_id, TIMESTAMP '2024-02-01 12:30:45.678' AS injection_date FROM events",
    ),
    "q_ingest_stamp_text": (
        stamped_text,
        "SELECT event_id, '2024-02-01 12:30:45' AS insert_date FROM events",
    ),
    "q_run_date": (
        run_dates,
        """SELECT o_orderkey, '20240201' AS run_date,
                  strftime(o_orderdate, '%Y%m%d') AS order_date FROM orders""",
    ),
    "q_to_json": (
        json_rows,
        """SELECT c_custkey, c_name, c_nationkey,
                  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, c_mktsegment,
                  CASE WHEN c_acctbal >= 0 THEN 5 ELSE 4 END AS n_keys
           FROM customer""",
    ),
}
