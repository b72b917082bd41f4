"""Flattening and projection."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feed_queries.feed import FLAT_SQL, landing, table
from feedlake.functions import null_safe_float, of_position, text_length
from feedlake.operators import (
    coordinates,
    explode_features,
    flat_map_rows,
    map_rows,
    properties_flatten,
    typed_projection,
)
from feedlake.schemas import FLAT
from feedlake.sources import read_documents


def _exploded(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return explode_features(read_documents(spark, landing(spark, sf_dir), columns=columns), strict=True)


def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(spark, sf_dir, ("place", "title")).select(
        F.col("f.id").alias("id"),
        F.col("f.properties.place").alias("place"),
        F.col("f.properties.title").alias("title"),
    )


def from_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k int", {"mode": "FAILFAST"})
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of ``properties`` as columns; numbers come as text, however they are given."""
    names = ("mag", "place", "time", "updated", "tz", "felt", "tsunami", "sig", "nst", "dmin")
    rows = properties_flatten(_exploded(spark, sf_dir, names), keep_id=True)
    numbers = ("mag", "felt", "tsunami", "sig", "nst", "dmin")
    return rows.withColumns({name: F.col(name).cast("double") for name in numbers})


def coordinate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", *coordinates("embedding"))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_projection(properties_flatten(_exploded(spark, sf_dir)))


def null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles, integers, number text and NULL to 32-bit floats."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        null_safe_float(price).alias("price"),
        null_safe_float("o_custkey").alias("customer"),
        null_safe_float(F.when(F.col("o_orderstatus") != "P", price)).alias("price_or_null"),
        null_safe_float("o_orderpriority", strict=False).alias("dirty"),
        null_safe_float(F.substring("o_orderpriority", 1, 1)).alias("priority"),
    )


def with_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two new columns and one replaced in place."""
    return table(spark, sf_dir, "customer").withColumns(
        {
            "of_position": of_position("c_mktsegment"),
            "length": text_length("c_mktsegment"),
            "c_mktsegment": F.lower("c_mktsegment"),
        }
    )


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_columns(spark, sf_dir).drop("of_position", "length")


_CHUNK = 200


def flat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User generator: the lines of each document, packed one after the other into chunks
    of at most 200 characters; a longer line is a chunk of its own."""

    def chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows: list[list] = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            number = -1
            for line in text.split("\n"):
                if number >= 0 and len(rows[-1][3]) + 1 + len(line) <= _CHUNK:
                    rows[-1][2] += 1
                    rows[-1][3] += "\n" + line
                else:
                    number += 1
                    rows.append([doc_id, number, 1, line])
        yield pd.DataFrame(rows, columns=["doc_id", "chunk_no", "n_lines", "chunk"])

    docs = table(spark, sf_dir, "documents").select("doc_id", "text").filter("text IS NOT NULL")
    return flat_map_rows(docs, chunks, "doc_id long, chunk_no long, n_lines long, chunk string")


def one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User function: one row per row."""

    def tidy(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(c_name=batch["c_name"].str.replace("#", " no. ", regex=False))

    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return map_rows(names, tidy, "c_custkey long, c_name string")


_WITH_COLUMNS_SQL = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment,
       instr(c_mktsegment, 'of') AS of_position, length(c_mktsegment) AS length
FROM customer
"""

QUERIES = {
    "q_explode_features": (
        exploded,
        f"WITH {FLAT_SQL} SELECT CAST(event_id AS VARCHAR) AS id, place, title FROM flat",
    ),
    "q_from_json": (
        from_json_text,
        "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events",
    ),
    "q_properties_flatten": (
        properties,
        f"""WITH {FLAT_SQL}
        SELECT CAST(event_id AS VARCHAR) AS id, e.value AS mag, place, time, updated, tz,
               CAST(felt AS DOUBLE) AS felt, CAST(tsunami AS DOUBLE) AS tsunami,
               CAST(sig AS DOUBLE) AS sig, CAST(nst AS DOUBLE) AS nst, e.value / 100 AS dmin
        FROM flat JOIN events e USING (event_id)""",
    ),
    "q_coordinates": (
        coordinate_columns,
        """SELECT vec_id, embedding[1] AS longitude, embedding[2] AS latitude,
                  embedding[3] AS depth FROM embeddings""",
    ),
    "q_typed_projection": (
        typed,
        f"WITH {FLAT_SQL} SELECT {', '.join(FLAT.names)} FROM flat",
    ),
    "q_null_safe_float": (
        null_safe,
        """SELECT o_orderkey, CAST(o_totalprice AS FLOAT) AS price,
                  CAST(o_custkey AS FLOAT) AS customer,
                  CAST(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS FLOAT)
                    AS price_or_null,
                  TRY_CAST(o_orderpriority AS FLOAT) AS dirty,
                  CAST(left(o_orderpriority, 1) AS FLOAT) AS priority
           FROM orders""",
    ),
    "q_with_columns": (with_columns, _WITH_COLUMNS_SQL),
    "q_drop_columns": (
        drop_columns,
        f"SELECT * EXCLUDE (of_position, length) FROM ({_WITH_COLUMNS_SQL})",
    ),
    "q_flat_map": (
        flat_map,
        f"""WITH RECURSIVE lines AS (
              SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line
              FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
            ),
            packed AS (
              SELECT doc_id, i, CAST(0 AS BIGINT) AS chunk_no, length(line) AS used
              FROM lines WHERE i = 0
              UNION ALL
              SELECT n.doc_id, n.i,
                p.chunk_no + CASE WHEN p.used + 1 + length(n.line) <= {_CHUNK} THEN 0 ELSE 1 END,
                length(n.line) + CASE WHEN p.used + 1 + length(n.line) <= {_CHUNK}
                  THEN p.used + 1 ELSE 0 END
              FROM packed p JOIN lines n ON n.doc_id = p.doc_id AND n.i = p.i + 1
            )
            SELECT doc_id, chunk_no, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS chunk
            FROM packed JOIN lines USING (doc_id, i) GROUP BY doc_id, chunk_no""",
    ),
    "q_map_rows": (
        one_to_one,
        "SELECT c_custkey, replace(c_name, '#', ' no. ') AS c_name FROM customer",
    ),
}
