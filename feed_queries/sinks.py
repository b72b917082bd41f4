"""File sinks and file layout, each written and read back."""

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
    table,
)
from feedlake.operators import counted, flatten, laid_out, record_count
from feedlake.plans import to_silver
from feedlake.schemas import FLAT
from feedlake.session import scratch_path
from feedlake.sinks import (
    land_documents,
    write_documents_text,
    write_jsonl,
    write_parquet,
    write_silver,
)
from feedlake.sources import (
    BACKFILL,
    DAILY,
    parse_documents,
    read_documents,
    read_run,
    read_silver,
    read_text_documents,
)


def _silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_documents(spark, landing(spark, sf_dir))
    return to_silver(flatten(raw), as_of=AS_OF)


def landing_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents up to mid-month as a backfill, later ones as a daily run."""
    root = scratch_path(spark, "landed")
    for kind, part in ((BACKFILL, EARLY), (DAILY, LATE)):
        docs = documents(spark, sf_dir, where=part)
        land_documents(docs, root, kind, RUN_DATE, compression=COMPRESSION)
    columns = ("mag", "place", "time")
    runs = [
        flatten(
            read_run(spark, root, kind, RUN_DATE, columns=columns),
            columns,
            keep=["run_kind", "ingest_date"],
            keep_id=True,
        )
        for kind in (BACKFILL, DAILY)
    ]
    return runs[0].unionByName(runs[1])


def jsonl_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows written as the backfill's and as the daily run's silver."""
    root = scratch_path(spark, "silver")
    rows = _silver_rows(spark, sf_dir)
    paths = [
        write_silver(rows, root, kind, RUN_DATE, fmt="json", compression=COMPRESSION)
        for kind in (BACKFILL, DAILY)
    ]
    return read_silver(spark, paths)


def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_silver(
        _silver_rows(spark, sf_dir), scratch_path(spark, "silver"), BACKFILL, RUN_DATE
    )
    stored = spark.read.parquet(path)
    return stored.withColumn("injection_date", F.col("injection_date").cast("timestamp_ntz"))


def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text lines, then their rows as JSON lines."""
    text, lines = scratch_path(spark, "text"), scratch_path(spark, "rows")
    write_documents_text(documents(spark, sf_dir), text, compression=COMPRESSION)
    docs = parse_documents(read_text_documents(spark, text))
    path = write_jsonl(flatten(docs), lines, compression=COMPRESSION)
    return spark.read.schema(FLAT).json(path)


def single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An explicit layout: the rows per order status, a small table, in one file."""
    path = scratch_path(spark, "compact")
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus")
    counts = counts.agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last"))
    write_parquet(laid_out(counts, 1), path)
    stored = spark.read.parquet(path)
    return stored.withColumn("n_files", F.lit(len(stored.inputFiles())).cast("long"))


def whole_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a table in one file, and in files of a bounded number of rows."""
    customers = table(spark, sf_dir, "customer")
    one, many = scratch_path(spark, "one"), scratch_path(spark, "many")
    write_parquet(laid_out(customers, 1), one)
    write_parquet(customers, many, records_per_file=1_000)
    stored, parts = spark.read.parquet(one), spark.read.parquet(many)
    most = parts.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    n_files = F.lit(len(stored.inputFiles())).cast("long")
    return stored.withColumns({"n_files": n_files, "most_rows": F.lit(most).cast("long")})


def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows created from the documents: counted, and observed by a write."""
    rows = flatten(read_documents(spark, landing(spark, sf_dir), columns=("mag",)), ("mag",))
    watched, observation = counted(rows, "rows")
    write_parquet(watched, scratch_path(spark, "counted"))
    written = F.lit(observation.get["records"]).cast("bigint")
    return record_count(rows).withColumn("n_written", written)


QUERIES = {
    "q_landing_sink": (
        landing_sink,
        f"""WITH {FLAT_SQL}
        SELECT CASE WHEN ingest_date < '20240116' THEN 'backfill' ELSE 'daily' END AS run_kind,
               '20240201' AS ingest_date, CAST(event_id AS VARCHAR) AS id, mag, place, time
        FROM flat""",
    ),
    "q_jsonl_sink": (
        jsonl_sink,
        f"WITH {WAREHOUSE_SQL} SELECT * FROM warehouse UNION ALL SELECT * FROM warehouse",
    ),
    "q_parquet_sink": (
        parquet_sink,
        f"""WITH {SILVER_SQL}
        SELECT {', '.join(FLAT.names)}, area,
               TIMESTAMP '2024-02-01 12:30:45.678' AS injection_date
        FROM silver""",
    ),
    "q_text_sink": (text_sink, f"WITH {FLAT_SQL} SELECT {', '.join(FLAT.names)} FROM flat"),
    "q_single_file": (
        single_file,
        """SELECT o_orderstatus, count(*) AS n_orders, max(o_orderdate) AS last,
                  CAST(1 AS BIGINT) AS n_files FROM orders GROUP BY o_orderstatus""",
    ),
    "q_whole_file": (
        whole_file,
        """SELECT *, CAST(1 AS BIGINT) AS n_files, least(1000, count(*) OVER ()) AS most_rows FROM customer""",
    ),
    "q_record_count": (
        record_counts,
        "SELECT count(*) AS n_records, count(*) AS n_written FROM events",
    ),
}
