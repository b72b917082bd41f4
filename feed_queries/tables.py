"""Catalog table loads.  Each query has a database of its own, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feed_queries.feed import AS_OF, COMPRESSION, RUN_DATE, landing, table
from feed_queries.scans import AUTODETECT_SQL, silver_lines
from feedlake.operators import flatten
from feedlake.plans import load_warehouse, to_silver
from feedlake.session import scratch_path
from feedlake.sinks import (
    ensure_database,
    load_append,
    load_autodetected,
    load_direct,
    load_overwrite,
    read_warehouse,
    register_warehouse,
    table_count,
    write_silver,
)
from feedlake.sources import DAILY, read_documents


def fresh_table(spark: SparkSession, label: str) -> str:
    """A table name in a new database."""
    folder = scratch_path(spark, label)
    name = f"{folder.rsplit('/', 1)[-1].replace('-', '_')}.feed"
    ensure_database(spark, name, folder)
    return name


def overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second replaces the first."""
    name = fresh_table(spark, "overwrite")
    orders = table(spark, sf_dir, "orders")
    load_overwrite(orders, name)
    load_overwrite(orders.withColumn("load_no", F.lit(2)), name)
    return spark.table(name)


def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of all orders; the second comes on top of the first."""
    name = fresh_table(spark, "append")
    orders = table(spark, sf_dir, "orders")
    load_append(orders.withColumn("load_no", F.lit(1)), name)
    load_append(orders.withColumn("load_no", F.lit(2)), name)
    return spark.table(name)


def append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, and the second once more under the same load id."""
    name = fresh_table(spark, "append_once")
    orders = table(spark, sf_dir, "orders")
    for load_id in ("first", "second", "second"):
        load_append(orders, name, load_id=load_id)
    return spark.table(name)


def write_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct writes: overwrite, then append, in a caller-chosen format."""
    name = fresh_table(spark, "direct")
    orders = table(spark, sf_dir, "orders")
    load_direct(orders, table=name, mode="overwrite", fmt="orc")
    load_direct(orders, table=name, mode="append", fmt="orc")
    return spark.table(name)


def connector_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through the connector: a load, the same load again, and one on top of it."""
    register_warehouse(spark)
    path = scratch_path(spark, "connector")
    orders = table(spark, sf_dir, "orders")
    for load_id in ("first", "first", "second"):
        load_direct(orders, fmt="feed_warehouse", mode="append", options={"path": path, "load_id": load_id})
    return read_warehouse(spark, path, orders.schema)


def total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after two loads counts the whole table."""
    name = fresh_table(spark, "counted")
    orders = table(spark, sf_dir, "orders")
    load_overwrite(orders, name)
    load_append(orders, name)
    return table_count(spark, name)


def autodetect_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_table(spark, "autodetect")
    load_autodetected(spark, silver_lines(spark, sf_dir), name)
    return spark.table(name)


def silver_to_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run's JSON-lines silver to the table, types inferred."""
    silver = scratch_path(spark, "run")
    rows = to_silver(flatten(read_documents(spark, landing(spark, sf_dir))), as_of=AS_OF)
    write_silver(rows, silver, DAILY, RUN_DATE, fmt="json", compression=COMPRESSION)
    name = fresh_table(spark, "warehouse")
    load_warehouse(spark, silver=silver, table=name, run_date=RUN_DATE)
    return spark.table(name)


QUERIES = {
    "q_table_overwrite": (overwrite, "SELECT *, 2 AS load_no FROM orders"),
    "q_table_append": (
        append,
        "SELECT *, 1 AS load_no FROM orders UNION ALL SELECT *, 2 AS load_no FROM orders",
    ),
    "q_table_append_once": (
        append_once,
        """SELECT *, 'first' AS load_id FROM orders
           UNION ALL SELECT *, 'second' AS load_id FROM orders""",
    ),
    "q_table_write_mode": (
        write_mode,
        "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    ),
    "q_connector_load": (
        connector_load,
        """SELECT *, 'first' AS load FROM orders
           UNION ALL SELECT *, 'second' AS load FROM orders""",
    ),
    "q_table_count": (total_rows, "SELECT 2 * count(*) AS table_rows FROM orders"),
    "q_autodetect_load": (autodetect_load, AUTODETECT_SQL),
    "q_silver_to_warehouse": (silver_to_warehouse, AUTODETECT_SQL),
}
