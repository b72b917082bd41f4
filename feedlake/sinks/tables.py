"""Catalog table loads.

Plain loads follow the feed: the backfill replaces the table, the daily run adds
to it, and a second daily run adds its rows again.  With a ``load_id`` the table
is partitioned by it and each load owns one partition, so a load that is repeated
after a failure replaces itself.

A replacement is written beside the table and takes its name in two renames.  Before them
the new table is marked with the name it is to take, in its properties: that mark is the
commit.  Whatever fails later, :func:`recover` finds the mark and does the rest; a table
without it was never complete and goes.  One writer at a time loads a table.

Loads count their rows on the way and keep the sums in properties of the table, so a row
report opens no data file.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.sources.silver import read_autodetect

LOAD_ID = "load_id"

# Table properties: the name a complete replacement is to take, and counts of rows, of the
# whole table and by load.
_REPLACES = "feedlake.replaces"
_ROWS = "feedlake.rows"
_ROWS_OF = "feedlake.rows.of."
_LOADED = "feedlake.load"

# Names beside the table, each with a mark of twelve hexadecimal digits.
_NEW, _OLD = "__new_", "__old_"
_MARK = re.compile("[0-9a-f]{12}")


def ensure_database(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the database of a ``database.table`` name if there is none."""
    database, _, _ = table.rpartition(".")
    if database:
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def _partitioned_by_load(spark: SparkSession, table: str) -> bool:
    return any(c.name == LOAD_ID and c.isPartition for c in spark.catalog.listColumns(table))


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set_properties(spark: SparkSession, table: str, properties: Mapping[str, object]) -> None:
    pairs = ", ".join(f"'{_quoted(key)}' = '{_quoted(str(value))}'" for key, value in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def _unset_properties(spark: SparkSession, table: str, names: list[str]) -> None:
    if names:
        listed = ", ".join(f"'{_quoted(name)}'" for name in names)
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({listed})")


def _location(spark: SparkSession, described: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {described}").filter("col_name = 'Location'")
    return [row["data_type"] for row in rows.collect()][-1]


def _follow_rename(spark: SparkSession, table: str, load_id: str) -> None:
    """Point the one partition of a renamed table to where its files are now.

    Not every catalog moves the places of partitions along with their table.
    """
    partition = f"PARTITION ({LOAD_ID} = '{_quoted(load_id)}')"
    if not spark.sql(f"SHOW PARTITIONS {table} {partition}").head(1):
        return
    above, _, folder = _partition_location(spark, table, partition).rstrip("/").rpartition("/")
    place = _location(spark, table).rstrip("/")
    if above == place:
        return
    # Places are described as URIs and set as paths.
    here = unquote(f"{place}/{folder}")
    spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION '{_quoted(here)}'")


def _partition_location(spark: SparkSession, table: str, partition: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
    # The partition is described before the table.
    return next(row["data_type"] for row in rows if row["col_name"] == "Location")


def _split_name(table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return (f"{database}." if database else ""), name


def _beside(spark: SparkSession, table: str, mark: str) -> list[str]:
    """Tables of the same database that a replacement of ``table`` left under such a name."""
    place, name = _split_name(table)
    within = f" IN {place[:-1]}" if place else ""
    try:
        rows = spark.sql(f"SHOW TABLES{within} LIKE '{name}{mark}*'").collect()
    except AnalysisException:  # no such database
        return []
    # The pattern of the catalog takes more than marks.
    names = [row["tableName"] for row in rows]
    return [f"{place}{one}" for one in names if _MARK.fullmatch(one[len(f"{name}{mark}") :])]


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a replacement of ``table`` that was interrupted; else nothing.

    A complete new table takes the name; an incomplete one is dropped.  Afterwards the
    table has its new content or its old one, and nothing is left beside it.
    """
    for new in _beside(spark, table, _NEW):
        if _REPLACES in _properties(spark, new):
            _rename(spark, new, table)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {new}")
    if _unfinished(spark, table):
        _finish(spark, table)
    for old in _beside(spark, table, _OLD):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE IF EXISTS {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")


def _unfinished(spark: SparkSession, table: str) -> bool:
    """Whether the table is a replacement that has its name and not all else."""
    return spark.catalog.tableExists(table) and _REPLACES in _properties(spark, table)


def _rename(spark: SparkSession, new: str, table: str) -> None:
    """Give a complete table the name of the one it replaces."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {new.replace(_NEW, _OLD)}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")


def _finish(spark: SparkSession, table: str) -> None:
    """After the renames; the mark goes last, so that any step may be repeated."""
    load_id = _properties(spark, table).get(_LOADED)
    if load_id is not None:
        _follow_rename(spark, table, load_id)
    for old in _beside(spark, table, _OLD):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    _unset_properties(spark, table, [_REPLACES])


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table, after a look whether a replacement was interrupted."""
    if not spark.catalog.tableExists(table) or _unfinished(spark, table):
        recover(spark, table)
    return spark.table(table)


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _rows_of(load_id: str) -> str:
    """Property of one load; its name must hold any id."""
    return _ROWS_OF + hashlib.sha256(load_id.encode()).hexdigest()[:32]


def load_overwrite(
    rows: DataFrame,
    table: str,
    *,
    load_id: str | None = None,
    fmt: str = "parquet",
    records: int | None = None,
) -> None:
    """Replace the content of ``table``; create it if missing.

    The rows are written to a new table first, which takes the name of the old one once
    it is complete.  A load that fails leaves the old table as it was, or, if it fails
    after the new one is complete, is finished by the next load or :func:`read_table`.
    """
    spark = rows.sparkSession
    ensure_database(spark, table)
    recover(spark, table)
    place, name = _split_name(table)
    new = f"{place}{name}{_NEW}{uuid.uuid4().hex[:12]}"
    written, seen = _observed(rows) if records is None else (rows, None)
    try:
        if load_id is None:
            written.write.format(fmt).saveAsTable(new)
        else:
            tagged = written.withColumn(LOAD_ID, F.lit(load_id))
            tagged.write.format(fmt).partitionBy(LOAD_ID).saveAsTable(new)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    count = records if seen is None else seen.get["n"]
    properties: dict[str, object] = {_REPLACES: table, _ROWS: count}
    if load_id is not None:
        properties |= {_LOADED: load_id, _rows_of(load_id): count}
    # The commit: from here on the new content is the content of the table.
    _set_properties(spark, new, properties)
    _rename(spark, new, table)
    _finish(spark, table)


def load_append(
    rows: DataFrame,
    table: str,
    *,
    load_id: str | None = None,
    fmt: str = "parquet",
    records: int | None = None,
) -> None:
    """Add to ``table``; create it if missing.

    With ``load_id`` the rows replace the partition of that load, if it is there.  The
    rows must have the columns of the table, and a table takes either loads with an id or
    loads without; anything else is an error, and changes nothing.
    """
    spark = rows.sparkSession
    ensure_database(spark, table)
    recover(spark, table)
    there = spark.catalog.tableExists(table)
    if there:
        _check_append(spark, rows, table, load_id is not None)
    counted, seen = _observed(rows) if records is None else (rows, None)
    before = _forget_rows(spark, table) if there else {_ROWS: "0"}
    if load_id is None:
        counted.write.format(fmt).mode("append").saveAsTable(table)
    else:
        if not there:
            empty = rows.withColumn(LOAD_ID, F.lit(load_id)).limit(0)
            empty.write.format(fmt).partitionBy(LOAD_ID).saveAsTable(table)
        columns = [name for name in spark.table(table).columns if name != LOAD_ID]
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_ID} = '{_quoted(load_id)}') SELECT * FROM {{rows}}",
            rows=counted.select(*columns),
        )
    count = records if seen is None else seen.get["n"]
    _remember_rows(spark, table, before, {load_id: count})


def _check_append(spark: SparkSession, rows: DataFrame, table: str, with_id: bool) -> None:
    by_load = _partitioned_by_load(spark, table)
    if by_load != with_id:
        raise ValueError(
            f"{table} was loaded {'with' if by_load else 'without'} a load id; "
            f"this load has {'one' if with_id else 'none'}"
        )
    columns = [name for name in spark.table(table).columns if name != LOAD_ID]
    given = [name for name in rows.columns if name != LOAD_ID]
    if sorted(columns) != sorted(given):
        missing, more = set(columns) - set(given), set(given) - set(columns)
        raise ValueError(f"{table}: the rows lack {sorted(missing)} and have {sorted(more)} besides")


def load_append_each(
    rows: DataFrame, table: str, load_ids: Mapping[str, int], *, fmt: str = "parquet"
) -> None:
    """Replace the partitions of several loads, named by the column ``load_id`` of the rows, in one job.

    ``load_ids`` has the number of rows of each; a load of no rows is emptied.  The session
    must overwrite partitions dynamically (``spark.sql.sources.partitionOverwriteMode``).
    """
    spark = rows.sparkSession
    ensure_database(spark, table)
    recover(spark, table)
    there = spark.catalog.tableExists(table)
    if there:
        _check_append(spark, rows, table, True)
    else:
        rows.limit(0).write.format(fmt).partitionBy(LOAD_ID).saveAsTable(table)
    before = _forget_rows(spark, table) if there else {_ROWS: "0"}
    columns = spark.table(table).columns
    rows.select(*columns).write.insertInto(table, overwrite=True)
    for load_id, count in load_ids.items():
        if not count:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD_ID} = '{_quoted(load_id)}')")
    _remember_rows(spark, table, before, load_ids)


def _forget_rows(spark: SparkSession, table: str) -> dict[str, str]:
    """The counts of a table, taken away from it until a load is through."""
    before = {key: value for key, value in _properties(spark, table).items() if key.startswith(_ROWS)}
    if _ROWS in before:
        _unset_properties(spark, table, [_ROWS])
    return before


def _remember_rows(
    spark: SparkSession, table: str, before: Mapping[str, str], counts: Mapping[str | None, int]
) -> None:
    if _ROWS not in before:  # a load that failed, or a table that others wrote: counted when asked
        return
    total = int(before[_ROWS])
    kept: dict[str, object] = {}
    for load_id, count in counts.items():
        if load_id is not None:
            total -= int(before.get(_rows_of(load_id), 0))
            kept[_rows_of(load_id)] = count
        total += count
    _set_properties(spark, table, {_ROWS: total, **kept})


def table_rows(spark: SparkSession, table: str) -> int:
    """Rows of the table, from the counts its loads keep; a table without them is counted."""
    read_table(spark, table)
    known = _properties(spark, table).get(_ROWS)
    return int(known) if known is not None else table_count(spark, table).first()[0]


def load_direct(
    rows: DataFrame,
    *,
    table: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write ``rows`` with any installed format and any save mode.

    With ``table`` the catalog gets the table; without it the format finds its
    target in ``options`` (``path``, or whatever its connector asks for).
    """
    writer = rows.write.format(fmt).mode(mode).options(**(options or {}))
    if table is None:
        writer.save()
        return
    spark = rows.sparkSession
    ensure_database(spark, table)
    if spark.catalog.tableExists(table):
        _forget_rows(spark, table)
    writer.saveAsTable(table)


def load_autodetected(
    spark: SparkSession, path: str, table: str, *, infer_timestamps: bool = False
) -> None:
    """Replace ``table`` by JSON lines whose types are inferred."""
    load_overwrite(read_autodetect(spark, path, infer_timestamps=infer_timestamps), table)


def table_count(spark: SparkSession, table: str) -> DataFrame:
    """Total rows of the table, not those of the last load, as ``table_rows``, counted."""
    return read_table(spark, table).agg(F.count(F.lit(1)).alias("table_rows"))
