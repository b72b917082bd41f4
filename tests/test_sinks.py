import json
import os

import pytest
from feed_documents import document, feature
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedlake.sinks import (
    land_documents,
    load_append,
    load_autodetected,
    load_direct,
    load_overwrite,
    read_table,
    recover,
    table_count,
    table_rows,
    write_documents_text,
    write_jsonl,
    write_silver,
)
from feedlake.sources import BACKFILL, DAILY, read_text_documents


@pytest.fixture
def table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE sinks LOCATION '{tmp_path}/sinks'")
    yield "sinks.feed"
    spark.sql("DROP DATABASE sinks CASCADE")


def test_landed_documents_are_untouched(spark, texts, tmp_path):
    docs = [document(feature("a", place="x\ny\r é")), document()]
    pretty = json.dumps(json.loads(docs[0]), indent=1).replace("\n", "\r\n")
    path = land_documents(texts(*docs, pretty), str(tmp_path), BACKFILL, "20240101")
    assert path.endswith("/run_kind=backfill/ingest_date=20240101")
    back = [row.value for row in read_text_documents(spark, path).collect()]
    assert sorted(json.dumps(json.loads(t)) for t in back) == sorted([docs[0], docs[0], docs[1]])
    assert docs[0] in back


def test_a_rerun_replaces_its_own_folder_only(spark, texts, tmp_path):
    root = str(tmp_path)
    land_documents(texts(document(feature("a"))), root, DAILY, "20240101")
    land_documents(texts(document(feature("b"))), root, DAILY, "20240102")
    land_documents(texts(document(feature("c"))), root, DAILY, "20240101")
    texts_left = sorted(row.value for row in read_text_documents(spark, root).collect())
    assert [json.loads(t)["features"][0]["properties"]["code"] for t in texts_left] == ["b", "c"]


def test_json_lines(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "é\n")], "a int, b string")
    path = write_jsonl(rows, str(tmp_path / "l"))
    lines = []
    for name in os.listdir(path):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as part:
                lines += part.read().splitlines()
    assert sorted(map(json.loads, lines), key=lambda r: r["a"]) == [{"a": 1}, {"a": 2, "b": "é\n"}]


def test_compressed_text_reads_back(spark, texts, tmp_path):
    text = document(feature("a", place="é"))
    path = land_documents(texts(text), str(tmp_path), DAILY, "20240101", compression="gzip")
    assert all(name.endswith(".gz") for name in spark.read.text(path).inputFiles())
    assert [r.value for r in read_text_documents(spark, path).collect()] == [text]
    rows = spark.createDataFrame([(1, "x")], "a int, b string")
    path = write_silver(rows, str(tmp_path), DAILY, "20240101", fmt="json", compression="gzip")
    assert [tuple(r) for r in spark.read.json(path).collect()] == [(1, "x")]


def test_unknown_silver_format(spark, tmp_path):
    with pytest.raises(ValueError, match="csv"):
        write_silver(spark.range(1), str(tmp_path), DAILY, "20240101", fmt="csv")


def test_text_sink_takes_any_column(spark, tmp_path):
    path = write_documents_text(spark.createDataFrame([("{}",)], "doc string"), str(tmp_path / "t"), "doc")
    assert read_text_documents(spark, path).first().value == "{}"


def test_overwrite_and_append(spark, table):
    rows = spark.range(10).withColumn("v", F.lit("x"))
    load_append(rows, table)  # creates
    load_append(rows.select("v", "id"), table)  # by name, not by position
    assert table_count(spark, table).first().table_rows == 20
    assert spark.table(table).agg(F.sum("id")).first()[0] == 90
    load_overwrite(rows, table)
    assert table_count(spark, table).first().table_rows == 10


def test_overwrite_may_change_the_columns(spark, table):
    load_overwrite(spark.range(3), table)
    load_overwrite(spark.range(2).withColumn("v", F.lit(1)), table)
    assert spark.table(table).columns == ["id", "v"]


def test_an_overwrite_that_fails_leaves_the_table(spark, table):
    load_overwrite(spark.range(3), table)
    broken = spark.range(5).withColumn("v", F.expr("if(id = 3, raise_error('no'), 1)"))
    with pytest.raises(Exception, match="no"):
        load_overwrite(broken, table)
    assert sorted(r.id for r in spark.table(table).collect()) == [0, 1, 2]
    assert [t.name for t in spark.catalog.listTables("sinks")] == ["feed"]


@pytest.mark.parametrize("load_id", [None, "it's 1"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_an_overwrite_that_is_cut_short_at_any_step(spark, table, monkeypatch, load_id, when):
    """The driver is lost before or after any statement that changes the catalog."""
    plain = SparkSession.sql
    steps = []

    def dies_at(step):
        def sql(self, query, *args, **options):
            changes = query.startswith(("ALTER", "DROP"))
            if changes:
                steps.append(query)
            if changes and when == "before" and len(steps) > step:
                raise KeyboardInterrupt(query)
            out = plain(self, query, *args, **options)
            if changes and when == "after" and len(steps) > step:
                raise KeyboardInterrupt(query)
            return out

        return sql

    for step in range(20):
        load_overwrite(spark.range(3), table, load_id=load_id)
        steps.clear()
        monkeypatch.setattr(SparkSession, "sql", dies_at(step))
        try:
            load_overwrite(spark.range(100, 105), table, load_id=load_id)
            done = True
        except KeyboardInterrupt:
            done = False
        monkeypatch.undo()
        if done:
            break
        got = sorted(r.id for r in read_table(spark, table).collect())
        assert got in ([0, 1, 2], [100, 101, 102, 103, 104]), steps
        committed = step > 0 or when == "after"
        recover(spark, table)
        after = sorted(r.id for r in spark.table(table).collect())
        assert after == ([100, 101, 102, 103, 104] if committed else [0, 1, 2]), steps
        assert table_rows(spark, table) == len(after)
        assert [t.name for t in spark.catalog.listTables("sinks")] == ["feed"]
    assert step >= 5


def test_an_incomplete_replacement_goes(spark, table):
    load_overwrite(spark.range(3), table)
    spark.range(9).write.saveAsTable(f"{table}__new_0123456789ab")
    spark.range(9).write.saveAsTable(f"{table}__new_products")
    load_append(spark.range(2), table)
    assert spark.table(table).count() == table_rows(spark, table) == 5
    assert sorted(t.name for t in spark.catalog.listTables("sinks")) == ["feed", "feed__new_products"]
    spark.sql(f"DROP TABLE {table}__new_products")


def test_a_row_report_opens_no_data_file(spark, table, tmp_path):
    load_overwrite(spark.range(1_000), table)
    load_append(spark.range(500), table)
    spark.sparkContext.setJobGroup("report", "report")
    try:
        assert table_rows(spark, table) == 1_500
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("report")
    assert len(jobs) == 0
    # A failed load leaves no count to trust: the table is counted.
    broken = spark.range(5).withColumn("id", F.expr("if(id = 3, raise_error('no'), id)"))
    with pytest.raises(Exception, match="no"):
        load_append(broken, table)
    spark.range(2).write.mode("append").saveAsTable(table)
    assert table_rows(spark, table) == spark.table(table).count() >= 1_502
    load_overwrite(spark.range(4), table)
    load_direct(spark.range(3), table=table, mode="append")
    assert table_rows(spark, table) == 7


def test_row_counts_by_load(spark, table):
    load_overwrite(spark.range(5), table, load_id="base")
    for n in (7, 2):
        load_append(spark.range(n), table, load_id="it's 1")
        assert table_rows(spark, table) == 5 + n == spark.table(table).count()


def test_an_append_must_have_the_columns_of_the_table(spark, table):
    load_append(spark.range(3), table, load_id="a")
    for rows in (spark.range(3).withColumn("more", F.lit(1)), spark.range(3).select(F.col("id").alias("x"))):
        with pytest.raises(ValueError, match="more|x"):
            load_append(rows, table, load_id="b")
    with pytest.raises(ValueError, match="load id"):
        load_append(spark.range(3), table)
    load_overwrite(spark.range(2), table)
    with pytest.raises(ValueError, match="load id"):
        load_append(spark.range(3), table, load_id="b")
    assert spark.table(table).count() == 2


def test_a_bare_line_break_in_a_string_is_not_repaired(spark, texts, tmp_path):
    broken = document(feature("a", place="x")).replace('"x"', '"x\ny"')
    with pytest.raises(Exception, match="line break inside a string"):
        land_documents(texts(broken), str(tmp_path), DAILY, "20240101")


def test_load_id_makes_a_load_repeatable(spark, table):
    load_overwrite(spark.range(5), table, load_id="base")
    for _ in range(2):
        load_append(spark.range(7), table, load_id="it's 1")
    counts = {r.load_id: r["count"] for r in spark.table(table).groupBy("load_id").count().collect()}
    assert counts == {"base": 5, "it's 1": 7}


def test_database_is_created(spark):
    load_overwrite(spark.range(3), "made_on_the_way.t")
    assert spark.table("made_on_the_way.t").count() == 3
    spark.sql("DROP DATABASE made_on_the_way CASCADE")


def test_direct_load(spark, table, tmp_path):
    path = str(tmp_path / "direct")
    load_direct(spark.range(4), fmt="json", options={"path": path})
    load_direct(spark.range(4), fmt="json", mode="append", options={"path": path})
    assert spark.read.json(path).count() == 8
    load_direct(spark.range(4), table=table, fmt="orc")
    with pytest.raises(Exception, match="(?i)already exists"):
        load_direct(spark.range(4), table=table, fmt="orc", mode="error")


def test_autodetected_load(spark, table, tmp_path):
    path = write_jsonl(spark.createDataFrame([(1, 2.5, "x")], "a int, b float, c string"), str(tmp_path / "j"))
    for _ in range(2):
        load_autodetected(spark, path, table)
    assert dict(spark.table(table).dtypes) == {"a": "bigint", "b": "double", "c": "string"}
    assert spark.table(table).count() == 1
