import json
import os
import random
import time
from datetime import datetime
from pathlib import Path

import pytest
from feed_documents import document, feature
from pyspark.sql import functions as F

from feedlake.operators import flatten
from feedlake.plans import (
    load_silver,
    load_warehouse,
    run_backfill,
    run_daily,
    run_silver,
    to_silver,
)
from feedlake.plans.runs import silver_rows
from feedlake.schemas import SILVER, WAREHOUSE
from feedlake.sinks import land_documents, table_rows, write_documents_framed
from feedlake.sources import (
    BACKFILL,
    DAILY,
    parse_documents,
    read_documents,
    read_rejected,
    read_silver,
    run_path,
    split_documents,
)
from feedlake.streaming import run_daily_stream

AS_OF = datetime(2024, 10, 21, 9, 0, 0, 5000)
TIME = 1729498113226


@pytest.fixture
def lake(spark, tmp_path):
    """Places of one lake, as keyword arguments of a run."""
    spark.sql(f"CREATE DATABASE lake LOCATION '{tmp_path}/lake'")
    yield {
        "landing": str(tmp_path / "landing"),
        "silver": str(tmp_path / "silver"),
        "table": "lake.feed",
    }
    spark.sql("DROP DATABASE lake CASCADE")


def quake(code, **properties):
    given = {"mag": 1.1, "place": "5 km N of X, Y", "time": TIME, "updated": TIME, **properties}
    return feature(code, **given)


def codes(spark, table="lake.feed"):
    return sorted(row.code for row in spark.table(table).collect())


def test_silver_columns(spark, texts):
    flat = flatten(parse_documents(texts(document(quake("a", updated=0)))))
    rows = to_silver(flat, as_of=AS_OF)
    assert [(f.name, f.dataType) for f in rows.schema.fields] == [
        (f.name, f.dataType) for f in SILVER.fields
    ]
    row = rows.first()
    assert (row.time, row.updated, row.area) == ("2024-10-21 08:08:33", None, "X, Y")
    text = to_silver(flat, stamp="text", as_of=AS_OF).first()
    assert text.insert_date == "2024-10-21 09:00:00"
    session = to_silver(flat, area="positional", epoch="session").first()
    assert (session.updated, session.area) == ("1970-01-01 00:00:00", "X, Y")
    for option in ("area", "epoch", "stamp"):
        with pytest.raises(ValueError, match=option):
            to_silver(flat, **{option: "other"})


@pytest.mark.parametrize("silver_format", ["parquet", "json"])
def test_backfill_twice_leaves_one_copy(spark, texts, lake, silver_format):
    docs = texts(document(quake("a"), quake("b", tz=-480, felt=12)), document(quake("c")))
    for _ in range(2):
        report = run_backfill(spark, documents=docs, as_of=AS_OF, silver_format=silver_format, **lake)
    assert (report.records, report.table_rows, report.run_date) == (3, 3, "20241021")
    assert report.silver_path == run_path(lake["silver"], BACKFILL, "20241021")
    stored = spark.table("lake.feed")
    assert [(f.name, f.dataType) for f in stored.schema.fields] == [
        (f.name, f.dataType) for f in WAREHOUSE.fields
    ]
    row = stored.filter("code = 'b'").first()
    assert (row.mag, row.tz, row.felt, row.area) == (1.1, -480, 12, "X, Y")
    assert row.injection_date == "2024-10-21T09:00:00.005Z"


def test_backfill_then_daily_is_the_sum(spark, texts, lake):
    run_backfill(spark, documents=texts(document(quake("a"), quake("b"))), as_of=AS_OF, **lake)
    report = run_daily(spark, documents=texts(document(quake("c"))), as_of=AS_OF, **lake)
    assert (report.records, report.table_rows) == (1, 3)
    # The daily run of the same day again: its rows come twice.
    run_daily(spark, documents=texts(document(quake("c"))), as_of=AS_OF, **lake)
    assert codes(spark) == ["a", "b", "c", "c"]


def test_silver_files_by_number_and_by_rows(spark, texts, lake):
    docs = texts(*[document(quake(f"c{i}")) for i in range(40)]).repartition(5)
    report = run_backfill(spark, documents=docs, as_of=AS_OF, files=1, **lake)
    assert len(spark.read.parquet(report.silver_path).inputFiles()) == 1
    report = run_backfill(spark, documents=docs, as_of=AS_OF, files=1, records_per_file=15, **lake)
    assert len(spark.read.parquet(report.silver_path).inputFiles()) == 3
    assert (report.records, report.table_rows) == (40, 40)


def test_large_delivered_files_are_landed_as_pieces(spark, lake, tmp_path):
    whole = {"type": "FeatureCollection", "features": [quake(f"c{i}") for i in range(400)]}
    (tmp_path / "inbox.json").write_text(json.dumps(whole, separators=(",", ":")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        docs = split_documents(spark, str(tmp_path / "inbox.json"))
        report = run_backfill(spark, documents=docs, as_of=AS_OF, **lake)
        landed = spark.read.text(f"{lake['landing']}/run_kind=backfill/ingest_date=20241021")
        assert landed.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (report.records, report.table_rows) == (400, 400)


def test_what_a_run_does_not_take_is_set_aside(spark, texts, lake):
    bad, empty = document(quake("x"))[:-9], '{"type": "FeatureCollection"}'
    docs = texts(document(quake("a")), bad, empty, document(quake("b")))
    options = {"documents": docs, "as_of": AS_OF, "mode": "PERMISSIVE", **lake}
    report = run_backfill(spark, strict=False, **options)
    assert (report.records, report.rejected, report.table_rows) == (2, 2, 2)
    aside = read_rejected(spark, report.rejected_path, fmt="parquet")
    assert sorted(r.value for r in aside.collect()) == sorted([bad, empty])
    with pytest.raises(Exception, match="no features member"):
        run_backfill(spark, strict=True, **options)
    assert codes(spark) == ["a", "b"]
    silver = run_silver(
        spark, landing=lake["landing"], silver=lake["silver"], run_kind=BACKFILL, as_of=AS_OF,
        mode="PERMISSIVE", strict=False,
    )
    assert (silver.records, silver.rejected) == (2, 2)
    aside = read_rejected(spark, silver.rejected_path)
    assert sorted(r.value for r in aside.collect()) == sorted([bad, empty])
    assert sorted(r.code for r in read_silver(spark, silver.silver_path).collect()) == ["a", "b"]
    assert load_warehouse(
        spark, silver=lake["silver"], table="lake.inferred", run_date="20241021", run_kind=BACKFILL
    ) == 2
    assert "value" not in spark.table("lake.inferred").columns


def test_accepted_and_rejected_come_from_one_job(spark, texts, lake):
    bad = document(quake("x"))[:-9]
    docs = texts(document(quake("a")), bad, "{}", document())
    land_documents(docs, lake["landing"], DAILY, "20241021")
    spark.sparkContext.setJobGroup("one", "one")
    try:
        report = run_silver(
            spark, landing=lake["landing"], silver=lake["silver"], as_of=AS_OF,
            mode="PERMISSIVE", strict=False, silver_format="parquet",
        )
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one")) == 1
    assert (report.records, report.rejected) == (1, 2)
    raw = parse_documents(docs, mode="PERMISSIVE", keep_text=True)
    rows = silver_rows(raw, strict=False, mode="PERMISSIVE", as_of=AS_OF)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_all_or_none_rejected(spark, texts, lake):
    options = {"as_of": AS_OF, "mode": "PERMISSIVE", "strict": False, **lake}
    report = run_backfill(spark, documents=texts("{}", "x"), **options)
    assert (report.records, report.rejected, report.table_rows) == (0, 2, 0)
    report = run_backfill(spark, documents=texts(document(quake("a"))), **options)
    assert (report.records, report.rejected, report.table_rows) == (1, 0, 1)


@pytest.mark.parametrize("silver_format", ["parquet", "json"])
def test_landed_frames(spark, texts, lake, silver_format):
    docs = texts(document(quake("a")), document(quake("b"), quake("c")), "{}")
    options = {"as_of": AS_OF, "layout": "frames", "silver_format": silver_format, "strict": False, **lake}
    report = run_backfill(spark, documents=docs, **options)
    assert (report.records, report.rejected) == (3, 1)
    assert run_backfill(spark, **options).records == 3
    assert codes(spark) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="layout"):
        run_backfill(spark, documents=docs, as_of=AS_OF, **{**lake, "layout": "tar"})


def test_one_landed_file_of_frames_is_read_by_many_tasks(spark, lake, tmp_path):
    draw = random.Random(1)
    texts = [(document(*(quake(f"{i}-{j}", place=draw.randbytes(90).hex()) for j in range(40))),) for i in range(800)]
    docs = spark.createDataFrame(texts, "value string").coalesce(1)
    path = write_documents_framed(docs, str(tmp_path / "landed"), frame_bytes=1 << 20)
    (file,) = Path(path).glob("*.parquet")
    size, before = file.stat().st_size, spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 6))
    try:
        raw = read_documents(spark, path, layout="frames", columns=("code",))
        taken = flatten(raw, ("code",)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(r["count"] for r in taken) == 32_000
    assert len(taken) >= 5 and max(r["count"] for r in taken) < 12_000


def test_silver_is_loaded_alone(spark, texts, lake):
    docs = texts(document(quake("a"), quake("b")))
    run_daily(spark, documents=docs, as_of=AS_OF, silver_format="json", **lake)
    place = {"silver": lake["silver"], "table": lake["table"], "run_date": "20241021", "silver_format": "json"}
    assert load_silver(spark, **place) == 4
    assert load_silver(spark, mode="overwrite", **place) == 2
    assert load_silver(spark, mode="overwrite", count_table=False, **place) is None
    assert spark.table("lake.feed").schema == WAREHOUSE
    with pytest.raises(ValueError, match="upsert"):
        load_silver(spark, mode="upsert", **place)


def test_daily_with_a_load_id_can_be_repeated(spark, texts, lake):
    run_backfill(spark, documents=texts(document(quake("a"))), as_of=AS_OF, load_id="base", **lake)
    for _ in range(2):
        run_daily(
            spark, documents=texts(document(quake("c"))), as_of=AS_OF, load_id="day-1",
            count_table=False, **lake,
        )
    assert codes(spark) == ["a", "c"]


@pytest.mark.parametrize("options", [{"multi_line": True}, {"split": True}])
def test_delivered_files(spark, lake, tmp_path, options):
    folder = tmp_path / "landing" / "run_kind=backfill" / "ingest_date=20241021"
    folder.mkdir(parents=True)
    whole = {"type": "FeatureCollection", "features": [quake("a"), quake("b")]}
    (folder / "20241021.json").write_text(json.dumps(whole, separators=(",", ":")))
    (folder / "more.json").write_text(json.dumps(whole, indent=2))
    report = run_backfill(spark, as_of=AS_OF, **options, **lake)
    assert report.records == 4
    assert codes(spark) == ["a", "a", "b", "b"]


def test_errors_are_not_swallowed(spark, texts, lake):
    with pytest.raises(Exception, match="(?i)malformed"):
        run_backfill(spark, documents=texts('{"features":[{'), as_of=AS_OF, **lake)
    with pytest.raises(Exception, match="no features member"):
        run_daily(spark, documents=texts("{}"), as_of=AS_OF, **lake)
    report = run_daily(spark, documents=texts("{}", document(quake("a"))), as_of=AS_OF, strict=False, **lake)
    assert report.records == 1


def test_raw_to_silver_to_warehouse(spark, texts, lake):
    docs = texts(document(quake("a", time="bad"), quake("b", place="Nevada")))
    land_documents(docs, lake["landing"], DAILY, "20241021")
    report = run_silver(spark, landing=lake["landing"], silver=lake["silver"], as_of=AS_OF)
    assert report.records == 2
    rows = {r.code: r for r in spark.read.json(report.silver_path).collect()}
    assert (rows["a"].time, rows["a"].updated, rows["a"].area) == (None, None, "X, Y")
    assert (rows["b"].time, rows["b"].area) == ("2024-10-21 08:08:33", None)
    assert rows["b"].insert_date == "2024-10-21 09:00:00"
    for _ in range(2):
        total = load_warehouse(spark, silver=lake["silver"], table=lake["table"], run_date="20241021")
    assert total == 2
    assert dict(spark.table("lake.feed").dtypes)["mag"] == "double"


def test_stream_takes_each_file_once(spark, texts, lake, tmp_path):
    options = {**lake, "checkpoint": str(tmp_path / "checkpoint"), "timeout": 120, "as_of": AS_OF}
    land_documents(texts(document(quake("a"), quake("b")), document(quake("c"))), lake["landing"], DAILY, "20241021")
    run_daily_stream(spark, **options)
    assert codes(spark) == ["a", "b", "c"]
    run_daily_stream(spark, **options)
    assert codes(spark) == ["a", "b", "c"]
    land_documents(texts(document(quake("d"))), lake["landing"], DAILY, "20241022")
    run_daily_stream(spark, max_files_per_batch=1, **options)
    assert codes(spark) == ["a", "b", "c", "d"]
    row = spark.table("lake.feed").filter("code = 'd'").first()
    assert (row.area, row.time, row.mag) == ("X, Y", "2024-10-21 08:08:33", 1.1)


def test_stream_batch_that_runs_again_changes_nothing(spark, texts, lake, tmp_path):
    checkpoint = tmp_path / "checkpoint"
    options = {**lake, "checkpoint": str(checkpoint), "timeout": 120, "as_of": AS_OF}
    land_documents(texts(document(quake("a"), quake("b"))), lake["landing"], DAILY, "20241021")
    run_daily_stream(spark, **options)
    # As after a failure between the load and the commit of the batch.
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink()
    run_daily_stream(spark, **options)
    assert codes(spark) == ["a", "b"]


@pytest.mark.parametrize("limit", [{"max_files_per_batch": 1}, {"max_bytes_per_batch": 1}])
def test_stream_backlog_in_several_batches(spark, texts, lake, tmp_path, limit):
    for day in ("20241021", "20241022", "20241023"):
        land_documents(texts(document(quake(day))), lake["landing"], DAILY, day)
    run_daily_stream(spark, checkpoint=str(tmp_path / "checkpoint"), timeout=120, **limit, **lake)
    stored = spark.table("lake.feed")
    assert codes(spark) == ["20241021", "20241022", "20241023"]
    assert stored.select("load_id").distinct().count() == 3


def test_stream_takes_old_files_too(spark, texts, lake, tmp_path):
    options = {**lake, "checkpoint": str(tmp_path / "checkpoint"), "timeout": 120, "as_of": AS_OF}
    land_documents(texts(document(quake("new"))), lake["landing"], DAILY, "20241021")
    run_daily_stream(spark, **options)
    late = land_documents(texts(document(quake("late"))), lake["landing"], DAILY, "20240901")
    before = time.time() - 30 * 86400
    for path in Path(late).glob("part-*"):
        os.utime(path, (before, before))
    run_daily_stream(spark, **options)
    assert codes(spark) == ["late", "new"]


def test_stream_stops_on_or_sets_aside_what_it_cannot_take(spark, texts, lake, tmp_path):
    bad = document(quake("x"))[:-9]
    docs = texts("{}", bad, document(quake("a")))
    land_documents(docs, lake["landing"], DAILY, "20241021")
    options = {**lake, "timeout": 120, "as_of": AS_OF}
    with pytest.raises(Exception, match="(?i)malformed|no features member"):
        run_daily_stream(spark, checkpoint=str(tmp_path / "one"), **options)
    loads = run_daily_stream(spark, checkpoint=str(tmp_path / "two"), strict=False, mode="PERMISSIVE", **options)
    assert codes(spark) == ["a"]
    assert [(one.run_date, one.records, one.rejected) for one in loads] == [("20241021", 1, 2)]
    aside = read_rejected(spark, loads[0].rejected_path, fmt="parquet")
    assert sorted(r.value for r in aside.collect()) == sorted(["{}", bad])


def test_a_day_landed_again_through_the_stream_replaces_itself(spark, texts, lake, tmp_path):
    options = {**lake, "checkpoint": str(tmp_path / "checkpoint"), "timeout": 120, "as_of": AS_OF}
    for day in ("20241021", "20241022"):
        land_documents(texts(document(quake(f"{day}-a"), quake(f"{day}-b"))), lake["landing"], DAILY, day)
    told = []
    loads = run_daily_stream(spark, on_load=told.append, **options)
    assert [(one.run_date, one.records) for one in loads] == [("20241021", 2), ("20241022", 2)] and told == loads
    land_documents(texts(document(quake("20241021-a"))), lake["landing"], DAILY, "20241021")
    loads = run_daily_stream(spark, **options)
    assert [(one.run_date, one.records) for one in loads] == [("20241021", 1)]
    assert codes(spark) == ["20241021-a", "20241022-a", "20241022-b"]
    assert table_rows(spark, lake["table"]) == 3
    # More files of a day that is there: the day is loaded with all of them.
    more = lake["landing"] + "/run_kind=daily/ingest_date=20241022/more.json"
    Path(more).write_text(document(quake("20241022-c")))
    assert [one.records for one in run_daily_stream(spark, **options)] == [3]
    assert codes(spark) == ["20241021-a", "20241022-a", "20241022-b", "20241022-c"]
    # A day of no features takes the place of its rows.
    land_documents(texts(document()), lake["landing"], DAILY, "20241022")
    run_daily_stream(spark, **options)
    assert codes(spark) == ["20241021-a"]
    assert table_rows(spark, lake["table"]) == 1
    assert run_daily_stream(spark, **options) == []


def test_stream_over_frames(spark, texts, lake, tmp_path):
    land_documents(texts(document(quake("a"))), lake["landing"], DAILY, "20241021", layout="frames")
    run_daily_stream(spark, checkpoint=str(tmp_path / "c"), layout="frames", timeout=120, **lake)
    assert codes(spark) == ["a"]


def test_one_stream_name_with_two_checkpoints_replaces_nothing(spark, texts, lake, tmp_path):
    for number, name in enumerate(("one", "two")):
        land_documents(texts(document(quake(name))), f"{lake['landing']}-{number}", DAILY, "20241021")
        run_daily_stream(
            spark, checkpoint=str(tmp_path / name), stream_name="feed", timeout=120,
            **{**lake, "landing": f"{lake['landing']}-{number}"},
        )
    assert codes(spark) == ["one", "two"]


def test_two_streams_share_a_table(spark, texts, lake, tmp_path):
    land_documents(texts(document(quake("a"))), lake["landing"], DAILY, "20241021")
    for name in ("one", "two"):
        run_daily_stream(
            spark, checkpoint=str(tmp_path / name), stream_name=name, timeout=120, silver_format="json", **lake
        )
    assert codes(spark) == ["a", "a"]
