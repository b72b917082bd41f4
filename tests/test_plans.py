"""What the physical plans must and must not contain."""

import contextlib
import io

import pytest
from feed_documents import document, feature

import __spark_entry__ as registry
from feed_queries.feed import EARLY, day_documents, documents
from feed_queries.scans import delivered
from feedlake.operators import flatten
from feedlake.plans import to_silver
from feedlake.sinks import land_documents
from feedlake.sources import DAILY, read_documents, read_run, read_silver, read_split_documents

SMALL = "/root/testdata/sf0.001"


def plan(frame, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


@pytest.fixture
def landing(texts, tmp_path):
    root = str(tmp_path / "landing")
    for date in ("20240101", "20240102"):
        land_documents(texts(document(feature(date))), root, DAILY, date)
    return root


def test_landing_to_silver_is_map_only(spark, landing):
    text = plan(to_silver(flatten(read_documents(spark, landing))))
    assert "Exchange" not in text and "Python" not in text and "Pandas" not in text


def test_only_pieces_that_cross_a_range_are_shuffled(spark, landing):
    text = plan(to_silver(flatten(read_split_documents(spark, landing, check=False))), "simple")
    below = [line for line in text.split("Union")[1].splitlines()[1:] if line.strip()]
    depth = len(below[0]) - len(below[0].lstrip())
    whole = [line for line in below if line[depth : depth + 1] == ":"]
    crossing = [line for line in below if line[depth : depth + 1] != ":"]
    assert any("FileScan" in line for line in whole) and not any("Exchange" in line for line in whole)
    assert any("Exchange" in line for line in crossing)
    assert "Python" not in text


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("mode", ["FAILFAST", "PERMISSIVE"])
def test_each_text_is_parsed_once(spark, landing, strict, mode):
    text = plan(flatten(read_documents(spark, landing, mode=mode), strict=strict), "simple")
    assert text.count("from_json(") == 1
    # Whole pieces and those put together are parsed after their union.
    text = plan(flatten(read_split_documents(spark, landing, mode=mode, check=False), strict=strict), "simple")
    assert text.count("from_json(") == 1


def test_landing_to_silver_is_generated_code_around_the_parse(spark, landing):
    text = plan(to_silver(flatten(read_documents(spark, landing))), "codegen")
    assert "Found 2 WholeStageCodegen" in text


def test_only_asked_members_are_parsed(spark, landing):
    columns = ("mag", "depth")
    text = plan(flatten(read_documents(spark, landing, columns=columns), columns))
    assert "(mag,StringType,true)" in text or "mag" in text
    assert "place" not in text


def test_a_run_lists_its_own_folder(spark, landing):
    text = plan(flatten(read_run(spark, landing, DAILY, "20240102")))
    assert "ingest_date=20240102" in text and "ingest_date=20240101" not in text


def test_silver_scan_reads_only_used_columns(spark, landing, tmp_path):
    path = str(tmp_path / "silver")
    to_silver(flatten(read_documents(spark, landing))).write.parquet(path)
    text = plan(read_silver(spark, path, fmt="parquet").select("mag").filter("place = 'x'"))
    assert "ReadSchema: struct<mag:float,place:string>" in text
    assert "EqualTo(place,x)" in text


def test_regular_expression_runs_once_per_value(spark):
    text = plan(registry.queries()["q_area_regex"](spark, SMALL), "simple")
    assert text.lower().count("regexp_extract") == 1
    assert "rlike" not in text.lower()


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """The given tables in as many files as a large table has per core."""
    root = tmp_path_factory.mktemp("many")
    files = 2 * spark.sparkContext.defaultParallelism
    for name in ("events", "orders", "documents", "customer"):
        rows = spark.read.parquet(f"{SMALL}/{name}.parquet")
        rows.repartition(files).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize(
    "name",
    """q_silver_rows q_text_scan q_dated_scan q_typed_projection q_epoch_guarded
    q_epoch_session q_area_regex q_area_positional q_to_json q_flat_map q_backfill
    """.split(),
)
def test_queries_do_not_shuffle(spark, many_files, name):
    assert "Exchange" not in plan(registry.queries()[name](spark, many_files))


def test_events_are_chosen_in_the_scan(spark):
    text = plan(documents(spark, SMALL, where=EARLY))
    assert "LessThan(ts" in text


def test_documents_of_a_day_are_rendered_after_the_shuffle(spark):
    """Events are shuffled and sorted, not their many times larger features."""
    text = plan(day_documents(spark, SMALL, 5000), "simple")
    assert text.index("StructsToJson") < text.index("Sort [") < text.index("Exchange hashpartitioning")


def test_delivered_files_may_be_compressed(spark):
    docs = {c: read_documents(spark, delivered(spark, SMALL, c), multi_line=True) for c in ("none", "gzip")}
    assert all(f.endswith(".gz") for f in docs["gzip"].inputFiles())
    assert not any(f.endswith(".gz") for f in docs["none"].inputFiles())
    ids = [sorted(r["id"] for r in d.selectExpr("explode(features) AS f").select("f.id").collect()) for d in docs.values()]
    assert ids[0] == ids[1] and len(ids[0]) == spark.read.parquet(f"{SMALL}/events.parquet").count()
