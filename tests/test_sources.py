import json
from datetime import date, datetime

import pytest
from feed_documents import document, feature

from feedlake.operators import flatten
from feedlake.plans import to_silver
from feedlake.schemas import CORRUPT, WAREHOUSE
from feedlake.sinks import land_documents, write_jsonl, write_parquet
from feedlake.sources import (
    BACKFILL,
    DAILY,
    parse_documents,
    read_chosen_runs,
    read_autodetect,
    read_documents,
    read_run,
    read_silver,
    read_split_documents,
    read_text_documents,
    run_file_glob,
)


def codes(documents, **options):
    return sorted(row.code for row in flatten(documents, **options).collect())


def features(prefix, count, start=0):
    return [feature(f"{prefix}{i}", place=f'{i} "of" {{"type":"Feature", é'[: i % 40]) for i in range(start, count)]


def deliver(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def compact(*members, **more):
    whole = {"type": "FeatureCollection", **more, "features": list(members), "bbox": [1, 2]}
    return json.dumps(whole, separators=(",", ":"), ensure_ascii=False)


def test_multi_line_files(spark, tmp_path):
    pretty = json.dumps(json.loads(document(feature("a"), feature("b"))), indent=2)
    deliver(tmp_path, "1.json", pretty)
    deliver(tmp_path, "2.json", document(feature("c")))
    assert codes(read_documents(spark, str(tmp_path), multi_line=True)) == ["a", "b", "c"]


def test_multi_line_run_keeps_its_partition(spark, tmp_path):
    folder = tmp_path / "run_kind=daily" / "ingest_date=20240102"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text(json.dumps(json.loads(document(feature("a"))), indent=2))
    run = read_run(spark, str(tmp_path), DAILY, "20240102", multi_line=True)
    row = flatten(run, keep=["run_kind", "ingest_date"]).first()
    assert (row.run_kind, row.ingest_date, row.code) == (DAILY, "20240102", "a")


def test_several_documents_per_file_by_line(spark, tmp_path):
    lines = "\n".join([document(feature("a")), document(feature("b"), feature("c"))])
    deliver(tmp_path, "1.json", lines)
    assert codes(read_documents(spark, str(tmp_path))) == ["a", "b", "c"]
    by_text = parse_documents(read_text_documents(spark, str(tmp_path)))
    assert codes(by_text) == ["a", "b", "c"]


def test_whole_text(spark, tmp_path):
    pretty = json.dumps(json.loads(document(feature("a"))), indent=2)
    deliver(tmp_path, "1.json", pretty)
    texts = read_text_documents(spark, str(tmp_path), whole_text=True)
    assert texts.count() == 1
    assert codes(parse_documents(texts)) == ["a"]


def test_malformed_documents(spark, tmp_path, texts):
    broken = document(feature("a"))[:-20]
    deliver(tmp_path, "1.json", "\n".join([broken, document(feature("b"))]))
    with pytest.raises(Exception, match="(?i)malformed"):
        codes(read_documents(spark, str(tmp_path)))
    kept = read_documents(spark, str(tmp_path), mode="PERMISSIVE").cache()
    assert [row[CORRUPT] for row in kept.filter(f"{CORRUPT} IS NOT NULL").collect()] == [broken]
    assert "b" in codes(kept)
    with pytest.raises(Exception, match="(?i)malformed"):
        codes(parse_documents(texts(broken)))
    parsed = parse_documents(texts(broken, document(feature("b"))), mode="PERMISSIVE")
    assert [row[CORRUPT] for row in parsed.collect()] == [broken, None]


@pytest.mark.parametrize(
    "text",
    ["{0}{0}", "{0} {0}", "{0},{0}", "{0} garbage ]]", "{0}]", "[{0}]", "null", "5", "{{", "[]", '{0},"x":1'],
)
def test_one_text_is_one_document(spark, texts, tmp_path, text):
    """Whatever follows the document is an error, in every reader."""
    bad = text.format(compact(feature("a")))
    deliver(tmp_path / "bad", "1.json", bad)
    for read in (
        lambda mode: parse_documents(texts(bad), mode=mode),
        lambda mode: read_documents(spark, str(tmp_path / "bad"), mode=mode),
        lambda mode: read_documents(spark, str(tmp_path / "bad"), mode=mode, multi_line=True),
    ):
        with pytest.raises(Exception, match="(?i)malformed"):
            read("FAILFAST").collect()
        (row,) = read("PERMISSIVE").collect()
        assert row["features"] is None and row[CORRUPT].strip() == bad
    with pytest.raises(Exception, match="(?i)malformed|not one whole"):
        codes(read_split_documents(spark, str(tmp_path / "bad")), strict=True)


def test_two_documents_in_a_file_of_lines_are_two(spark, tmp_path):
    deliver(tmp_path, "1.json", document(feature("a")) + "\n\n  \n" + document(feature("b")) + "\n")
    assert codes(read_documents(spark, str(tmp_path))) == ["a", "b"]
    with pytest.raises(Exception, match="(?i)malformed"):
        codes(read_documents(spark, str(tmp_path), multi_line=True))


@pytest.mark.parametrize("cut", ["comma", "feature", "second", "other second"])
def test_split_scan_stops_on_cut_files_and_second_documents(spark, tmp_path, cut):
    whole = compact(*features("a", 5))
    end = whole.index('{"type":"Feature","properties":{"code":"a3"')
    text = {
        "comma": whole[:end],
        "feature": whole[: end + 40],
        "second": whole + "\n" + whole,
        "other second": whole + "\n" + json.dumps(json.loads(whole), indent=1),
    }[cut]
    deliver(tmp_path, "1.json", text)
    with pytest.raises(Exception, match="(?i)malformed|not one whole"):
        codes(read_split_documents(spark, str(tmp_path)), strict=True)


@pytest.mark.parametrize("split_bytes", ["3000", "134217728"])
def test_split_scan_of_large_documents(spark, tmp_path, split_bytes):
    deliver(tmp_path, "1.json", compact(*features("a", 500), metadata={"count": 500}))
    deliver(tmp_path, "2.json", compact(*features("b", 3)))
    deliver(tmp_path, "3.json", compact())
    deliver(tmp_path, "4.json", document(*features("c", 300)))  # blanks: no separator in it
    deliver(tmp_path, "5.json", json.dumps(json.loads(document(*features("d", 20))), indent=1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        pieces = read_split_documents(spark, str(tmp_path))
        got = flatten(pieces, strict=True, keep_id=True).collect()
        want = flatten(
            read_documents(spark, str(tmp_path), multi_line=True), strict=True, keep_id=True
        ).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 823
    assert sorted(got, key=lambda r: r.id) == sorted(want, key=lambda r: r.id)


def test_split_scan_uses_many_tasks(spark, tmp_path):
    deliver(tmp_path, "1.json", compact(*features("a", 2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pieces = read_split_documents(spark, str(tmp_path), columns=("code",))
        assert pieces.rdd.getNumPartitions() > 8
        assert len(set(codes(pieces, columns=("code",)))) == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_split_scan_keeps_features_of_another_layout(spark, tmp_path):
    plain = compact(*features("a", 6))
    other = [json.dumps(f) for f in features("b", 9, 6)]
    untyped = '{"id":"id-c","properties":{"code":"c"}}'
    parts = plain.split(',{"type":"Feature",')
    mixed = ",".join([f'{parts[0]}', other[0], '{"type":"Feature",' + parts[1], other[1], untyped])
    mixed += "," + ",".join('{"type":"Feature",' + part for part in parts[2:])
    first = plain.replace('"features":[', f'"features":[{other[2]},')
    json.loads(mixed), json.loads(first)
    deliver(tmp_path, "1.json", mixed)
    deliver(tmp_path, "2.json", first)
    got = codes(read_split_documents(spark, str(tmp_path)))
    assert got == codes(read_documents(spark, str(tmp_path), multi_line=True))
    assert len(got) == 6 + 3 + 6 + 1


def test_split_scan_stops_on_broken_documents(spark, tmp_path):
    deliver(tmp_path, "1.json", compact(*features("a", 5)).replace('"id":"id-a2"', '"id":id'))
    with pytest.raises(Exception, match="(?i)malformed"):
        codes(read_split_documents(spark, str(tmp_path)))


def test_split_scan_reports_missing_features(spark, tmp_path):
    deliver(tmp_path, "1.json", '{"type":"FeatureCollection"}')
    with pytest.raises(Exception, match="no features member"):
        codes(read_split_documents(spark, str(tmp_path)), strict=True)


def test_file_of_one_run_by_name(spark, tmp_path):
    deliver(tmp_path, "20241021.json", document(feature("month")))
    deliver(tmp_path, "daily20241021.json", document(feature("day")))
    deliver(tmp_path, "daily20241022.json", document(feature("next")))
    for kind, date, want in (
        (BACKFILL, "20241021", ["month"]),
        (DAILY, "20241021", ["day"]),
        (DAILY, "20241022", ["next"]),
    ):
        glob = run_file_glob(kind, date)
        assert codes(read_documents(spark, str(tmp_path), multi_line=True, glob=glob)) == want
    with pytest.raises(ValueError, match="run_kind"):
        run_file_glob("weekly", "20241021")


def test_one_run_of_the_landing_zone(spark, texts, tmp_path):
    root = str(tmp_path / "landing")
    for kind, date, code in ((DAILY, "20240101", "a"), (DAILY, "20240102", "b"), (BACKFILL, "20240101", "c")):
        land_documents(texts(document(feature(code))), root, kind, date)
    run = read_run(spark, root, DAILY, "20240102")
    assert all("ingest_date=20240102" in path for path in run.inputFiles())
    row = flatten(run, keep=["run_kind", "ingest_date"]).first()
    assert (row.run_kind, row.ingest_date, row.code) == (DAILY, "20240102", "b")
    assert codes(read_run(spark, root, DAILY, ["20240101", "20240102"])) == ["a", "b"]


@pytest.mark.parametrize("layout", ["text", "frames"])
def test_runs_chosen_by_a_table_prune_their_folders(spark, tmp_path, layout):
    """300 days, three of them in the table: the files of the others are not opened."""
    days = [f"2024{i:04d}" for i in range(300)]
    rows = [(document(feature(day)), day) for day in days]
    landed = spark.createDataFrame(rows, "value string, ingest_date string").repartition(4)
    writer = landed.write.partitionBy("ingest_date")
    place = f"{tmp_path}/run_kind=daily"
    writer.text(place) if layout == "text" else writer.parquet(place)
    table = str(tmp_path / "runs")
    spark.createDataFrame([(day, n) for n, day in enumerate(days)], "ingest_date string, n int").write.parquet(table)
    runs = spark.read.parquet(table).filter("n % 100 = 7")
    chosen = read_chosen_runs(spark, str(tmp_path), DAILY, runs, layout=layout, columns=("code",))
    got = flatten(chosen, ("code",), keep=["ingest_date"])
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    # The folders are listed by now; a file that is gone would stop a task that opens it.
    for day in days:
        if day not in (days[7], days[107], days[207]):
            for path in (tmp_path / "run_kind=daily" / f"ingest_date={day}").glob("part-*"):
                path.unlink()
    assert sorted((r.ingest_date, r.code) for r in got.collect()) == [(d, d) for d in (days[7], days[107], days[207])]


def test_silver_lines_have_warehouse_types(spark, texts, tmp_path):
    flat = flatten(parse_documents(texts(document(feature("a", mag=1.1, tz="7", felt=3)))))
    rows = to_silver(flat, as_of=datetime(2024, 10, 21, 9, 0, 0, 5999))
    lines = write_jsonl(rows, str(tmp_path / "lines"))
    columnar = write_parquet(rows, str(tmp_path / "columnar"))
    from_lines = read_silver(spark, lines)
    assert from_lines.schema == WAREHOUSE
    row = from_lines.first()
    assert (row.mag, row.tz, row.felt, row.title) == (1.1, 7, 3, None)
    assert from_lines.collect() == read_silver(spark, columnar, fmt="parquet").collect()
    with pytest.raises(ValueError, match="csv"):
        read_silver(spark, lines, fmt="csv")


def test_inferred_types(spark, tmp_path):
    deliver(tmp_path, "1.json", '{"a":1,"t":"2024-10-21 08:08:33"}\n{"a":2.5,"b":true}')
    kinds = dict(read_autodetect(spark, str(tmp_path)).dtypes)
    assert kinds == {"a": "double", "b": "boolean", "t": "string"}
    kinds = dict(read_autodetect(spark, str(tmp_path), infer_timestamps=True).dtypes)
    assert kinds["t"].startswith("timestamp")


def test_types_written_with_silver_are_those_inferred(spark, tmp_path):
    """Every kind of column, alone and in two folders, against inference over the same lines."""
    schema = "a int, b bigint, c float, d double, e string, f boolean, g date, h timestamp, none string, `odd.name` smallint, bad double"
    day, time = date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5)
    rows = [(1, 2**40, 1.0, 1e300, "x", True, day, time, None, 3, 1.0), (None, None, None, None, "7", None, None, None, None, None, float("nan"))]
    one = write_jsonl(spark.createDataFrame(rows, schema), str(tmp_path / "one"))
    two = write_jsonl(spark.createDataFrame([(1.5, "x", 2, None)], "a double, b string, c int, e string"), str(tmp_path / "two"))
    for paths in ([one], [two], [one, two]):
        plain = [f"{p}/*.json" for p in paths]
        got, want = read_autodetect(spark, paths), spark.read.option("inferTimestamp", False).json(plain)
        assert got.schema == want.schema
        key = lambda r: str(tuple(r))
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    # The lines are not read for their types: here they are gone when the schema is made.
    for path in (tmp_path / "one").glob("part-*"):
        path.write_text("{broken")
    assert read_autodetect(spark, one).schema == spark.read.schema(read_autodetect(spark, one).schema).json(one).schema
    assert "_corrupt_record" not in read_autodetect(spark, one).columns
