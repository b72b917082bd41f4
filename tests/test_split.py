"""Documents of any layout, cut by many tasks: the features must be those of the whole file."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedlake.operators import flatten
from feedlake.sources import read_documents, read_split_documents, split_documents


@pytest.fixture(params=[100_000, 0], ids=["sent", "joined"])
def sent_ranges(request):
    """States of the ranges sent to the tasks, or joined to the text."""
    return request.param


@pytest.fixture
def small_ranges(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def tricky(draw: random.Random, name: str) -> dict:
    """A feature whose texts look like structure."""
    odd = ["{", "}", "[{", "]},{", '"', '\\"', "\\", "\\\\", '{"type":"Feature",', 'features":[{', "é中😀", "a\nb\t", "", "x" * 200]
    place = "".join(draw.choices(odd, k=draw.randrange(6)))
    more = {"deep": [[{"a": [{}, [], {"b": "]}"}]}], [1, 2]], "features": [{"type": "Feature"}, {"x": 1}]}
    return {
        "type": "Feature",
        "properties": {"code": name, "place": place, "more": more if draw.random() < 0.3 else None},
        "geometry": {"type": "Point", "coordinates": [draw.random(), 2.5, None][: draw.randrange(4)]},
        "id": name,
    }


def whole(draw: random.Random, label: str, n: int) -> dict:
    members = [
        ("type", "FeatureCollection"),
        ("metadata", {"title": 'a "quoted" {title}', "features": [{"no": 1}, {"no": 2}], "n": n}),
        ("links", [{"href": "x"}, {"href": "y", "features": [{"z": {}}]}]),
        ("features", [tricky(draw, f"{label}-{i}") for i in range(n)]),
        ("bbox", [1, 2, 3]),
        ("after", [{"type": "Feature", "properties": {"code": "not one"}}]),
    ]
    draw.shuffle(members)
    return dict(members)


def styles(value: dict) -> list[str]:
    return [
        json.dumps(value), json.dumps(value, separators=(",", ":")), json.dumps(value, indent=2) + "\n",
        json.dumps(value, indent="\t", ensure_ascii=False).replace("\n", "\r\n"), " \n" + json.dumps(value, separators=(" ,\n", " : ")),
    ]


def deliver(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


COLUMNS = ("code", "place", "longitude", "latitude", "depth")


def rows(documents):
    return sorted(flatten(documents, COLUMNS, strict=True, keep_id=True).collect(), key=repr)


@pytest.mark.parametrize("size", [400, 5_000, 1 << 27])
def test_every_layout_and_range(spark, tmp_path, small_ranges, sent_ranges, size):
    draw = random.Random(size)
    for n in (0, 1, 12):
        for i, text in enumerate(styles(whole(draw, f"n{n}", n))):
            deliver(tmp_path, f"{n}-{i}.json", text)
    small_ranges(size)
    got = rows(read_split_documents(spark, str(tmp_path), sent_ranges=sent_ranges, columns=COLUMNS))
    want = rows(read_documents(spark, str(tmp_path), multi_line=True, columns=COLUMNS))
    assert len(want) == 5 * 13
    assert got == want


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**9), st.integers(100, 3_000), st.integers(0, 12))
def test_any_document(spark, tmp_path_factory, small_ranges, seed, size, n):
    draw = random.Random(seed)
    folder = tmp_path_factory.mktemp("any")
    deliver(folder, "1.json", draw.choice(styles(whole(draw, "f", n))))
    small_ranges(size)
    got = rows(read_split_documents(spark, str(folder), columns=COLUMNS))
    assert got == rows(read_documents(spark, str(folder), multi_line=True, columns=COLUMNS))


def test_a_pretty_printed_document_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    draw = random.Random(9)
    text = json.dumps(whole(draw, "f", 3_000), indent=2)
    deliver(tmp_path, "1.json", text)
    small_ranges(len(text) // 12)
    pieces = split_documents(spark, str(tmp_path))
    assert pieces.count() >= 3_000
    ranges = spark.read.parquet(pieces.inputFiles()[0].split("/pieces/")[0] + "/ranges")
    assert 10 <= ranges.count() <= 16
    longest = max(len(r.value) for r in pieces.collect())
    assert longest < len(text) // 100


def test_one_feature_over_many_ranges(spark, tmp_path, small_ranges, sent_ranges):
    value = {"type": "FeatureCollection", "features": [tricky(random.Random(1), c) for c in "abc"]}
    value["features"][1]["properties"]["place"] = "{" * 20_000
    value["features"][1]["properties"]["more"] = [{"k": [i]} for i in range(3_000)]
    deliver(tmp_path, "1.json", json.dumps(value, indent=1))
    small_ranges(2_000)
    got = rows(read_split_documents(spark, str(tmp_path), sent_ranges=sent_ranges, columns=COLUMNS))
    assert got == rows(read_documents(spark, str(tmp_path), multi_line=True, columns=COLUMNS))
    assert [len(r.place) for r in got if r.id == 'b'] == [20_000]


@pytest.mark.parametrize("size", [600, 1 << 27])
def test_cut_off_and_second_documents(spark, tmp_path, small_ranges, size):
    draw = random.Random(3)
    text = json.dumps(whole(draw, "f", 4), indent=1)
    bad = [text[:at] for at in (1, 30, len(text) // 3, len(text) // 2, len(text) - 2, len(text) - 1)]
    bad += [text + text, text + "\n" + text, text + "{", text + "}", text + '{"a":1}', text[:-1] + "]"]
    small_ranges(size)
    for i, one in enumerate(bad):
        deliver(tmp_path / str(i), "1.json", one)
        with pytest.raises(Exception, match="(?i)malformed|not one whole"):
            rows(read_split_documents(spark, str(tmp_path / str(i)), columns=COLUMNS))
    deliver(tmp_path / "good", "1.json", text + " \n\t ")
    assert len(rows(read_split_documents(spark, str(tmp_path / "good"), columns=COLUMNS))) == 4


def test_members_without_a_comma_or_with_two_are_errors(spark, tmp_path, small_ranges):
    plain = json.dumps({"features": [{"id": "a"}, {"id": "b"}, {"id": "c"}]})
    for i, text in enumerate([plain.replace("}, {", "} {", 1), plain.replace("}, {", "},, {", 1), plain.replace("[{", "[,{")]):
        deliver(tmp_path / str(i), "1.json", text)
        with pytest.raises(Exception, match="(?i)malformed"):
            rows(read_split_documents(spark, str(tmp_path / str(i)), columns=COLUMNS))


def test_other_members_of_the_list(spark, tmp_path):
    text = '{"features" : [null, {"id":"a"}, null, {"id":"b"}, null ], "n": 1}'
    deliver(tmp_path, "1.json", text)
    deliver(tmp_path, "2.json", '{"feat\\u0075res":[{"id":"c"},{"id":"d"}]}')
    got = read_split_documents(spark, str(tmp_path)).selectExpr("explode(features) AS f").select("f.id").collect()
    assert sorted(r.id or "" for r in got) == ["", "", "", "a", "b", "c", "d"]


def test_compressed_files(spark, tmp_path):
    import gzip

    (tmp_path / "1.json.gz").write_bytes(gzip.compress(json.dumps(whole(random.Random(2), "z", 9)).encode()))
    assert len(rows(read_split_documents(spark, str(tmp_path), columns=COLUMNS))) == 9
