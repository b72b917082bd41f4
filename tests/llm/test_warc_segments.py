import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.llm import warc_segments as warc

PAGES = "page_id long, url string, html string, block string, segment string, sha1 string"


@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunks_round_trip(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


def test_chunks_with_extensions_and_broken_ones():
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"2\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(ValueError, match="chunk"):
            warc.unchunked(broken)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "b", "s", "d") for r in rows], PAGES).repartition(3)


def expected(rows, least=0):
    out = []
    for i, (page_id, _, html) in enumerate(rows):
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == payload]
        top = max((p for p in same if p is not None), default=None)
        first = len(payload) < least or page_id == top
        out.append((page_id, len(payload), warc.digest(payload), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, "http://a/9", "<p>same</p>"),
    (3, None, None), (4, "x\r\ny", ""), (5, "http://a/5", "long é中 " * 9000), (6, "http://a/6", "long é中 " * 9000),
    (7, "http://a/7", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"), (8, "u", "\x00\U0001F600"),
]


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 100}, {"least_revisit_bytes": 5}, {"compression": "none"}])
def test_archive_round_trip(spark, tmp_path, options):
    path = warc.write_archive(pages(spark, ROWS), str(tmp_path / "w"), **options)
    rows = warc.read_archive(spark, path)
    full = warc.with_referred(rows).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, full.collect()), key=str) == expected(ROWS, options.get("least_revisit_bytes", 0))
    texts = {r["page_id"]: r["payload"].decode() for r in rows.filter("payload IS NOT NULL").collect()}
    assert all(texts[i] == (html or "") for i, _, html in ROWS if i in texts)


def test_long_records_are_segmented(spark, tmp_path):
    path = warc.write_archive(pages(spark, ROWS), str(tmp_path / "w"), segment_bytes=1000)
    records = warc.read_records(spark, path)
    assert records.filter("segment > 1").count() > 50
    assert records.filter("kind = 'continuation'").agg(F.max(F.octet_length("block"))).first()[0] <= 1000


@pytest.mark.parametrize("damage", ["segment <> 3", "segment <> 1", "total IS NULL"])
def test_missing_segments_stop_the_read(spark, tmp_path, damage):
    path = warc.write_archive(pages(spark, ROWS[5:6]), str(tmp_path / "w"), segment_bytes=1000)
    records = warc.read_records(spark, path).filter(damage)
    with pytest.raises(Exception, match="are missing or of a wrong length"):
        warc.reassembled(records).collect()


def test_repeated_rows_null_ids_and_none(spark, tmp_path):
    rows = [(1, "u", "x"), (1, "u", "x"), (None, "u", "x"), (None, "u", "y"), (None, "u", "y")]
    path = warc.write_archive(pages(spark, rows), str(tmp_path / "w"))
    out = warc.with_referred(warc.read_archive(spark, path)).select("page_id", "record_type", "refers_to").collect()
    assert sorted(map(tuple, out), key=str) == sorted(
        [(1, "response", None), (1, "revisit", 1), (None, "revisit", 1), (None, "response", None), (None, "revisit", None)], key=str
    )
    path = warc.write_archive(pages(spark, rows).limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, path).count() == 0


def test_broken_files_are_errors():
    good = warc._record({"WARC-Type": "resource", "WARC-Record-ID": "<urn:x>"}, b"abc") + b"\r\n\r\n"
    assert [block for _, block in warc.parse_records(good * 2)] == [b"abc"] * 2
    for broken in (good[:-5], b"junk" + good, b"WARC/1.1\r\n"):
        with pytest.raises(ValueError, match="WARC|ends early"):
            list(warc.parse_records(broken))
