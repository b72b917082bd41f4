"""WARC archives of pages: written with Spark, read back, segments put together again.

Writing.  Pages with equal payloads share one response record, that of the largest
page id; the others are revisit records that refer to it.  A response is an HTTP
message in chunked transfer framing.  Records beyond ``segment_bytes`` are cut into
a first segment and continuation records (``WARC-Segment-Number``,
``WARC-Segment-Origin-ID``, and ``WARC-Segment-Total-Length`` on the last).  Spark's
text writer puts the records into files, the blank lines between records being
its line separator, so lost tasks are written anew by its commit protocol.

Reading.  A record begins with its version line; its length is in its header.  Whole
records need nothing more.  Segments are grouped by the record they continue, ordered
by number, checked against their numbers and total length, and joined; then the
chunks are decoded.  Only segmented records are shuffled.

Defined results: a null or empty html is an empty payload; rows with equal payload
and equal ``page_id`` are told apart by an order that the scan gives them, and the one
of them that is the response is referred to by that id; a null ``page_id`` counts as
smaller than any and is written as an empty field; a null ``url`` likewise; an empty
table makes an archive without records; other columns are not kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.frames import quoted

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 8 * 1024
RECORDS_PER_FILE = 500

# Fixed values of the format.
VERSION = "WARC/1.1"
_BETWEEN = "\r\n\r\n"
_HEAD = b"\r\n\r\n"
_EPOCH = "1970-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORDS = (
    "record_id string, kind string, page_id long, url string, payload_digest string, refers_to string, "
    "segment int, origin string, total long, block binary"
)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    out = []
    for i in range(0, len(payload), size):
        piece = payload[i : i + size]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload in chunked framing; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunked body ends inside a size line")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is not as long as its size line says")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    end = block.find(_HEAD)
    if end < 0:
        raise ValueError("no HTTP header")
    fields = block[:end].lower()
    body = block[end + 4 :]
    return unchunked(body) if b"\r\ntransfer-encoding: chunked" in fields else body


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: dict[str, object], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields.items() if value is not None)]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def _urn(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"


def _one_line(value: str | None) -> str:
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value or "").strip()


def records_of(
    row: int, page_id: int | None, url: str | None, payload: bytes, kept: str, refers_to: int | None,
    refers_row: int | None, segment_bytes: int,
) -> Iterator[bytes]:
    """The records of one page."""
    fields = {
        "WARC-Type": "response" if kept == "response" else "revisit",
        "WARC-Record-ID": _urn(f"page {row}"),
        "WARC-Date": _EPOCH,
        "WARC-Target-URI": _one_line(url),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Page-ID": "" if page_id is None else page_id,
    }
    http = {"Content-Type": "application/http; msgtype=response"}
    if kept == "revisit":
        refers = {"WARC-Profile": _REVISIT, "WARC-Refers-To": _urn(f"page {refers_row}")}
        yield _record({**fields, **refers, **http}, _HTTP.split("\r\nTransfer")[0].encode() + _HEAD)
        return
    block = _HTTP.encode() + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record({**fields, **http}, block)
        return
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record({**fields, "WARC-Segment-Number": 1, **http}, pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        yield _record(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": _urn(f"page {row} segment {number}"),
                "WARC-Date": _EPOCH,
                "WARC-Target-URI": fields["WARC-Target-URI"],
                "WARC-Segment-Origin-ID": fields["WARC-Record-ID"],
                "WARC-Segment-Number": number,
                "WARC-Segment-Total-Length": len(block) if number == len(pieces) else None,
            },
            piece,
        )


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    compression: str = "gzip",
) -> str:
    """Write ``pages`` as WARC files below ``path``.

    Of pages with equal payloads of at least ``least_revisit_bytes`` one is the
    response, others revisit it; smaller ones are all responses.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(quoted(page_id)).cast("long").alias("page_id"),
        F.col(quoted(url)).cast("string").alias("url"),
        F.coalesce(F.col(quoted(html)), F.lit("")).alias("html"),
    )
    marked = rows.withColumn("sha1", F.unhex(F.sha1(F.col("html").cast("binary"))))
    # One row per payload; a payload that a third of the pages have is summed up
    # before it is moved.
    groups = (
        marked.filter(F.octet_length("html") >= least_revisit_bytes)
        .groupBy("sha1")
        .agg(F.max(F.struct("page_id", "row")).alias("response"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1")
        .select(F.col("sha1").alias("of"), "response")
    )
    judged = marked.join(groups, marked["sha1"] == groups["of"], "left").select(
        "row", "page_id", "url", "html",
        F.when(F.col("response.row") != F.col("row"), F.lit("revisit")).otherwise(F.lit("response")).alias("kept"),
        F.col("response.page_id").alias("refers_to"),
        F.col("response.row").alias("refers_row"),
    )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 200):
                batch = whole.slice(begin, 200)
                out = []
                for r in zip(*(column.to_pylist() for column in batch.columns)):
                    row, key, target, body, kept, to, to_row = r
                    out += records_of(row, key, target, body.encode(), kept, to, to_row, segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    text = judged.mapInArrow(lines, "record binary").select(F.col("record").cast("string").alias("value"))
    writer = text.write.option("lineSep", _BETWEEN).option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.option("compression", compression).text(path)
    return path


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a file."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(_HEAD, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in data[at:end].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size:
            raise ValueError(f"record {fields.get('warc-record-id')} ends early")
        yield fields, block
        at = end + 4 + size


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archive, segments still apart."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for i in range(len(batch)):
                data = batch.column(1)[i].as_buffer().to_pybytes()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows: list[dict] = []
                size = 0
                for fields, block in parse_records(data):
                    number = int(fields.get("warc-segment-number", 0))
                    page, total = fields.get("x-page-id"), fields.get("warc-segment-total-length")
                    rows.append(
                        {
                            "record_id": fields["warc-record-id"],
                            "kind": fields["warc-type"],
                            "page_id": int(page) if page else None,
                            "url": fields.get("warc-target-uri"),
                            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            "refers_to": fields.get("warc-refers-to"),
                            "segment": number,
                            "origin": fields.get("warc-segment-origin-id") or fields["warc-record-id"],
                            "total": int(total) if total else None,
                            "block": block,
                        }
                    )
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    arrow = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = pa.schema([(c.split()[0], arrow[c.split()[1]]) for c in _RECORDS.split(", ")])
    return files.mapInArrow(run, _RECORDS)


def reassembled(records: DataFrame) -> DataFrame:
    """Records with the segments of each put together, in ``block``.

    A record whose segments are not numbered 1 to n, or do not add up to the total
    length that the last one states, stops the read.
    """
    whole = records.filter("segment = 0").drop("segment", "origin", "total")
    parts = records.filter("segment > 0")
    head = ["record_id", "kind", "page_id", "url", "payload_digest", "refers_to"]
    first = F.when(F.col("segment") == 1, F.struct(*head))
    joined = parts.groupBy("origin").agg(
        F.max(first).alias("head"),
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("pieces"),
    )
    numbers = "transform(pieces, p -> p.segment) = sequence(1, size(pieces))"
    length = "aggregate(pieces, 0L, (n, p) -> n + octet_length(p.block)) = total"
    broken = F.concat(F.lit("segments of "), F.col("origin"), F.lit(" are missing or of a wrong length"))
    block = F.when(
        F.expr(f"head IS NOT NULL AND {numbers} AND {length}"),
        F.expr("unhex(array_join(transform(pieces, p -> hex(p.block)), ''))"),
    ).otherwise(F.raise_error(broken).cast("binary"))
    return whole.unionByName(joined.select("head.*", block.alias("block")))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``record_type``, ``refers_to`` (a page id),
    ``payload``, ``payload_bytes`` and ``payload_digest``.

    Payloads are decoded and checked against their digest.  A revisit has no payload
    of its own; its length is that of the record it refers to.
    """
    records = reassembled(read_records(spark, path))
    kinds = pa.schema(
        [
            ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
            ("record_type", pa.string()), ("refers_record", pa.string()), ("payload", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ]
    )

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 200):
                rows = []
                for r in whole.slice(begin, 200).to_pylist():
                    payload = payload_of(r["block"]) if r["kind"] == "response" else None
                    if payload is not None and digest(payload) != r["payload_digest"]:
                        raise ValueError(f"payload of {r['record_id']} does not have the digest stated")
                    rows.append(
                        {
                            "record_id": r["record_id"], "page_id": r["page_id"], "url": r["url"],
                            "record_type": r["kind"], "refers_record": r["refers_to"], "payload": payload,
                            "payload_bytes": None if payload is None else len(payload),
                            "payload_digest": r["payload_digest"],
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    schema = (
        "record_id string, page_id long, url string, record_type string, refers_record string, "
        "payload binary, payload_bytes long, payload_digest string"
    )
    return records.mapInArrow(decoded, schema)


def with_referred(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`read_archive` with ``refers_to`` and the length of revisits filled in."""
    slim = rows.drop("payload")
    responses = slim.filter("record_type = 'response'")
    known = responses.select(
        F.col("record_id").alias("refers_record"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("referred_bytes"),
    )
    revisits = slim.filter("record_type = 'revisit'").join(known, "refers_record", "left")
    revisits = revisits.withColumn("payload_bytes", F.col("referred_bytes")).drop("referred_bytes")
    return responses.withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits)
