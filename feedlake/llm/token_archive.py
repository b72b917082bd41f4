"""Token ids on disk: one zstandard frame per document and one dictionary for all.

Documents are encoded, compressed one by one with a dictionary that was trained on
serialized id arrays, shuffled once into ascending order of their ids and packed
into blocks.  A block is a row of a Parquet file::

    part, block        place in the order of documents
    first_doc, n_docs  smallest doc_id, number of documents
    n_ids, start       ids in the block, ids before it in its part
    id_bytes           bytes per id: 2 or 4, little-endian, unsigned
    dictionary         SHA-256 of the dictionary the frames need
    doc_ids, present   doc_id of each document (8 bytes), 0 where it is null (1 byte)
    lengths            ids of each document (8 bytes)
    offsets            where each frame begins in payload, and the end (8 bytes)
    payload            the frames

So a short document is read by one block and decompressed alone.  The dictionary
lies beside the blocks; ``parts`` has how many ids stand before each part.

Defined results: a null text is empty and has only the end id; rows without
``doc_id`` come first; rows with equal ids keep an order by their content; extra
columns are not kept; an empty table makes an archive without blocks.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.frames import quoted, share_of
from feedlake.llm.words import EXACT, LONG, differ, span_hashes, text_blocks

END_ID = 0

# The dictionary is trained on about so many pieces of texts, of so many characters.
SAMPLE_PIECES = 1_500
PIECE_CHARS = 4_000
DICTIONARY_BYTES = 64 * 1024

PAYLOAD_BYTES = 4 << 20
LEVEL = 3

_FRAMES = "part int, doc_id long, n_ids long, crc long, frame binary"
_BLOCKS = (
    "part int, block int, first_doc long, n_docs int, n_ids long, start long, id_bytes int, "
    "dictionary string, doc_ids binary, present binary, lengths binary, offsets binary, payload binary"
)
_READ = "part int, doc_id long, start long, ids binary"


# Kinds of bytes, for finding places that no token spans.
_LETTER, _DIGIT, _MARK, _BLANK, _FEED, _LATIN = 1, 2, 3, 4, 5, 6
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x20], _KIND[0x0A], _KIND[0xC3] = _BLANK, _FEED, _LATIN


def cuts(data: np.ndarray) -> np.ndarray:
    """Where a UTF-8 text can be cut so that its pieces, byte-level encoded alone, give its ids.

    Byte-level pre-tokenization keeps letters, digits, other signs and white space apart,
    and gives a word the one blank before it.  So no token spans the place before a blank
    or line feed that follows a letter, digit or sign, between a letter and a sign, or on
    either side of a line feed between two such characters.  Letters are those of ASCII and Latin-1;
    other characters are not looked at, and not cut from their neighbours.
    """
    kind = _KIND[data]
    before = np.zeros_like(kind)
    before[1:] = kind[:-1]
    # The second byte of a Latin-1 letter, C3 80 to C3 BF without the signs C3 97 and C3 B7.
    latin = np.zeros(len(data), bool)
    latin[2:] = (kind[:-2] == _LATIN) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
    letter = (before == _LETTER) | latin
    solid = letter | (before == _DIGIT) | (before == _MARK)
    blank = (kind == _BLANK) | (kind == _FEED)
    goes_on = (kind == _LETTER) | (kind == _DIGIT) | (kind == _MARK)
    parted = blank & solid
    alone = np.zeros(len(data), bool)
    alone[1:] = parted[:-1]
    return parted | ((kind == _MARK) & letter) | ((before == _FEED) & alone & goes_on)


class Encoder:
    """Ids of texts by a tokenizer file, remembering the ids of pieces.

    Texts are cut at :func:`cuts` if the tokenizer is a plain byte-level one; other
    tokenizers get whole texts.  One encoder lives per process and tokenizer.
    """

    MOST_PIECES = 700_000
    BLOCK_BYTES = 2 << 20
    _made: dict[str, Encoder] = {}

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        # The strings of special tokens are ordinary text in a text.
        self.tokenizer.encode_special_tokens = True
        self.by_piece = self.piecewise(json.loads(source))
        self.pieces: dict[bytes, bytes] = {}

    @staticmethod
    def piecewise(spec: dict) -> bool:
        """Whether the pieces of a text, encoded one by one, give its ids."""
        before = spec.get("pre_tokenizer") or {}
        return (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not spec.get("normalizer")
            and not spec.get("post_processor")
        )

    @classmethod
    def of(cls, source: str) -> Encoder:
        key = f"{cls.__name__} {hashlib.sha256(source.encode()).hexdigest()}"
        if key not in cls._made:
            cls._made[key] = cls(source)
        return cls._made[key]

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        ids = [one.ids for one in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [struct.pack(f"={len(one)}I", *one) for one in ids]

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return self._ids(self.tokenizer, texts)

    def blocks(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First row, ids of all texts one after the other, and the end of each, block by block."""
        for row, data, bounds in text_blocks(column, self.BLOCK_BYTES):
            yield row, *self._block(data, bounds)

    def spans(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces that are encoded one by one begin and end."""
        here = cuts(data)
        here[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(here)
        return starts, np.append(starts[1:], len(data)) if len(starts) else starts

    def folded(self, data: np.ndarray) -> np.ndarray:
        """The bytes with what the tokenizer does not tell apart made one; as many, in their places."""
        return data

    def _block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.by_piece:
            data = self.folded(data)
        text = data.tobytes()
        if not self.by_piece:
            parts = self._encoded([text[a:b].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
            ends = np.cumsum([len(p) // 4 for p in parts])
            return np.frombuffer(b"".join(parts), np.uint32), ends
        starts, stops = self.spans(data, bounds)
        hashes = span_hashes(data, starts, stops, EXACT)
        _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        # A hash finds the pieces that look alike; their bytes decide.
        odd = np.flatnonzero(differ(data, starts, stops, first[place]))
        place[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate((first, odd))
        # Pieces are remembered until there are MOST_PIECES of them: the frequent ones
        # come early, later ones are encoded once per block.
        keys = [text[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())]
        parts = [*map(self.pieces.get, keys)]
        new = [i for i, part in enumerate(parts) if part is None]
        if new:
            for i, part in zip(new, self._encoded([keys[i].decode() for i in new])):
                parts[i] = part
            room = self.MOST_PIECES - len(self.pieces)
            self.pieces.update((keys[i], parts[i]) for i in new[: max(room, 0)] if len(keys[i]) <= LONG)
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        offsets = (np.cumsum(sizes) - sizes)[place]
        sizes = sizes[place]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.frombuffer(b"".join(parts), np.uint32)
        flat = ids[np.arange(total[-1]) + np.repeat(offsets - total[:-1], sizes)]
        return flat, total[np.searchsorted(starts, bounds[1:])]


def _id_bytes(source: str) -> int:
    """Bytes that hold every id of a tokenizer."""
    spec = json.loads(source)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), END_ID])
    return 2 if most < 1 << 16 else 4


def _serialized(encoder: Encoder, column: pa.Array, width: int) -> Iterator[tuple[int, list[bytes]]]:
    """First row of a block and the id array of each of its texts, the end id included."""
    for row, flat, ends in encoder.blocks(column):
        ids = np.insert(flat.astype(f"<u{width}"), ends, END_ID)
        stops = (ends + np.arange(1, len(ends) + 1)) * width
        raw = ids.tobytes()
        yield row, [raw[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]


def train_dictionary(docs: DataFrame, source: str, width: int) -> bytes:
    """A zstandard dictionary from the id arrays of a bounded sample; empty if there is too little.

    Every piece of every text, long ones included, has the same chance to be in it.
    """
    pieces = F.ceil(F.length("text") / PIECE_CHARS)
    total = docs.agg(F.sum(pieces)).first()[0] or 0
    row = F.monotonically_increasing_id()
    places = F.filter(
        F.sequence(F.lit(0).cast("long"), pieces - 1), lambda i: share_of(F.xxhash64("row", i), SAMPLE_PIECES, total)
    )
    found = docs.filter(F.length("text") > 0).withColumn("row", row).withColumn("places", places)
    cut = F.transform("places", lambda i: F.substring("text", (i * PIECE_CHARS + 1).cast("int"), F.lit(PIECE_CHARS)))
    chosen = found.filter(F.size("places") > 0).select(F.explode(cut).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(shared.value)
        for batch in batches:
            for _, rows in _serialized(encoder, batch.column(0), width):
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    samples = [row[0] for row in chosen.mapInArrow(run, "ids binary").collect()]
    try:
        size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compression(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_archive(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = PAYLOAD_BYTES,
) -> str:
    """Encode ``docs`` with the tokenizer file ``tokenizer`` and write the archive to ``path``."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as lines:  # on the driver; executors get its content
        source = lines.read()
    width = _id_bytes(source)
    slim = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    dictionary = train_dictionary(slim, source, width)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = [i / parts for i in range(1, parts)]
    bounds = sorted(set(slim.approxQuantile("doc_id", quantiles, 1 / (4 * parts)))) if parts > 1 else []
    shared = spark.sparkContext.broadcast((source, dictionary, np.array(bounds, np.float64)))

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, dictionary, bounds = shared.value
        encoder = Encoder.of(source)
        packer = zstandard.ZstdCompressor(level=LEVEL, **_compression(dictionary))
        for batch in batches:
            for row, arrays in _serialized(encoder, batch.column(1), width):
                keys = batch.column(0).slice(row, len(arrays))
                part = np.searchsorted(bounds, keys.fill_null(0).to_numpy(), "right")
                part[keys.is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int32()),
                        keys,
                        pa.array([len(ids) // width for ids in arrays], pa.int64()),
                        pa.array([zlib.crc32(ids) for ids in arrays], pa.int64()),
                        pa.array([packer.compress(ids) for ids in arrays], pa.binary()),
                    ],
                    names=["part", "doc_id", "n_ids", "crc", "frame"],
                )

    mark = hashlib.sha256(dictionary).hexdigest()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start = None, 0, 0
        rows: list[tuple] = []
        size = 0

        def row() -> pa.RecordBatch:
            ids = [r[0] for r in rows]
            lengths = np.array([r[1] for r in rows], "<i8")
            frames = [r[2] for r in rows]
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames]))).astype("<i8")
            first = min((i for i in ids if i is not None), default=None)
            values = [
                part, block, first, len(rows), int(lengths.sum()), start, width, mark,
                np.array([i or 0 for i in ids], "<i8").tobytes(),
                np.array([i is not None for i in ids], np.uint8).tobytes(),
                lengths.tobytes(), offsets.tobytes(), b"".join(frames),
            ]
            return pa.RecordBatch.from_pylist([dict(zip(names, values))], schema=kinds)

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for p, key, n, frame in zip(*columns):
                if rows and (p != part or size >= block_bytes):
                    yield row()
                    block, start = block + 1, start + sum(r[1] for r in rows)
                    rows, size = [], 0
                if p != part:
                    part, block, start = p, 0, 0
                rows.append((key, n, frame))
                size += len(frame)
        if rows:
            yield row()

    names = [column.split()[0] for column in _BLOCKS.split(", ")]
    arrow = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = pa.schema([(c.split()[0], arrow[c.split()[1]]) for c in _BLOCKS.split(", ")])
    frames = slim.mapInArrow(compressed, _FRAMES)
    ordered = frames.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "crc", "n_ids")
    blocks = ordered.mapInArrow(packed, _BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame([(mark, bytearray(dictionary))], "sha256 string, bytes binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    return path


def read_archive(spark: SparkSession, path: str, *, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` as 4-byte little-endian values.

    With ``doc_ids`` only the blocks that may have them are read, and of those only
    their frames are decompressed.
    """
    mark, dictionary = spark.read.schema("sha256 string, bytes binary").parquet(f"{path}/dictionary").first()
    dictionary = bytes(dictionary)
    if hashlib.sha256(dictionary).hexdigest() != mark:
        raise ValueError(f"{path}: the dictionary does not have the hash it is listed with")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    before, total = {}, 0
    for row in sorted(sums):
        before[row["part"]] = total
        total += row["n"]
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        after = F.expr("lead(first_doc) OVER (PARTITION BY part ORDER BY block)")
        spans = blocks.select("part", "block", "first_doc", after.alias("next_doc"))
        near = F.lit(False)
        for one in wanted:
            near = near | ((F.col("first_doc") <= one) & (F.col("next_doc").isNull() | (F.col("next_doc") >= one)))
        chosen = spans.filter(near).select("part", "block")
        blocks = blocks.join(chosen, ["part", "block"], "left_semi")
    shared = spark.sparkContext.broadcast((dictionary, before, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, before, wanted = shared.value
        unpacker = zstandard.ZstdDecompressor(**_compression(dictionary))
        for batch in batches:
            for i in range(len(batch)):
                block = {name: batch.column(name)[i] for name in batch.schema.names}
                if block["dictionary"].as_py() != mark:
                    raise ValueError("a block was made with another dictionary")
                kind = np.dtype(f"<u{block['id_bytes'].as_py()}")
                lengths, offsets, keys = (
                    np.frombuffer(block[name].as_buffer(), "<i8") for name in ("lengths", "offsets", "doc_ids")
                )
                present = np.frombuffer(block["present"].as_buffer(), np.uint8)
                starts = before[block["part"].as_py()] + block["start"].as_py() + np.cumsum(lengths) - lengths
                payload = memoryview(block["payload"].as_buffer())
                out: tuple[list, list, list] = ([], [], [])
                for k, key in enumerate(keys.tolist()):
                    key = key if present[k] else None
                    if wanted is not None and key not in wanted:
                        continue
                    ids = np.frombuffer(unpacker.decompress(payload[offsets[k] : offsets[k + 1]]), kind)
                    if len(ids) != lengths[k]:
                        raise ValueError(f"document {key} has {len(ids)} ids, its index says {lengths[k]}")
                    for column, value in zip(out, (key, int(starts[k]), ids.astype("<u4").tobytes())):
                        column.append(value)
                if out[0]:
                    part = pa.array([block["part"].as_py()] * len(out[0]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [part, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                        names=["part", "doc_id", "start", "ids"],
                    )

    columns = ["part", "start", "id_bytes", "dictionary", "doc_ids", "present", "lengths", "offsets", "payload"]
    return blocks.select(*columns).mapInArrow(run, _READ).drop("part")
