"""Documents packed into sequences of a fixed number of tokens, best fit decreasing.

Documents are encoded, ended and, where longer than a sequence, cut into pieces.  Best fit
decreasing takes the pieces from the longest to the shortest and puts each into the open
sequence with the least room that still holds it.  Pieces of one length are alike, and so
are sequences with the same room: hence the pieces of the whole corpus, however many, are
planned from how many there are of each length.  A segment tree over the remaining
capacities finds the tightest one that is open in logarithmic time, for a document or for
a run of documents that go the same way; the plan has runs of places, not documents, and
its size depends on the capacity alone.

Spark does the rest: a task numbers its pieces of each length, counts per task and length
are summed to the place of each piece in the order of all, and that place is looked up in
the broadcast plan.  So the result is that of one global best fit decreasing, while no
task sees more than its share, whatever length or document is frequent.

Defined results: a null or empty text has only the end id; rows with equal or null ids are
packed like any others; other columns are not kept; an empty table gives no rows.
"""

from __future__ import annotations

import json
import operator
import re
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlake.llm.frames import quoted, written
from feedlake.llm.token_archive import Encoder
from feedlake.llm.words import LOWER, SPACED, word_spans

CAPACITY = 4096
END_ID = 1

_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"
)


class WordEncoder(Encoder):
    """Ids of texts by a lower-casing tokenizer whose tokens never span white space, in parts of words.

    A word is also cut before an ASCII sign that follows an ASCII letter or digit, which no
    token spans either.  Words of ASCII and Latin-1 are lower-cased first, so that those at
    the start of a sentence are remembered as well; in other words a letter may belong to
    the mark after it, and they are left as they are.
    """

    MOST_PIECES = 400_000
    BLOCK_BYTES = 4 << 20
    # Steps that treat the words of a text alone and together alike.
    _NORMALIZERS = {"NFC", "Lowercase"}
    # Small letters of ASCII and Latin-1: no step before the merges changes or parts them.
    _LETTERS = re.compile("[a-zß-öø-ÿ]+")

    def __init__(self, source: str):
        super().__init__(source)
        if self.by_piece:
            spec = json.loads(source)
            bytewise = spec["pre_tokenizer"]["pretokenizers"][1]
            self.merges = Tokenizer.from_str(json.dumps({**spec, "normalizer": None, "pre_tokenizer": bytewise}))
            self.merges.encode_special_tokens = True

    def _encoded(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return super()._encoded(texts)
        plain = [self._LETTERS.fullmatch(text) is not None for text in texts]
        ids = [iter(self._ids(one, [*compress(texts, which)])) for one, which in (
            (self.tokenizer, map(operator.not_, plain)), (self.merges, plain)
        )]
        return [next(ids[which]) for which in plain]

    @staticmethod
    def piecewise(spec: dict) -> bool:
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        blanks = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        if len(splits) != 2 or spec.get("post_processor") or {"type": "Lowercase"} not in steps:
            return False
        split, bytewise = splits
        pattern = split.get("pattern", {}).get("Regex", " ")
        probes = "a b\t1 2\n. !\r\v\fä 's a! z- 0' m'd"
        apart = (r"\s", r"[a-z0-9][^a-z0-9]")
        return (
            all(step["type"] in WordEncoder._NORMALIZERS or step == blanks for step in steps)
            and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
            and not any(regex.search(one, found) for found in regex.findall(pattern, probes) for one in apart)
            and bytewise["type"] == "ByteLevel"
            and not bytewise["add_prefix_space"]
            and not bytewise["use_regex"]
        )

    def spans(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = word_spans(data, bounds, SPACED)
        sign = np.flatnonzero(_SIGNS[data])
        sign = sign[sign > 0]
        sign = sign[_SOLID[data[sign - 1]]]
        # Not at the beginning of a text, whatever the one before it ends with.
        sign = np.setdiff1d(sign, starts, assume_unique=True)
        return np.sort(np.concatenate((starts, sign))), np.sort(np.concatenate((ends, sign)))

    def folded(self, data: np.ndarray) -> np.ndarray:
        latin = np.zeros(len(data) + 1, bool)
        latin[1:] = data == 0xC3
        second = latin[:-1]
        low = LOWER[data]
        # U+00C0 to U+00DE are the capitals of U+00E0 to U+00FE, but for the sign at D7.
        low[second & (data <= 0x9E) & (data != 0x97)] += 0x20
        other = (data >= 0x80) & ~second & (data != 0xC3)
        if other.any():
            # Only the words without other characters are folded.
            blank = np.flatnonzero(~SPACED[data])
            edges = np.concatenate(([0], blank, [len(data)]))
            word = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            odd = np.bincount(word[other], minlength=len(edges) - 1)[word] > 0
            low[odd] = data[odd]
        return low


_SOLID = np.zeros(256, bool)
_SOLID[0x30:0x3A] = _SOLID[0x41:0x5B] = _SOLID[0x61:0x7B] = True
_SIGNS = np.zeros(256, bool)
_SIGNS[0x21:0x7F] = ~_SOLID[0x21:0x7F]


class OpenSequences:
    """Open sequences by what room they have left, and the tightest that still takes a piece.

    A segment tree over the rooms 0 to ``capacity`` counts the runs of sequences of each; a
    run is its first number and how many sequences it has.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _add(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += change
            node >>= 1

    def put(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.runs.setdefault(room, []).append((first, count))
            self._add(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.runs[room].pop()

    def tightest(self, length: int) -> int | None:
        """The least room of ``length`` or more that an open sequence has."""
        node = self.leaves + length
        if not self.tree[node]:
            # Up to the first subtree of greater rooms that has one.
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.tree[2 * node])
        return node - self.leaves


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where best fit decreasing puts pieces, ``counts[length]`` of each length.

    Rows of (place, sequence, per, offset, length): the piece at ``place`` in the order of
    falling lengths begins a run that fills ``per`` pieces into each sequence from
    ``sequence`` on, the first of them at ``offset``.
    """
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError(f"pieces have 1 to {capacity} tokens")
    rooms = OpenSequences(capacity)
    runs, place, opened = [], 0, 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                new = -(-left // (capacity // length))
                rooms.put(capacity, opened, new)
                opened += new
                room = capacity
            first, count = rooms.take(room)
            per = room // length
            taken = min(left, count * per)
            full, rest = divmod(taken, per)
            runs.append((place, first, per, capacity - room, length))
            rooms.put(room - per * length, first, full)
            rooms.put(room - rest * length, first + full, int(rest > 0))
            used = full + (rest > 0)
            rooms.put(room, first + used, count - used)
            place, left = place + taken, left - taken
    return np.array(runs, np.int64).reshape(-1, 5)


def encoded_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` ids, the end id included, of every document; a written table.

    ``ids`` are little-endian unsigned 32-bit integers; ``part`` and ``nth`` number the
    pieces of each length within the task that made them.
    """
    with open(tokenizer, encoding="utf-8") as lines:  # on the driver; executors get its content
        source = lines.read()
    shared = docs.sparkSession.sparkContext.broadcast(source)
    slim = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    names = [column.split()[0] for column in _PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(shared.value)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for row, flat, ends in encoder.blocks(batch.column(1)):
                ids = np.insert(flat, ends, end_id).astype("<u4")
                sizes = np.diff(ends, prepend=0) + 1
                cuts = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), cuts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked) + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                raw, stops = memoryview(ids.tobytes()), np.cumsum(length) * 4
                parts = [raw[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sizes)).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        pa.array([bytes(p) for p in parts], pa.binary()),
                        pa.array(np.full(len(doc), part), pa.int32()),
                        pa.array(nth, pa.int64()),
                    ],
                    names=names,
                )

    return written(slim.mapInArrow(run, _PIECES), "pieces")


def placed(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces``, as :func:`encoded_pieces` wrote them, with ``sequence_id`` and ``offset``."""
    counts = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # One row per length, and there are no more lengths than tokens in a sequence.
    total = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(total, capacity)
    longer = np.zeros(capacity + 1, np.int64)
    lengths = np.zeros(capacity + 2, np.int64)
    lengths[list(total)] = list(total.values())
    longer[:] = np.cumsum(lengths[::-1])[::-1][1:]
    shared = pieces.sparkSession.sparkContext.broadcast((runs, longer))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # A row per task and length: sorted and merged, as its size grows with the input.
    ranked = pieces.join(before.hint("merge"), ["length", "part"]).withColumn("nth", F.col("nth") + F.col("before"))
    ranked = ranked.drop("part", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, longer = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            place = longer[length] + batch.column("nth").to_numpy()
            found = runs[np.searchsorted(runs[:, 0], place, "right") - 1]
            row, at = np.divmod(place - found[:, 0], found[:, 2])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found[:, 1] + row), pa.array(found[:, 3] + at * length)],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in ranked.schema.fields)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long").drop("nth")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ``ids`` and ``parts``, the documents' pieces in order.

    A sequence has no more pieces than tokens, so a group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    flat = grouped.select(
        "sequence_id",
        F.col("parts.ids").alias("ids"),
        F.transform("parts", lambda p: F.struct(p["offset"], p["doc_id"], p["piece"], p["length"])).alias("parts"),
    )
    schema = flat.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pa.array([b"".join(ids) for ids in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), whole, batch.column(2)], names=batch.schema.names
            )

    kind = schema["parts"].dataType.simpleString()
    return flat.mapInArrow(run, f"sequence_id long, ids binary, parts {kind}")
