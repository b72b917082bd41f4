"""Large documents dealt to many tasks, whatever their layout.

A file is read as text that is parted at every opening brace, so Spark deals its byte
ranges like lines.  Where a range begins nobody knows whether that is inside a string, how
deep, and in which member of the document; so a first pass has every range report what it
does to that, for a start inside a string and outside of one: its quotes, its change of
depth, and at the levels that may be the root the closings and the last member name.
Running sums over the ranges of a file give each the state it starts in, and tell whether
the file is one whole document.  A second pass then cuts in front of the members of the
``features`` list, wherever they are, on one line or on many.

Both passes must see the same ranges.  Their number of bytes comes from session settings
and from the cores at hand, which change when an executor is lost, so the passes share a
session of their own in which it is fixed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.session import scratch_path, ship_library

FEATURES = "features"

# States of this many ranges are sent to every executor (some 100 bytes each); beyond that
# they are joined to the text.
SENT_RANGES = 100_000

_BLANKS = " \t\r\n"

_BRACE = ord("{")
_QUOTE, _COLON, _SLASH = ord('"'), ord(":"), ord("\\")

# Bytes that the structure hangs on, and what they do to the depth.
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in '{}[]":']] = True
_STEP = np.zeros(256, np.int64)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1

_TOPS = "array<struct<level: long, closings: long, features: boolean>>"
_SUMMARY = (
    "file string, begin long, size long, n_bytes long, records long, quotes long, "
    f"delta0 long, tops0 {_TOPS}, delta1 long, tops1 {_TOPS}"
)
_PIECES = "file string, begin long, whole boolean, opens boolean, first boolean, last boolean, value string"


# What a range must know: is it in a string, how deep, in the list, the last of its file.
_STATE = ("inside", "depth", "listed", "last")
_NONE = (None,) * len(_STATE)


class _Text:
    """Structure of a stretch of text that begins with a record: quotes that count, and marks."""

    def __init__(self, data: np.ndarray):
        self.data = data
        at = np.flatnonzero(_MARKS[data])
        kind = data[at]
        quote = kind == _QUOTE
        slashes = data == _SLASH
        if slashes.any():
            # A quote behind an odd number of backslashes is part of its string.  No
            # backslash stands before a record, which follows a brace.
            index = np.arange(len(data))
            solid = np.maximum.accumulate(np.where(slashes, -1, index))
            behind = at[quote]
            before = np.where(behind > 0, solid[behind - 1], -1)
            run = np.where(behind > 0, behind - 1 - before, 0)
            quote[np.flatnonzero(quote)[run % 2 == 1]] = False
        self.at, self.kind = at, kind
        self.quotes = at[quote]
        self.seen = np.cumsum(quote)

    def outside(self, inside: int) -> np.ndarray:
        """Which marks are not in a string, if the text begins inside one or not (1 or 0)."""
        return (self.seen + inside) % 2 == 0

    def depths(self, outside: np.ndarray) -> np.ndarray:
        """Depth after each mark, from 0 at the start."""
        return np.cumsum(np.where(outside, _STEP[self.kind], 0))

    def names_features(self, colon: int) -> bool:
        """Whether the string before a colon is the name of the list."""
        n = int(np.searchsorted(self.quotes, colon))
        if n < 2:  # a name that begins before the last brace is another
            return False
        name = self.data[self.quotes[n - 2] : self.quotes[n - 1] + 1].tobytes()
        if _SLASH not in name:
            return name == b'"features"'
        try:
            return json.loads(name) == FEATURES
        except ValueError:
            return False


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict, np.ndarray, np.ndarray]]:
    """(range, its other columns, text, places of the braces that part it), batch by batch.

    ``batches`` have the columns value, file, begin and others that are those of the range.
    """
    opened: set[tuple] = set()
    for batch in batches:
        files, begins = batch.column("file"), batch.column("begin").to_numpy()
        codes = files.dictionary_encode().indices.to_numpy()
        change = np.flatnonzero((codes[1:] != codes[:-1]) | (begins[1:] != begins[:-1])) + 1
        edges = [0, *change.tolist(), len(batch)] if len(batch) else []
        for first, end in zip(edges, edges[1:]):
            part = batch.slice(first, end - first)
            key = (part.column("file")[0].as_py(), int(begins[first]))
            others = {
                name: part.column(name)[0].as_py()
                for name in batch.schema.names
                if name not in ("value", "file", "begin")
            }
            text = part.column("value").cast(pa.large_string())
            _, offsets, data = text.buffers()
            bounds = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
            raw = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
            # The first record of a file has no brace before it.
            skip = int(key[1] == 0 and key not in opened)
            places = (bounds[:-1] - bounds[0])[skip:]
            opened = {key}
            joined = np.insert(raw, places, _BRACE)
            yield key, {**others, "records": end - first}, joined, places + np.arange(len(places))


class _Summary:
    """What a range does to the state, built up stretch by stretch."""

    def __init__(self, key: tuple, others: dict):
        self.key, self.size = key, others["size"]
        self.n_bytes = self.records = self.quotes = 0
        self.depth = [0, 0]
        self.closings: list[dict[int, int]] = [{}, {}]
        self.names: list[dict[int, bool]] = [{}, {}]

    def add(self, text: np.ndarray, records: int, n_places: int) -> None:
        found = _Text(text)
        self.n_bytes += len(text) - n_places
        self.records += records
        for start in (0, 1):
            outside = found.outside((start + self.quotes) % 2)
            depths = found.depths(outside) + self.depth[start]
            # Only levels at or below that of the start can be the root.
            closing = outside & (_STEP[found.kind] < 0) & (depths <= 0)
            for level, n in zip(*np.unique(depths[closing], return_counts=True)):
                self.closings[start][int(level)] = self.closings[start].get(int(level), 0) + int(n)
            naming = np.flatnonzero(outside & (found.kind == _COLON) & (depths <= 1))
            levels, last = np.unique(depths[naming][::-1], return_index=True)
            for level, i in zip(levels.tolist(), naming[::-1][last].tolist()):
                self.names[start][level] = found.names_features(int(found.at[i]))
            self.depth[start] = int(depths[-1]) if len(depths) else self.depth[start]
        self.quotes += len(found.quotes)

    def row(self) -> dict:
        out = {
            "file": self.key[0], "begin": self.key[1], "size": self.size, "n_bytes": self.n_bytes,
            "records": self.records, "quotes": self.quotes,
        }
        for start in (0, 1):
            closings, names = self.closings[start], self.names[start]
            out[f"delta{start}"] = self.depth[start]
            out[f"tops{start}"] = [
                {"level": level, "closings": closings.get(level, 0), "features": names.get(level)}
                for level in sorted({*closings, *names})
            ]
        return out


_TOPS_ARROW = pa.list_(pa.struct([("level", pa.int64()), ("closings", pa.int64()), ("features", pa.bool_())]))
_SUMMARY_ARROW = pa.schema(
    [("file", pa.string()), *((name, pa.int64()) for name in ("begin", "size", "n_bytes", "records", "quotes"))]
    + [(f"{name}{start}", kind) for start in (0, 1) for name, kind in (("delta", pa.int64()), ("tops", _TOPS_ARROW))]
)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Summary | None = None
    for key, others, text, places in _stretches(batches):
        if now is None or now.key != key:
            if now is not None:
                yield pa.RecordBatch.from_pylist([now.row()], schema=_SUMMARY_ARROW)
            now = _Summary(key, others)
        now.add(text, others["records"], len(places))
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=_SUMMARY_ARROW)


_PIECES_ARROW = pa.schema(
    [("file", pa.string()), ("begin", pa.int64()), *((n, pa.bool_()) for n in ("whole", "opens", "first", "last"))]
    + [("value", pa.string())]
)


class _Cutter:
    """Cuts one range at the members of the list, from the state it starts in."""

    def __init__(self, key: tuple, state: tuple[int, int, bool, bool]):
        self.key = key
        self.inside, self.depth, self.listed, self.last = state
        # Text since the last cut; it opens a piece at the start of a file and after a cut.
        self.open: list[bytes] = []
        self.opens = key[1] == 0
        self.first = key[1] == 0

    def add(self, text: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _Text(text)
        outside = found.outside(self.inside)
        depths = found.depths(outside) + self.depth
        naming = found.at[outside & (found.kind == _COLON) & (depths == 1)]
        listed = np.array([self.listed, *(found.names_features(int(c)) for c in naming)])
        mark = np.searchsorted(found.at, places)
        member = outside[mark] & (depths[mark] == 3)
        cuts = places[member]
        cuts = cuts[listed[np.searchsorted(naming, cuts)]]
        self.inside = (self.inside + len(found.quotes)) % 2
        self.depth = int(depths[-1]) if len(depths) else self.depth
        self.listed = bool(listed[-1])
        if not len(cuts):
            self.open.append(text.tobytes())
            return
        self.open.append(text[: cuts[0]].tobytes())
        if self.key[1] == 0 or self.opens or any(self.open):
            yield self._rows([b"".join(self.open)], whole=self.opens, opens=self.opens, first=self.first)
        self.opens, self.first = True, False
        if len(cuts) > 1:
            offsets = (cuts - cuts[0]).astype(np.int32)
            body = pa.py_buffer(text[cuts[0] : cuts[-1]].tobytes())
            values = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(offsets.tobytes()), body)
            yield self._rows(values, whole=True, opens=True, first=False)
        self.open = [text[cuts[-1] :].tobytes()]

    def end(self) -> Iterator[pa.RecordBatch]:
        yield self._rows(
            [b"".join(self.open)], whole=self.opens and self.last, opens=self.opens, first=self.first, last=self.last
        )

    def _rows(self, values, *, whole: bool, opens: bool, first: bool, last: bool = False) -> pa.RecordBatch:
        if isinstance(values, list):
            values = pa.array(values, pa.binary()).cast(pa.string())
        n = len(values)
        columns = [self.key[0], self.key[1], whole, opens, first, last]
        arrays = [pa.array([c] * n, f.type) for c, f in zip(columns, _PIECES_ARROW)]
        return pa.RecordBatch.from_arrays([*arrays, values], schema=_PIECES_ARROW)


def _pinned(spark: SparkSession) -> SparkSession:
    """A session with the file settings of this one, in which ranges do not depend on the cores at hand."""
    session = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(name, spark.conf.get(name))
    least = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.files.minPartitionNum", str(least))
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session


def _states(summaries: DataFrame) -> DataFrame:
    """The state that each range starts in, and what it adds to its file."""
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2))
    chosen = summaries.withColumn("inside", inside).select(
        "*",
        F.when(F.col("inside") == 0, F.col("delta0")).otherwise(F.col("delta1")).alias("delta"),
        F.when(F.col("inside") == 0, F.col("tops0")).otherwise(F.col("tops1")).alias("tops"),
    )
    placed = chosen.withColumn("depth", F.coalesce(F.sum("delta").over(before), F.lit(0)))

    def at(level: int, field: str) -> Column:
        return F.expr(f"get(filter(tops, t -> t.level = {level} - depth), 0).{field}")

    named = placed.select("*", at(1, "features").alias("named"), F.coalesce(at(0, "closings"), F.lit(0)).alias("ends"))
    listed = F.coalesce(F.last("named", ignorenulls=True).over(before), F.lit(False))
    # A range in which no record begins has no text: the last is the last that has.
    after = Window.partitionBy("file").orderBy("begin")
    last = F.lead("begin").over(after).isNull()
    return named.withColumn("listed", listed).withColumn("last", last)


def _judged(states: DataFrame) -> DataFrame:
    """States with what is ``wrong`` with their file: it must end one document, with nothing open."""
    file = Window.partitionBy("file")
    left_open, ends = F.sum("delta").over(file), F.sum("ends").over(file)
    in_string = F.pmod(F.sum("quotes").over(file), F.lit(2))
    # The text reader does not tell whether a brace stands at the very end, sizes do
    # (but for compressed files, in which it goes unnoticed).
    brace = F.sum("n_bytes").over(file) + F.sum("records").over(file) == F.col("size")
    said = F.concat(F.lit("documents that end in it: "), ends, F.lit(", levels that stay open: "), left_open)
    return states.withColumn("wrong", F.when((left_open != 0) | (in_string != 0) | (ends != 1) | brace, said))


def _stop_on_wrong(rows: list) -> None:
    for row in rows:
        if row["wrong"] is not None:
            raise ValueError(f"{row['file']} is not one whole document; {row['wrong']}")


def split_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    glob: str | None = None,
    check: bool = True,
    sent_ranges: int = SENT_RANGES,
) -> DataFrame:
    """Delivered files, one document each, as ``value`` texts of one feature and what follows it.

    Files of any size and layout are shared by tasks like text; see the module.  A piece
    that ends before a further feature is closed to a document of its own, and the last one
    of a file must close itself.  The pieces are a table in the scratch folder.

    With ``check`` a file that was cut off, or that holds a second document, is an error.
    """
    ship_library(spark)
    session = _pinned(spark)
    reader = session.read
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    texts = reader.text(paths if isinstance(paths, str) else list(paths), lineSep="{")
    records = texts.select(
        "value",
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("begin"),
        meta["file_size"].alias("size"),
    )
    scratch = scratch_path(spark, "split")
    records.mapInArrow(_summaries, _SUMMARY).write.parquet(f"{scratch}/ranges")
    states = _states(spark.read.schema(_SUMMARY).parquet(f"{scratch}/ranges"))
    if check:
        states = _judged(states)
    else:
        states = states.withColumn("wrong", F.lit(None).cast("string"))
    # A file of one range starts and ends it outside of everything.
    told = states.filter("wrong IS NOT NULL OR NOT (begin = 0 AND last)").select("file", "begin", *_STATE, "wrong")
    few = told.limit(sent_ranges + 1).collect()
    _stop_on_wrong(few)
    if len(few) <= sent_ranges:
        known = {(row["file"], row["begin"]): tuple(row)[2:-1] for row in few}
        shared = spark.sparkContext.broadcast(known)
        stated = records
    else:
        shared = spark.sparkContext.broadcast(None)
        _stop_on_wrong(told.filter("wrong IS NOT NULL").head(1))
        told.drop("wrong").write.parquet(f"{scratch}/states")
        there = session.read.parquet(f"{scratch}/states").hint("merge")
        joined = records.withColumn("place", F.monotonically_increasing_id()).join(there, ["file", "begin"], "left")
        stated = joined.sortWithinPartitions("file", "begin", "place").drop("place")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Cutter | None = None
        for key, others, text, places in _stretches(batches):
            if now is None or now.key != key:
                if now is not None:
                    yield from now.end()
                if shared.value is None:
                    state = tuple(others[name] for name in _STATE)
                else:
                    state = shared.value.get(key, _NONE)
                if state == _NONE:
                    if key[1]:
                        raise RuntimeError(f"{key} was not a range of the first pass")
                    state = (0, 0, False, True)
                now = _Cutter(key, state)
            yield from now.add(text, places)
        if now is not None:
            yield from now.end()

    stated.mapInArrow(pieces, _PIECES).write.partitionBy("whole").parquet(f"{scratch}/pieces")
    cut = spark.read.schema(_PIECES).parquet(f"{scratch}/pieces")
    # What crosses a range: the end of one, whole ranges, and the beginning of another.
    order = Window.partitionBy("file").orderBy("begin", "opens").rowsBetween(Window.unboundedPreceding, 0)
    parts = cut.filter("NOT whole").withColumn("piece", F.sum(F.col("opens").cast("long")).over(order))
    text = F.sort_array(F.collect_list(F.struct("begin", "opens", "value")))
    crossing = parts.groupBy("file", "piece").agg(
        F.bool_or("first").alias("first"),
        F.bool_or("last").alias("last"),
        F.array_join(F.transform(text, lambda one: one["value"]), "").alias("value"),
    )
    both = cut.filter("whole").select("first", "last", "value").unionByName(crossing.select("first", "last", "value"))
    return both.select(_closed().alias("value"))


def _closed() -> Column:
    """A piece as a document; one that no comma parts from the next is no JSON and stays none."""
    text = F.trim(F.col("value"), F.lit(_BLANKS))
    before = F.rtrim(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(_BLANKS))
    inner = (
        F.when(text.endswith(",") & ~before.endswith("["), before)
        .when(F.col("first") & text.endswith("["), text)
        .otherwise(F.concat(text, F.lit("?")))
    )
    opened = F.when(F.col("first"), F.lit("")).otherwise(F.lit('{"features":['))
    return F.concat(opened, F.when(F.col("last"), text).otherwise(F.concat(inner, F.lit("]}"))))
