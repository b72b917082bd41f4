"""Documents resampled towards a target corpus by hashed n-gram weights.

Features are the runs of 1 to ``longest`` words of a text, joined by one blank; each falls
into the bucket that the CRC-32 of its bytes names.  The log ratio of a bucket in the
target and in all documents is its gain, and a document weighs the sum of the gains of its
features, which one numpy array lookup gives.  Gumbel noise from a hash of the id turns the
highest scores into a draw without replacement in proportion to the weights.

The cutoff of the draw is found without sorting all scores: a quantile sketch brackets it,
exact counts outside and inside the bracket confirm that it lies there or widen the
bracket, and only the rows of the bracket are sorted.  The drawn rows are then ranked by a
range partitioned sort.  What the driver sees is bounded: a count per bucket, a few
quantiles, and the number of rows of each partition.

Defined results: a null or empty text has no features, weighs 0 and is never drawn; a null
id counts as empty text in the noise and comes last among ties; rows of one id tie by their
features and weight and then by an arbitrary row number, so repeated rows get ranks of
their own; other columns are not kept; an empty table, or a target without words, is fine.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import quoted, written
from feedlake.llm.words import ALPHANUMERIC, LONG, LOWER, text_blocks, word_spans

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"

# Accuracy of the quantile sketch: its ranks are off by at most one in so many.
ACCURACY = 1_000

_HASHED = "doc_id long, n_words long, n_features long, cells binary"


def _crc_table() -> np.ndarray:
    """Steps of the reflected CRC-32 polynomial for one byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans of ``data``, each going on from its value in ``before`` (0 at first)."""
    state = ~before.astype(np.uint32)
    sizes = ends - starts
    at = np.flatnonzero(sizes <= LONG)
    for k in range(LONG):
        at = at[sizes[at] > k]
        if not len(at):
            break
        value = state[at]
        state[at] = _CRC[(value ^ data[starts[at] + k]) & 255] ^ (value >> 8)
    for i in np.flatnonzero(sizes > LONG).tolist():
        state[i] = ~np.uint32(zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(~state[i])))
    return ~state


_BLANK = np.frombuffer(b" ", np.uint8)


def _cells(data: np.ndarray, bounds: np.ndarray, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, text by text; how many features and words each text has."""
    data = LOWER[data]
    starts, ends = word_spans(data, bounds, ALPHANUMERIC)
    edges = np.searchsorted(starts, bounds)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(edges))
    crc = np.zeros(len(starts), np.uint32)
    found, owners = [], []
    for size in range(1, longest + 1):
        # crc has the runs of size - 1 words; one more word, in the same text, goes on.
        first = np.arange(len(starts) - size + 1) if len(starts) >= size else np.empty(0, np.int64)
        first = first[text[first] == text[first + size - 1]]
        value = crc[first]
        if size > 1:
            zeros = np.zeros(len(first), np.int64)
            value = crc32_spans(_BLANK, zeros, zeros + 1, value)
        crc = np.zeros(len(starts), np.uint32)
        crc[first] = crc32_spans(data, starts[first + size - 1], ends[first + size - 1], value)
        found.append(crc[first] % np.uint32(buckets))
        owners.append(text[first])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    n_features = np.bincount(owner, minlength=len(bounds) - 1)
    return np.concatenate(found)[order], n_features, np.diff(edges)


def hashed(
    docs: DataFrame,
    *,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    doc_id: str | None = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``cells``, the bucket of each feature."""
    key = F.lit(None) if doc_id is None else F.col(quoted(doc_id))
    slim = docs.select(key.cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    kind = np.dtype(_kind(buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in text_blocks(batch.column(1)):
                cells, n_features, n_words = _cells(data, bounds, buckets, longest)
                raw = cells.astype(kind).tobytes()
                stops = (np.cumsum(n_features) * kind.itemsize).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(n_words)),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_features, pa.int64()),
                        pa.array([raw[a:b] for a, b in zip([0, *stops[:-1]], stops)], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "n_features", "cells"],
                )

    return slim.mapInArrow(run, _HASHED)


def _kind(buckets: int) -> str:
    """Little-endian bytes that hold every bucket."""
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all ``rows`` of :func:`hashed`."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cells in batch.column(0):
                if cells.is_valid:
                    total += np.bincount(np.frombuffer(cells.as_buffer(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = rows.select("cells").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # a row per bucket at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share, target to source, rounded down."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``rows`` of :func:`hashed`, other columns kept, with ``weight`` in place of ``cells``."""
    shared = rows.sparkSession.sparkContext.broadcast((gain, _kind(len(gain))))
    names = [name for name in rows.columns if name != "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, kind = shared.value
        for batch in batches:
            cells = [np.frombuffer(one.as_buffer(), kind) for one in batch.column("cells")]
            total = np.concatenate(([0], np.cumsum(gain[np.concatenate([np.empty(0, kind), *cells])])))
            stops = np.cumsum([len(one) for one in cells], dtype=np.int64)
            weight = np.diff(total[stops], prepend=0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(weight, pa.int64())], names=[*names, "weight"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("cells").schema.fields)
    return rows.mapInArrow(run, f"{schema}, weight long")


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Thousandths of a standard Gumbel value from a hash of the id, rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(named, 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight", "row"]


def ranked(rows: DataFrame, name: str = "rank") -> DataFrame:
    """``rows`` with their number, from 1, in the order of the draw.

    The rows are range partitioned and sorted; each is numbered within its partition and the
    sizes of the partitions before it are added.
    """
    spread = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    placed = written(spread.withColumn("place", F.monotonically_increasing_id()), "ranked")
    # The upper bits of such an id are the partition, the lower 33 the row in it.
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for row in sorted(sizes):
        offsets.append((row["part"], before))
        before += row["n"]
    small = placed.sparkSession.createDataFrame(offsets, "part long, before long")  # a row per partition
    at = placed.withColumn("part", part).join(F.broadcast(small), "part")
    return at.withColumn(name, F.col("place").bitwiseAND((1 << 33) - 1) + F.col("before") + 1).drop(
        "part", "place", "before"
    )


@dataclass(frozen=True)
class Bracket:
    """Scores between which the last drawn row lies; None is no bound.  ``above`` rows score higher."""

    low: int | None
    high: int | None
    above: int
    inside: int
    rounds: int


def bracket(pool: DataFrame, draw: int, total: int, accuracy: int = ACCURACY) -> Bracket:
    """A bracket of scores that holds the ``draw``-th highest of ``total`` rows."""
    widths = [2.0**k / accuracy for k in range(1, 1 + math.ceil(math.log2(accuracy)))]
    middle = 1 - draw / total
    asked = sorted({min(max(middle + sign * w, 0.0), 1.0) for w in widths for sign in (-1, 1)})
    found = pool.agg(F.percentile_approx("score", asked, accuracy)).first()[0]
    at = dict(zip(asked, found))
    below = above = 0
    rounds = 0
    while True:
        rounds += 1
        low = middle - widths[below] if below < len(widths) else -1.0
        high = middle + widths[above] if above < len(widths) else 2.0
        # A quantile beyond the ends of the sketch is no bound.
        least = at[low] if 0 < low else None
        most = at[high] if high < 1 else None
        over = F.lit(False) if most is None else F.col("score") > most
        within = ~over if least is None else ~over & (F.col("score") >= least)
        n_over, n_within = pool.agg(F.count_if(over), F.count_if(within)).first()
        if n_over >= draw:
            above += 1
        elif n_over + n_within < draw:
            below += 1
        else:
            return Bracket(least, most, n_over, n_within, rounds)


def cutoff(pool: DataFrame, draw: int, total: int, accuracy: int = ACCURACY):
    """The row of ``pool`` that is the ``draw``-th in order; only the bracket is sorted."""
    found = bracket(pool, draw, total, accuracy)
    inside = F.lit(True)
    if found.low is not None:
        inside = inside & (F.col("score") >= found.low)
    if found.high is not None:
        inside = inside & (F.col("score") <= found.high)
    numbered = ranked(pool.filter(inside), "rank")
    return numbered.filter(F.col("rank") == draw - found.above).first()


def _not_after(last) -> Column:
    """Rows that come no later than ``last`` in the order of the draw."""
    ids = F.col("doc_id")
    if last["doc_id"] is None:
        sooner, same = ids.isNotNull(), ids.isNull()
    else:
        sooner, same = F.coalesce(ids < last["doc_id"], F.lit(False)), ids.eqNullSafe(last["doc_id"])
    rest = F.struct("n_features", "weight", "row") <= F.struct(
        *(F.lit(last[name]).cast("long").alias(name) for name in ("n_features", "weight", "row"))
    )
    return (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & (sooner | (same & rest)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Every document's ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn)."""
    numbered = hashed(docs, buckets=buckets, longest=longest, doc_id=doc_id, text=text).withColumn(
        "row", F.monotonically_increasing_id()
    )
    rows = written(numbered, "cells")
    wanted = hashed(target, buckets=buckets, longest=longest, doc_id=None, text=target_text)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
    noisy = weighted(rows, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(noisy, "scores")
    pool = scored.filter(F.col("n_words") >= least_words)
    total = pool.count()
    draw = percent * total // 100
    keep = ["doc_id", "n_features", "weight", "score"]
    if not draw:
        return scored.select(*keep, F.lit(None).cast("long").alias("rank"))
    taken = (F.col("n_words") >= least_words) & _not_after(cutoff(pool, draw, total, accuracy))
    others = scored.filter(~taken).select(*keep, F.lit(None).cast("long").alias("rank"))
    return ranked(scored.filter(taken)).select(*keep, "rank").unionByName(others)
