"""Benchmark decontamination with suffix arrays over the training words.

Every task turns its documents into shards of a few megabytes and builds a suffix
array over the word sequence of each shard.  All suffixes of the benchmark items
are then searched in it at once, which gives for each the longest verbatim match
and every place it stands at.  A document lies in one shard, so nothing is
shuffled, and a document with many copies or many matches weighs on its own task
only by its own words.

The benchmark is the query set.  It is taken in blocks of at most ``block_words``
words, the only thing that is ever broadcast; with more than one block the
documents pass through one such scan per block.

Defined results: a null text or item has no words; an item without words matches
nothing; a null ``item_id`` counts as the empty string; repeated rows are judged
one by one; other columns, whatever their names, pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm.frames import quoted, unused, written
from feedlake.llm.words import ALPHANUMERIC, Block, text_hashes, word_blocks

WINDOW_WORDS = 10
SHARD_BYTES = 2 << 20
BLOCK_WORDS = 500_000

VERDICT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)

MATCHES = "doc_id long, item_id string, item_pos long, doc_pos long, n_words long"


def suffix_array(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Start positions of all suffixes of ``ranks``, sorted by their first ``depth`` values.

    The first key packs as many values as fit 63 bits; after that only the
    suffixes that are still tied are sorted again, by the rank of what follows.
    """
    n = len(ranks)
    if not n:
        return np.empty(0, np.int64)
    bits = max(1, int(ranks.max()).bit_length())
    known = max(1, 63 // bits)
    padded = np.concatenate([ranks.astype(np.int64), np.zeros(known, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(known):
        key = (key << bits) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    # Rank of a suffix: the slot at which its group of equal keys begins.
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(np.append(heads, n))
    group = np.repeat(heads, sizes)
    rank = np.empty(n + 1, np.int64)
    rank[order] = group
    rank[n] = -1
    tied = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while known < depth and len(tied):
        suffixes = order[tied]
        below = rank[np.minimum(suffixes + known, n)]
        by = np.lexsort((below, group[tied]))
        suffixes, below, above = suffixes[by], below[by], group[tied][by]
        order[tied] = suffixes
        first = np.concatenate(([True], (above[1:] != above[:-1]) | (below[1:] != below[:-1])))
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(tied)))
        group[tied] = np.repeat(tied[heads], sizes)
        rank[suffixes] = group[tied]
        tied = tied[np.repeat(sizes > 1, sizes)]
        known *= 2
    return order


@dataclass
class Suffixes:
    """All suffixes of a block of items: where each starts and how long it is."""

    words: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    windows: np.ndarray
    item: np.ndarray
    ids: list[str]

    @classmethod
    def of(cls, items: list[tuple[str, np.ndarray]], window_words: int) -> Suffixes:
        sizes = np.array([len(words) for _, words in items], np.int64)
        item = np.repeat(np.arange(len(items)), sizes)
        starts = np.arange(len(item))
        lengths = np.cumsum(sizes)[item] - starts
        windows = np.minimum(window_words, sizes)[item]
        words = np.concatenate([words for _, words in items] or [np.empty(0, np.uint64)])
        return cls(words, starts, lengths, windows, item, [name for name, _ in items])


@dataclass
class Found:
    """For each suffix: slots of the suffix array with its window, and its longest match."""

    low: np.ndarray
    high: np.ndarray
    longest: np.ndarray


def search(array: np.ndarray, ranks: np.ndarray, suffixes: Suffixes, values: np.ndarray) -> Found:
    """Binary search of every suffix; ``values`` are its words as ranks, -1 if unknown.

    The range of slots narrows word by word until no slot is left.
    """
    n, m = len(array), len(suffixes.starts)
    padded = np.concatenate([ranks, np.full(1, -2, ranks.dtype)])
    low, high = np.zeros(m, np.int64), np.full(m, n, np.int64)
    found = Found(low.copy(), low.copy(), low.copy())

    def bound(lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray, depth: int, right: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while len(open_ := np.flatnonzero(lo < hi)):
            middle = (lo[open_] + hi[open_]) >> 1
            here = padded[np.minimum(array[middle] + depth, n)]
            up = here <= wanted[open_] if right else here < wanted[open_]
            lo[open_] = np.where(up, middle + 1, lo[open_])
            hi[open_] = np.where(up, hi[open_], middle)
        return lo

    alive = np.arange(m)
    depth = 0
    while len(alive):
        wanted = values[suffixes.starts[alive] + depth]
        left = bound(low[alive], high[alive], wanted, depth, False)
        right = bound(left, high[alive], wanted, depth, True)
        kept = (left < right) & (wanted >= 0)
        alive, left, right = alive[kept], left[kept], right[kept]
        low[alive], high[alive] = left, right
        depth += 1
        found.longest[alive] = depth
        whole = alive[suffixes.windows[alive] == depth]
        found.low[whole], found.high[whole] = low[whole], high[whole]
        alive = alive[suffixes.lengths[alive] > depth]
    return found


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All slots of the ranges, and which range each is of."""
    sizes = high - low
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of], of


@dataclass
class Shard:
    """Suffix array over the words of a block, a separator after each document."""

    block: Block
    suffixes: Suffixes

    def __post_init__(self) -> None:
        edges, counts = self.block.edges, self.block.counts
        vocabulary, ranks = np.unique(self.block.hashes, return_inverse=True)
        self.starts = edges[:-1] + np.arange(len(counts))
        self.ranks = np.zeros(len(ranks) + len(counts), np.int64)
        where = np.arange(len(ranks)) + np.repeat(np.arange(len(counts)), counts)
        self.ranks[where] = ranks + 1
        if len(vocabulary):
            at = np.minimum(np.searchsorted(vocabulary, self.suffixes.words), len(vocabulary) - 1)
            values = np.where(vocabulary[at] == self.suffixes.words, at + 1, -1)
        else:
            values = np.full(len(self.suffixes.words), -1)
        self.values = values
        depth = int(self.suffixes.lengths.max(initial=1))
        self.array = suffix_array(self.ranks, depth)
        self.found = search(self.array, self.ranks, self.suffixes, values)

    def document_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1

    def hits(self) -> tuple[list[list[int]], list[list[str]]]:
        """Per document: hit ranges of words (from, to, from, to, ...), and items."""
        slots, query = _spread(self.found.low, self.found.high)
        positions = self.array[slots]
        covered = np.zeros(len(self.ranks) + 1, np.int64)
        np.add.at(covered, positions, 1)
        np.add.at(covered, positions + self.suffixes.windows[query], -1)
        inside = np.concatenate(([False], np.cumsum(covered[:-1]) > 0, [False]))
        turns = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
        ranges: list[list[int]] = [[] for _ in self.block.counts]
        for document, (begin, end) in zip(self.document_of(turns[:, 0]).tolist(), turns.tolist()):
            start = int(self.starts[document])
            ranges[document] += [begin - start, end - start]
        items: list[list[str]] = [[] for _ in self.block.counts]
        pairs = np.unique(self.document_of(positions) * len(self.suffixes.ids) + self.suffixes.item[query])
        for pair in pairs.tolist():
            document, item = divmod(pair, len(self.suffixes.ids))
            items[document].append(self.suffixes.ids[item])
        return ranges, items

    def longest(self) -> Iterator[tuple[int, int, int, int, int]]:
        """Matches of at least a window that cannot be longer on either side: document,
        item, word of the item, word of the document, words."""
        slots, query = _spread(self.found.low, self.found.high)
        positions, begin = self.array[slots], self.suffixes.starts[query]
        # What stands in front of a match must differ, or be the edge of an item or document.
        ranks = np.append(self.ranks, -2)
        edge = (begin == 0) | (self.suffixes.item[np.maximum(begin - 1, 0)] != self.suffixes.item[begin])
        left = self.values[np.maximum(begin - 1, 0)]
        free = edge | (positions == 0) | (ranks[positions - 1] != left)
        query, positions, begin = query[free], positions[free], begin[free]
        words = self.suffixes.windows[query].copy()
        going = np.arange(len(words))
        while len(going):
            going = going[words[going] < self.suffixes.lengths[query[going]]]
            at = words[going]
            going = going[ranks[np.minimum(positions[going] + at, len(ranks) - 1)] == self.values[begin[going] + at]]
            words[going] += 1
        document = self.document_of(positions)
        item = self.suffixes.item[query]
        inner = begin - np.searchsorted(self.suffixes.item, item)
        rows = (document, item, inner, positions - self.starts[document], words)
        yield from zip(*(column.tolist() for column in rows))


def _union(ranges: list[int], more: list[int]) -> list[int]:
    out: list[int] = []
    for begin, end in sorted(zip([*ranges[::2], *more[::2]], [*ranges[1::2], *more[1::2]])):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def item_blocks(
    benchmark: DataFrame, item_id: str, text: str, window_words: int, block_words: int
) -> Iterator[Suffixes]:
    """The benchmark in blocks of about ``block_words`` words; one is held at a time."""
    rows = benchmark.select(F.col(quoted(item_id)).cast("string"), F.col(quoted(text)))
    block, size = [], 0
    for name, body in rows.toLocalIterator():
        words = text_hashes(body or "", ALPHANUMERIC)
        if not len(words):
            continue
        block.append((name or "", words))
        size += len(words)
        if size >= block_words:
            yield Suffixes.of(block, window_words)
            block, size = [], 0
    if block:
        yield Suffixes.of(block, window_words)


def _scanned(docs: DataFrame, suffixes: Suffixes | None, text: str, name: str, shard_bytes: int) -> DataFrame:
    """``docs`` with the verdict of one block of items, added to an earlier one."""
    again = name in docs.columns
    kept = [field for field in docs.schema.fields if field.name != name]
    schema = T.StructType([*kept, T.StructField(name, VERDICT)])
    shared = docs.sparkSession.sparkContext.broadcast(suffixes) if suffixes else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            earlier = batch.column(batch.schema.names.index(name)).to_pylist() if again else None
            for block in word_blocks(column, ALPHANUMERIC, shard_bytes):
                rows = len(block.counts)
                if shared is None:
                    ranges, items = [[] for _ in range(rows)], [[] for _ in range(rows)]
                else:
                    ranges, items = Shard(block, shared.value).hits()
                if earlier:
                    for i, old in enumerate(earlier[block.first : block.first + rows]):
                        ranges[i], items[i] = _union(old["hits"], ranges[i]), old["items"] + items[i]
                verdict = pa.StructArray.from_arrays(
                    [
                        pa.array(block.counts, pa.int64()),
                        pa.array(ranges, pa.list_(pa.int64())),
                        pa.array([sorted(names) for names in items], pa.list_(pa.string())),
                    ],
                    names=VERDICT.names,
                )
                part = batch.slice(block.first, rows)
                columns = [part.column(part.schema.names.index(field.name)) for field in kept]
                yield pa.RecordBatch.from_arrays([*columns, verdict], names=schema.names)

    return docs.mapInArrow(run, schema)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    verdict: str = "verdict",
    window_words: int = WINDOW_WORDS,
    shard_bytes: int = SHARD_BYTES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` and a struct ``verdict``: ``n_words``, ``hits`` (from, to, ... of the
    words inside any occurrence of an item window) and ``items`` (sorted ids, one per
    item row with a window that occurs).

    A window is ``window_words`` consecutive words of an item, or all of a shorter one.
    """
    if verdict in docs.columns:
        raise ValueError(f"documents have a column {verdict!r}")
    out = None
    for suffixes in item_blocks(benchmark, item_id, item_text, window_words, block_words):
        before = docs if out is None else written(out, "scan")
        out = _scanned(before, suffixes, text, verdict, shard_bytes)
    return out if out is not None else _scanned(docs, None, text, verdict, shard_bytes)


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_words: int = WINDOW_WORDS,
    shard_bytes: int = SHARD_BYTES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Longest verbatim matches and where they stand, one row per document, item and place.

    ``item_pos`` and ``doc_pos`` count words from 0.  A match has at least
    ``least_words`` words, or is all of a shorter item, and cannot be extended.
    """
    slim = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    out = docs.sparkSession.createDataFrame([], MATCHES)
    for suffixes in item_blocks(benchmark, item_id, item_text, least_words, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(suffixes)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in word_blocks(batch.column(1), ALPHANUMERIC, shard_bytes):
                    ids = batch.column(0).slice(block.first, len(block.counts)).to_pylist()
                    names = shared.value.ids
                    rows = [
                        (ids[document], names[item], *rest)
                        for document, item, *rest in Shard(block, shared.value).longest()
                    ]
                    columns = list(zip(*rows)) if rows else [[] for _ in range(5)]
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(
                        arrays, names=["doc_id", "item_id", "item_pos", "doc_pos", "n_words"]
                    )

        out = out.unionByName(slim.mapInArrow(run, MATCHES))
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that have a window of a benchmark item."""
    name = unused(docs, "verdict")
    judged = scan(docs, benchmark, verdict=name, **options)
    return judged.filter(F.size(f"{quoted(name)}.hits") == 0).drop(name)


def n_hit_words(ranges: str):
    """SQL: words inside the ranges of a ``hits`` column."""
    signed = f"transform({ranges}, (x, i) -> if(i % 2 = 0, -x, x))"
    return F.expr(f"aggregate({signed}, 0L, (total, x) -> total + x)")

