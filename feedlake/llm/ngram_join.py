"""Jaccard similarity join on word n-grams with rare-first prefix filtering.

1. One pass counts n-grams into a table of fixed size (a count sketch of hashed
   cells).  It sets the global order, rare first; any order gives the same links,
   a good one keeps the lists of common n-grams short.
2. Each document becomes the sorted set of its n-gram hashes.  Documents with equal
   sets form a class; one of them, the smallest id, stands for all.
3. The prefix of a set is so long that two similar sets must share an n-gram of
   their prefixes.  Pairs come from equi-joins on prefix n-grams and pass a length,
   a positional and a suffix filter before their whole sets are compared, once.
4. The links are closed to components.

A list of thousands of near copies would have millions of pairs.  First every
document is paired with two members of its lists only; what that links is one
component, and what is still outside is paired once more.  Then exactly the pairs that are left, those across components,
are made: all members outside the component that a list mostly consists of, with
all members of the list.  Pairs within a component cannot change the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.components import connected
from feedlake.llm.frames import quoted, unused, written
from feedlake.llm.words import joined, mixed, shingles, word_blocks

SHINGLE_WORDS = 3
PERCENT = 90

SKETCH_BITS = 20
_SECTIONS = 64

# Members of a component that one outside it is paired with, per list, before all are.
_PARTNERS = 16

# N-grams per bin of a set's outline, at least; less than twice as many.
_PER_BIN = 4

_COUNTS = "section int, counts binary"
_SETS = "doc_id long, n int, digest binary, prefix array<long>, outline binary"


def sets_of(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct n-gram hashes of each text.

    A text with fewer than ``size`` words is one n-gram; one without words is empty.
    """
    for block in word_blocks(column):
        edges = block.edges
        grams = shingles(block.hashes, size)
        for i, (begin, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if end - begin >= size:
                yield block.first + i, np.unique(grams[begin : end - size + 1])
            elif end > begin:
                whole = np.array([joined(block.hashes[begin:end])], np.uint64)
                yield block.first + i, whole
            else:
                yield block.first + i, np.empty(0, np.uint64)


def outline(grams: np.ndarray) -> bytes:
    """How many n-grams lie in each of 2**k equal ranges of hash values."""
    k = max(0, (len(grams) // _PER_BIN).bit_length() - 1)
    where = (grams >> np.uint64(64 - k)).astype(np.int64) if k else np.zeros(len(grams), np.int64)
    return np.minimum(np.bincount(where, minlength=1 << k), 65535).astype(np.uint16).tobytes()


def most_common(one: bytes, other: bytes) -> int:
    """The largest overlap that two outlines allow."""
    p, q = (np.frombuffer(x, np.uint16).astype(np.int64) for x in (one, other))
    size = min(len(p), len(q))
    return int(np.minimum(p.reshape(size, -1).sum(1), q.reshape(size, -1).sum(1)).sum())


def gram_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How often n-grams fall into each of ``2**SKETCH_BITS`` cells, over all documents.

    Tasks count for themselves and give one row per section; sections are added
    up on the executors.  The result has the same size for any input.
    """
    cells = 1 << SKETCH_BITS
    width = cells // _SECTIONS

    def rows(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for section, counts in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([section], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                names=["section", "counts"],
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for block in word_blocks(batch.column(0)):
                grams = shingles(block.hashes, size)
                total += np.bincount((grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=cells)
        if total.any():
            yield from rows(dict(enumerate(total.reshape(_SECTIONS, width))))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for section, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                have = totals.setdefault(section, np.zeros(width, np.int64))
                have += np.frombuffer(counts, np.int64)
        yield from rows(totals)

    found = (
        docs.select("text")
        .mapInArrow(counted, _COUNTS)
        .repartition(_SECTIONS // 4, "section")
        .mapInArrow(added, _COUNTS)
        .collect()
    )
    out = np.zeros((_SECTIONS, width), np.int64)
    for section, counts in found:
        out[section] = np.frombuffer(counts, np.int64)
    return out.reshape(-1)


def _described(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """Set size, set digest, prefix in the global order and outline of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = shared.value
        for batch in batches:
            sizes, digests, prefixes, outlines = [], [], [], []
            for _, grams in sets_of(batch.column(1), size):
                n = len(grams)
                sizes.append(n)
                seeds = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
                sums = [int(mixed(grams ^ seed).sum()) if n else 0 for seed in seeds]
                digests.append(b"".join(s.to_bytes(8, "little") for s in sums) + n.to_bytes(4, "little"))
                keep = n - -(-percent * n // 100) + 1 if n else 0
                order = np.argsort(rare[grams >> np.uint64(64 - SKETCH_BITS)], kind="stable")
                prefixes.append(grams[order[:keep]].view(np.int64))
                outlines.append(outline(grams))
            lengths = np.cumsum([0] + [len(p) for p in prefixes])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int32()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(lengths, pa.int32()), pa.array(np.concatenate([*prefixes, np.empty(0, np.int64)]))
                    ),
                    pa.array(outlines, pa.binary()),
                ],
                names=["doc_id", "n", "digest", "prefix", "outline"],
            )

    return docs.mapInArrow(run, _SETS)


def _enough(overlap: str, percent: int) -> str:
    """SQL: so large an overlap makes ``percent`` of the union; sizes are na and nb."""
    return f"({overlap}) * {100 + percent} >= {percent} * (na + nb)"


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of rows that share a prefix n-gram and pass two filters.

    Length: the smaller set can hold enough of the larger one.  Positional: the
    shared n-gram and what comes after it are enough.  That holds for the first
    n-gram that two similar sets share, so a join that has the rows of all shared
    n-grams of a pair loses none.
    """
    most = "least(na - pa, nb - pb)"
    return (
        rows.filter("a <> b")
        .filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        .filter(_enough(most, percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the candidate pairs that are similar, by a suffix filter and the whole sets."""
    # The whole order of hash values is cut at fixed points, so that the parts hold a few
    # n-grams each; parts of two sets overlap by no more than the smaller one.
    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (na, nb, x, y) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(2, 6)))):
                if most_common(x, y) * (100 + percent) >= percent * (na + nb):
                    kept.append(i)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])

    outlines = classes.select("doc_id", "n", "outline")
    one = outlines.selectExpr("doc_id AS a", "n AS na", "outline AS outline_a")
    two = outlines.selectExpr("doc_id AS b", "n AS nb", "outline AS outline_b")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "outline_a", "outline_b")
    likely = written(both.mapInArrow(fitting, "a long, b long"), "candidates")
    wanted = likely.select("a").union(likely.select("b")).distinct().withColumnRenamed("a", "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams.tobytes() for _, grams in sets_of(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "grams"]
            )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    kept.append(i)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])

    whole = docs.join(wanted, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, grams binary")
    whole = written(whole, "sets")
    full = (
        likely.join(whole.selectExpr("doc_id AS a", "grams AS grams_a"), "a")
        .join(whole.selectExpr("doc_id AS b", "grams AS grams_b"), "b")
        .select("a", "b", "grams_a", "grams_b")
    )
    return written(full.mapInArrow(compared, "a long, b long"), "links")


def _entries(classes: DataFrame) -> DataFrame:
    """One row per n-gram of each prefix, with its position."""
    return classes.select("doc_id", "n", F.posexplode("prefix").alias("pos", "gram"))


def similar_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each document.

    Two documents are linked when ``100 * intersection >= percent * union`` of their
    sets of ``shingle_words``-word shingles; ``component_id`` is the smallest
    ``doc_id`` that links reach, the document's own included.

    Defined results: a text with fewer words is one shingle; a null or empty text
    has none and is linked with nothing.  A row without ``doc_id`` gets the component
    of its exact copies that have one, else null, and links nothing itself.  Rows
    that share a ``doc_id`` are one document.  Other columns are not looked at.
    """
    slim = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    counts = gram_counts(slim, shingle_words)
    described = written(_described(slim, counts, shingle_words, percent), "described")
    classes = written(
        described.filter("doc_id IS NOT NULL AND n > 0")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n").alias("n"),
            F.first("prefix").alias("prefix"),
            F.first("outline").alias("outline"),
        ),
        "classes",
    )
    components = _class_components(classes, slim, shingle_words, percent)
    standing = classes.selectExpr("digest", "doc_id AS node").join(components, "node", "left")
    standing = standing.select("digest", F.coalesce("component", "node").alias("component"))
    placed = described.select("doc_id", "n", "digest").join(standing, "digest", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return placed.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that are linked, directly or through others, with a
    document of a smaller id; of rows that share an id, one stays.

    Rows without ``doc_id`` stay.
    """
    found = similar_documents(docs, doc_id=doc_id, **options)
    key, gone = unused(docs, "similar_key"), unused(docs, "similar_gone")
    later = found.filter("component_id < doc_id").select(F.col("doc_id").cast("string").alias(gone)).distinct()
    row = F.concat(F.lit("row "), F.monotonically_increasing_id())
    keyed = docs.withColumn(key, F.coalesce(F.col(quoted(doc_id)).cast("long").cast("string"), row))
    kept = keyed.join(later, keyed[key] == later[gone], "left_anti")
    return kept.dropDuplicates([key]).drop(key)


def _class_components(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    entries = _entries(classes)
    repeated = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = written(entries.join(repeated.select("gram"), "gram"), "shared")
    # Each document is first paired with two members of its lists: of the rarest n-gram it
    # shares, the member with the fewest rarer n-grams, which is the likely origin of near
    # copies; and one drawn at random from any list.
    draw = F.xxhash64("doc_id", "gram").alias("draw")
    rest = ["doc_id", "n", "pos"]
    hubs = shared.groupBy("gram").agg(
        F.min(F.struct("pos", draw, "doc_id", "n")).alias("central"),
        F.min(F.struct(draw, *rest)).alias("drawn"),
    )
    near_hubs = (
        shared.join(hubs, "gram")
        .groupBy(F.col("doc_id").alias("a"), F.col("n").alias("na"))
        .agg(
            F.min(F.when(F.col("central.doc_id") != F.col("doc_id"), F.struct("pos", "central"))).alias("central"),
            F.min(F.when(F.col("drawn.doc_id") != F.col("doc_id"), F.struct("drawn", "pos"))).alias("drawn"),
        )
    )
    ends = [
        F.struct(f"{h}.pos", f"{h}.{h}.doc_id", f"{h}.{h}.n", F.col(f"{h}.{h}.pos").alias("pb"))
        for h in ("central", "drawn")
    ]
    spokes = near_hubs.select("a", "na", F.explode(F.array(*ends)).alias("hub")).selectExpr(
        "a", "na", "hub.pos AS pa", "hub.doc_id AS b", "hub.n AS nb", "hub.pb AS pb"
    )
    first = written(_candidates(spokes, percent), "pairs")
    links = _linked(first, classes, docs, size, percent)
    members = _mixed_lists(shared, connected(links))
    # Members outside the component that a list mostly consists of are paired with a few
    # members of it from each of their lists, which leaves few of them.
    share = F.pmod(F.xxhash64(F.lit("share"), "doc_id"), F.lit(_PARTNERS)).alias("share")
    chance = F.struct(F.xxhash64(F.lit("drawn"), "doc_id", "gram").alias("draw"), *rest)
    partners = members.filter("component = main").groupBy("gram", share).agg(F.min(chance).alias("hub"))
    spokes = members.filter("component <> main").join(partners, "gram").selectExpr(
        "doc_id AS a", "n AS na", "pos AS pa", "hub.doc_id AS b", "hub.n AS nb", "hub.pos AS pb"
    )
    second = written(_candidates(spokes, percent).join(first, ["a", "b"], "left_anti"), "pairs")
    more = _linked(second, classes, docs, size, percent)
    if more.head(1):
        links = links.union(more)
        members = _mixed_lists(shared, connected(links))
    # What is left: pairs across components.
    left = members.filter("component <> main").selectExpr(
        "gram", "doc_id AS a", "n AS na", "pos AS pa", "component AS ca"
    )
    right = members.selectExpr("gram", "doc_id AS b", "n AS nb", "pos AS pb", "component AS cb")
    across = _candidates(left.join(right, "gram").filter("ca <> cb"), percent)
    across = across.join(first.union(second), ["a", "b"], "left_anti")
    more = _linked(written(across, "pairs"), classes, docs, size, percent)
    return connected(links.union(more))


def _mixed_lists(shared: DataFrame, near: DataFrame) -> DataFrame:
    """Entries of lists with members of several components, with their ``component`` and
    the one of the list's central member, ``main``."""
    labels = near.withColumnRenamed("node", "doc_id")
    component = F.coalesce("component", "doc_id")
    placed = written(shared.join(labels, "doc_id", "left").withColumn("component", component), "placed")
    draw = F.xxhash64("doc_id", "gram").alias("draw")
    lists = placed.groupBy("gram").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min(F.struct("pos", draw, "component")).alias("central"),
    )
    mixed = lists.filter("low < high").select("gram", F.col("central.component").alias("main"))
    return placed.join(mixed, "gram")
