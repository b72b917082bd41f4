"""Resampling against plain Python over the whole table, and the cutoff against a sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedlake.llm import importance_resampling as resampling
from feedlake.llm.words import text_blocks

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    words = WORDS.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), runs


def brute(rows, target, *, percent=10, least_words=20, buckets=10_000, longest=1):
    cell = lambda f: zlib.crc32(f.encode()) % buckets
    texts = [(doc_id, *features(text, longest)) for doc_id, text, *_ in rows]
    source = Counter(cell(f) for _, _, runs in texts for f in runs)
    wanted = Counter(cell(f) for text in target for f in features(text, longest)[1])
    s_all, t_all = sum(source.values()) + buckets, sum(wanted.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((source[b] + 1) * t_all)))
    out, pool = [], []
    for doc_id, n_words, runs in texts:
        weight = sum(gain(cell(f)) for f in runs)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(runs), weight, score, None])
        if n_words >= least_words:
            pool.append(out[-1])
    pool.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(pool[: percent * len(pool) // 100], 1):
        row[4] = rank
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="module")
def corpus(prose):
    draw = random.Random(3)
    rows = [(i, " ".join(prose(i, draw.randrange(1, 90)))) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(150)] + [(9, rows[9][1])] * 60
    return rows + [(None, rows[11][1]), (None, rows[12][1]), (None, None)]


TARGET = ["Ban bast ben bin. BIN!", None, "", "dur dor déjà vu", "kan kin 中文"]


@pytest.mark.parametrize("options", [{}, {"longest": 2, "percent": 33}, {"percent": 100, "least_words": 1, "buckets": 70_000}])
def test_equals_brute_force(spark, documents, corpus, options):
    target = spark.createDataFrame([(text,) for text in TARGET], "text string")
    got = resampling.resampled(documents(corpus, 6), target, accuracy=50, **options).collect()
    assert in_order(got) == in_order(brute(corpus, TARGET, **options))


def test_hostile_rows(spark, documents, hostile_rows):
    target = spark.createDataFrame([("one two",)], "text string")
    for share in (50, 100):
        options = {"percent": share, "least_words": 1}
        got = resampling.resampled(documents(hostile_rows, 3), target, **options).collect()
        assert in_order(got) == in_order(brute(hostile_rows, ["one two"], **options))


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "text string")
    assert resampling.resampled(documents([]), none).count() == 0
    got = resampling.resampled(documents([(1, "a b"), (2, None)]), none).collect()
    assert in_order(got) == in_order(brute([(1, "a b"), (2, None)], []))


@pytest.mark.parametrize("draw", [1, 2, 250, 4_999, 9_999, 10_000])
def test_cutoff_and_bracket(spark, draw):
    # Half of all scores are one value: the bracket must take them all and ids decide.
    rows = spark.range(10_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.xxhash64("id") % 1000).alias("score"),
        ((F.col("id") * 7_919) % 10_000).alias("doc_id"), F.lit(1).cast("long").alias("n_features"),
        F.lit(0).cast("long").alias("weight"), F.col("id").alias("row"),
    )
    want = sorted(((-r.score, r.doc_id) for r in rows.collect()))[draw - 1]
    for accuracy in (2, 100, 10_000):
        last = resampling.cutoff(rows, draw, 10_000, accuracy)
        assert (-last.score, last.doc_id) == want
    found = resampling.bracket(rows, draw, 10_000, 10_000)
    assert found.above < draw <= found.above + found.inside
    picked = rows.filter(resampling._not_after(last))
    assert picked.count() == draw
    ranks = resampling.ranked(picked).orderBy("rank").collect()
    assert [r.rank for r in ranks] == [*range(1, draw + 1)]
    assert [(-r.score, r.doc_id) for r in ranks] == sorted((-r.score, r.doc_id) for r in ranks)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    rows = spark.range(1_000).selectExpr("id AS score", "id AS doc_id", "1L AS n_features", "0L AS weight", "id AS row")
    # A sketch that is off by a tenth, one way and the other.
    plain = F.percentile_approx
    for shift in (-100, 100):
        monkeypatch.setattr(
            resampling.F, "percentile_approx",
            lambda c, asked, accuracy: F.transform(plain(c, asked, 10_000), lambda x: x + shift),
        )
        found = resampling.bracket(rows, 100, 1_000, 1_000)
        assert found.rounds > 1 and found.above < 100 <= found.above + found.inside
        monkeypatch.undo()


def test_crc_of_spans():
    texts = ["", "a", "é" * 200, "ab " * 50, "x" * 64, "y" * 65, "Ünï 中文"]
    for row, data, bounds in text_blocks(pa.array(texts)):
        zero = np.zeros(len(texts), np.uint32)
        got = resampling.crc32_spans(data, bounds[:-1], bounds[1:], zero)
        assert got.tolist() == [zlib.crc32(t.encode()) for t in texts]
        again = resampling.crc32_spans(data, bounds[:-1], bounds[1:], got)
        assert again.tolist() == [zlib.crc32((t + t).encode()) for t in texts]
