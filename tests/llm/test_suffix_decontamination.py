import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import suffix_decontamination as decon

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window=10):
    """Words hit and items found per document, by plain search."""
    windows = {}
    for item_id, text in items:
        found = words(text)
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            windows.setdefault(tuple(found[i : i + size]), []).append((item_id,))
    out = []
    for doc_id, text, *_ in docs:
        own, hit, names = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    names |= {str(n[0]) for n in windows[tuple(own[i : i + size])]}
        out.append((doc_id, len(own), len(hit), sorted(names)))
    return sorted(out, key=str)


def scanned(docs, items, **options):
    rows = decon.scan(docs, items, verdict="found", **options).select(
        "doc_id", "found.n_words", decon.n_hit_words("found.hits").alias("hit"), "found.items"
    )
    return sorted([(r[0], r[1], r[2], r[3]) for r in rows.collect()], key=str)


@pytest.mark.parametrize("depth", [1, 2, 5, 40])
def test_suffix_array_sorts_by_the_first_values(depth):
    draw = random.Random(depth)
    ranks = np.array([draw.randint(0, 3) for _ in range(300)] + [1] * 50)
    array = decon.suffix_array(ranks, depth).tolist()
    keys = [ranks[i : i + depth].tolist() for i in array]
    assert sorted(array) == list(range(350))
    assert keys == sorted(keys)


def test_suffix_array_of_nothing():
    assert len(decon.suffix_array(np.empty(0, int), 5)) == 0


@pytest.fixture
def case(spark, documents, hostile_rows, prose):
    item = prose(1, 30)
    short = ["Only", "four", "words", "here"]
    items = [(1, " ".join(item)), (2, " ".join(short)), (3, None), (4, ""), (5, "..."), (1, " ".join(item[5:25])), (6, " ".join(item))]
    texts = [
        " ".join(prose(2, 20) + item[3:15] + prose(3, 20)),
        "-".join(w.upper() for w in item),
        " ".join(item[:9]),
        " ".join(item[:12] + item[8:20]),
        "x only FOUR, words here y only four words",
    ]
    rows = hostile_rows + [(100 + i, t) for i, t in enumerate(texts)] + [(100, texts[0])]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("verdict", F.lit(1))
    return rows, documents(rows), items, benchmark


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 200}, {"block_words": 20}, {"shard_bytes": 50, "block_words": 1}])
def test_scan_equals_plain_search(case, options):
    rows, docs, items, benchmark = case
    got = [(d, w, h, sorted(set(i))) for d, w, h, i in scanned(docs, benchmark, **options)]
    assert got == brute(rows, items)


def test_clashing_column_is_an_error_and_removal_keeps_columns(case):
    rows, docs, items, benchmark = case
    with pytest.raises(ValueError, match="verdict"):
        decon.scan(docs, benchmark)
    kept = decon.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    clean = [r for r in brute(rows, items) if not r[2]]
    assert sorted(str(r[0]) for r in kept.select("doc_id").collect()) == sorted(str(r[0]) for r in clean)


def test_empty_tables(case, documents):
    _, docs, _, benchmark = case
    assert decon.remove_contaminated(docs, benchmark.limit(0)).count() == docs.count()
    assert scanned(docs.limit(0), benchmark) == []


def test_longest_matches_tell_where(spark, documents, prose):
    item = prose(4, 40)
    text = prose(5, 7) + item[10:35] + prose(6, 5)
    docs = documents([(1, " ".join(text)), (2, " ".join(item)), (3, " ".join(item[:9]))])
    benchmark = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    found = decon.longest_matches(docs, benchmark).collect()
    assert {tuple(r) for r in found} == {(1, "9", 10, 7, 25), (2, "9", 0, 0, 40)}
