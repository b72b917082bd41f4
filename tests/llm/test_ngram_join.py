import random

import numpy as np
import pytest

from feedlake.llm import ngram_join
from feedlake.llm.components import connected


def shingles(text, size):
    own = (text or "").encode().lower().split()
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def brute(rows, size, percent):
    """Component of each doc_id by comparing all pairs."""
    sets = [(d, shingles(t, size)) for d, t, *_ in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, p) in enumerate(sets):
        for e, q in sets[:i]:
            if p and q and 100 * len(p & q) >= percent * len(p | q):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {(d, len(s), root(d)) for d, s in sets}


def found(docs, **options):
    rows = ngram_join.similar_documents(docs, **options).collect()
    return {tuple(r) for r in rows if r["doc_id"] is not None}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_components_equal_all_pairs(documents, hostile_rows, prose, size, percent):
    draw = random.Random(size)
    rows = list(hostile_rows)
    for group in range(6):
        base = prose(group, draw.choice([4, 30, 120, 300]))
        for copy in range(12):
            text = list(base)
            for _ in range(draw.randint(0, 6)):
                text[draw.randrange(len(text))] = f"edit{draw.randint(0, 99)}"
            rows.append((100 + 20 * group + copy, " ".join(text)))
    shared = prose(50, 60)
    rows += [(500 + i, " ".join(prose(60 + i, 30) + shared)) for i in range(10)]
    assert found(documents(rows), shingle_words=size, percent=percent) == brute(rows, size, percent)


def test_a_long_chain_is_one_component(documents, prose):
    base = prose(1, 100)
    rows = []
    for i in range(30):
        base = base[:]
        base[3 * i % 100] = f"new{i}"
        rows.append((i, " ".join(base)))
    assert {r[2] for r in found(documents(rows))} == {r[2] for r in brute(rows, 3, 90)} == {0}


def test_rows_without_id_take_the_component_of_their_copies(documents):
    rows = ngram_join.similar_documents(documents([(3, "a b c d"), (None, "A b c d"), (None, "else where gone")])).collect()
    assert sorted(map(str, rows)) == sorted(
        ["Row(doc_id=3, n_shingles=2, component_id=3)", "Row(doc_id=None, n_shingles=2, component_id=3)",
         "Row(doc_id=None, n_shingles=1, component_id=None)"]
    )


def test_one_of_each(documents, hostile_rows):
    docs = documents(hostile_rows)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r[0]) for r in kept.select("doc_id").collect())
    assert ids == sorted(["1", "2", "3", "4", "None", "None", "5", "6", "7", "8", "10"])
    assert ngram_join.one_of_each(docs.limit(0)).count() == 0


def test_outlines_never_rule_out_a_real_overlap():
    draw = np.random.default_rng(1)
    for n, m, both in [(1, 1, 1), (10, 9, 8), (700, 640, 600), (5000, 5000, 4500)]:
        pool = np.unique(draw.integers(0, 1 << 63, size=n + m, dtype=np.uint64) * np.uint64(2))
        p, q = np.sort(pool[:n]), np.sort(pool[n - both : n - both + m])
        common = len(np.intersect1d(p, q))
        assert common <= ngram_join.most_common(ngram_join.outline(p), ngram_join.outline(q)) <= min(len(p), len(q))


def test_connected_ignores_nulls_and_loops(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (5, 5), (None, 7), (8, 9), (9, 8)], "x int, y int")
    assert {tuple(r) for r in connected(pairs).collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}
    assert connected(pairs.limit(0)).count() == 0
