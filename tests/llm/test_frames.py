"""Samples and frequent rows, found without sorting."""

import pytest
from pyspark.sql import functions as F

from feedlake.llm.frames import most_frequent, share_of


@pytest.mark.parametrize("rows", [1, 50, 2_000, 20_000, 50_000])
def test_share_of(spark, rows):
    frame = spark.range(20_000)
    got = frame.filter(share_of(F.xxhash64("id"), rows, 20_000)).count()
    assert got == 20_000 if rows >= 20_000 else abs(got - rows) <= 6 * rows**0.5 + 1


@pytest.mark.parametrize("most", [0, 1, 3, 10, 100, 499, 5_000])
def test_most_frequent(spark, most):
    counts = [max(1, 100_000 // (i + 1)) for i in range(500)]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "key int, n long").repartition(3)
    got = sorted((r.n for r in most_frequent(frame, most, "key").collect()), reverse=True)
    assert most - 6 * most**0.5 - 40 <= len(got) <= most or len(got) == 500
    # All of the largest counts, and some of the next.
    missed = sorted(counts, reverse=True)
    for n in got:
        missed.remove(n)
    assert not missed or not got or missed[0] <= 1.1 * got[-1]


def test_ties_are_taken_in_part(spark):
    frame = spark.range(5_000).withColumn("n", F.lit(7))
    assert abs(most_frequent(frame, 400, "id").count() - 320) < 70


def test_nothing_to_choose_from(spark):
    assert most_frequent(spark.createDataFrame([], "key int, n long"), 5, "key").count() == 0
