"""Loads of the connector are there as a whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from feedlake.sinks import load_direct, read_warehouse, register_warehouse


@pytest.fixture
def place(spark, tmp_path):
    register_warehouse(spark)
    return str(tmp_path / "warehouse")


def ids(spark, place):
    return sorted(r.id for r in read_warehouse(spark, place, "id long, v string").collect())


def load(rows, place, mode="append", **options):
    load_direct(rows, fmt="feed_warehouse", mode=mode, options={"path": place, **options})


def numbers(spark, n, parts=4):
    return spark.range(0, n, 1, parts).withColumn("v", F.lit("x"))


def test_append_and_overwrite(spark, place):
    load(numbers(spark, 5), place)
    load(numbers(spark, 3), place)
    assert ids(spark, place) == [0, 0, 1, 1, 2, 2, 3, 4]
    load(numbers(spark, 2), place, mode="overwrite")
    assert ids(spark, place) == [0, 1]
    assert len(os.listdir(place)) == 1


def test_a_failing_task_leaves_no_row(spark, place):
    load(numbers(spark, 4), place)
    broken = numbers(spark, 1_000, 8).withColumn("v", F.expr("if(id = 900, raise_error('no'), v)"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="no"):
            load(broken, place, mode=mode)
        assert ids(spark, place) == [0, 1, 2, 3]
        # Tasks that were killed may still write a file where readers do not look.
        assert all(name.startswith(("load=", "_staging-")) for name in os.listdir(place))


def test_a_load_that_is_repeated_replaces_itself(spark, place):
    load(numbers(spark, 2), place, load_id="base")
    for n in (5, 3):
        load(numbers(spark, n), place, load_id="day-1")
    rows = read_warehouse(spark, place, "id long, v string")
    counts = {r.load: r["count"] for r in rows.groupBy("load").count().collect()}
    assert counts == {"base": 2, "day-1": 3}


def test_empty_loads_and_bad_options(spark, place):
    load(numbers(spark, 0), place)
    assert ids(spark, place) == []
    with pytest.raises(Exception, match="load_id"):
        load(numbers(spark, 1), place, load_id="../x")
    with pytest.raises(Exception, match="path"):
        numbers(spark, 1).write.format("feed_warehouse").mode("append").save()
