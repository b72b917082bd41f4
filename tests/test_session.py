import os
from types import SimpleNamespace

import pyarrow as pa
import pytest

from feedlake.session import BATCH_BYTES, SETTINGS, scratch_path, scratch_root, ship_library


def fake(settings, application="app-1"):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(applicationId=application))


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == shared
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    cluster = fake({"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"})
    assert scratch_path(cluster, "x").startswith("hdfs:///shared/feedlake-x-")


def test_scratch_without_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(fake({"spark.master": "yarn"}))
    local = fake({"spark.master": "local[2]"})
    assert os.path.isdir(scratch_root(local))
    assert scratch_root(local) == scratch_root(local)
    assert scratch_root(local) != scratch_root(fake({"spark.master": "local[2]"}, "app-2"))


def test_session_settings(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value


def test_batches_for_python_are_bounded_by_bytes(spark):
    ship_library(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert int(spark.conf.get(name)) == BATCH_BYTES
    texts = spark.range(200).selectExpr("repeat('x', 1000000) AS t").coalesce(1)

    def sizes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)])], names=["n"])

    sizes = texts.mapInArrow(sizes_of, "n long").collect()
    assert sum(r.n for r in sizes) == 200 and max(r.n for r in sizes) <= 10
    spark.conf.set(name, "5000000")
    ship_library(spark)
    assert spark.conf.get(name) == "5000000"
    spark.conf.unset(name)

