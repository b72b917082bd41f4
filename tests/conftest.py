from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from feedlake.session import feed_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = feed_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Make a frame of document strings."""

    def make(*documents: str):
        return spark.createDataFrame([(text,) for text in documents], "value string")

    return make
