"""Session settings the feed relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Mapping

from pyspark.sql import SparkSession

# ANSI mode stays on: a wrong cast is an error unless the code says try_cast.  Scan
# tasks take more text than by default, as 512 MB of JSON make some 50 MB of Parquet;
# small inputs are shared by all cores all the same.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def feed_session(
    app_name: str = "feedlake", settings: Mapping[str, str] | None = None
) -> SparkSession:
    """Get or create a session with :data:`SETTINGS`, overridden by ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def _temporary_folder() -> str:
    """A new folder on this machine that goes when Python ends."""
    folder = tempfile.mkdtemp(prefix="feedlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder



def scratch_root(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is made, one per application, but
    only when the whole of Spark runs on this machine; it goes when Python ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_scratch:
        _local_scratch[application] = _temporary_folder()
    return _local_scratch[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below :func:`scratch_root` that no other call returns."""
    return f"{scratch_root(spark)}/feedlake-{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()

# Rows go to Python in batches of ten thousand by default, which is a matter of their size
# in memory outside of the heap, on both sides.  Bounded by bytes, long texts cost no more.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_NO_BOUND = str(2**31 - 1)
BATCH_BYTES = 8 << 20


def ship_library(spark: SparkSession) -> None:
    """Make a session ready for this library's user functions.

    They are pickled by reference to its modules, so a cluster on whose machines the
    package is not installed needs a copy, once per application.  Arrow batches are bounded
    by bytes, unless the session has a bound of its own.
    """
    if spark.conf.get(_BATCH_BYTES, _NO_BOUND) == _NO_BOUND:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(_temporary_folder(), "feedlake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
