"""How many files a write makes, and how many rows went by."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedlake.schemas import ACCEPTED, DISPOSITION


def laid_out(frame: DataFrame, files: int) -> DataFrame:
    """``frame`` for a write of at most ``files`` files, without a shuffle.

    For results that are known to be small.  Otherwise leave the number of files to the
    scan tasks, and bound their size by the ``maxRecordsPerFile`` option of the writer.
    """
    return frame.coalesce(files)


def record_count(frame: DataFrame) -> DataFrame:
    """The number of rows as a one-row frame ``n_records``."""
    return frame.agg(F.count(F.lit(1)).alias("n_records"))


def counted(frame: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``frame`` with a row count taken along the way, by the action that runs it.

    After the action ``observation.get["records"]`` holds the count; no extra job.  Where
    rows have a ``disposition``, the accepted ones are ``records`` and the others ``rejected``.
    """
    observation = Observation(name)
    if DISPOSITION not in frame.columns:
        return frame.observe(observation, F.count(F.lit(1)).alias("records")), observation
    taken = F.col(DISPOSITION) == ACCEPTED
    counts = F.count_if(taken).alias("records"), F.count_if(~taken).alias("rejected")
    return frame.observe(observation, *counts), observation
