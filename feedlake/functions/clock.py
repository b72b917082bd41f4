"""Epoch milliseconds to text, and the time stamps of a run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions._columns import as_column

# Fixed value: 10000-01-01 00:00:00 UTC; times from here on have no four-digit year.
_END_MILLIS = 253402300800000.0

# Seconds beyond this do not fit a timestamp in microseconds.
_LAST_TIMESTAMP_SECOND = 9223372036854

# ISO-8601 as the JSON writer renders it, and the run date.
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
_RUN_DATE = "%Y%m%d"


def _utc_text(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, epoch).cast("string")


def epoch_session(millis: Column | str) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss`` in the session zone.

    Seconds are truncated towards zero.  Text that is no number, and numbers no
    timestamp can hold, give NULL.
    """
    seconds = (as_column(millis).try_cast("double") / 1000).try_cast("bigint")
    bounded = seconds.between(-_LAST_TIMESTAMP_SECOND, _LAST_TIMESTAMP_SECOND)
    return F.from_unixtime(F.when(bounded, seconds))


def _guarded_millis(millis: Column) -> Column:
    """Milliseconds as DOUBLE: NULL for NULL, 0 for NaN, too large for broken text.

    The cast also takes ``1d``, ``1f`` and ``0x1p3``; these are no numbers here.
    """
    text = millis.cast("string")
    number = F.when(~text.rlike("[dDfFxX]"), text.try_cast("double"))
    broken = F.when(text.isNotNull(), F.lit(_END_MILLIS))
    return F.nanvl(F.coalesce(number, broken), F.lit(0.0))


def epoch_guarded(time: Column | str, updated: Column | str) -> tuple[Column, Column]:
    """A pair of epoch-millisecond fields as UTC ``yyyy-MM-dd HH:mm:ss`` texts.

    * zero, a negative value or NaN gives NULL for that field alone;
    * text that is no number, or a time beyond the year 9999, in either field
      gives NULL for both;
    * NULL stays NULL and leaves its partner alone.

    Times are rounded to the microsecond before the seconds are cut off.
    """
    fields = [_guarded_millis(as_column(field)) for field in (time, updated)]
    usable = F.greatest(*fields) < _END_MILLIS
    return tuple(
        F.when(usable & (field > 0), _utc_text(F.floor(F.rint(field * 1000) / 1000000)))
        for field in fields
    )


def ingest_stamp(as_of: datetime | None = None) -> Column:
    """The ingestion timestamp: one value per query, or the fixed ``as_of``.

    An ``as_of`` without a zone is taken as UTC.
    """
    if as_of is None:
        return F.current_timestamp()
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    since = as_of - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (since.days * 86400 + since.seconds) * 1000000 + since.microseconds
    return F.timestamp_micros(F.lit(micros))


def ingest_stamp_text(as_of: datetime | None = None) -> Column:
    """The ingestion time as UTC ``yyyy-MM-dd HH:mm:ss``."""
    return _utc_text(F.unix_seconds(ingest_stamp(as_of)))


def stamp_text(stamp: Column | str) -> Column:
    """A timestamp the way the JSON writer renders it: ISO-8601 with milliseconds."""
    return F.date_format(as_column(stamp), STAMP_FORMAT)


def run_date(as_of: datetime | None = None) -> Column:
    """The run date ``yyyyMMdd`` as a column, in the session zone."""
    return F.date_format(ingest_stamp(as_of), "yyyyMMdd")


def run_tag(as_of: datetime | None = None) -> str:
    """The run date ``yyyyMMdd`` in UTC as a string, for paths."""
    if as_of is None:
        as_of = datetime.now(timezone.utc)
    elif as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc)
    return as_of.strftime(_RUN_DATE)
