import math
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions import (
    epoch_guarded,
    epoch_session,
    ingest_stamp,
    ingest_stamp_text,
    run_date,
    run_tag,
    stamp_text,
)

GOOD = "1729498113226"
GOOD_TEXT = "2024-10-21 08:08:33"

# value, session text, guarded text, whether a good partner field survives
EPOCHS = [
    (GOOD, GOOD_TEXT, GOOD_TEXT, True),
    ("0", "1970-01-01 00:00:00", None, True),
    ("-1500", "1969-12-31 23:59:59", None, True),
    ("1729498113226.5", GOOD_TEXT, GOOD_TEXT, True),
    ("bad", None, None, False),
    (None, None, None, True),
    ("99999999999999999", None, None, False),
    ("253402300799999", "9999-12-31 23:59:59", "9999-12-31 23:59:59", True),
    ("253402300800000", "+10000-01-01 00:00:00", None, False),
    ("nan", None, None, True),
    ("inf", None, None, False),
    ("1e300", None, None, False),
    ("-9223372036854775808000", None, None, True),
    ("-1e300", None, None, True),
    ("1.729498113226e12", GOOD_TEXT, GOOD_TEXT, True),
    ("", None, None, False),
    ("1729498113226d", GOOD_TEXT, None, False),
    ("0x1p40", "2004-11-03 19:53:47", None, False),
    # Divided by 1000 this is the whole second 1729498114 in double precision.
    ("1729498113999.9999", "2024-10-21 08:08:34", "2024-10-21 08:08:34", True),
    ("0.0001", "1970-01-01 00:00:00", "1970-01-01 00:00:00", True),
]


@pytest.mark.parametrize("value, session, guarded, partner_kept", EPOCHS)
def test_epochs(spark, value, session, guarded, partner_kept):
    frame = spark.createDataFrame([(value, GOOD)], "a string, b string")
    first, second = epoch_guarded("a", "b")
    swapped = epoch_guarded("b", "a")
    row = frame.select(epoch_session("a"), first, second, *swapped).first()
    partner = GOOD_TEXT if partner_kept else None
    assert tuple(row) == (session, guarded, partner, partner, guarded)


def test_both_fields_missing(spark):
    frame = spark.createDataFrame([(None, None)], "a string, b string")
    assert tuple(frame.select(*epoch_guarded("a", "b")).first()) == (None, None)


def by_hand(pair):
    """Both fields as text, NULL by the rules of the guard."""
    texts = []
    for value in pair:
        if value is None:
            texts.append(None)
            continue
        try:
            seconds = float(value) / 1000
            if not seconds > 0:
                texts.append(None)
                continue
            moment = datetime.fromtimestamp(seconds, timezone.utc)
        except (ValueError, OverflowError, OSError):
            return (None, None)
        texts.append(moment.strftime("%Y-%m-%d %H:%M:%S"))
    return tuple(texts)


numbers = st.one_of(
    st.integers(-(10**13), 3 * 10**14).map(str),
    st.integers(253402300790000, 253402300810000).map(str),
    st.integers(1000 * 365 * 86400 * 1000 // 20, 10**13).map(lambda n: f"{n / 8}"),
    st.sampled_from(["", "x", "nan", "-5", "0", "0.0", "1e12", "-1e12", "1e17", "12 ms", " 77000 "]),
    st.none(),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(numbers, numbers), min_size=100, max_size=300))
def test_guard_equals_python(spark, pairs):
    frame = spark.createDataFrame(pairs, "a string, b string")
    rows = frame.select("a", "b", *epoch_guarded("a", "b")).collect()
    for a, b, time, updated in rows:
        assert (time, updated) == by_hand((a, b)), (a, b)


def test_guard_is_utc_in_any_session_zone(spark):
    frame = spark.createDataFrame([(GOOD, GOOD)], "a string, b string")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = frame.select(epoch_guarded("a", "b")[0], epoch_session("a")).first()
        text = frame.select(ingest_stamp_text(datetime(2024, 10, 21, 8, 8, 33))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (GOOD_TEXT, "2024-10-21 01:08:33")
    assert text == GOOD_TEXT


def test_session_epoch_truncates_towards_zero(spark):
    values = [str(v) for v in range(-5000, 5000, 250)]
    frame = spark.createDataFrame([(v,) for v in values], "a string")
    for value, text in frame.select("a", epoch_session("a")).collect():
        seconds = math.trunc(int(value) / 1000)
        moment = datetime(1970, 1, 1) + timedelta(seconds=seconds)
        assert text == moment.strftime("%Y-%m-%d %H:%M:%S")


def test_stamps(spark):
    as_of = datetime(2024, 1, 1, 0, 0, 0, 123999)
    row = spark.range(1).select(
        ingest_stamp(as_of).cast("timestamp_ntz"),
        ingest_stamp_text(as_of),
        stamp_text(ingest_stamp(as_of)),
        run_date(as_of),
    ).first()
    assert tuple(row) == (as_of, "2024-01-01 00:00:00", "2024-01-01T00:00:00.123Z", "20240101")
    eastern = datetime(2024, 1, 1, 1, tzinfo=timezone(timedelta(hours=3)))
    assert run_tag(eastern) == "20231231"
    assert spark.range(1).select(run_date(eastern)).first()[0] == "20231231"


def test_clock_is_one_value_per_query(spark):
    frame = spark.range(0, 1000, numPartitions=8).select(ingest_stamp().alias("s"))
    assert frame.distinct().count() == 1


def test_stamp_text_equals_the_json_writer(spark):
    frame = spark.range(1).select(ingest_stamp(datetime(2024, 5, 6, 7, 8, 9, 10)).alias("s"))
    row = frame.select(stamp_text("s"), F.to_json(F.struct("s"))).first()
    assert row[1] == f'{{"s":"{row[0]}"}}'
