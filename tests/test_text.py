import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedlake.functions import area_positional, area_regex, of_position, strip, text_length

PLACES = [
    ("12 km N of Testville, Utopia", "Testville, Utopia", "Testville, Utopia"),
    ("Nevada", "vada", None),
    ("off the coast of Oregon", " the coast of Oregon", "Oregon"),
    ("xx of", "", None),
    ("", "", None),
    (None, None, None),
    ("5 km of  X  ", " X  ", "X"),
    ("Hof of A of B", "of A of B", "of A of B"),
    ("Of Mice", " Mice", None),
    ("a of b\n", "b\n", "b"),
    ("a of b\nc", "b\nc", None),
    ("a of b\r c", "b\r c", "b\r c"),
    ("a of nb", "nb", "nb"),
    ("a of   ", "  ", ""),
    ("a of\x1cfs", "fs", "fs"),
    ("a of\n\nb", "\nb", "b"),
]


@pytest.mark.parametrize("place, positional, regex", PLACES)
def test_area(spark, place, positional, regex):
    row = spark.createDataFrame([(place,)], "place string").select(
        area_positional("place").alias("p"), area_regex("place").alias("r")
    )
    assert tuple(row.first()) == (positional, regex)


def by_hand(text):
    found = re.search(r"of\s+(.+)$", text)
    start = text.find("of") + 1
    after = text[start + 2 :] if len(text) > start + 2 else ""
    return (
        start,
        len(text),
        after,
        found.group(1).strip() if found else None,
        text.strip(),
    )


pieces = st.lists(
    st.sampled_from(["of", "o", "f", " ", "\n", "\r", "\t", "\x0b", "\x1c", "\u0085", " ",
                     " ", " ", "　", "᠎", "﻿", "é", "北", "x", "-"]),
    max_size=12,
).map("".join)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(pieces, min_size=150, max_size=300))
def test_text_functions_equal_python(spark, values):
    frame = spark.createDataFrame([(value,) for value in values], "t string")
    rows = frame.select(
        "t", of_position("t"), text_length("t"), area_positional("t"), area_regex("t"), strip("t")
    ).collect()
    for row in rows:
        assert tuple(row[1:]) == by_hand(row[0]), repr(row[0])


def test_whole_long_text_is_searched(spark):
    text = "x " * 60000 + "south of  The End "
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(area_regex("t")).first()[0] == "The End"
