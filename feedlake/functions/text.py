"""Place text: where the area name starts and what it is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions._columns import as_column

# The characters that count as white space, Unicode included.
# Java's own \s leaves out U+001C-U+001F, so the set is spelled out.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# "of", white space, then the rest of the line up to the end of the text.
# (?d): only \n ends a line, for the dot as well as for the dollar sign.
AREA_PATTERN = f"(?d)of[{WHITESPACE}]+(.+)$"

_TO_THE_END = 2**31 - 1


def of_position(place: Column | str) -> Column:
    """1-based position of the first ``of``; 0 without one, NULL for NULL."""
    return F.instr(as_column(place), "of")


def text_length(text: Column | str) -> Column:
    """Length in characters."""
    return F.length(as_column(text))


def strip(text: Column | str) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def area_positional(place: Column | str) -> Column:
    """Text after the first ``of`` and one separator character.

    A text without ``of`` loses its first two characters, because the position
    is 0 then: ``Nevada`` gives ``vada``.
    """
    place = as_column(place)
    position = of_position(place)
    return F.substring(place, position + 3, text_length(place) - position - 2)


def area_regex(place: Column | str) -> Column:
    """Stripped text after the first ``of`` plus white space; NULL without one.

    The match is taken whole and the two letters are cut off: the white space
    behind them goes with the strip, so one regex pass is enough.
    """
    match = F.regexp_substr(as_column(place), F.lit(AREA_PATTERN))
    return strip(F.substring(match, 3, _TO_THE_END))
