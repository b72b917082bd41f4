from __future__ import annotations

import random

import pytest

from feedlake.session import ship_library

# Names that operators use for columns of their own.
CLASHING = "a b n row key digest verdict score statistics similar_key similar_gone ids decoded start training".split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{name}` string" for name in CLASHING
)


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_library(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table of (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, parts: int = 3):
        full = []
        for doc_id, text, *rest in rows:
            lang, source = rest or ("en", "src")
            full.append((doc_id, text, lang, source, len(text or ""), *CLASHING))
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def hostile_rows():
    """Rows that any operator must take: nulls, blanks, repeats, a long text, odd characters."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "no id at all here"),
        (None, None), (5, long_text), (6, "x" * 3_000), (7, "naïve “quotes” 中文 \U0001F600 a b ▁"),
        (8, "Same text for two ids."), (9, "Same text for two ids."), (10, "tab\tand\r\nbreaks\x0b\x0c"),
    ]


@pytest.fixture(scope="session")
def prose():
    """Make repeatable texts of invented words."""

    def make(seed: int, words: int, vocabulary: int = 400) -> list[str]:
        draw = random.Random(seed)
        pool = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l", "ck", "m", "t")]
        return [draw.choice(pool[:vocabulary]) for _ in range(words)]

    return make
