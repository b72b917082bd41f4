import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from feedlake.llm import piece_lattice as lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces.load(MODEL).ready()


@pytest.fixture(scope="module")
def unigram():
    """A small table of log-probabilities, with ties."""
    draw = random.Random(2)
    texts = {"".join(p) for n in (1, 2, 3) for p in itertools.product(" ab", repeat=n) if not (n > 1 and " " in p[1:])}
    scores = {t: (-float(draw.randint(1, 6)), 300 + i) for i, t in enumerate(sorted(texts))}
    table = lattice.Pieces(scores, list(range(256)), [bytes([i]) for i in range(256)] + [b""] * 44 + [t.encode() for t in sorted(texts)])
    return table.ready()


def all_paths(table, word):
    """(score, piece lengths from the end, ids) of every way through a word."""
    if not word:
        yield 0.0, (), []
        return
    for size in range(1, min(len(word), table.longest) + 1):
        part = word[-size:]
        options = []
        if part in table.scores:
            score, i = table.scores[part]
            options.append((score, [i]))
        elif size == 1:
            raw = part.encode()
            options.append((len(raw) * table.byte_score, [table.bytes_of[b] for b in raw]))
        for score, ids in options:
            for before, sizes, path in all_paths(table, word[:-size]):
                yield before + score, (size, *sizes), path + ids


WORDS = [" " + "".join(w) for n in (1, 2, 4, 6) for w in itertools.islice(itertools.product("abé", repeat=n), 0, None, 1 + n)]


def test_viterbi_fold_equals_all_paths(spark, unigram):
    frame = spark.createDataFrame([(w,) for w in WORDS], "word string")
    folded = {r["word"]: r["ids"] for r in lattice.best_paths(lattice.lattice(frame, unigram)).collect()}
    for word in WORDS:
        best = max(all_paths(unigram, word), key=lambda p: (p[0], p[1]))
        assert folded[word] == best[2] == unigram.best_path(word), word


def test_merge_fold_equals_the_library(spark, pieces, library, prose):
    assert pieces.merges
    words = {" " + w for i in range(20) for w in prose(i, 30)} | {" Übergrößen", " 中文", " \U0001F600x", "   spaced", " a\nb\tc", " aaaaaaaa"}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    folded = {r["word"]: r["ids"] for r in lattice.merged_paths(lattice.lattice(frame, pieces)).collect()}
    assert folded.keys() == words
    for word in words:
        assert folded[word] == pieces.merged_path(word) == library.encode(word[1:]), word


def test_documents_equal_the_library_and_come_back(documents, hostile_rows, library):
    rows = hostile_rows + [(50, " leading  and   many    blanks "), (51, "▁▁ marks ▁x")]
    docs = documents(rows).drop("ids", "decoded")
    table = lattice.fit(docs, MODEL, most=30)
    assert 0 < len(table.known) <= 30
    both = lattice.decoded(lattice.encoded(docs, table), table)
    assert both.columns == [*docs.columns, "ids", "decoded"]
    for row in both.collect():
        assert row["decoded"] == row["text"]
        if row["text"] is None:
            assert row["ids"] is None
        elif "▁" not in row["text"]:
            assert row["ids"] == library.encode(row["text"])


def test_empty_table(documents, hostile_rows):
    docs = documents(hostile_rows).drop("ids").limit(0)
    assert lattice.encoded(docs, lattice.fit(docs, MODEL)).count() == 0


def test_long_words_and_full_memory(pieces, library, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_WORDS", 2)
    text = "x" * 5000 + " " + "ab" * 700 + " one two three"
    assert pieces.ids(text).tolist() == library.encode(text)
    assert pieces.text(np.array(library.encode(text))) == text
