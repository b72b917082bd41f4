"""Packing against best fit decreasing, one piece after the other, and the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlake.llm import best_fit_packing as packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """Rooms left by best fit decreasing over single pieces."""
    rooms: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def places(lengths: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(sequence, offset, length) of every piece of a plan."""
    counts = {length: lengths.count(length) for length in set(lengths)}
    runs = packing.plan(counts, capacity)
    out = []
    for place, length in enumerate(sorted(lengths, reverse=True)):
        found = runs[np.searchsorted(runs[:, 0], place, "right") - 1]
        assert found[4] == length
        row, at = divmod(place - found[0], found[2])
        out.append((int(found[1] + row), int(found[3] + at * length), length))
    return out


def rooms_of(placed, capacity: int) -> list[int]:
    rooms = {}
    for sequence, offset, length in sorted(placed):
        assert offset == capacity - rooms.get(sequence, capacity), "gapless"
        rooms[sequence] = capacity - offset - length
        assert rooms[sequence] >= 0
    assert sorted(rooms) == list(range(len(rooms)))
    return sorted(rooms.values())


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_plan_is_best_fit_decreasing(drawn):
    capacity, lengths = drawn
    assert rooms_of(places(lengths, capacity), capacity) == best_fit(lengths, capacity)


def test_plan_is_small_for_any_number_of_pieces():
    draw = random.Random(5)
    counts = {length: draw.randrange(1, 10**12) for length in range(1, 4097)}
    assert len(packing.plan(counts, 4096)) < 60_000
    with pytest.raises(ValueError):
        packing.plan({0: 1}, 8)
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


def test_tightest():
    rooms = packing.OpenSequences(10)
    assert rooms.tightest(1) is None
    for room in (3, 7, 7, 10):
        rooms.put(room, room, 1)
    assert [rooms.tightest(n) for n in (1, 3, 4, 7, 8, 10)] == [3, 3, 7, 7, 10, 10]
    rooms.take(10)
    assert rooms.tightest(8) is None
    rooms.put(0, 1, 1)
    assert rooms.tightest(0) == 3


def expected(rows, capacity):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    out = []
    for doc_id, text, *_ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            raw = np.array(part, "<u4").tobytes()
            out.append((doc_id, piece, start, len(part), zlib.crc32(raw), raw))
    return out


def check(spark, docs, rows, capacity):
    pieces = packing.encoded_pieces(docs, PATH, capacity=capacity)
    packed = packing.placed(pieces, capacity=capacity)
    got = [tuple(r) for r in packed.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset").collect()]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(((*r[:5], bytes(r[5])) for r in got), key=key) == sorted(expected(rows, capacity), key=key)
    rooms = rooms_of([(r[6], r[7], r[3]) for r in got], capacity)
    assert rooms == best_fit([r[3] for r in got], capacity)
    by_place = {(r[6], r[7]): bytes(r[5]) for r in got}
    for row in packing.sequences(packed).collect():
        assert bytes(row.ids) == b"".join(by_place[row.sequence_id, p.offset] for p in row.parts)
        assert len(row.ids) <= 4 * capacity


def test_pieces_and_places(spark, documents, prose):
    rows = [(i, " ".join(prose(i, 1 + (i * 37) % 400))) for i in range(60)]
    rows += [(7, rows[7][1])] * 25 + [(100, "Straße İstanbul été ﬁn <|endoftext|> it's 12 3  x")]
    check(spark, documents(rows, 5), rows, 256)
    check(spark, documents(rows, 1), rows, 4096)


def test_hostile_rows(spark, documents, hostile_rows):
    check(spark, documents(hostile_rows, 4), hostile_rows, 4096)


def test_empty_table(spark, documents):
    packed = packing.placed(packing.encoded_pieces(documents([]), PATH))
    assert packed.count() == 0
    assert packing.sequences(packed).count() == 0


def test_ids_of_odd_words():
    """Capitals, marks that join the letter before, contractions, signs and digits, alone and in texts."""
    words = ["ÉTION", "Étion,", "H\u0331ut", "h\u0331", "A\u030A", "É\u0301x", "İx", "ẞ", "ß", "STRASSE", "×÷", "A×B", "it's", "'S", "x'll!",
             "don't.", "a.b,c", "1.5", "12ab", "é!", "é'd", "¿Qué?", "ﬁ", "Ǆ", "中文。", "<\u0338", "a<\u0338b", "_a_", "#x#", "\x00y", "N°5"]
    draw = random.Random(4)
    texts = ["", *words, *(w.upper() for w in words), *(" ".join(draw.choices(words, k=30)) for _ in range(200))]
    texts += ["".join(draw.choices(words, k=3)) for _ in range(500)]
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    encoder = packing.WordEncoder.of(open(PATH, encoding="utf-8").read())
    for _ in range(2):  # from the tokenizer, then as remembered
        got = [p.tolist() for _, flat, ends in encoder.blocks(pa.array(texts)) for p in np.split(flat, ends[:-1])]
        assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_words_are_encoded_alone():
    assert packing.WordEncoder.of(open(PATH, encoding="utf-8").read()).by_piece
    other = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    assert not packing.WordEncoder.of(other).by_piece
