import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlake.llm import token_archive as archive

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as source:
        return archive.Encoder.of(source.read())


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def pieces_of(encoder, texts):
    out = []
    for _, ids, ends in encoder.blocks(pa.array(texts, pa.string())):
        out += [part.tolist() for part in np.split(ids, ends[:-1])]
    return out


ODD = list("aBz é×÷ü.,'!-_$9\n\t   　中ß٣\r\x1c\x85") + ["'re", " '", "  ", "\n\n", " \n", "<|endoftext|>", "ab c"]


def test_pieces_encode_like_whole_texts(encoder, library):
    draw = random.Random(5)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 25))) for _ in range(5000)]
    assert pieces_of(encoder, texts) == [library(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text(encoder, library, text):
    assert pieces_of(encoder, [text]) == [library(text)]


def test_full_memory_changes_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(encoder, "pieces", {})
    monkeypatch.setattr(encoder, "MOST_PIECES", 3)
    texts = ["one two three four five"] * 3 + ["two six"]
    assert pieces_of(encoder, texts) == [library(t) for t in texts]


def expected(rows, library):
    """doc_id, start and ids in ascending order of ids, nulls first."""
    out, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = (library(text) if text else []) + [archive.END_ID]
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_bytes", [archive.PAYLOAD_BYTES, 64])
def test_round_trip(spark, documents, hostile_rows, prose, library, tmp_path, block_bytes):
    rows = hostile_rows + [(-5 - i, " ".join(prose(i, 30))) for i in range(40)]
    rows = [r for r in rows if r[0] not in (4, None)] + [(4, "one"), (None, "no id")]
    path = archive.write_archive(documents(rows), str(tmp_path / "out"), PATH, block_bytes=block_bytes)
    back = archive.read_archive(spark, path).collect()
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in sorted(back, key=lambda r: r["start"])]
    assert got == expected(rows, library)
    some = archive.read_archive(spark, path, doc_ids=[4, -7, 999]).collect()
    assert {r["doc_id"]: r["start"] for r in some} == {d: s for d, s, _ in got if d in (4, -7)}


def test_repeated_rows_are_all_there(spark, documents, library, tmp_path):
    rows = [(3, "b"), (3, "a a"), (3, "b"), (1, None)]
    path = archive.write_archive(documents(rows), str(tmp_path / "out"), PATH)
    back = sorted(archive.read_archive(spark, path).collect(), key=lambda r: r["start"])
    ids = [np.frombuffer(r["ids"], "<u4").tolist() for r in back]
    assert [r["doc_id"] for r in back] == [1, 3, 3, 3]
    assert sorted(ids[1:]) == sorted(library(t) + [0] for t in ("b", "a a", "b"))
    assert [r["start"] for r in back] == np.cumsum([0] + [len(i) for i in ids[:-1]]).tolist()


def test_empty_table_and_wrong_dictionary(spark, documents, tmp_path):
    path = archive.write_archive(documents([(1, "x")]).limit(0), str(tmp_path / "none"), PATH)
    assert archive.read_archive(spark, path).count() == 0
    path = archive.write_archive(documents([(1, "x")]), str(tmp_path / "one"), PATH)
    wrong = spark.createDataFrame([("0" * 64, bytearray(b"other"))], "sha256 string, bytes binary")
    wrong.write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError, match="hash"):
        archive.read_archive(spark, path)
