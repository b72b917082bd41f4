"""Different words have different hashes, also where a sum of powers has not."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from feedlake.llm import ngram_join, suffix_decontamination, token_archive
from feedlake.llm.words import EXACT, differ, shingles, span_hashes, text_hashes


def twins(bits: int = 10) -> tuple[str, str]:
    """The Thue-Morse word over a and b, and its complement."""
    parity = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join("ab"[p] for p in parity), "".join("ba"[p] for p in parity)


def test_twins_and_lengths():
    words = [word for bits in range(1, 13) for word in twins(bits)] + ["a" * n for n in range(1, 200)]
    words += ["x" * n + "\0" * k for n in range(1, 20) for k in range(1, 4)]
    distinct = sorted(set(words))
    hashes = [int(text_hashes(word)[0]) for word in distinct]
    assert len(set(hashes)) == len(distinct)
    assert text_hashes("AbÉ").tolist() == text_hashes("abÉ").tolist() != text_hashes("abé").tolist()


def test_hash_does_not_depend_on_the_place():
    data = np.frombuffer(b"one two, one two one", np.uint8)
    starts, ends = np.array([0, 4, 9, 13, 17]), np.array([3, 7, 12, 16, 20])
    a, b, c, d, e = span_hashes(data, starts, ends, EXACT)
    assert a == c == e != b == d
    assert differ(data, starts, ends, np.array([0, 0, 0, 1, 1])).tolist() == [False, True, False, False, True]


def test_long_texts_of_twins(documents, spark):
    one, other = twins()
    tail = " ".join(f"w{i}" for i in range(6))
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = token_archive.Encoder.of(open(path, encoding="utf-8").read()).blocks(pa.array([one, other]))
    got = [part.tolist() for _, flat, ends in ids for part in np.split(flat, ends[:-1])]
    plain = Tokenizer.from_file(path)
    assert got == [plain.encode(word, add_special_tokens=False).ids for word in (one, other)]
    docs = documents([(1, f"{one} {one} {one}"), (2, f"{other} {other} {other}")])
    found = ngram_join.similar_documents(docs, shingle_words=3, percent=90).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 2)}
    items = spark.createDataFrame([("i", f"{other} {tail}")], "item_id string, text string")
    judged = suffix_decontamination.scan(documents([(1, f"{one} {tail}")]).select("doc_id", "text"), items)
    assert [len(r.verdict.hits) for r in judged.collect()] == [0]
    assert len(set(shingles(text_hashes(f"{one} {other} {one} {other}"), 2).tolist())) == 2
