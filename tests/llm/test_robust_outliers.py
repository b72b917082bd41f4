import re
from collections import Counter

import numpy as np
import pytest

from feedlake.llm import robust_outliers as quality

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    own = SPACED.findall(text)
    grams = Counter(zip(own, own[1:], own[2:]))
    covered = {p for i in range(len(own) - 2) if grams[tuple(own[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    return (
        len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts(documents, hostile_rows, prose):
    odd = [
        "a b c a b c a b c", "x x x x", "one two\none two\n\n  \none two ", "# * $ % & | < >", "a b a b a", "\n\n\n",
        " ".join(prose(1, 80) * 3), "  nbsp   em \x85 nel \x1c fs",
    ]
    rows = hostile_rows + [(100 + i, t) for i, t in enumerate(odd)]
    judged = quality.judged(documents(rows), verdict="found", keep=["doc_id", "text"], reuse=True)
    for row in judged.select("text", "found.*").collect():
        n = counts(row["text"])
        assert tuple(row[1:6]) == n, row["text"]
        assert row["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (row["base_failed"] and row["kept"])


@pytest.fixture(scope="module")
def mixed(documents, prose):
    """Clean texts of two languages, one source of few rows, and texts full of symbols."""
    rows = []
    for i in range(420):
        lang = "de" if i % 3 == 0 else "en"
        source = "rare" if i % 60 == 0 else "src0"
        rows.append((i, " ".join(prose(i, 60 + i % 200, 100 if lang == "de" else 400)), lang, source))
    for i in range(40):
        rows.append((1000 + i, " ".join(f"{w}###" for w in prose(i, 80)), "en", "src0"))
    rows.append((2000, " ".join(prose(9, 70)), None, None))
    return documents(rows)


@pytest.mark.parametrize("reuse", [True, False])
def test_outliers_go_and_clean_texts_stay(mixed, reuse):
    found = quality.judged(mixed, verdict="found", reuse=reuse).select("doc_id", "found.*").collect()
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert len(found) == 461
    assert not any(kept[i] for i in range(1000, 1040))
    assert all(kept[i] for i in range(420))
    assert kept[2000]


def test_distances_equal_numpy(mixed):
    """The estimate is a fixed point: half of the rows by its own distance give it again."""
    rows = quality.judged(mixed, verdict="found", reuse=True, least_rows=100)
    pooled = [r for r in rows.select("lang", "source", "found.*").collect() if (r["lang"], r["source"]) == ("en", "src0")]
    x = np.array(
        [
            [np.log(r["n_words"]), np.log(r["word_chars"] / r["n_words"]),
             np.arcsinh(100 * r["n_symbols"] / r["word_chars"]), r["n_repeat_words"] / r["n_words"],
             np.log(1 + r["n_dup_lines"])]
            for r in pooled
        ]
    )
    d = np.array([r["distance"] for r in pooled])
    floors = np.diag(np.array(list(quality.VECTOR.values())) ** 2)

    def distances(inside):
        m = x[inside].mean(0)
        scatter = np.cov(x[inside].T, bias=True) + floors
        raw = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(scatter), x - m)
        return raw / max(np.sort(raw)[(len(raw) - 1) // 2] / quality.chi_square_point(0.5, 5), 1e-3)

    clean = distances(np.array([r["n_symbols"] == 0 for r in pooled]))
    assert np.corrcoef(clean, d)[0, 1] > 0.99


def test_chi_square_points():
    for tail, freedom, value in [(0.05, 1, 3.8415), (0.5, 5, 4.3515), (0.025, 5, 12.8325), (1e-9, 2, 41.4465)]:
        assert quality.chi_square_point(tail, freedom) == pytest.approx(value, rel=1e-4)


def test_few_rows_and_none(documents, prose):
    few = documents([(i, " ".join(prose(i, 60))) for i in range(5)] + [(9, "short")])
    kept = quality.keep_good(few)
    assert kept.columns == few.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 4]
    assert quality.keep_good(few.limit(0)).count() == 0


def test_main_path_is_native(mixed):
    plan = quality.judged(mixed, verdict="found")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_many_pools_are_joined_instead(mixed, monkeypatch):
    """Without the estimates sent to the vectors the distances are the same."""
    key = lambda r: r["doc_id"]
    sent = sorted(quality.judged(mixed, keep=["doc_id"]).select("doc_id", "verdict.distance").collect(), key=key)
    monkeypatch.setattr(quality, "SENT_POOLS", 0)
    joined = sorted(quality.judged(mixed, keep=["doc_id"]).select("doc_id", "verdict.distance").collect(), key=key)
    assert [(r[0], r[1] and round(r[1], 6)) for r in sent] == [(r[0], r[1] and round(r[1], 6)) for r in joined]
