"""The registered operator queries and the pipeline on the small given tables."""

import check
import pytest
from test_ngram_join import brute as components
from test_robust_outliers import counts
from test_suffix_decontamination import brute as leaks

import __spark_entry__ as registry
import corpus_pipeline
from feedlake.llm.frames import table, written
from feedlake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_each_operator_and_the_pipeline_are_registered():
    names = list(registry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "n-gram Jaccard join"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(spark, name):
    good, note = check.compare(spark, check.connect(SMALL), SMALL, name)
    assert good, note


def test_stages_against_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    benchmark = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    for (name, stage), columns in zip(corpus_pipeline.STAGES, [docs.columns] * 4 + [["doc_id", "lang", "source", "ids", "n_ids"]]):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = written(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == columns
        after = {r["doc_id"] for r in docs.collect()}
        if name == "quality rules":
            failed = {d for d, t in before if (n := counts(t))[0] < 50 or 100 * n[4] > 50 * n[0]}
            assert not after & failed
        elif name == "n-gram Jaccard join":
            assert after == {c for _, _, c in components(before, 5, 80)}
        elif name == "benchmark decontamination":
            assert after == {r[0] for r in leaks(before, benchmark) if not r[2]}
        elif name != "toxicity":
            assert after == {d for d, _ in before}


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_ids"]
    assert 0 < out.count() < table(spark, SMALL, "documents").count()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels and a benchmark that have nothing to do with the documents."""
    root = str(tmp_path_factory.mktemp("stages"))
    labels = [(i, 1, int(i % 3 == 0)) for i in range(30)] + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    items = [("i", "ten words in a row that no document here has"), ("none", None), ("blank", "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_take_odd_rows(spark, documents, hostile_rows, prose, folder):
    whole = [(100 + i, " ".join(prose(i, 90))) for i in range(8)]
    docs = documents([*hostile_rows, *whole, whole[0], (None, whole[1][1])])
    good = {text for _, text in whole}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, folder), "odd")
        rows = out.collect()
        ids = sorted(str(r["doc_id"]) for r in rows)
        if name == "SentencePiece encoding and decoding":
            assert len(rows) == docs.count() and {r["doc_id"] for r in rows if r["ids"] is None} == {1, None}
            continue
        assert out.columns == docs.columns
        texts = [r["text"] for r in rows]
        if name == "quality rules":
            assert good <= set(texts) and None not in texts and "" not in texts and ids.count("100") == 2
        elif name == "n-gram Jaccard join":
            named = [r["text"] for r in rows if r["doc_id"] is not None and (r["text"] or "").strip()]
            assert len(named) == len(set(named)) and good <= set(named)
            assert ids.count("None") == 3 and len(set(ids) - {"None"}) == len(ids) - 3
        else:
            assert sorted(map(str, texts)) == sorted(str(r["text"]) for r in docs.collect())


def test_stages_take_an_empty_table(spark, documents, folder):
    docs = documents([]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name
