"""Documents to training data: five stages, each over all that the one before it kept.

Stages filter the ``documents`` table and keep its columns; the last one encodes what is
left.  Between stages the rows are written and read again, so no stage repeats the work of
another and a lost executor costs no more than its tasks.

Defined results: a null or empty text fails the quality rules, as does one of fewer than 50
words; where a stage meets one all the same, it is not toxic, has no near copy, holds no
benchmark passage, and is encoded as null or as no ids.  Repeated rows are judged one by
one, and the n-gram join keeps one of them; of rows that share an id it keeps one, too.
Rows without an id are kept by every stage that keeps their text.  Columns besides those
of ``documents``, whatever their names, pass the first four stages.  An empty table gives an
empty one with the same columns, and without labels nothing is toxic.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import ngram_join, piece_lattice, robust_outliers, suffix_decontamination, toxicity_grammar
from feedlake.llm.frames import remainder, table, written
from feedlake.session import ship_library

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near duplicates: runs of five words, a similarity of 0.8 or more.
SHINGLE_WORDS = 5
PERCENT = 80


def _stage(function: Stage) -> Stage:
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_library(spark)
        return function(spark, docs, sf_dir)

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the outlier distance reject."""
    return robust_outliers.keep_good(docs)


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop toxic documents; the grammar learns from the labels of four fifths."""
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    return toxicity_grammar.keep_civil(docs, toxicity_grammar.fit(docs, labels))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that similarity links, the one of the smallest id."""
    return ngram_join.one_of_each(docs, shingle_words=SHINGLE_WORDS, percent=PERCENT)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with ten words in a row of a benchmark item."""
    return suffix_decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, checked by decoding them."""
    docs = docs.select("doc_id", "lang", "source", "text")
    pieces = piece_lattice.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    both = piece_lattice.encoded_and_checked(docs, pieces)
    wrong = F.raise_error(F.lit("decoding did not give a text back")).cast("array<int>")
    ids = F.when(F.col("round_trip"), F.col("ids")).otherwise(wrong)
    return both.select("doc_id", "lang", "source", ids.alias("ids"), F.size("ids").cast("long").alias("n_ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", encoding),
]

# Components, a learned grammar and piece merges are beyond SQL; tests hold the stages
# against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
