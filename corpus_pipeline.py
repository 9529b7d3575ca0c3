"""The corpus pipeline: five operators one after the other over the table of documents.

Each stage works on all that its predecessor kept, and its result is written before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecat.llm import bpe, decontaminate, language, repeats, simhash
from pagecat.llm.common import fold, fresh, reachable, table, written

# Passages shorter than op2's 400 bytes go too if they have more words than this. Repeated bytes are looked for
# from this length on: the words of such a passage are short ones indeed if it is shorter.
PASSAGE_WORDS = 50
PASSAGE_BYTES = 250


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without a letter, or in none (``und``), go."""
    reachable(spark)
    trained = language.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    column = fresh(docs, "language")[0]
    found = language.annotated(docs, trained, column=column)
    return found.where(F.col(column)["lang_pred"] != language.UNKNOWN).drop(column)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHash of four-word shingles, four differing bits at most."""
    reachable(spark)
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur elsewhere too: those of 400 bytes or more, and those of over
    50 words in documents that keep over 50."""
    reachable(spark)
    return repeats.deduplicated(docs, PASSAGE_BYTES, words=PASSAGE_WORDS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids of every document."""
    reachable(spark)
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

# Language models and repeated passages can't be expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table of documents.

    Null, empty and letterless texts go in the first stage; rows without doc_id and repeated rows are
    documents like any other; very long texts stay whole; an empty table gives an empty one; extra columns
    of any name pass up to the last stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
