"""One query per operator, over whole tables; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecat.llm import (
    bpe,
    counts,
    decontaminate,
    html,
    language,
    neighbours,
    order,
    quality,
    repeats,
    simhash,
    toxicity,
    vafile,
    whitening,
)
from pagecat.llm.common import fold, table


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.materialised(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = toxicity.labelled(docs.where(fold(F.col("doc_id"), 5) != 0), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, toxicity.fit(learned))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "evidence", "spans")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.detect(docs, fold(F.col("doc_id"), 4) != 2)
    return found.select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "languages", "proportions"
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *quality.COUNTS[:5], "base_failed", "kept", "reasons")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.clustered(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_training_order": op1_training_order,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_html": op4_html,
        "op5_language": op5_language,
        "op6_simhash": op6_simhash,
        "op7_quality": op7_quality,
        "op8_token_counts": op8_token_counts,
        "op9_bpe": op9_bpe,
        "op10_decontaminate": op10_decontaminate,
        "op11_clustering": op11_clustering,
        "op12_whitening": op12_whitening,
        "op13_near_vectors": op13_near_vectors,
    }
