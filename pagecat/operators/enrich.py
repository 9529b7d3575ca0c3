"""Fifteen more fields for every record, from the document of its page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat.functions.values import date_published_expr, donor_count_expr
from pagecat.operators.embedded import embedded_json
from pagecat.operators.joins import best_lookup, rank_expr
from pagecat.operators.sections import body_fields_expr, first_value_expr
from pagecat.schemas import IMAGING_FIELDS, NEW_FIELDS, embedded_doc

SAMPLE_LISTS = {
    "anatomical_entity": "anatomicalEntities",
    "preservation_method": "preservationMethods",
    "disease_state": "diseaseStates",
    "biomaterial_type": "biomaterialTypes",
}


def sample_lists(nodes: DataFrame) -> DataFrame:
    """The four list fields of the dataset node as text."""
    kept = [c for c in nodes.columns if c not in ("dataset", "filesets", "has_doc")]
    return nodes.select(
        *kept,
        *(
            F.coalesce(F.array_join(F.col("dataset")[source], ", "), F.lit("")).alias(field)
            for field, source in SAMPLE_LISTS.items()
        ),
    )


def donor_count(nodes: DataFrame) -> DataFrame:
    kept = [c for c in nodes.columns if c not in ("dataset", "filesets", "has_doc")]
    return nodes.select(*kept, donor_count_expr(F.col("dataset.donorCount")).alias("donor_count"))


def date_published(nodes: DataFrame) -> DataFrame:
    kept = [c for c in nodes.columns if c not in ("dataset", "filesets", "has_doc")]
    return nodes.select(
        *kept, date_published_expr(F.col("dataset.publishedAt")).alias("date_published")
    )


def document_fields(docs: DataFrame) -> DataFrame:
    """Documents with ``has_doc`` and the fifteen fields beside ``doc``, inside the page's row."""
    node = F.col("doc.props.pageProps.dataset")
    kept = docs.columns
    # A step of its own: nine fields read the candidates, which are worked out once.
    with_candidates = docs.withColumn("candidates", body_fields_expr(node["body"]))
    return with_candidates.select(
        *kept,
        F.col("doc.props").isNotNull().alias("has_doc"),
        *(first_value_expr(F.col("candidates"), field).alias(field) for field in IMAGING_FIELDS),
        *(
            F.coalesce(F.array_join(node[source], ", "), F.lit("")).alias(field)
            for field, source in SAMPLE_LISTS.items()
        ),
        donor_count_expr(node["donorCount"]).alias("donor_count"),
        date_published_expr(node["publishedAt"]).alias("date_published"),
    )


def page_fields(pages: DataFrame) -> DataFrame:
    """(dataset_url, has_doc, fifteen fields) of every page."""
    read = pages.select(F.col("url").alias("dataset_url"), "html")
    return document_fields(embedded_json(read, embedded_doc(filesets=False))).drop("doc")


def filled_fields() -> list[Column]:
    """The fifteen fields after a left join: '' where there was no page."""
    return [F.coalesce(field, F.lit("")).alias(field) for field in NEW_FIELDS]


def outcome_expr() -> Column:
    return F.when(F.col("has_doc").isNull(), "failed").otherwise("ok")


def enrich(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Every record unchanged, plus the fifteen fields ('' by default) and the outcome.

    The outcome is ok where the record has a page. Of several copies of a page one with a readable
    document is taken.
    """
    rank = rank_expr(F.col("has_doc").cast("int"), *map(F.col, NEW_FIELDS))
    joined = best_lookup(records, page_fields(pages), "dataset_url", rank)
    return joined.select(
        *records.columns,
        *filled_fields(),
        outcome_expr().alias("outcome"),
    )
