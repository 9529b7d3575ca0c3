"""The whole path: listing pages to records, records to a checked catalogue.

Between the two steps the records are a stage table (io.replace_stage), which cuts the lineage and
keeps what a lost executor would otherwise have to crawl through again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.operators.embedded import embedded_json
from pagecat.operators.enrich import document_fields, filled_fields, outcome_expr
from pagecat.operators.files import file_columns, files_expr
from pagecat.operators.joins import best_lookup, rank_expr
from pagecat.operators.listing import apply_stop_rule, dedup_first_seen, listing_records
from pagecat.operators.validate import (
    compared_columns,
    filled_count_expr,
    told_by_page,
    url_status,
)
from pagecat.session import stage


def crawl_records(
    entries: DataFrame, include: str = rules.DATASET_LINK, exclude: str = rules.LISTING_LINK
) -> DataFrame:
    """Stored listing entries to the records a crawl would have kept.

    The first-seen records are written once: the stop rule counts them before it cuts them.
    """
    first = stage(dedup_first_seen(listing_records(entries, include, exclude)), "first-seen")
    return apply_stop_rule(first, entries)


def page_facts(pages: DataFrame) -> DataFrame:
    """All that is ever read off a detail page, in one pass over the HTML; one row per page."""
    told = told_by_page(pages.select(F.col("url").alias("dataset_url"), "html"))
    facts = document_fields(embedded_json(told)).withColumn(
        "files", files_expr(F.col("doc.props.pageProps.filesetMap"))
    )
    return facts.drop("doc")


def facts_rank() -> Column:
    """Of several copies of a page the one with a readable document, most files and most said wins."""
    many = F.coalesce(F.size("files"), F.lit(0)).cast("long")
    merit = F.col("has_doc").cast("long") * (1 << 40) + many * (1 << 8) + filled_count_expr(F.col("page"))
    return rank_expr(merit, F.col("page"), F.col("files"))


def catalogue(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Records enriched, with files, and checked against their pages: one scan, one wide shuffle."""
    joined = best_lookup(records, page_facts(pages), "dataset_url", facts_rank())
    return url_status(
        joined.select(
            *records.columns,
            *filled_fields(),
            outcome_expr().alias("outcome"),
            *file_columns(),
            *compared_columns("page"),
        )
    )
