"""The JSON document embedded in a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecat import rules
from pagecat.schemas import EMBEDDED_DOC, FILESET_MAP


def document_text(pages: DataFrame) -> DataFrame:
    """Pages with ``text``, the body of their first document script, in place of the HTML.

    Null where there is none. A byte search from both ends finds the usual single script; only pages
    that repeat the tag are split by it.
    """
    html, opened, closed = F.col("html"), rules.DOCUMENT_OPEN, rules.DOCUMENT_CLOSE
    kept = [c for c in pages.columns if c != "html"]
    head, tail, whole = F.octet_length("head"), F.octet_length("tail"), F.octet_length("html")
    found = F.when(head + tail + len(opened) == whole, F.col("tail")).when(
        head < whole, F.split_part(html, F.lit(opened), F.lit(2))
    )
    cut = (
        pages.withColumn("head", F.substring_index(html, opened, 1))
        .withColumn("tail", F.substring_index(html, opened, -1))
        .select(*kept, found.alias("after"))
    )
    text = F.nullif(F.substring_index("after", closed, 1), F.lit(""))
    return cut.select(*kept, F.when(F.col("after").contains(closed), text).alias("text"))


def embedded_json(pages: DataFrame, schema: T.StructType = EMBEDDED_DOC) -> DataFrame:
    """Pages with ``doc`` in place of the HTML.

    Absent documents are null; malformed ones are a struct of nulls, so ask for an inner field.
    The schema names only what is read; pass a smaller one to parse less.
    """
    kept = [c for c in pages.columns if c != "html"]
    return document_text(pages).select(*kept, F.from_json("text", schema).alias("doc"))


def dataset_node(docs: DataFrame) -> DataFrame:
    """``dataset`` and ``filesets`` of every document (needs the full schema).

    ``has_doc`` tells a readable document; without one the node is null and the map empty.
    """
    kept = [c for c in docs.columns if c != "doc"]
    props = F.col("doc.props.pageProps")
    return docs.select(
        *kept,
        F.col("doc.props").isNotNull().alias("has_doc"),
        props["dataset"].alias("dataset"),
        F.coalesce(props["filesetMap"], F.create_map().cast(FILESET_MAP)).alias("filesets"),
    )
