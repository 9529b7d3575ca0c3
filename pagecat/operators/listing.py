"""Listing pages to base records: rows, links, cells, first-seen dedup, stop rule, page counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.functions.text import (
    TAG_REST,
    drop_unseen_expr,
    has_any,
    inline_text_expr,
    rest_expr,
    strip_expr,
    unescape_expr,
)
from pagecat.functions.urls import is_dataset_link_expr, resolve_href_expr
from pagecat.schemas import BASE_FIELDS
from pagecat.session import stage

METADATA = [f for f in BASE_FIELDS if f not in ("dataset_name", "dataset_url")]
ORDER = ["run", "page_num", "pos"]

_HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
_LINK = "struct<href:string,inner:string>"
# A table has rows in a body, or rows of its own, whose body HTML implies.
_TBODY = r"(?is)<tbody\b|<table\b(?:(?!</table\b).)*?<tr\b"
_FIRST_TABLE = rf"(?is)<table\b{TAG_REST}(.*?)(?:</table\b|\z)"
_FIRST_TBODY = rf"(?is)<tbody\b{TAG_REST}(.*?)(?:</tbody\b|</table\b|\z)"


def _after_tag(name: str) -> str:
    return rf"<(?i:{name})\b{TAG_REST}"


def _elements(html: Column, tag: str) -> Column:
    """Contents of every element, in order. End tags may be missing, as HTML allows."""
    return F.transform(
        rest_expr(F.split(html, _after_tag(tag))),
        lambda piece: F.get(F.split(piece, rf"</(?i:{tag})\b", 2), F.lit(0)),
    )


def links_expr(html: Column) -> Column:
    """Every anchor: array of (href, inner), in page order; href is '' where there is none."""
    anchors = rest_expr(F.split(html, r"<[aA](?=[\s>])"))

    def link(piece: Column) -> Column:
        attributes = F.regexp_extract(piece, rf"^{TAG_REST}", 0)
        raw = F.concat(*(F.regexp_extract(attributes, _HREF, group) for group in (1, 2, 3)))
        # As a browser reads an address: references decoded, no white space around it.
        href = strip_expr(F.when(raw.contains("&"), unescape_expr(raw)).otherwise(raw))
        inner = F.regexp_replace(
            F.get(F.split(piece, r"(?i)</a\s*>", 2), F.lit(0)), rf"^{TAG_REST}", ""
        )
        return F.struct(href.alias("href"), inner.alias("inner"))

    return F.transform(anchors, link)


def _div_class(word: str) -> str:
    value = rf"""(?:"[^">]*{word}|'[^'>]*{word}|[^"'\s>]*{word})"""
    return rf"(?i:<div)\b[^>]*?\s(?i:class)\s*=\s*{value}"


def _seen_pages(pages: DataFrame) -> DataFrame:
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, drop_unseen_expr(F.col("html")).alias("seen"))


def layout_probe(pages: DataFrame, include: str = rules.DATASET_LINK) -> DataFrame:
    """Which of six layouts a page has (first with any hit) and how many elements; null if none."""
    return _probe(_seen_pages(pages), include)


def _probe(seen_pages: DataFrame, include: str) -> DataFrame:
    html = F.col("seen")
    rows = F.when(html.rlike(r"(?i)<table\b"), F.regexp_count(html, F.lit(r"(?i)<tr\b"))).otherwise(0)
    probes = [
        ("dataset", F.regexp_count(html, F.lit(_div_class("dataset")))),
        ("table_row", rows),
        ("hit", F.regexp_count(html, F.lit(_div_class("hit")))),
        ("result", F.regexp_count(html, F.lit(_div_class("result")))),
        ("article", F.regexp_count(html, F.lit(r"(?i)<article\b"))),
        ("link", F.size(F.filter(links_expr(html), lambda link: link["href"].contains(include)))),
    ]
    # Lazy: a later probe is only counted where every earlier one found nothing.
    found = F.coalesce(
        *(
            F.when(count > 0, F.struct(F.lit(name).alias("layout"), count.alias("elements")))
            for name, count in probes
        )
    )
    kept = [c for c in seen_pages.columns if c != "seen"]
    return seen_pages.select(*kept, found.alias("probe")).select(
        *kept, "probe.layout", "probe.elements"
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` reads it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _depths(steps: Column) -> Column:
    """Running sums of steps (1, -1 or 0) that never fall below 0.

    By blocks of about the square root of their number: a block turns the depth d before it into
    max(d + total, floor). So no array grows beyond a block, and the work grows with n times its root.
    """

    def blocks(all_steps: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(all_steps))), F.lit(1)).cast("int")
        last = F.floor((F.size(all_steps) - 1) / width).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_steps, k * width + 1, width))

    def effect(block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(F.lit(0).alias("total"), F.lit(-(1 << 30)).alias("floor")),
            lambda e, x: F.struct((e["total"] + x).alias("total"), F.greatest(e["floor"] + x, F.lit(0)).alias("floor")),
        )

    def walk(start: Column, moves: Column, move: Callable[[Column, Column], Column], after: bool) -> Column:
        """Depths before, or after, each move."""
        none = F.array().cast("array<int>")

        def step(state: Column, x: Column) -> Column:
            now = move(state["depth"], x)
            told = now if after else state["depth"]
            return F.struct(now.alias("depth"), F.concat(state["told"], F.array(told)).alias("told"))

        return F.aggregate(moves, F.struct(start.alias("depth"), none.alias("told")), step, lambda state: state["told"])

    def joined(parts: Column) -> Column:
        starts = walk(F.lit(0), F.transform(parts, effect), lambda d, e: F.greatest(d + e["total"], e["floor"]), after=False)
        within = F.zip_with(parts, starts, lambda p, d: walk(d, p, lambda e, x: F.greatest(e + x, F.lit(0)), after=True))
        return F.flatten(within)

    return _let(_let(steps, blocks), joined)


def _outer_tables(seen: Column) -> Column:
    """The page without tables inside tables: their cells are no cells of the listing."""

    def step(piece: Column) -> Column:
        return F.when(piece.rlike("(?i)^<table\\b"), 1).when(piece.rlike("(?i)^</table\\b"), -1).otherwise(0)

    def kept(piece: Column, depth: Column) -> Column:
        inner_end = (depth == 1) & piece.rlike("(?i)^</table\\b")
        return F.when(inner_end, F.regexp_replace(piece, "^[^>]*>?", "")).when(depth <= 1, piece).otherwise("")

    def flat(pieces: Column) -> Column:
        return F.array_join(F.zip_with(pieces, _depths(F.transform(pieces, step)), kept), "")

    pieces = F.split(seen, r"(?i)(?=</?table\b)")
    return F.when(F.regexp_count(seen, F.lit(r"(?i)<table\b")) > 1, _let(pieces, flat)).otherwise(seen)


def _row_cells(seen: Column) -> Column:
    """Cells of the rows of the first body, or of the first table where no body is written."""
    outer = _outer_tables(seen)
    written = outer.rlike(r"(?i)<tbody\b")
    body = F.when(written, F.regexp_extract(outer, _FIRST_TBODY, 1)).otherwise(
        F.regexp_extract(outer, _FIRST_TABLE, 1)
    )
    return F.transform(_elements(body, "tr"), lambda row: _elements(row, "td"))


def table_rows(pages: DataFrame) -> DataFrame:
    """Rows of the first tbody of every page, cells as HTML; rows with fewer than two cells drop."""
    return (
        _seen_pages(pages)
        .select("run", "page_num", "url", F.posexplode(_row_cells(F.col("seen"))).alias("pos", "cells"))
        .where(F.size("cells") >= 2)
    )


def _first_link(cells: Column, include: str, exclude: str) -> Column:
    wanted = F.filter(
        links_expr(F.get(cells, F.lit(0))),
        lambda link: is_dataset_link_expr(link["href"], include, exclude),
    )
    return F.get(wanted, F.lit(0))


def _name_and_url(rows: DataFrame) -> DataFrame:
    """Rows with a ``link`` -> rows with its text and absolute URL; empty names drop.

    The empty ones go by a generator, not a filter: a filter would be pushed below the projection and
    work every text out twice.
    """
    kept = [c for c in rows.columns if c != "link"]
    named = F.struct(
        inline_text_expr(F.col("link.inner")).alias("dataset_name"),
        resolve_href_expr(F.col("url"), F.col("link.href")).alias("dataset_url"),
    )
    return rows.select(*kept, F.inline(F.filter(F.array(named), lambda r: r["dataset_name"] != "")))


def row_link(
    rows: DataFrame, include: str = rules.DATASET_LINK, exclude: str = rules.LISTING_LINK
) -> DataFrame:
    """Name and URL from the first matching link of the first cell; rows without both drop."""
    return _name_and_url(rows.withColumn("link", _first_link(F.col("cells"), include, exclude)))


def _cell_kind(cell: Column) -> Column:
    lower = F.lower(cell)
    tests = [
        (field, has_any(lower, words) if how == "contains" else lower.isin(words))
        for field, how, words in rules.CELL_RULES
    ]
    (field, test), *rest = tests
    return reduce(lambda case, t: case.when(t[1], t[0]), rest, F.when(test, field)).when(
        cell != "", "sample_type"
    )


def _with_cell_texts(rows: DataFrame) -> DataFrame:
    """Texts of all cells after the name, and the kind each looks like."""
    texts = F.transform(F.slice("cells", 2, F.size("cells")), inline_text_expr)
    kinds = F.transform("texts", lambda t: F.struct(_cell_kind(t).alias("kind"), t.alias("text")))
    return rows.withColumn("texts", texts).withColumn("kinds", kinds)


def _by_position(field: str) -> Column:
    return F.get("texts", F.lit(rules.CELL_POSITIONS[field] - 1))


def _by_pattern(field: str) -> Column:
    """The last cell of a kind, but of the sample type the first; short rows stay blank."""
    index = 1 if field == "sample_type" else -1
    hits = F.filter("kinds", lambda cell: cell["kind"] == field)
    return F.when(F.size("cells") >= 5, F.try_element_at(hits, F.lit(index))["text"])


def _with_fields(rows: DataFrame, value) -> DataFrame:
    fields = [F.coalesce(value(field), F.lit("")).alias(field) for field in METADATA]
    kept = [c for c in rows.columns if c not in ("texts", "kinds")]
    return rows.select(*kept, *fields)


def map_cells_by_position(rows: DataFrame) -> DataFrame:
    """Rows of seven or more cells: the metadata fields by position."""
    return _with_fields(_with_cell_texts(rows.where(F.size("cells") >= 7)), _by_position)


def map_cells_by_pattern(rows: DataFrame) -> DataFrame:
    """Rows of two to six cells: five or six are told apart by their words, fewer stay blank."""
    return _with_fields(_with_cell_texts(rows.where(F.size("cells") < 7)), _by_pattern)


def fallback_links(
    pages: DataFrame, include: str = rules.DATASET_LINK, exclude: str = rules.LISTING_LINK
) -> DataFrame:
    """Pages without any tbody: every matching link is a record without metadata."""
    links = (
        _seen_pages(pages)
        .where(~F.col("seen").rlike(_TBODY))
        .select("run", "page_num", "url", F.posexplode(links_expr(F.col("seen"))).alias("pos", "link"))
        .where(is_dataset_link_expr(F.col("link.href"), include, exclude))
    )
    blanks = [F.lit("").alias(field) for field in METADATA]
    return _name_and_url(links).select(*ORDER, "dataset_name", "dataset_url", *blanks)


def listing_entries(pages: DataFrame, include: str = rules.DATASET_LINK) -> DataFrame:
    """One row per page: its layout and its raw entries (table rows, else links).

    All that later steps need of the HTML, read in one pass. Write it as a stage table before the
    dedup and the stop rule, which both read it.
    """
    no_cells, no_link = F.array().cast("array<string>"), F.lit(None).cast(_LINK)
    rows = F.transform(
        _row_cells(F.col("seen")), lambda c: F.struct(no_link.alias("link"), c.alias("cells"))
    )
    links = F.transform(
        links_expr(F.col("seen")), lambda a: F.struct(a.alias("link"), no_cells.alias("cells"))
    )
    entries = F.when(F.col("seen").rlike(_TBODY), rows).otherwise(links)
    return _probe(_seen_pages(pages).withColumn("entries", entries), include)


def listing_records(
    entries: DataFrame, include: str = rules.DATASET_LINK, exclude: str = rules.LISTING_LINK
) -> DataFrame:
    """Entries of all pages to base records, with repeats, whichever layout a page has."""
    rows = entries.select("run", "page_num", "url", F.posexplode("entries").alias("pos", "entry"))
    table = F.size("entry.cells") >= 2
    direct = is_dataset_link_expr(F.col("entry.link.href"), include, exclude)
    link = F.when(table, _first_link(F.col("entry.cells"), include, exclude)).when(
        direct, F.col("entry.link")
    )
    named = _name_and_url(
        rows.select("run", "page_num", "url", "pos", F.col("entry.cells").alias("cells"), link.alias("link"))
    )
    long = F.size("cells") >= 7
    return _with_fields(
        _with_cell_texts(named),
        lambda field: F.when(long, _by_position(field)).otherwise(_by_pattern(field)),
    ).select(*ORDER, "dataset_name", "dataset_url", *METADATA)


def dedup_first_seen(rows: DataFrame) -> DataFrame:
    """One record per run and URL: the first by page and position.

    An aggregate rather than a window, so a URL repeated on every page shrinks to one row per map
    task before the shuffle.
    """
    keys = ["run", "dataset_url"]
    kept = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*kept), F.struct("page_num", "pos"))
    return rows.groupBy(*keys).agg(first.alias("r")).select(*keys, "r.*").select(*rows.columns)


def new_per_page(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """New records per page, pages without any included; one shuffle of counts, no join."""
    none = pages.select("run", "page_num", F.lit(0).cast("bigint").alias("n"))
    one = rows.select("run", "page_num", F.lit(1).cast("bigint").alias("n"))
    return none.unionByName(one).groupBy("run", "page_num").agg(F.sum("n").alias("new_records"))


def stop_pages(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Per run, the page its crawl stops at: the first without a layout, or the last of three
    pages in a row with nothing new. Runs that never stop have no row. ``pages`` are pages, or
    their entries, which already know the layout.

    Each empty page votes for itself and the next two; a page with three votes is the third in a
    row. That is an aggregate by page, so a run of any length needs no window over its pages.
    """
    votes = rules.EMPTY_PAGES_TO_STOP
    probed = pages if "layout" in pages.columns else layout_probe(pages)
    unusable = (
        probed.where(F.col("layout").isNull())
        .select("run", F.col("page_num").alias("stop"), F.lit(votes).cast("bigint").alias("n"))
    )
    empty = (
        new_per_page(rows, pages)
        .where(F.col("new_records") == 0)
        .select(
            "run",
            F.explode(F.sequence("page_num", F.col("page_num") + votes - 1)).alias("stop"),
            F.lit(1).cast("bigint").alias("n"),
        )
    )
    return (
        unusable.unionByName(empty)
        .groupBy("run", "stop")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= votes)
        .groupBy("run")
        .agg(F.min("stop").alias("stop"))
    )


def apply_stop_rule(rows: DataFrame, pages: DataFrame, salts: int = 32) -> DataFrame:
    """Keep the records a crawl would have reached; ``rows`` are deduplicated."""
    return before_stops(rows, stop_pages(rows, pages), salts)


def before_stops(rows: DataFrame, stops: DataFrame, salts: int = 32) -> DataFrame:
    """Records before the page their run stops at, (run, stop); all of runs that don't stop.

    A run may hold a third of all records, so its rows are spread over ``salts`` keys; the other side
    is one narrow row per run, cheap to repeat.
    """
    stops = stops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("dataset_url"), F.lit(salts)).cast("int"))
    return (
        salted.join(stops, ["run", "salt"], "left")
        .where(F.col("stop").isNull() | (F.col("page_num") < F.col("stop")))
        .select(*rows.columns)
    )


def page_stats(rows: DataFrame, pages: DataFrame, block: int = 1024) -> DataFrame:
    """New records per page and the running total of the run.

    The total is summed within blocks of pages, then over the blocks, so no task sorts more than
    ``block`` pages of a run, or its blocks.
    """
    per_page = stage(new_per_page(rows, pages), "page-counts")
    counts = per_page.withColumn("block", F.expr(f"page_num div {block}"))
    within = Window.partitionBy("run", "block").orderBy("page_num")
    blocks = counts.groupBy("run", "block").agg(F.sum("new_records").alias("in_block"))
    before = Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("run", "block", F.sum("in_block").over(before).alias("start"))
    return (
        counts.withColumn("here", F.sum("new_records").over(within))
        .join(starts, ["run", "block"])
        .select(
            "run",
            "page_num",
            "new_records",
            (F.coalesce("start", F.lit(0)) + F.col("here")).cast("bigint").alias("running_total"),
        )
    )


def column_width_profile(df: DataFrame) -> DataFrame:
    """Width of every column on a sheet: longest value or header plus 2, at most 100. One pass."""
    longest = [F.max(F.length(F.col(c).cast("string"))).alias(c) for c in df.columns]
    wide = df.agg(*longest)
    pairs = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.least(
                    F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(len(c))) + 2, F.lit(100)
                ).alias("width"),
            )
            for c in df.columns
        )
    )
    return wide.select(F.inline(pairs))
