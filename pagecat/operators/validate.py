"""Two copies of a catalogue compared row by row, and records compared with their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.functions.text import (
    detect_first_expr,
    page_heading_expr,
    strip_expr,
    visible_text_expr,
)
from pagecat.operators.joins import lookup_join, one_per_key
from pagecat.schemas import DIFFERENCE
from pagecat.session import stage

_PAGE_FIELDS = [field for field, _ in rules.COMPARISONS]


# ---- copy against copy -----------------------------------------------------------------------


def _sides(left: DataFrame, right: DataFrame, by: tuple[str, ...], how: str) -> DataFrame:
    """Both sides beside each other: per group with ``by`` (nulls are a group), else one row each."""
    if not by:
        return left.crossJoin(right)
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    joined = left.join(renamed, same, how)
    return joined.withColumns({c: F.coalesce(c, f"_{c}") for c in by}).drop(*(f"_{c}" for c in by))


def count_check(a: DataFrame, b: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Row counts of both copies, and the one mismatch entry where they differ; a row per group."""
    left = a.groupBy(*by).agg(F.count(F.lit(1)).alias("json_count"))
    right = b.groupBy(*by).agg(F.count(F.lit(1)).alias("excel_count"))
    both = _sides(left, right, by, "full").na.fill(0, ["json_count", "excel_count"])
    same = F.col("json_count") == F.col("excel_count")
    message = F.concat(
        F.lit("Entry count mismatch: JSON has "),
        F.col("json_count").cast("string"),
        F.lit(", Excel has "),
        F.col("excel_count").cast("string"),
    )
    return both.select(
        *by,
        same.alias("passed"),
        "json_count",
        "excel_count",
        F.when(~same, "count_mismatch").alias("type"),
        F.when(~same, message).alias("message"),
    )


def row_diff(
    a: DataFrame, b: DataFrame, index: str = "row_idx", by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows that differ, copies aligned by position: (by, row, dataset_url, differences).

    One join on the group and the row index, which starts anew in every group (a run, say), then all
    fields are compared inside the row. Nulls count as ''.
    Fields of only one copy are added or removed; fields of unlike types differ in type.
    """
    keys = [*by, index]
    left = {f.name: f.dataType for f in a.schema if f.name not in keys}
    right = {f.name: f.dataType for f in b.schema if f.name not in keys}
    place = F.col(index).alias("_row")
    # Rows of only one copy have no partner; counts are compared by count_check.
    joined = _sides(
        a.select(*by, place, F.struct(*left).alias("_a")),
        b.select(*by, place, F.struct(*right).alias("_b")),
        (*by, "_row"),
        "inner",
    )

    def entry(kind: str, field: str, old: Column, new: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(field).alias("field"),
            old.alias("old_value"),
            new.alias("new_value"),
        )

    def text(side: str, field: str) -> Column:
        return F.coalesce(F.col(side)[field].cast("string"), F.lit(""))

    nothing = F.lit(None).cast("string")
    changes = []
    for field, dtype in left.items():
        old = text("_a", field)
        if field not in right:
            changes.append(entry("removed", field, old, nothing))
            continue
        new = text("_b", field)
        differs = F.when(old != new, entry("changed", field, old, new))
        if dtype != right[field]:
            both = F.col("_a")[field].isNotNull() & F.col("_b")[field].isNotNull()
            differs = F.when(both, entry("type_changed", field, old, new)).otherwise(differs)
        changes.append(differs)
    for field in right.keys() - left.keys():
        changes.append(entry("added", field, nothing, text("_b", field)))

    found = F.array_sort(F.filter(F.array(*changes), lambda c: c.isNotNull()))
    return (
        joined.select(
            *by,
            (F.col("_row") + 1).cast("bigint").alias("row"),
            (F.coalesce(F.col("_a")["dataset_url"], F.lit("")) if "dataset_url" in left else F.lit("Unknown")).alias(
                "dataset_url"
            ),
            found.alias("differences"),
        )
        .where(F.size("differences") > 0)
    )


def consistency_summary(
    a: DataFrame, b: DataFrame, index: str = "row_idx", by: tuple[str, ...] = ()
) -> DataFrame:
    """Passed, both counts, and the number of mismatches; rows count only where counts agree."""
    differing = row_diff(a, b, index, by).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    counts = count_check(a, b, by)
    mismatches = F.when(F.col("passed"), F.col("n")).otherwise(F.lit(1)).cast("bigint")
    return _sides(counts, differing, by, "left").na.fill(0, ["n"]).select(
        *by,
        (F.col("passed") & (F.col("n") == 0)).alias("passed"),
        "json_count",
        "excel_count",
        mismatches.alias("mismatch_count"),
    )


def key_coverage(a: DataFrame, b: DataFrame, key: str = "dataset_url") -> DataFrame:
    """Keys of only one copy. One aggregate, so copies of a key shrink before the shuffle."""
    sides = a.select(key, F.lit("a").alias("side")).unionByName(
        b.select(key, F.lit("b").alias("side"))
    )
    seen = sides.groupBy(key).agg(F.min("side").alias("first"), F.max("side").alias("last"))
    return seen.where(F.col("first") == F.col("last")).select(
        key, F.when(F.col("first") == "a", "only_in_a").otherwise("only_in_b").alias("coverage")
    )


# ---- record against page ---------------------------------------------------------------------


def body_text(pages: DataFrame) -> DataFrame:
    """Lower-cased visible text of every page."""
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, F.lower(visible_text_expr(F.col("html"))).alias("body_text"))


PAGE_RULES = {
    "species": rules.SPECIES_RULES,
    "preservation": rules.PRESERVATION_RULES,
    "sample_type": rules.TISSUE_RULES,
}


def detect_fields(texts: DataFrame, text: str, by_field: dict = PAGE_RULES) -> DataFrame:
    """Per field the first rule with a word inside the lower-cased text, '' if none."""
    return texts.withColumns(
        {field: detect_first_expr(F.col(text), field_rules) for field, field_rules in by_field.items()}
    )


def told_by_page(pages: DataFrame) -> DataFrame:
    """Pages with ``page``: the struct of what each says of its dataset."""
    kept = pages.columns
    read = pages.withColumns(
        {
            "dataset_name": page_heading_expr(F.col("html")),
            "text": F.lower(visible_text_expr(F.col("html"))),
        }
    )
    return detect_fields(read, "text").select(*kept, F.struct(*_PAGE_FIELDS).alias("page"))


def filled_count_expr(page: Column) -> Column:
    return sum((F.when(page[f] != "", 1).otherwise(0) for f in _PAGE_FIELDS), F.lit(0))


def extract_page_fields(pages: DataFrame) -> DataFrame:
    """What a page says of its dataset: (dataset_url, dataset_name, species, …), one row per url.

    Of several copies of a page the one that says most is taken.
    """
    told = told_by_page(pages.select(F.col("url").alias("dataset_url"), "html"))
    prefer = F.struct(filled_count_expr(F.col("page")), F.xxhash64("page"))
    return one_per_key(told.drop("html"), "dataset_url", prefer).select("dataset_url", "page.*")


def _mismatch(method: str, scraped: Column, actual: Column) -> Column:
    if method == "exact":
        return scraped != actual
    a, b = F.lower(scraped), F.lower(actual)
    if method == "case_insensitive":
        return a != b
    if method == "normalized":
        return F.translate(a, " -", "") != F.translate(b, " -", "")
    return ~(b.contains(a) | a.contains(b))


def compared_columns(page: str) -> list[Column]:
    """``has_page`` and ``differences`` of a record joined with the struct its page tells.

    Fields the page does not tell are skipped; no page gives a single page_load entry.
    """
    nothing = F.lit(None).cast("string")

    def difference(field: str, method: str) -> Column:
        scraped = strip_expr(F.coalesce(field, F.lit("")))
        found = strip_expr(F.col(page)[field])
        severity = "error" if method == "exact" else "warning"
        entry = F.struct(
            F.lit(field).alias("field"),
            F.lit(severity).alias("severity"),
            scraped.alias("scraped_value"),
            found.alias("actual_value"),
            nothing.alias("message"),
        )
        return F.when((found != "") & _mismatch(method, scraped, found), entry)

    compared = F.filter(
        F.array(*(difference(*rule) for rule in rules.COMPARISONS)), lambda d: d.isNotNull()
    )
    no_page = F.array(
        F.struct(
            F.lit("page_load").alias("field"),
            F.lit("error").alias("severity"),
            nothing.alias("scraped_value"),
            nothing.alias("actual_value"),
            F.lit("page not found").alias("message"),
        )
    )
    has_page = F.col(page).isNotNull()
    differences = F.when(has_page, compared).otherwise(no_page)
    return [
        has_page.alias("has_page"),
        differences.cast(f"array<{DIFFERENCE.simpleString()}>").alias("differences"),
    ]


def compare_fields(records: DataFrame, page_fields: DataFrame) -> DataFrame:
    """Records with their differences from their pages (one row of fields per url)."""
    told = page_fields.select("dataset_url", F.struct(*_PAGE_FIELDS).alias("_page"))
    joined = lookup_join(records, told, "dataset_url")
    return joined.select(*records.columns, *compared_columns("_page"))


def url_status(compared: DataFrame) -> DataFrame:
    """Status of every record by its differences."""
    errors = F.exists("differences", lambda d: d["severity"] == "error")
    status = (
        F.when(~F.col("has_page"), "failed")
        .when(F.size("differences") == 0, "verified")
        .when(errors, "mismatched")
        .otherwise("warning")
    )
    return compared.withColumn("status", status).drop("has_page")


def status_counts(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of every status, over all results or per ``by``."""
    names = {
        "verified": "verified",
        "mismatched": "mismatched",
        "warnings": "warning",
        "failed_urls": "failed",
    }
    counts = [F.count_if(F.col("status") == status).alias(name) for name, status in names.items()]
    return results.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("total_datasets"), *counts)


def exit_code_expr(
    passed: Column, mismatched: Column, failed: Column, readable: Column, has_pages: Column
) -> Column:
    """0; 1 on any mismatch or failed page; 2 where the input or all pages could not be read."""
    return (
        F.when(~readable | ~has_pages, 2)
        .when(~passed | (mismatched + failed > 0), 1)
        .otherwise(0)
    )


def exit_code(
    counts: DataFrame, consistency: DataFrame, pages: DataFrame | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """Exit code of every row of status counts, under the consistency check of its group.

    A run without any record is unreadable input; a group without any page has no page source. Without
    ``by`` there is one check and one corpus for all rows.
    """
    passed = consistency.select(*by, "passed")
    if pages is None:
        with_pages = _sides(counts, passed, by, "left").withColumn("has_pages", F.lit(True))
    elif by:
        paged = pages.select(*by).distinct().withColumn("has_pages", F.lit(True))
        with_pages = _sides(_sides(counts, passed, by, "left"), paged, by, "left")
        with_pages = with_pages.na.fill(False, ["has_pages", "passed"])
    else:
        any_page = pages.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_pages"))
        with_pages = counts.crossJoin(passed).crossJoin(any_page)
    code = exit_code_expr(
        F.col("passed"),
        F.col("mismatched"),
        F.col("failed_urls"),
        F.col("total_datasets") > 0,
        F.col("has_pages"),
    )
    return with_pages.select(*counts.columns, code.cast("int").alias("exit_code"))


def report_rows(results: DataFrame, index: str = "row_idx") -> DataFrame:
    """Rows of the readable report: number, url, short name, status label, differences as text."""

    def fragment(d: Column) -> Column:
        value = lambda name: F.coalesce(d[name], F.lit(""))
        return F.concat(
            d["field"], F.lit(': "'), value("scraped_value"), F.lit('" → "'), value("actual_value"), F.lit('"')
        )

    label = F.lit("?")
    for status, text in rules.STATUS_LABELS.items():
        label = F.when(F.col("status") == status, text).otherwise(label)
    details = F.array_join(F.transform("differences", fragment), "; ")
    return results.select(
        (F.col(index) + 1).cast("bigint").alias("row"),
        "dataset_url",
        F.substring("dataset_name", 1, 60).alias("name"),
        label.alias("status_label"),
        F.when(details == "", "-").otherwise(details).alias("differences"),
    )


def validation_report(
    coded_counts: DataFrame, consistency: DataFrame, timestamp: Column, by: tuple[str, ...] = ()
) -> DataFrame:
    """Report header and summary numbers as nested rows, one per row of coded status counts.

    ``by`` names the groups that have a consistency check of their own; without it there is one for all.
    The single results stay a table of their own (``url_status``), as they grow with the records.
    """
    numbers = ("total_datasets", "verified", "mismatched", "warnings", "failed_urls", "exit_code")
    kept = [c for c in coded_counts.columns if c not in numbers]
    file_part = consistency.select(
        *by, F.struct("passed", "json_count", "excel_count", "mismatch_count").alias("file_consistency")
    )
    return _sides(coded_counts, file_part, by, "left").select(
        *kept,
        timestamp.cast("string").alias("validation_timestamp"),
        "total_datasets",
        "file_consistency",
        F.struct("verified", "mismatched", "warnings", "failed_urls").alias("url_validation"),
        "exit_code",
    )


def report_view(reports: DataFrame, form: str = "summary") -> DataFrame:
    """A stored report as asked for: its summary, or all of it."""
    if form == "summary":
        return reports.drop("exit_code", "report")
    return reports


def issue_expr() -> Column:
    """True for a result with a problem."""
    return F.col("status").isin("mismatched", "warning", "failed")


def issues_only(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Results with a problem, and their total, over all or per ``by``, on every row.

    They are written, then counted.
    """
    bad = stage(results.where(issue_expr()), "issues")
    total = bad.groupBy(*by).agg(F.count(F.lit(1)).alias("total_issues"))
    return _sides(bad, total, by, "left")
