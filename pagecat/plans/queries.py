"""One query per operator, over the given tables or pages derived from them.

Results are flat: nested values are joined to text, so that they compare by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecat import rules, schemas
from pagecat.functions import files as file_exprs
from pagecat.functions import urls
from pagecat.functions.text import label_by_line_expr, page_heading_expr, squash_ws_expr
from pagecat.functions.values import stage_status_expr
from pagecat.operators import embedded, enrich, files, listing, quality, runs, sections, validate
from pagecat.plans import fixtures, flow
from pagecat.session import scratch_path, stage, tune
from pagecat.sources import io, reports
from pagecat.streaming import ingest, stops

REPORT_TIME = "2024-01-01T00:00:00"

# Common words of the document table, as stand-ins for the catalogue's own words.
WORD_RULES = [("English", ["the ", "and "]), ("French", ["les ", "dans "]), ("German", ["der ", "und "])]
LINE_RULES = [("A", ["elle", "ation"]), ("B", ["the", "der "])]
DOCUMENT_HEADERS = [("The ", "the"), ("La ", "la"), ("Der ", "der"), ("De", None)]

_ROWS = ["run", "page_num", "pos"]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return fixtures.table(spark, d, name)


# ---- sources and sinks -----------------------------------------------------------------------


def read_pages(spark, d):
    schema = T.StructType(schemas.strings("url", "html"))
    pages = io.read_pages(spark, f"{d}/pages.parquet", schema)
    return pages.select("url", F.length("html").cast("bigint").alias("n_chars"))


def _indexed(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("row_idx", T.LongType()), *schema.fields])


def records_roundtrip(spark, d):
    path = scratch_path(spark, "records")
    io.write_records(fixtures.copy_b(spark, d), path)
    return io.read_records(spark, path, _indexed(schemas.BASE_RECORD), lines=True)


def tabular_roundtrip(spark, d):
    path = scratch_path(spark, "tabular")
    io.write_tabular(fixtures.copy_b(spark, d), path, ["row_idx", *schemas.BASE_FIELDS])
    return io.read_tabular(spark, path, _indexed(schemas.BASE_RECORD))


def column_order(spark, d):
    ordered = io.column_order(
        fixtures.copy_a(spark, d), ["row_idx", "species", "dataset_name", "not_there", "dataset_url"]
    )
    cells = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in ordered.columns[1:])
    )
    return ordered.select("row_idx", F.posexplode(cells).alias("position", "c")).select(
        "row_idx", "position", "c.column_name", "c.value"
    )


def archive_pages(spark, d):
    path = scratch_path(spark, "archive")
    pages = _table(spark, d, "pages").select(
        (F.col("page_id") % 4).cast("string").alias("run"),
        F.col("page_id").cast("int").alias("page_num"),
        "url",
        "html",
    )
    io.archive_pages(pages, path)
    return io.read_pages(spark, path).select(
        "run", "page_num", "url", F.md5("html").alias("html_md5")
    )


def _results(spark, d) -> DataFrame:
    compared = validate.compare_fields(
        fixtures.page_records(spark, d),
        validate.extract_page_fields(fixtures.record_pages(spark, d)),
    )
    return validate.url_status(compared)


def _consistency(spark, d) -> DataFrame:
    return validate.consistency_summary(fixtures.copy_a(spark, d), fixtures.copy_b(spark, d))


def _reports(spark, d) -> DataFrame:
    counts = validate.status_counts(_results(spark, d), ["run"])
    consistency = stage(_consistency(spark, d), "consistency")  # one row, read twice
    coded = validate.exit_code(counts, consistency, fixtures.record_pages(spark, d))
    return validate.validation_report(coded, consistency, F.lit(REPORT_TIME))


def validation_report(spark, d):
    path = scratch_path(spark, "report")
    written = io.write_report(_reports(spark, d), path, "2024-01-01_00-00-00")
    report = spark.read.schema(schemas.VALIDATION_REPORT).json(written)
    return report.select(
        "run",
        "validation_timestamp",
        "total_datasets",
        "file_consistency.*",
        "url_validation.*",
        "exit_code",
    )


def replace_stage(spark, d):
    path = scratch_path(spark, "stage")
    key = F.regexp_extract("dataset_url", "([0-9]+)$", 1).cast("bigint")
    records = fixtures.order_records(spark, d).withColumn("run", (key % 3).cast("string"))
    io.replace_stage(records, path)
    filed = records.where(F.col("run") == "1").withColumn("product", F.upper("product"))
    io.replace_stage(filed, path)
    schema = T.StructType(schemas.strings(*schemas.BASE_FIELDS, "run"))
    return spark.read.schema(schema).parquet(path).select("run", "dataset_url", "product")


def latest_report(spark, d):
    """Three reports, each of one run less: every run's newest is another one."""
    path = scratch_path(spark, "reports")
    rows = stage(_reports(spark, d), "report-rows")
    for day, last in (("2024-01-01", "2"), ("2024-01-02", "1"), ("2024-01-03", "0")):
        io.write_report(rows.where(F.col("run") <= last), path, f"{day}_00-00-00")
    newest = validate.report_view(io.latest_report(spark, path), "full")
    return newest.select("run", "report", "total_datasets", "url_validation.*", "exit_code")


def _stored_reports(spark, d) -> str:
    """Three runs, each with its own consistency check, stored with their results; two of them once more."""
    path = scratch_path(spark, "report-store")
    results = stage(_results(spark, d), "results")
    checks = stage(validate.consistency_summary(*_copies_by_run(spark, d), by=("run",)), "consistency")
    counts = validate.status_counts(results, ["run"])
    pages = results.select("run").where("run <> '1'")
    coded = validate.exit_code(counts, checks, pages, by=("run",))
    header = stage(validate.validation_report(coded, checks, F.lit(REPORT_TIME), by=("run",)), "report-rows")
    for day, last in (("2024-01-01", "2"), ("2024-01-02", "1")):
        mine = F.col("run") <= last
        reports.store(header.where(mine), results.where(mine), path, f"{day}_00-00-00")
    return path


def report_summary(spark, d):
    found = reports.summary(spark, _stored_reports(spark, d))
    return found.select("run", "report", "validation_timestamp", "total_datasets", "file_consistency.*", "url_validation.*")


def report_full(spark, d):
    found = reports.full(spark, _stored_reports(spark, d))
    return found.select(
        "run", "report", "total_datasets", "file_consistency.passed", "exit_code", "dataset_url", "dataset_name", "status",
        F.size("differences").alias("n_differences"),
    )


def report_issues(spark, d):
    found = reports.issues(spark, _stored_reports(spark, d))
    return found.select("run", "report", "file_consistency_passed", "total_issues", "dataset_url", "status")


def issues_by_run(spark, d):
    return validate.issues_only(_results(spark, d), by=("run",)).select("run", "dataset_url", "status", "total_issues")


def stored_artifacts(spark, d):
    """Files of four runs, some without sheet, report or enriched records, found again by their paths."""
    path = scratch_path(spark, "artifacts")
    records = stage(fixtures.copy_a(spark, d).withColumn("run", (F.col("row_idx") % 4).cast("string")), "artifact-rows")
    for run in range(4):
        mine = records.where(F.col("run") == str(run)).drop("run")
        base = f"{path}/{run}"
        io.write_records(mine, f"{base}/output/Data-{run}.json")
        if run % 2 == 0:
            io.write_tabular(mine, f"{base}/output/Data-{run}.csv", ["row_idx", *schemas.BASE_FIELDS])
        if run:
            io.write_records(mine.limit(1), f"{base}/reports/validation_report_2024-01-0{run}.json")
        if run == 2:
            io.write_records(mine.limit(1), f"{base}/reports/validation_report_2024-02-01.json")
            io.write_records(mine.limit(5), f"{base}/enriched/Data-{run}-Enriched.json")
    return io.artifact_inventory(io.list_artifacts(spark, path), io.artifact_records(spark, path))


def row_diff_files(spark, d):
    """Two written copies without row numbers, JSON lines and a flat file, compared by their places."""
    base = scratch_path(spark, "copies")
    schema = schemas.BASE_RECORD
    io.write_records(fixtures.copy_a(spark, d).orderBy("row_idx").drop("row_idx"), f"{base}/a")
    io.write_tabular(fixtures.copy_b(spark, d).orderBy("row_idx"), f"{base}/b", schemas.BASE_FIELDS)
    a = io.read_records(spark, f"{base}/a", schema, lines=True, index="row_idx")
    b = io.read_tabular(spark, f"{base}/b", schema, index="row_idx")
    return validate.row_diff(a, b).select("row", "dataset_url", F.inline("differences"))


def artifact_inventory(spark, d):
    day = F.date_format("ts", "yyyyMMdd")
    run = F.concat(F.col("user_id").cast("string"), F.lit("-"), day)
    path = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit("input/URL-"), run, F.lit(".txt")))
        .when(F.col("event_type") == "view", F.concat(F.lit("output/Data-"), run, F.lit(".json")))
        .when(F.col("event_type") == "click", F.concat(F.lit("output/Data-"), run, F.lit(".xlsx")))
        .when(
            F.col("event_type") == "purchase",
            F.concat(F.lit("reports/validation_report_"), F.col("event_id").cast("string"), F.lit(".json")),
        )
        .otherwise(F.concat(F.lit("enriched/Data-"), run, F.lit("-Enriched.json")))
    )
    log = _table(spark, d, "events").select(
        run.alias("run"), F.concat(F.lit("/out/"), run, F.lit("/"), path).alias("path")
    )
    counts = log.groupBy("run").agg(F.count(F.lit(1)).alias("datasets_count"))
    return io.artifact_inventory(log, counts)


# ---- URLs ------------------------------------------------------------------------------------


def _busy_url() -> Column:
    """A page URL with more parameters: repeated, encoded, blank, without value."""
    base = F.substring_index("url", "#", 1)
    return F.concat(
        base,
        F.when(base.contains("?"), "&").otherwise("?"),
        F.lit("tag=a+b&tag=c%20d&blank=&flag&x"),
        (F.col("page_id") % 3).cast("string"),
        F.lit("=%C3%A9#f"),
    )


def url_params(spark, d):
    params = urls.query_params_expr(F.col("busy"))
    return (
        _table(spark, d, "pages")
        .select("page_id", _busy_url().alias("busy"))
        .select("page_id", F.explode(params).alias("param", "values"))
        .select("page_id", "param", F.array_join("values", "|").alias("param_values"))
    )


def url_set_page(spark, d):
    new = urls.set_query_param_expr(F.col("busy"), "page", F.col("page_id") % 7)
    return (
        _table(spark, d, "pages")
        .select("page_id", _busy_url().alias("busy"))
        .select("page_id", new.alias("new_url"))
    )


def listing_urls(spark, d):
    return urls.listing_urls(_table(spark, d, "pages").select("url"), 3)


def link_filter(spark, d):
    k = F.col("p_partkey")
    href = fixtures._pick(k % 4, ["/datasets/part-", "/datasets?page=", "/datasets/x?y=/datasets?z=", "/about/"])
    return (
        _table(spark, d, "part")
        .select(k, F.concat(href, k.cast("string")).alias("href"))
        .withColumn("is_dataset", urls.is_dataset_link_expr(F.col("href")))
    )


def resolve_links(spark, d):
    return (
        _table(spark, d, "pages")
        .select("url", F.posexplode(listing.links_expr(F.col("html"))).alias("pos", "link"))
        .select(
            "url",
            "pos",
            urls.resolve_href_expr(F.col("url"), F.col("link.href")).alias("absolute_url"),
        )
    )


# ---- listing ---------------------------------------------------------------------------------


def layout_probe(spark, d):
    return listing.layout_probe(_table(spark, d, "pages").select("url", "html"))


def layout_probe_listing(spark, d):
    return listing.layout_probe(fixtures.listing_pages(spark, d)).drop("url")


def table_rows(spark, d):
    rows = listing.table_rows(fixtures.listing_pages(spark, d))
    return rows.select(
        *_ROWS, F.size("cells").alias("n_cells"), F.get("cells", F.lit(1)).alias("second_cell")
    )


def _linked_rows(spark, d):
    return listing.row_link(listing.table_rows(fixtures.listing_pages(spark, d)))


def row_links(spark, d):
    return _linked_rows(spark, d).select(*_ROWS, "dataset_name", "dataset_url")


def squash_ws(spark, d):
    return _table(spark, d, "documents").select(
        "doc_id", F.md5(squash_ws_expr(F.col("text"))).alias("squashed_md5")
    )


def cells_positional(spark, d):
    return listing.map_cells_by_position(_linked_rows(spark, d)).select(*_ROWS, *listing.METADATA)


def cells_pattern(spark, d):
    return listing.map_cells_by_pattern(_linked_rows(spark, d)).select(*_ROWS, *listing.METADATA)


def fallback_links(spark, d):
    pages = _table(spark, d, "pages").select(
        F.lit("0").alias("run"), F.col("page_id").cast("int").alias("page_num"), "url", "html"
    )
    links = listing.fallback_links(pages, include="/")
    return links.select("page_num", "pos", "dataset_name", "dataset_url")


def fallback_links_listing(spark, d):
    return listing.fallback_links(fixtures.listing_pages(spark, d))


def _entries(spark, d):
    return listing.listing_entries(fixtures.listing_pages(spark, d))


def dedup_first_seen(spark, d):
    return listing.dedup_first_seen(listing.listing_records(_entries(spark, d)))


def _stored_entries(spark, d):
    """Parsed once and written, as dedup and stop rule both read it."""
    return stage(_entries(spark, d), "entries")


def stop_rule(spark, d):
    entries = _stored_entries(spark, d)
    return flow.crawl_records(entries)


def page_stats(spark, d):
    entries = _stored_entries(spark, d)
    first = listing.dedup_first_seen(listing.listing_records(entries))
    return listing.page_stats(first, entries)


def column_widths(spark, d):
    return listing.column_width_profile(_table(spark, d, "supplier"))


# ---- embedded JSON and enrichment ------------------------------------------------------------


def _nodes(spark, d):
    pages = fixtures.detail_pages(spark, d).withColumnRenamed("url", "dataset_url")
    return embedded.dataset_node(embedded.embedded_json(pages))


def embedded_json(spark, d):
    pages = fixtures.detail_pages(spark, d)
    docs = embedded.embedded_json(pages)
    return docs.select(
        "url",
        F.col("doc").isNull().alias("no_script"),
        F.col("doc.props").isNotNull().alias("has_doc"),
    )


def dataset_node(spark, d):
    return _nodes(spark, d).select(
        "dataset_url",
        "has_doc",
        F.col("dataset.donorCount").alias("donors"),
        F.col("dataset.publishedAt").alias("published_at"),
        F.size("filesets").alias("n_sets"),
    )


def _sections(spark, d):
    return sections.body_sections(
        _nodes(spark, d).select("dataset_url", F.col("dataset.body").alias("body"))
    )


def body_sections(spark, d):
    return _sections(spark, d)


def body_sections_documents(spark, d):
    texts = _table(spark, d, "documents").select("doc_id", F.col("text").alias("body"))
    return sections.body_sections(texts, DOCUMENT_HEADERS).select(
        "doc_id", "pos", "section", F.md5("line").alias("line_md5")
    )


def section_first_line(spark, d):
    return sections.section_first_line(
        _sections(spark, d).where(F.col("section").isin("biomaterials", "sample_preparation"))
    )


def section_kv(spark, d):
    return sections.section_key_values(_sections(spark, d))


def imaging_fields(spark, d):
    return sections.map_keys(sections.section_key_values(_sections(spark, d)))


def sample_fields(spark, d):
    return sections.map_keys(sections.section_key_values(_sections(spark, d)), rules.SAMPLE_RULES)


def sample_lists(spark, d):
    return enrich.sample_lists(_nodes(spark, d))


def donor_count(spark, d):
    return enrich.donor_count(_nodes(spark, d))


def date_published(spark, d):
    return enrich.date_published(_nodes(spark, d))


def _labels(spark, d, label_rules):
    label = label_by_line_expr(F.col("text"), label_rules)
    return _table(spark, d, "documents").select("doc_id", label.alias("label"))


def image_type_text(spark, d):
    return _labels(spark, d, rules.IMAGE_TYPE_RULES)


def disease_text(spark, d):
    return _labels(spark, d, rules.DISEASE_RULES + LINE_RULES)


def preservation_text(spark, d):
    return _labels(spark, d, rules.PRESERVATION_TEXT_RULES + WORD_RULES)


def _enriched(spark, d):
    return enrich.enrich(fixtures.order_records(spark, d), fixtures.detail_pages(spark, d))


def enrich_records(spark, d):
    return _enriched(spark, d)


# ---- files -----------------------------------------------------------------------------------


def filesets(spark, d):
    return files.filesets(_nodes(spark, d)).select(
        "dataset_url",
        "set_pos",
        "set_name",
        F.size("inputs").alias("n_inputs"),
        F.size("outputs").alias("n_outputs"),
    )


def _flat_files(spark, d):
    return files.explode_files(files.filesets(_nodes(spark, d)))


def explode_files(spark, d):
    return _flat_files(spark, d)


def file_names(spark, d):
    name = file_exprs.file_name_expr(F.col("url"))
    return _table(spark, d, "pages").select(
        "url", name.alias("filename"), file_exprs.file_type_expr(name).alias("file_type")
    )


def human_size(spark, d):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    size = cents * F.pow(F.lit(10), F.col("l_linenumber") % 4).cast("bigint")
    return (
        _table(spark, d, "lineitem")
        .select(size.alias("size_bytes"))
        .select("size_bytes", file_exprs.human_size_expr(F.col("size_bytes")).alias("size"))
    )


def parse_size(spark, d):
    unit = fixtures._pick(F.col("l_linenumber") % 7, ["B", "KB", "mb", "GB", "Tb", "items", "KB"])
    amount = F.col("l_quantity").cast("int").cast("string")
    tenth = (F.col("l_partkey") % 10).cast("string")
    text = (
        F.when(F.col("l_partkey") % 5 == 0, "")
        .when(F.col("l_partkey") % 5 == 1, F.concat(amount, F.lit(","), F.lpad(tenth, 3, "0"), F.lit(" "), unit))
        .otherwise(F.concat(F.lit(" "), amount, F.lit("."), tenth, unit, F.lit(" left")))
    )
    parsed = file_exprs.parse_size_expr(F.col("size_text"))
    return (
        _table(spark, d, "lineitem")
        .select(text.alias("size_text"))
        .withColumn("parsed", parsed)
        .select("size_text", "parsed.human", F.col("parsed.bytes").cast("bigint").alias("size_bytes"))
    )


def classify_files(spark, d):
    kind = file_exprs.classify_file_expr(F.col("file_title"), F.col("filename"))
    return _flat_files(spark, d).select("url", "file_title", "filename", kind.alias("file_class"))


def _filed(spark, d):
    return files.attach_files(
        fixtures.order_records(spark, d), files.page_files(fixtures.detail_pages(spark, d))
    )


def _file_text(f: Column) -> Column:
    return F.concat_ws("|", *(f[name].cast("string") for name in files.FILE_NAMES))


def attach_files(spark, d):
    return _filed(spark, d).select(
        "dataset_url",
        F.array_join(F.transform("files", _file_text), ";").alias("files"),
        "files_found_count",
        "file_extraction_status",
    )


def attach_files_flat(spark, d):
    """The same from flat file rows, nested again by an aggregate."""
    filed = files.attach_files(fixtures.order_records(spark, d), _flat_files(spark, d))
    return filed.select(
        "dataset_url",
        F.array_join(F.transform("files", _file_text), ";").alias("files"),
        "files_found_count",
        "file_extraction_status",
    )


def file_stats(spark, d):
    return files.file_stats(_flat_files(spark, d), _filed(spark, d))


def files_wide(spark, d):
    """The wide form with as many file columns as the longest list needs, read back cell by cell, so
    that the answer doesn't depend on the width."""
    wide = files.files_wide(_filed(spark, d).select("dataset_url", "files"))
    cells = [
        F.struct(F.lit(c).alias("file_column"), F.col(c).cast("string").alias("value"))
        for c in wide.columns
        if c != "dataset_url"
    ]
    none = F.array().cast("array<struct<file_column:string,value:string>>")
    return wide.select("dataset_url", F.inline(F.array(*cells) if cells else none)).where("value IS NOT NULL")


# ---- validation ------------------------------------------------------------------------------


def count_check(spark, d):
    return validate.count_check(fixtures.copy_a(spark, d), fixtures.copy_c(spark, d))


def row_diff(spark, d):
    diff = validate.row_diff(fixtures.copy_a(spark, d), fixtures.copy_b(spark, d))
    return diff.select("row", "dataset_url", F.inline("differences"))


def _copies_by_run(spark, d):
    """Both copies as three runs, whose rows all count from zero; one run lacks a row in b."""

    def runs(copy):
        return copy.withColumn("run", (F.col("row_idx") % 3).cast("string")).withColumn(
            "row_idx", F.floor(F.col("row_idx") / 3)
        )

    a, b = runs(fixtures.copy_a(spark, d)), runs(fixtures.copy_b(spark, d))
    return a, b.where("NOT (run = '2' AND row_idx = 0)")


def row_diff_by_run(spark, d):
    diff = validate.row_diff(*_copies_by_run(spark, d), by=("run",))
    return diff.select("run", "row", "dataset_url", F.inline("differences"))


def consistency_by_run(spark, d):
    return validate.consistency_summary(*_copies_by_run(spark, d), by=("run",))


def exit_code_by_run(spark, d):
    """One run of checked records has no page at all, one has unequal copies."""
    counts = validate.status_counts(_results(spark, d), ["run"])
    pages = fixtures.record_pages(spark, d).select(F.lit("0").alias("run"))
    pages = pages.unionByName(pages.select(F.lit("2").alias("run")))
    checks = validate.consistency_summary(*_copies_by_run(spark, d), by=("run",))
    return validate.exit_code(counts, checks, pages, by=("run",)).select("run", "exit_code")


def consistency_summary(spark, d):
    return _consistency(spark, d)


def key_coverage(spark, d):
    return validate.key_coverage(fixtures.copy_a(spark, d), fixtures.copy_b(spark, d))


def page_heading(spark, d):
    return _table(spark, d, "pages").select("url", page_heading_expr(F.col("html")).alias("heading"))


def body_text(spark, d):
    texts = validate.body_text(_table(spark, d, "pages").select("url", "html"))
    return texts.select("url", F.md5("body_text").alias("body_md5"))


def detect_fields(spark, d):
    texts = _table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))
    by_field = {"language": WORD_RULES, "sample_type": rules.TISSUE_RULES, "line_kind": LINE_RULES}
    return validate.detect_fields(texts, "text", by_field).drop("text")


def _compared(spark, d):
    return validate.compare_fields(
        fixtures.page_records(spark, d),
        validate.extract_page_fields(fixtures.record_pages(spark, d)),
    )


def compare_fields(spark, d):
    return _compared(spark, d).select("dataset_url", F.inline("differences"))


def url_status(spark, d):
    return _results(spark, d).select(
        "run", "dataset_url", "status", F.size("differences").alias("n_differences")
    )


def status_counts(spark, d):
    return validate.status_counts(_results(spark, d), ["run"])


def validation_exit(spark, d):
    counts = validate.status_counts(_results(spark, d), ["run"])
    return validate.exit_code(counts, _consistency(spark, d), fixtures.record_pages(spark, d)).select(
        "run", "exit_code"
    )


def report_rows(spark, d):
    return validate.report_rows(_results(spark, d))


def issues_only(spark, d):
    return validate.issues_only(_results(spark, d)).select("dataset_url", "status", "total_issues")


# ---- quality ---------------------------------------------------------------------------------


def _checked_catalogue(spark, d):
    return flow.catalogue(fixtures.order_records(spark, d), fixtures.detail_pages(spark, d))


def _catalogue(spark, d):
    """Enriched records with their files."""
    return _checked_catalogue(spark, d).drop("outcome", "differences", "status")


def field_completion(spark, d):
    return quality.field_completion(_catalogue(spark, d))


def field_statistics(spark, d):
    return quality.field_statistics(_enriched(spark, d).drop("outcome"))


def catalog_summary(spark, d):
    return quality.catalog_summary(fixtures.copy_b(spark, d).na.replace("Spatial PROMO", None, ["product"]))


def field_catalog(spark, d):
    return quality.field_catalog(_catalogue(spark, d))


# ---- runs ------------------------------------------------------------------------------------


def stage_timestamps(spark, d):
    return runs.stage_timestamps(fixtures.stage_events(spark, d))


def run_outcome(spark, d):
    return runs.run_outcome(fixtures.stage_events(spark, d, by_day=True))


def stage_status(spark, d):
    code = F.col("exit_code")
    kinds = [stage_status_expr(code, kind).alias(f"{kind}_status") for kind in rules.STAGE_STATUS]
    return fixtures.stage_events(spark, d).select("event_id", *kinds)


def stage_durations(spark, d):
    return runs.stage_durations(fixtures.stage_events(spark, d)).select("event_id", "duration")


# ---- streaming and the whole path ------------------------------------------------------------


def stream_ingest(spark, d):
    """Page files to records by a stream that stops when all are read."""
    pages_in, out = scratch_path(spark, "pages-in"), scratch_path(spark, "records-out")
    fixtures.listing_pages(spark, d).repartition("run", "page_num").write.parquet(pages_in)
    ingest.stream_pages(spark, pages_in, out, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(*listing.ORDER, "dataset_name", "dataset_url", *listing.METADATA)


def stream_stop_rule(spark, d):
    """Pages in three waves, neither in order; the records before the page each run stops at in the end."""
    pages_in, out = scratch_path(spark, "pages-in"), scratch_path(spark, "stops-out")
    pages = stage(fixtures.listing_pages(spark, d), "listing-pages")
    for wave in range(3):
        some = pages.where(F.pmod(F.xxhash64("run", "page_num"), F.lit(3)) == wave)
        some.repartition("run", "page_num").write.mode("append").parquet(pages_in)
        stops.stream_stops(spark, pages_in, out)
    first = listing.dedup_first_seen(listing.listing_records(listing.listing_entries(pages)))
    return listing.before_stops(first, stops.stops(spark, out))


def catalogue_flow(spark, d):
    """Records, enriched, with files, checked against their pages: status of every record."""
    checked = _checked_catalogue(spark, d)
    return checked.select(
        "dataset_url",
        "microscope",
        "date_published",
        "files_found_count",
        "file_extraction_status",
        "status",
    )


def _crawled(spark, d) -> DataFrame:
    """Listing pages to records stored per run, and these to records checked against their pages."""
    path = scratch_path(spark, "records")
    io.replace_stage(flow.crawl_records(_stored_entries(spark, d)), path)
    stored = spark.read.schema(schemas.CRAWLED).parquet(path)
    return flow.catalogue(stored, fixtures.part_pages(spark, d))


def crawl_to_status(spark, d):
    """From listing pages to the status of every record; of some pages there are older copies."""
    return _crawled(spark, d).select(
        "run",
        "dataset_url",
        "dataset_name",
        "microscope",
        "date_published",
        "files_found_count",
        "file_extraction_status",
        "outcome",
        F.size("differences").alias("n_differences"),
        "status",
    )


def crawl_report(spark, d):
    """The same path to its end: both written copies compared by place per run, and the report of every run."""
    base = scratch_path(spark, "crawl")
    checked = stage(_crawled(spark, d), "checked")
    flat = ["run", *schemas.BASE_FIELDS]
    rows = checked.orderBy(*listing.ORDER).select(*flat)
    io.write_records(rows, f"{base}/records")
    io.write_tabular(rows, f"{base}/sheet", flat)
    schema = T.StructType(schemas.strings(*flat))
    a = io.read_records(spark, f"{base}/records", schema, lines=True, index="row_idx")
    b = io.read_tabular(spark, f"{base}/sheet", schema, index="row_idx")
    checks = stage(validate.consistency_summary(a, b, by=("run",)), "consistency")
    counts = validate.status_counts(checked, ["run"])
    coded = validate.exit_code(counts, checks, checked, by=("run",))
    report = validate.validation_report(coded, checks, F.lit(REPORT_TIME), by=("run",))
    return report.select("run", "total_datasets", "file_consistency.*", "url_validation.*", "exit_code")


_NAMED_OTHERWISE = {"enrich": enrich_records}
_PLAIN = [
    read_pages,
    records_roundtrip,
    tabular_roundtrip,
    column_order,
    archive_pages,
    validation_report,
    replace_stage,
    latest_report,
    artifact_inventory,
    stored_artifacts,
    report_summary,
    report_full,
    report_issues,
    url_params,
    url_set_page,
    listing_urls,
    link_filter,
    resolve_links,
    layout_probe,
    layout_probe_listing,
    table_rows,
    row_links,
    squash_ws,
    cells_positional,
    cells_pattern,
    fallback_links,
    fallback_links_listing,
    dedup_first_seen,
    stop_rule,
    page_stats,
    column_widths,
    embedded_json,
    dataset_node,
    body_sections,
    body_sections_documents,
    section_first_line,
    section_kv,
    imaging_fields,
    sample_fields,
    sample_lists,
    donor_count,
    date_published,
    image_type_text,
    disease_text,
    preservation_text,
    filesets,
    explode_files,
    file_names,
    human_size,
    parse_size,
    classify_files,
    attach_files,
    attach_files_flat,
    file_stats,
    files_wide,
    count_check,
    row_diff,
    consistency_summary,
    row_diff_files,
    row_diff_by_run,
    consistency_by_run,
    exit_code_by_run,
    key_coverage,
    page_heading,
    body_text,
    detect_fields,
    compare_fields,
    url_status,
    status_counts,
    validation_exit,
    report_rows,
    issues_only,
    issues_by_run,
    field_completion,
    field_statistics,
    catalog_summary,
    field_catalog,
    stage_timestamps,
    run_outcome,
    stage_status,
    stage_durations,
    stream_ingest,
    stream_stop_rule,
    catalogue_flow,
    crawl_to_status,
    crawl_report,
]


def _tuned(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def all_queries() -> dict:
    named = {query.__name__: query for query in _PLAIN} | _NAMED_OTHERWISE
    return {name: _tuned(query) for name, query in named.items()}
