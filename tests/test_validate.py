"""Copies against copies, records against pages, reports."""

import pytest
from pyspark.sql import functions as F

from pagecat.operators import quality, runs, validate
from pagecat.schemas import BASE_RECORD
from pagecat.sources import io

URL = "https://example.com/datasets/x"
SCHEMA = "row_idx bigint, dataset_url string, species string"


def copy(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def test_nulls_equal_blanks_and_rows_align_by_position(spark):
    a = copy(spark, ("u", ""), ("v", "Human"), ("w", None))
    b = copy(spark, ("u", None), ("v", "human"), ("w", ""))
    (row,) = validate.row_diff(a, b).collect()
    assert (row.row, row.dataset_url) == (2, "v")
    assert [tuple(d) for d in row.differences] == [("changed", "species", "Human", "human")]


def test_added_removed_and_type_changes(spark):
    a = copy(spark, ("u", "7"), schema="row_idx bigint, dataset_url string, species string")
    b = spark.createDataFrame([(0, "u", 7, "x")], "row_idx bigint, dataset_url string, species int, extra string")
    kinds = {(d.kind, d.field) for d in validate.row_diff(a, b.drop("dataset_url")).first().differences}
    assert kinds == {("removed", "dataset_url"), ("type_changed", "species"), ("added", "extra")}


def test_unequal_counts_are_one_mismatch(spark):
    a, b = copy(spark, ("u", "x"), ("v", "y")), copy(spark, ("u", "z"))
    got = validate.consistency_summary(a, b).first()
    assert tuple(got) == (False, 2, 1, 1)
    assert validate.count_check(a, b).first().message == "Entry count mismatch: JSON has 2, Excel has 1"
    assert tuple(validate.consistency_summary(a, a).first()) == (True, 2, 2, 0)


def test_key_coverage(spark):
    a, b = copy(spark, ("u", ""), ("v", ""), ("v", "")), copy(spark, ("v", ""), ("w", ""))
    assert sorted(map(tuple, validate.key_coverage(a, b).collect())) == [("u", "only_in_a"), ("w", "only_in_b")]


def check(spark, record, body, heading="Name"):
    records = spark.createDataFrame([record], BASE_RECORD)
    pages = spark.createDataFrame([(URL, f"<body><h1>{heading}</h1><p>{body}</p></body>")], "url string, html string")
    compared = validate.compare_fields(records, validate.extract_page_fields(pages))
    row = validate.url_status(compared).first()
    return row.status, [(d.field, d.severity) for d in row.differences]


@pytest.mark.parametrize(
    "record, body, heading, expected",
    [
        (("Name", URL, "", "Human", "Breast", "", "FFPE"), "human breast ffpe", "name", ("verified", [])),
        (("Name", URL, "", "Human", "Lymph", "", "fresh-frozen"), "human lymph node fresh frozen", "Name", ("verified", [])),
        (("Name", URL, "", "Mouse", "", "", ""), "Human cells", "Name", ("mismatched", [("species", "error")])),
        (("Name", URL, "", "Mouse", "Lung", "", ""), "mouse skin", "Name", ("warning", [("sample_type", "warning")])),
        (("Name", URL, "", "Rat", "Lung", "", "x"), "nothing known", "Other", ("warning", [("dataset_name", "warning")])),
        (("Name", URL, "", "Rat", "Lung", "", "FFPE"), "fixed frozen", "", ("warning", [("preservation", "warning")])),
        (("Name", URL + "y", "", "Human", "", "", ""), "human", "Name", ("failed", [("page_load", "error")])),
    ],
)
def test_statuses(spark, record, body, heading, expected):
    assert check(spark, record, body, heading) == expected


def results(spark, *statuses):
    rows = [(i, f"u{i}", "n" * 70, s, []) for i, s in enumerate(statuses)]
    entry = "array<struct<field:string,severity:string,scraped_value:string,actual_value:string,message:string>>"
    return spark.createDataFrame(rows, f"row_idx bigint, dataset_url string, dataset_name string, status string, differences {entry}")


@pytest.mark.parametrize(
    "statuses, equal, pages, expected",
    [
        (["verified", "warning"], True, 1, 0),
        (["verified", "mismatched"], True, 1, 1),
        (["failed", "verified"], True, 1, 1),
        (["verified"], False, 1, 1),
        (["failed", "failed"], True, 0, 2),
        ([], True, 1, 2),
    ],
)
def test_exit_codes(spark, statuses, equal, pages, expected):
    a, b = copy(spark, ("u", "x")), copy(spark, ("u", "x" if equal else "y"))
    counts = validate.status_counts(results(spark, *statuses))
    corpus = spark.range(pages)
    assert validate.exit_code(counts, validate.consistency_summary(a, b), corpus).first().exit_code == expected


def test_worked_report(spark):
    counts = validate.status_counts(results(spark, *["verified"] * 18, "mismatched"))
    consistency = validate.consistency_summary(copy(spark, ("u", "x")), copy(spark, ("u", "x")))
    coded = validate.exit_code(counts, consistency)
    row = validate.validation_report(coded, consistency, F.lit("2025-10-30T09:30:00Z")).first().asDict(True)
    assert row["total_datasets"] == 19
    assert row["url_validation"] == {"verified": 18, "mismatched": 1, "warnings": 0, "failed_urls": 0}
    assert row["file_consistency"]["passed"] is True
    assert row["exit_code"] == 1


def test_report_rows_and_issues(spark):
    found = results(spark, "verified", "warning", "failed")
    rows = validate.report_rows(found).orderBy("row").collect()
    assert [r.status_label for r in rows] == ["✓ VERIFIED", "⚠ WARNING", "✗ FAILED"]
    assert (rows[0].row, rows[0].name, rows[0].differences) == (1, "n" * 60, "-")
    issues = validate.issues_only(found).collect()
    assert {(r.status, r.total_issues) for r in issues} == {("warning", 2), ("failed", 2)}


def test_filled_is_by_type(spark):
    df = spark.createDataFrame(
        [("a", 0, [], "N/A"), ("", 2, [1], None), ("b", None, None, "x")], "s string, n int, l array<int>, t string"
    )
    got = {r.field: (r.filled, r.completion_rate) for r in quality.field_completion(df).collect()}
    assert got == {"s": (2, 66.7), "n": (1, 33.3), "l": (1, 33.3), "t": (2, 66.7)}
    empty = quality.field_completion(df.limit(0)).collect()
    assert {(r.total, r.completion_rate) for r in empty} == {(0, 0.0)}


def test_field_statistics(spark):
    df = spark.createDataFrame([("a", [1]), ("a", []), ("", [1])], "s string, l array<int>")
    rows = {(r.field, r.value): r for r in quality.field_statistics(df).collect()}
    assert rows["s", "a"].value_count == 2 and rows["s", "a"].unique_values_count == 1
    assert rows["l", "[1]"].value_count == 2 and rows["l", "[1]"].completion_rate == 66.7
    assert {r.field for r in quality.field_statistics(df, "s").collect()} == {"s"}
    with pytest.raises(KeyError, match="available: s, l"):
        quality.field_statistics(df, "nope")


def test_example_fill_rates(spark):
    df = spark.createDataFrame([("m" if i < 16 else "", "d" if i < 18 else "") for i in range(19)], "microscope string, disease_state string")
    got = {r.field: (r.filled, r.total) for r in quality.field_completion(df).collect()}
    assert got == {"disease_state": (18, 19), "microscope": (16, 19)}


def test_catalog_summary_counts_missing_as_unknown(spark):
    df = spark.createDataFrame([("Human", "p", None), (None, "", "Lung")], "species string, product string, sample_type string")
    got = {(r.field, r.value, r.records, r.total_datasets) for r in quality.catalog_summary(df).collect()}
    assert ("species", "Unknown", 1, 2) in got and ("product", "", 1, 2) in got and len(got) == 6


def test_timestamps_and_outcomes(spark):
    rows = [
        ("r", "scraper", "2024-01-01 00:00:00", "2024-01-01 00:00:01", 0, "success"),
        ("r", "scraper", "2024-01-02 00:00:00", "2024-01-02 00:00:01", 2, "error"),
        ("r", "metadata_enricher", "2024-01-01 00:00:00", "2024-01-01 00:01:01.125", 1, "failed"),
        ("ok", "scraper", "2024-01-01 00:00:00", "2024-01-01 00:00:00", 0, "success"),
        ("ok", "validator", None, None, None, "user_skipped"),
    ]
    events = spark.createDataFrame(rows, "run string, name string, a string, b string, exit_code int, status string").select(
        "run", "name", F.to_timestamp("a").alias("start_time"), F.to_timestamp("b").alias("end_time"), "exit_code", "status"
    )
    got = {(r.run, r.task): r.time for r in runs.stage_timestamps(events).collect()}
    assert got["r", "scraper"] == "2024-01-01 00:00:01"  # exit code 2 leaves the old time
    assert got["r", "metadata-enricher"] == "2024-01-01 00:01:01"
    assert got["r", "file-extractor"] == "" and len(got) == 8
    assert {r.run: r.overall_status for r in runs.run_outcome(events).collect()} == {"r": "failed", "ok": "success"}
    durations = [r.duration for r in runs.stage_durations(events).collect()]
    assert durations == ["1.00s", "1.00s", "61.12s", "0.00s", None]


def test_sources_and_sinks(spark, tmp_path):
    from pagecat.schemas import BASE_FIELDS

    rows = [("007", "u", "N/A", None, ' "q", x ', "é\n2", "")]
    df = spark.createDataFrame(rows, BASE_RECORD)
    io.write_records(df, f"{tmp_path}/json")
    text = "".join(r.value for r in spark.read.text(f"{tmp_path}/json").collect())
    assert '"species":null' in text and "é" in text
    blanks = ["" if v is None else v for v in rows[0]]
    assert list(io.read_records(spark, f"{tmp_path}/json", BASE_RECORD, lines=True).first()) == blanks
    (tmp_path / "array.json").write_text('[\n  {"dataset_name": "a"},\n  {"dataset_name": "b", "species": null}\n]')
    assert io.read_records(spark, f"{tmp_path}/array.json", BASE_RECORD).count() == 2
    flat = df.withColumn("cells_or_nuclei", F.lit("N/A"))
    assert io.write_tabular(flat, f"{tmp_path}/csv", BASE_FIELDS)
    back = io.read_tabular(spark, f"{tmp_path}/csv", BASE_RECORD).first()
    assert (back.dataset_name, back.product, back.species, back.sample_type) == ("007", "N/A", "", ' "q", x ')
    assert not io.write_tabular(df.limit(0), f"{tmp_path}/none", BASE_FIELDS)
    assert not (tmp_path / "none").exists()


def test_loose_pages_and_artifacts(spark, tmp_path):
    folder = tmp_path / "out" / "r1" / "output"
    folder.mkdir(parents=True)
    (folder / "Data-r1.json").write_text("[]")
    (folder / "Data-r1.xlsx").write_text("x")
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.html").write_text("<p>one\ntwo</p>")
    assert io.read_page_files(spark, str(pages)).first().html == "<p>one\ntwo</p>"
    listed = io.list_artifacts(spark, f"{tmp_path}/out")
    got = io.artifact_inventory(listed).first()
    assert (got.scrape_completed, got.validation_completed, got.has_html) == (True, False, False)
