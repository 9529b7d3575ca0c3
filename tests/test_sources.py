"""Row positions, stored reports and artifacts of several runs."""

import json

from pyspark.sql import functions as F

from pagecat import schemas
from pagecat.operators import validate
from pagecat.sources import io, reports

FIELDS = schemas.BASE_FIELDS


def record(k):
    return {f: f"{f}-{k}" + " x" * (k % 50) for f in FIELDS}


def positions(df):
    return sorted((r.row_idx, r.dataset_name) for r in df.collect())


def test_positions_over_files_and_splits(spark, tmp_path):
    want = [(k, record(k)["dataset_name"]) for k in range(400)]
    (tmp_path / "lines").mkdir()
    (tmp_path / "array").mkdir()
    (tmp_path / "flat").mkdir()
    ends = [0, 7, 7, 330, 331, 400]  # one file is empty, one is much larger
    for n, (begin, end) in enumerate(zip(ends, ends[1:])):
        rows = [record(k) for k in range(begin, end)]
        (tmp_path / "lines" / f"part-{n:05}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
        (tmp_path / "array" / f"part-{n:05}.json").write_text(json.dumps(rows, indent=2))
        (tmp_path / "flat" / f"part-{n:05}.csv").write_text("\n".join([",".join(FIELDS), *(",".join(r.values()) for r in rows)]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # the large file is cut into many splits
    try:
        lines = io.read_records(spark, str(tmp_path / "lines"), schemas.BASE_RECORD, lines=True, index="row_idx")
        flat = io.read_tabular(spark, str(tmp_path / "flat"), schemas.BASE_RECORD, index="row_idx")
        assert spark.read.text(str(tmp_path / "lines")).rdd.getNumPartitions() > 10
        assert positions(lines) == positions(flat) == want
        assert validate.row_diff(lines, flat).collect() == []
        array = io.read_records(spark, str(tmp_path / "array"), schemas.BASE_RECORD, index="row_idx")
        assert positions(array) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_window_over_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(record(1)) + "\n")
    rows = io.read_records(spark, str(tmp_path), schemas.BASE_RECORD, lines=True, index="row_idx")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "HashAggregate" in window  # only splits, already counted, reach the window


def results(spark, rows):
    schema = "run string, dataset_url string, dataset_name string, status string, differences array<struct<field:string,severity:string,scraped_value:string,actual_value:string,message:string>>"
    return spark.createDataFrame([(*r, []) for r in rows], schema)


def reported(spark, path, rows, checks, timestamp):
    found = results(spark, rows)
    consistency = spark.createDataFrame(checks, "run string, passed boolean, json_count long, excel_count long, mismatch_count long")
    coded = validate.exit_code(validate.status_counts(found, ["run"]), consistency, found.select("run"), by=("run",))
    report = validate.validation_report(coded, consistency, F.lit("now"), by=("run",))
    return reports.store(report, found, path, timestamp)


def test_reports_of_several_runs(spark, tmp_path):
    path = str(tmp_path / "reports")
    first = [("a", "u1", "n1", "verified"), ("a", "u2", "n2", "failed"), ("b", "u3", "n3", "verified"), (None, "u4", "n4", "warning")]
    checks = [("a", True, 2, 2, 0), ("b", False, 1, 2, 1), (None, True, 1, 1, 0)]
    reported(spark, path, first, checks, "2024-01-01_00-00-00")
    name = reported(spark, path, [("a", "u1", "n1", "mismatched")], [("a", False, 1, 1, 1)], "2024-01-02_00-00-00")
    summary = {r.run: r for r in reports.summary(spark, path).collect()}
    assert set(summary) == {"a", "b", None}  # one report per run, not one per run and check
    assert summary["a"].report == name and summary["a"].url_validation.mismatched == 1
    assert [summary[r].file_consistency.passed for r in ("a", "b", None)] == [False, False, True]
    full = {(r.run, r.dataset_url, r.status) for r in reports.full(spark, path).collect()}
    assert full >= {("a", "u1", "mismatched"), ("b", "u3", "verified")} and len(full) == 3
    issues = {(r.run, r.total_issues, r.file_consistency_passed, r.dataset_url) for r in reports.issues(spark, path).collect()}
    assert issues >= {("a", 1, False, "u1"), ("b", 0, False, None)}


def test_report_per_run_and_issue_totals(spark):
    found = results(spark, [("a", "u1", "n", "failed"), ("a", "u2", "n", "warning"), ("b", "u3", "n", "mismatched"), ("b", "u4", "n", "verified")])
    totals = sorted((r.run, r.dataset_url, r.total_issues) for r in validate.issues_only(found, by=("run",)).collect())
    assert totals == [("a", "u1", 2), ("a", "u2", 2), ("b", "u3", 1)]
    assert {r.total_issues for r in validate.issues_only(found).collect()} == {3}


def test_artifacts_from_storage(spark, tmp_path):
    for path, text in {
        "r1/output/Data-r1.json": '{"dataset_url": "a"}\n{"dataset_url": "b"}\n\n',
        "r1/output/Data-r1.csv": "x\n",
        "r1/input/URL-r1.txt": "u\n",
        "r1/reports/validation_report_2.json": "{}\n",
        "r1/reports/validation_report_1.json": "{}\n",
        "r2/output/Data-r2.json/part-0.json": '{"dataset_url": "a"}\n',
        "r2/output/Data-r2.json/part-1.json": '{"dataset_url": "b"}\n',
        "r2/other/notes.txt": "n\n",
    }.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)
    listed = io.list_artifacts(spark, str(tmp_path))
    assert listed.where("run = 'r2'").count() == 1  # two parts, one artifact
    found = {r.run: r for r in io.artifact_inventory(listed, io.artifact_records(spark, str(tmp_path))).collect()}
    assert found["r1"].datasets_count == 2 and found["r1"].report_files == 2 and found["r1"].latest_report == "validation_report_2.json"
    assert found["r2"].has_json and not found["r2"].scrape_completed and found["r2"].datasets_count is None
    (tmp_path / "r1/output/Data-r1.json").write_text('[{"dataset_url": "a"},\n {"dataset_url": "b"}, {"dataset_url": null}]')
    arrays = {r.run: r.datasets_count for r in io.artifact_records(spark, str(tmp_path), lines=False).collect()}
    assert arrays["r1"] == 3
