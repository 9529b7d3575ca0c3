"""Validation reports as they are stored: a header per run, and the single results beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecat.operators.validate import issue_expr
from pagecat.schemas import URL_RESULT, strings
from pagecat.sources import io

HEADER = ["validation_timestamp", "total_datasets", "file_consistency", "url_validation"]


def store(report: DataFrame, results: DataFrame, path: str, timestamp: str) -> str:
    """Write the report of some runs and its results, a folder per report and run. Returns the report's name.

    The results come first: a header that can be read has all its results. Writing the same time again
    replaces the runs in ``results`` and the report.
    """
    name = f"validation_report_{timestamp}.json"
    (
        results.select(*URL_RESULT.fieldNames(), F.lit(name).alias("report"), "run")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report", "run")
        .parquet(f"{path}/results")
    )
    io.write_report(report, path, timestamp)
    return name


def _results(spark: SparkSession, path: str) -> DataFrame:
    """Results of all reports; report and run are folders, so a join on them leaves the others unread."""
    schema = T.StructType([*URL_RESULT.fields, *strings("report", "run")])
    return spark.read.schema(schema).parquet(f"{path}/results")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """Newest report of every run: its time, total, consistency and counts by status."""
    return io.latest_report(spark, path).select("run", "report", *HEADER)


def full(spark: SparkSession, path: str) -> DataFrame:
    """Newest report of every run, whole: a row per result, the header's fields on each."""
    newest = io.latest_report(spark, path).select("run", "report", *HEADER, "exit_code")
    return newest.join(_results(spark, path), ["report", "run"], "left")


def issues(spark: SparkSession, path: str) -> DataFrame:
    """Problems in the newest report of every run, with their total and whether the copies agreed.

    A run without problems has one row, its total 0 and no result. A report without a consistency check
    counts as passed.
    """
    status = F.col("url_validation")
    newest = io.latest_report(spark, path).select(
        "run",
        "report",
        (status["mismatched"] + status["warnings"] + status["failed_urls"]).alias("total_issues"),
        F.coalesce(F.col("file_consistency.passed"), F.lit(True)).alias("file_consistency_passed"),
    )
    return newest.join(_results(spark, path).where(issue_expr()), ["report", "run"], "left")
