"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Pages are derived from the tables once and stored, as a crawl would leave them; the timings are those
of the operators over the stored pages, whole tables, best of two runs, written to a sink that keeps
nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pagecat.operators import enrich, files, listing, quality, runs, validate  # noqa: E402
from pagecat.plans import fixtures, flow, queries  # noqa: E402
from pagecat.session import STATIC_SETTINGS, scratch_path, tune  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("pagecat-bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=STATIC_SETTINGS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, f"bench-{name}")
    df.repartition(4 * int(CPUS)).write.parquet(path)
    return spark.read.parquet(path)


def seconds(make) -> float:
    best = None
    for _ in range(2):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return round(best, 3)


def main() -> None:
    spark = session()
    d = SF_DIR
    start = time.perf_counter()
    listing_pages = stored(spark, fixtures.listing_pages(spark, d), "listing")
    pages = stored(spark, fixtures.detail_pages(spark, d), "detail")
    records = stored(spark, fixtures.order_records(spark, d), "records")
    entries = stored(spark, listing.listing_entries(listing_pages), "entries")
    catalogue = stored(spark, flow.catalogue(records, pages), "catalogue")
    checked = fixtures.page_records(spark, d), stored(spark, fixtures.record_pages(spark, d), "told")
    copies = stored(spark, fixtures.copy_a(spark, d), "a"), stored(spark, fixtures.copy_b(spark, d), "b")
    events = stored(spark, fixtures.stage_events(spark, d), "events")
    prepared = time.perf_counter() - start

    named = queries.all_queries()
    jobs = {
        "listing_entries": lambda: listing.listing_entries(listing_pages),
        "crawl_records": lambda: flow.crawl_records(entries),
        "page_stats": lambda: listing.page_stats(
            listing.dedup_first_seen(listing.listing_records(entries)), entries
        ),
        "enrich": lambda: enrich.enrich(records, pages),
        "attach_files": lambda: files.attach_files(records, files.page_files(pages)),
        "catalogue": lambda: flow.catalogue(records, pages),
        "url_status": lambda: validate.url_status(
            validate.compare_fields(checked[0], validate.extract_page_fields(checked[1]))
        ),
        "row_diff": lambda: validate.row_diff(*copies),
        "field_completion": lambda: quality.field_completion(catalogue),
        "field_statistics": lambda: quality.field_statistics(catalogue.drop("files", "differences")),
        "file_rows": lambda: catalogue.select("dataset_url", F.inline("files")),
        "stage_timestamps": lambda: runs.stage_timestamps(events),
        "page_heading": lambda: named["page_heading"](spark, d),
        "body_text": lambda: named["body_text"](spark, d),
        "detect_fields": lambda: named["detect_fields"](spark, d),
        "squash_ws": lambda: named["squash_ws"](spark, d),
        "human_size": lambda: named["human_size"](spark, d),
        "parse_size": lambda: named["parse_size"](spark, d),
    }
    timings = {name: seconds(job) for name, job in jobs.items()}
    n = records.count()
    print(
        json.dumps(
            {
                "metric": "seconds over all headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(os.path.basename(d.rstrip("/")).removeprefix("sf")),
                "records": n,
                "catalogue_ms_per_record": round(timings["catalogue"] / n * 1000, 4),
                "prepare_sec": round(prepared, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
