"""Properties of plans that decide how the operators behave on large and skewed data."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from pagecat import session
from pagecat.operators import enrich, files, joins, listing, quality, validate
from pagecat.operators.joins import lookup_join, one_per_key
from pagecat.plans import fixtures, flow
from pagecat.schemas import FILE

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def detail(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("detail"))
    fixtures.detail_pages(spark, SF_DIR).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def entries(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("entries"))
    listing.listing_entries(fixtures.listing_pages(spark, SF_DIR)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_no_query_leaves_the_jvm_or_pairs_rows(spark):
    for name in ("catalogue_flow", "stop_rule", "field_statistics", "report_rows", "body_text"):
        text = plan(queries()[name](spark, SF_DIR))
        assert not re.search(r"Python|Pandas|CartesianProduct", text), name


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k in names:
        spark.conf.unset(k)


@pytest.fixture
def staged(monkeypatch):
    """Plans of the tables written on the way."""
    plans = []
    monkeypatch.setattr(joins, "stage", lambda df, name: plans.append(plan(df)) or session.stage(df, name))
    return plans


def test_a_page_is_scanned_and_parsed_once(spark, detail, staged):
    records = fixtures.order_records(spark, SF_DIR)
    text = plan(flow.catalogue(records, detail)) + "".join(staged)
    assert len(re.findall(r"ReadSchema: struct<url:string,html:string>", text)) == 1
    assert text.count("from_json(") == 1



@pytest.mark.parametrize("build", [flow.catalogue, enrich.enrich, lambda r, p: files.attach_files(r, files.page_files(p))], ids=["catalogue", "enrich", "files"])
def test_facts_are_shuffled_and_sorted_once(spark, detail, staged, no_broadcast, build):
    text = plan(build(fixtures.order_records(spark, SF_DIR), detail))
    assert "Exchange" not in "".join(staged) and "Sort" not in "".join(staged)
    # The side of the last join that reads the facts: scan, one exchange, one sort, nothing else.
    wide = text[text.rindex("SortMergeJoin [_row") :] if "SortMergeJoin [_row" in text else text
    assert text.count("Exchange hashpartitioning(_row#") == 2  # records with the winner's number, and the facts
    narrow = [n for n in re.findall(r"ReadSchema: struct<(.*?)>\n", text + "\n") if n.startswith("dataset_url:string,_rank:")]
    assert narrow == ["dataset_url:string,_rank:decimal(38,0),_row:bigint"]  # all that copies are compared by
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and "partial_max_by(_row" in text
    assert wide.count("Sort [_row#") == 2


def test_best_copy_wins_and_hot_keys_are_split(spark, staged):
    n = F.col("id")
    records = spark.range(3000).select(F.when(n % 3 == 0, "hot").when(n % 3 == 1, "none").otherwise(n.cast("string")).alias("k"), n.alias("own"))
    facts = spark.range(3000).select(F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("k"), (n % 7).alias("good"), F.array(n).alias("files"))
    rank = joins.rank_expr(F.col("good"), F.col("files"))
    out = joins.best_lookup(records, facts, "k", rank).collect()
    assert len(out) == 3000 and {r.good for r in out if r.k == "hot"} == {6}
    assert len({tuple(r.files) for r in out if r.k == "hot"}) == 1
    assert all(r.files is None for r in out if r.k == "none")
    assert all(r.files == [int(r.k)] for r in out if r.k.isdigit())


def test_only_needed_columns_are_read(spark, entries):
    rows = listing.dedup_first_seen(listing.listing_records(entries))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan(listing.new_per_page(rows, entries)) + "\n")
    assert "run:string,page_num:int" in schemas
    widths = plan(listing.column_width_profile(spark.read.parquet(f"{SF_DIR}/supplier.parquet").select("s_name")))
    assert "ReadSchema: struct<s_name:string>" in widths


def test_filters_reach_the_scan(spark, detail):
    wanted = detail.where(F.col("url") == "https://catalog.example.com/datasets/o-1")
    assert "PushedFilters: [IsNotNull(url), EqualTo(url," in plan(enrich.page_fields(wanted))


def test_dedup_shrinks_before_the_shuffle(spark, entries):
    text = plan(listing.dedup_first_seen(listing.listing_records(entries)))
    assert "Window" not in text and "partial_min_by" in text
    assert "partial_max_by" in plan(one_per_key(spark.range(3).withColumn("x", F.lit(1)), "id", F.col("x")))
    assert "Window" not in plan(listing.stop_pages(listing.listing_records(entries), entries))


def test_windows_see_bounded_blocks(spark, entries):
    rows = listing.dedup_first_seen(listing.listing_records(entries))
    text = plan(listing.page_stats(rows, entries))
    windows = [w.split(" ASC")[0] for w in re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", text)]
    names = [[c.split("#")[0].strip() for c in w.split(",")] for w in windows]
    # Pages in order within a block of a run; blocks in order within a run, one for 1,024 pages.
    assert sorted(set(map(tuple, names))) == [("run", "block"), ("run", "block", "page_num")]


def test_hot_key_of_a_lookup_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = F.col("id")
        records = spark.range(0, 200_000, 1, 8).select(
            F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("dataset_url"), F.md5(n.cast("string")).alias("v")
        )
        pages = spark.range(0, 200_000, 1, 8).select(
            F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("dataset_url"), n.alias("seen")
        )
        joined = lookup_join(records, one_per_key(pages, "dataset_url", F.col("seen")), "dataset_url")
        found = joined.groupBy(F.spark_partition_id().alias("p"), "dataset_url").count()
        hot = [r["count"] for r in found.where("dataset_url = 'hot'").collect()]
        assert sum(hot) == 66_667
        assert len(hot) > 1
        joined.collect()
        assert "skew=true" in plan(joined)
        assert joined.where("seen is null").count() == 0
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_hot_listing_url_and_hot_run(spark):
    """A third of the rows is one URL, all in one run: results are those of a plain loop."""
    rows = spark.range(30_000).select(
        F.lit("r").alias("run"),
        (F.col("id") / 100).cast("int").alias("page_num"),
        (F.col("id") % 100).cast("int").alias("pos"),
        F.lit("n").alias("dataset_name"),
        F.when((F.col("id") % 3 == 0) | (F.col("id") >= 15_000), "hot").otherwise(F.col("id").cast("string")).alias("dataset_url"),
    )
    pages = rows.select("run", "page_num").distinct().withColumn("layout", F.lit("link"))
    first = listing.dedup_first_seen(rows)
    kept = listing.apply_stop_rule(first, pages)
    assert first.count() == kept.count() == 10_001
    stop = listing.stop_pages(first, pages).first()
    assert (stop.run, stop.stop) == ("r", 152)
    stats = {r.page_num: r.running_total for r in listing.page_stats(first, pages, block=16).collect()}
    assert len(stats) == 300 and stats[299] == 10_001 and stats[0] == 67


def test_key_coverage_and_statistics_need_no_group_in_memory(spark):
    a = fixtures.copy_a(spark, SF_DIR)
    assert "collect_" not in plan(validate.key_coverage(a, a)) + plan(quality.field_statistics(a))


def test_pages_are_built_from_sorted_lines_without_a_hash_table(spark):
    """Lines are grouped once, as they come sorted; no partial aggregate, no fall back to sorting."""
    built = plan(fixtures.detail_pages(spark, SF_DIR))
    assert built.count("SortAggregate") == 1 and "ObjectHashAggregate" not in built


def test_flat_files_are_nested_without_a_stage(spark, monkeypatch):
    def refuse(df, name):
        raise AssertionError(f"{name} was written")

    monkeypatch.setattr(joins, "stage", refuse)
    schema = f"dataset_url string, set_pos int, file_pos int, kind string, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in FILE)}"
    file = ("output", "t", "CSV", "a.csv", "1 B", 1, "m", "u")
    flat = spark.createDataFrame([("a", 0, 1, *file), ("a", 0, 0, *file), ("a", 0, 0, *file), (None, 0, 0, *file)], schema)
    records = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "dataset_url string, n int")
    found = files.attach_files(records, flat).select("n", "files_found_count", "file_extraction_status").collect()
    assert sorted(map(tuple, found)) == [(1, 2, "success"), (2, 2, "success"), (3, 0, "failed"), (4, 0, "failed")]


FILE_TYPES = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FILE)


def copies(spark, n, page, places=2):
    """Flat rows of ``n`` copies of pages, dealt to 8 tasks; a copy's number is its files' size."""
    rows = spark.range(0, n, 1, 8).select(page.alias("dataset_url"), F.col("id").alias("size_bytes"), F.explode(F.sequence(F.lit(0), F.lit(places - 1))).alias("file_pos"))
    text = {"kind": "output", "file_title": "t", "file_type": "CSV", "filename": "a.csv", "size": "1 B", "md5sum": "m"}
    values = {"set_pos": F.col("size_bytes").cast("int") % 1, "set_name": F.lit("Files"), **{k: F.lit(v) for k, v in text.items()}, "url": F.format_string("u%s", "file_pos")}
    return rows.withColumns(values)


def sizes(filed):
    return {r.n: (r.file_extraction_status, [f.size_bytes for f in r.files]) for r in filed.collect()}


def test_flat_files_move_once(spark, no_broadcast):
    """Between the shuffle of the flat rows and the records' join: one sort, no other shuffle."""
    flat = copies(spark, 100, F.format_string("p%s", F.col("id") % 10))
    text = plan(files.attach_files(spark.range(10).select(F.format_string("p%s", "id").alias("dataset_url")), flat))
    nested = text[text.index("SortAggregate") : text.index("ShuffledHashJoin")]
    assert "Exchange" not in nested and "ObjectHashAggregate" not in text
    assert len(re.findall(r"\bSort \[", nested)) == 1
    assert re.search(r"ShuffledHashJoin.*\n[ :+-]*Exchange hashpartitioning\(dataset_url#\d+, _key_hash#\d+L", text)


def test_flat_copies_of_a_hot_page_are_split(spark, no_broadcast):
    """A page with most of all copies: its rows are read by several tasks, and its list is still one page's."""
    small = {"skewJoin.skewedPartitionThresholdInBytes": "2k", "skewJoin.skewedPartitionFactor": "2", "advisoryPartitionSizeInBytes": "2k", "coalescePartitions.enabled": "false"}
    for k, v in small.items():
        spark.conf.set(f"spark.sql.adaptive.{k}", v)
    try:
        n = F.col("id")
        flat = copies(spark, 20_000, F.when(n % 50 != 0, "hot").when(n % 100 == 0, F.format_string("p%s", n % 1000)))
        records = spark.createDataFrame([("hot", 1), ("hot", 2), ("p100", 3), ("none", 4), (None, 5)], "dataset_url string, n int")
        filed = files.attach_files(records, flat)
        found = sizes(filed)
        text = plan(filed)
    finally:
        for k in small:
            spark.conf.unset(f"spark.sql.adaptive.{k}")
    hot, none = ("success", [19_999, 19_999]), ("failed", [])
    assert found == {1: hot, 2: hot, 3: ("success", [19_100, 19_100]), 4: none, 5: none}
    assert "ShuffledHashJoin(skew=true)" in text


def test_a_hot_key_of_the_records_is_still_split(spark, monkeypatch):
    records = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4), (None, 5)], "dataset_url string, n int")
    flat = copies(spark, 40, F.when(F.col("id") % 2 == 0, "a").otherwise("c"))
    usual = sizes(files.attach_files(records, flat))
    asked = []
    monkeypatch.setattr(joins, "lookup_join", lambda *given: asked.append(given) or lookup_join(*given))
    assert not joins.has_hot_key(records, "dataset_url") and not joins.has_hot_key(records.limit(0), "dataset_url")
    monkeypatch.setattr(joins, "HOT_RECORDS", 2)
    assert joins.has_hot_key(records, "dataset_url") and not joins.has_hot_key(records.where("n > 2"), "dataset_url")
    assert sizes(files.attach_files(records, flat)) == usual and len(asked) == 1
    assert usual == {n: ("success", [38, 38]) if n < 4 else ("failed", []) for n in range(1, 6)}
