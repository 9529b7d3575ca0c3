"""Cases that real pages, sizes and catalogues bring: each against the standard library or by hand."""

import html
import random
from decimal import Decimal
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from pagecat.functions import files as fx
from pagecat.functions import text as t
from pagecat.functions.numbers import ratio_text_expr
from pagecat.operators import listing, validate
from pagecat.schemas import BASE_RECORD
from pagecat.sources import io
from tests.test_listing import pages_of, records_of, row, table


def test_every_entity_like_the_library(spark):
    names = sorted(html5)
    samples = [f"a&{n}b c" for n in names] + [f"a&{n} " for n in names] + [f"&{n.rstrip(';')}" for n in names]
    samples += ["&#65;", "&#00000065;", "&#x0000041", "&#65x", "&#", "&#;", "&;", "& amp;", "&#x;", "&#99999999999999999999;", "&nosuch;", "&ampamp;"]
    samples += [f"&#{n};" for n in [0, 1, 8, 9, 10, 11, 13, 31, 127, 128, 129, 150, 159, 160, 0xD800, 0xFDD0, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000]]
    rows = spark.createDataFrame(list(enumerate(samples)), "i int, x string").select("i", t.unescape_expr(F.col("x")).alias("y"))
    got = {r.i: r.y for r in rows.collect()}
    assert {s: got[i] for i, s in enumerate(samples)} == {s: html.unescape(s) for s in samples}


@pytest.mark.parametrize("page", ["a<!-- human", "a<script>human", "a<style>p{human", "<b>a</b><!-- x --> <!-- human"])
def test_what_is_never_closed_is_unseen(one, page):
    assert one(t.visible_text_expr(F.col("x")), "x string", page) == "a"


def test_links_are_read_as_a_browser_reads_them(spark):
    got = records_of(spark, table(row("1", href=" /datasets/a?x=1&amp;y=2 "), row("2", href="/datasets/a?x=1&y=2", name="B")))
    assert [r["dataset_url"] for r in got] == ["https://example.com/datasets/a?x=1&y=2"] * 2


def test_a_table_needs_no_written_body(spark):
    rows = row("p", "s", "t", "c", "f", "d", name="A") + row("p2", "s2", "t2", "c2", "f2", "d2", href="/datasets/b", name="B")
    plain, written = (records_of(spark, x) for x in (f"<table>{rows}</table>", f"<table><tbody>{rows}</tbody></table>"))
    assert plain == written and len(plain) == 2 and plain[0]["product"]
    assert listing.fallback_links(pages_of(spark, f"<table>{rows}</table>")).count() == 0
    assert listing.fallback_links(pages_of(spark, "<table></table><a href='/datasets/c'>C</a>")).count() == 1


def test_rows_after_an_inner_table_stay(spark):
    inner = "<table><tbody><tr><td>x</td><td>y</td></tr></tbody></table>"
    first = f"<tr><td><a href='/datasets/z'>Z</a>{inner}</td><td>p</td></tr>"
    got = records_of(spark, table(first, row("1", name="A"), row("2", href="/datasets/b", name="B")))
    assert [r["dataset_name"] for r in got] == ["Z", "A", "B"]


def test_rounding_does_not_depend_on_size(spark):
    rng = random.Random(3)
    borders = [2**k for k in (10, 20, 30, 33)]
    sizes = [b * 10**9 + d * 5 * 10**6 for b in borders for d in range(-40, 41)] + [1048577015000000]
    sizes += [rng.randrange(2**63 // (10**7)) * 10**7 + 5 * 10**6 for _ in range(3000)]
    sizes = [s for s in sizes if 0 <= s < 2**63]
    got = spark.createDataFrame([(s,) for s in sizes], "b bigint").select("b", ratio_text_expr(F.col("b"), 10**9)).collect()
    assert [r[1] for r in got] == [f"{r[0] / 10**9:.2f}" for r in got]
    micros = [b * 10**6 + d * 5000 for b in (2**20, 2**30, 2**34, 2**42) for d in range(-40, 41)]
    micros += [rng.randrange(2**63 // 10**4) * 10**4 + 5000 for _ in range(3000)]
    got = spark.createDataFrame([(m,) for m in micros], "m bigint").select("m", ratio_text_expr(F.col("m"), 10**6)).collect()
    assert [r[1] for r in got] == [f"{r[0] / 10**6:.2f}" for r in got]


def test_sizes_past_a_bigint_are_kept(one):
    got = one(fx.parse_size_expr(F.col("x")), "x string", "9000000 TB")
    assert tuple(got) == ("9216000000.0 GB", Decimal(9000000 * 1024**4))


def test_a_catalogue_of_runs_equals_itself(spark):
    schema = "run string, row_idx bigint, dataset_url string"
    a = spark.createDataFrame([("r1", 0, "u"), ("r2", 0, "v"), (None, 0, "w"), ("r3", 0, "x"), ("r3", 1, "y")], schema)
    by = ("run",)
    assert validate.row_diff(a, a, by=by).count() == 0
    assert all(r.passed for r in validate.consistency_summary(a, a, by=by).collect())
    b = a.where("NOT (run <=> 'r3' AND row_idx = 1)").replace("v", "other")
    found = {r.run: (r.passed, r.json_count, r.excel_count, r.mismatch_count) for r in validate.consistency_summary(a, b, by=by).collect()}
    assert found == {"r1": (True, 1, 1, 0), "r2": (False, 1, 1, 1), None: (True, 1, 1, 0), "r3": (False, 2, 1, 1)}
    missing = validate.count_check(a, b.where("run = 'r1'"), by=by).collect()
    assert {r.run: r.excel_count for r in missing} == {"r1": 1, "r2": 0, None: 0, "r3": 0}


def test_exit_code_asks_the_run(spark):
    counts = spark.createDataFrame([("r1", 2, 2, 0, 0, 0), ("r2", 1, 1, 0, 0, 0), ("r3", 1, 1, 0, 0, 0)], "run string, total_datasets long, verified long, mismatched long, warnings long, failed_urls long")
    checks = spark.createDataFrame([("r1", True), ("r2", True), ("r3", False)], "run string, passed boolean")
    pages = spark.createDataFrame([("r1", "u"), ("r3", "v")], "run string, url string")
    got = {r.run: r.exit_code for r in validate.exit_code(counts, checks, pages, by=("run",)).collect()}
    assert got == {"r1": 0, "r2": 2, "r3": 1}


def test_a_missing_key_is_no_blank_where_it_matters(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"dataset_name": "a", "species": ""}, {"dataset_name": "b"}]')
    read = lambda blanks: {r.dataset_name: r.species for r in io.read_records(spark, str(tmp_path / "x.json"), BASE_RECORD, blanks=blanks).collect()}
    assert read(True) == {"a": "", "b": ""} and read(False) == {"a": "", "b": None}


def test_stage_tables_never_go_to_the_machines_temporary_folder(spark):
    import tempfile

    from pagecat import session

    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(shared)
    source = open(session.__file__).read()
    assert tempfile.__name__ not in source
