"""Listing pages: layouts, rows, cells, dedup, stop rule."""

import random
import time
import pytest
from pyspark.sql import functions as F

from pagecat.operators import listing
from pagecat.schemas import PAGES

SEED = "https://example.com/datasets"


def pages_of(spark, *sources, run="r"):
    rows = [(run, i, f"{SEED}?page={i}" if i else SEED, source) for i, source in enumerate(sources)]
    return spark.createDataFrame(rows, PAGES)


def records_of(spark, *sources):
    found = listing.listing_records(listing.listing_entries(pages_of(spark, *sources)))
    return [r.asDict() for r in found.orderBy("page_num", "pos").collect()]


def row(*cells, href="/datasets/a", name="A"):
    return "<tr><td><a href='%s'>%s</a></td>%s</tr>" % (href, name, "".join(f"<td>{c}</td>" for c in cells))


def table(*rows):
    return "<table><tbody>" + "".join(rows) + "</tbody></table>"


@pytest.mark.parametrize(
    "source, expected",
    [
        ('<div class="x dataset-card"></div><div class=dataset>', ("dataset", 2)),
        ("<table><thead><tr></thead><tr><td></table><div class='hit'>", ("table_row", 2)),
        ('<DIV id=1 CLASS="ais-hits">', ("hit", 1)),
        ("<div class='result'></div><article>", ("result", 1)),
        ("<article><article>", ("article", 2)),
        ('<a class=b href="/datasets/x">', ("link", 1)),
        ('<a href=" \n/datasets/x "><a href="&#47;datasets&#x2F;y"><a href="/about">', ("link", 2)),
        ("<tr><td>no table</td></tr><div data-x='dataset'>", (None, None)),
        ("<!-- <article> --><script>'<article>'</script>", (None, None)),
    ],
)
def test_layouts(spark, source, expected):
    probe = listing.layout_probe(pages_of(spark, source)).first()
    assert (probe.layout, probe.elements) == expected


def test_worked_examples(spark):
    name = "Spatial Gene Expression Library, Human Pancreas (FFPE)"
    source = table(
        row("", "Spatial Gene Expression v1.0", "Human", "Pancreas", "N/A", "FFPE", href="/datasets/pancreas-4", name=name),
        row("", "Spatial Gene Expression v1.0", "Human", "Breast", "N/A", "Fresh Frozen", href="/datasets/breast-4", name="B"),
    )
    first, second = records_of(spark, source)
    assert first == {
        "run": "r",
        "page_num": 0,
        "pos": 0,
        "dataset_name": name,
        "dataset_url": "https://example.com/datasets/pancreas-4",
        "product": "Spatial Gene Expression v1.0",
        "species": "Human",
        "sample_type": "Pancreas",
        "cells_or_nuclei": "N/A",
        "preservation": "FFPE",
    }
    assert (second["sample_type"], second["preservation"]) == ("Breast", "Fresh Frozen")


def test_cells_by_pattern(spark):
    (got,) = records_of(spark, table(row("Lung", "Spatial A", "Gene Expression B", "MOUSE", "other")))
    assert got["product"] == "Gene Expression B"  # the last product cell wins
    assert got["sample_type"] == "Lung"  # the first leftover wins
    assert (got["species"], got["preservation"], got["cells_or_nuclei"]) == ("MOUSE", "", "")
    (got,) = records_of(spark, table(row("fixed frozen block", "nuclei", "rat", "")))
    assert got["preservation"] == "fixed frozen block"
    assert (got["cells_or_nuclei"], got["species"], got["sample_type"]) == ("nuclei", "rat", "")


def test_short_rows_stay_blank_and_single_cells_drop(spark):
    got = records_of(spark, table(row("Spatial", "Human"), row(), "<tr><td>no link</td><td>x</td></tr>"))
    assert len(got) == 1
    assert {got[0][f] for f in listing.METADATA} == {""}


def test_first_tbody_only_and_missing_end_tags(spark):
    source = (
        "<table><tbody class='a'><tr><td><a href=/datasets/a>A <b>&amp;\n B</b></a><td>x<tr>"
        "<td><a href='/datasets?q=1'>all</a> <a title='x>y' href='/datasets/b'>B</a><td>y</table>"
        "<table><tbody>" + row("z", href="/datasets/c") + "</tbody></table>"
    )
    got = records_of(spark, source)
    assert [(r["pos"], r["dataset_name"], r["dataset_url"]) for r in got] == [
        (0, "A & B", "https://example.com/datasets/a"),
        (1, "B", "https://example.com/datasets/b"),
    ]


def test_links_only_where_no_tbody(spark):
    source = "<a>no href</a><a href='/datasets?p=1'>list</a><a href='https://o.org/datasets/x'> X </a><a href='/datasets/y'> </a>"
    (got,) = records_of(spark, source)
    assert (got["pos"], got["dataset_name"], got["dataset_url"]) == (2, "X", "https://o.org/datasets/x")
    assert records_of(spark, source + "<table><tbody></tbody></table>") == []


def test_one_pass_equals_single_operators(spark):
    from pagecat.plans import fixtures

    pages = fixtures.listing_pages(spark, "/root/testdata/sf0.01")
    linked = listing.row_link(listing.table_rows(pages))
    columns = [*listing.ORDER, "dataset_name", "dataset_url", *listing.METADATA]
    apart = (
        listing.map_cells_by_position(linked)
        .select(columns)
        .unionByName(listing.map_cells_by_pattern(linked).select(columns))
        .unionByName(listing.fallback_links(pages))
    )
    together = listing.listing_records(listing.listing_entries(pages))
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, together.select(columns).collect()))


def links(*names):
    return "".join(f"<a href='/datasets/{n}'>{n}</a>" for n in names) or "<article>"


def crawl(spark, *sources):
    pages = pages_of(spark, *sources)
    first = listing.dedup_first_seen(listing.listing_records(listing.listing_entries(pages)))
    kept = listing.apply_stop_rule(first, pages)
    return sorted((r.page_num, r.dataset_name) for r in kept.collect())


def test_first_seen_wins_and_blank_names_never_claim(spark):
    blank = "<a href='/datasets/a'> </a>"
    got = crawl(spark, blank, "<a href='/datasets/a'>second</a>", "<a href='/datasets/a'>third</a>")
    assert got == [(1, "second")]


def test_stop_after_three_pages_without_news(spark):
    assert crawl(spark, links("a"), links("a"), links("a"), links("b")) == [(0, "a"), (3, "b")]
    assert crawl(spark, links("a"), links("a"), links(), links("a"), links("b")) == [(0, "a")]
    assert crawl(spark, links(), links(), links("a"), links(), links(), links("b")) == [(2, "a"), (5, "b")]


def test_stop_at_a_page_without_layout(spark):
    assert crawl(spark, links("a"), "<p>error</p>", links("b")) == [(0, "a")]
    assert crawl(spark, "<p>error</p>", links("b")) == []


def test_page_stats_across_blocks(spark):
    pages = pages_of(spark, *(links(f"n{i}") if i % 3 else links() for i in range(25)))
    first = listing.dedup_first_seen(listing.listing_records(listing.listing_entries(pages)))
    got = {r.page_num: (r.new_records, r.running_total) for r in listing.page_stats(first, pages, block=4).collect()}
    total = 0
    for i in range(25):
        total += bool(i % 3)
        assert got[i] == (int(bool(i % 3)), total)


def test_column_widths(spark):
    df = spark.createDataFrame([("x" * 200, 5, None), ("y", 123456789, None)], "long_text string, n bigint, empty string")
    assert {r[0]: r[1] for r in listing.column_width_profile(df).collect()} == {"long_text": 100, "n": 11, "empty": 7}


def test_depths_like_a_plain_walk(spark):
    rnd = random.Random(1)
    rows = [([rnd.choice([1, -1, 0]) for _ in range(n)],) for n in (1, 2, 3, 4, 5, 9, 10, 50, 200) for _ in range(8)]
    found = spark.createDataFrame(rows, "steps array<int>").select("steps", listing._depths(F.col("steps")).alias("d")).collect()
    for r in found:
        depth, true = 0, []
        for x in r.steps:
            depth = max(0, depth + x)
            true.append(depth)
        assert r.d == true


def test_a_page_of_twenty_thousand_tables(spark):
    inner = "<table><tr><td>no<td>no</table>"
    rows = "".join(f'<tr><td><a href="/datasets/{i}">n{i}</a>{inner}</td><td>x</td></tr>' for i in range(10_000))
    page = f"<table><tbody>{rows}</tbody></table>" + "<table><tr><td>later</td><td>later</td></tr></table>" * 10_000
    pages = spark.createDataFrame([("r", 0, "https://x.example/datasets", page)], "run string, page_num int, url string, html string").cache()
    pages.count()
    start = time.perf_counter()
    found = listing.listing_entries(pages).select(F.size("entries").alias("n"), F.col("entries")[9_999]["cells"].alias("cells")).first()
    assert found.n == 10_000 and len(found.cells) == 2 and "no" not in found.cells[0].replace("n9999", "")
    assert time.perf_counter() - start < 10  # a string grown table by table takes minutes
