"""URL helpers against urllib."""

from urllib.parse import parse_qs, urlencode, urljoin, urlparse, urlunparse

from pyspark.sql import functions as F

from pagecat.functions import urls

URLS = [
    "https://example.com/datasets?query=&page=1&x=a+b&x=c%20d&y=%C3%A9#top",
    "https://example.com/datasets",
    "HTTP://Example.com/a;p=1?b=1&b=2&c&=3&d==4",
    "https://example.com/?page=7&page=8&z=~*_-.",
    "https://example.com/#frag",
    "/relative?a=1%2B1",
    "https://example.com/a?x=%zz&y=1",
]


def test_query_parameters(spark):
    got = spark.createDataFrame([(u,) for u in URLS], "url string").select(
        urls.query_params_expr(F.col("url"))
    )
    assert [r[0] for r in got.collect()] == [parse_qs(urlparse(u).query) for u in URLS]


def test_page_parameter(spark):
    def expected(url):
        parts = urlparse(url)
        params = parse_qs(parts.query)
        params["page"] = ["3"]
        return urlunparse(parts._replace(query=urlencode(params, doseq=True)))

    got = spark.createDataFrame([(u,) for u in URLS], "url string").select(
        urls.set_query_param_expr(F.col("url"), "page", F.lit(3))
    )
    assert [r[0] for r in got.collect()] == [expected(u) for u in URLS]


def test_listing_urls_keep_the_seed(spark):
    rows = urls.listing_urls(spark.createDataFrame([(URLS[0],)], "url string"), 2).collect()
    assert {r.page_num: r.page_url for r in rows} == {
        0: URLS[0],
        1: "https://example.com/datasets?page=1&x=a+b&x=c+d&y=%C3%A9#top",
    }


def test_links_resolve_like_urljoin(spark):
    base = "https://example.com/a/b/page.html?q=1#f"
    links = ["/x", "x", "./x", "../x", "../../x/./y?z=1/../2", "?p=2", "#g", "//cdn.example.com/x", "mailto:a@b", "http://o/p", "x/..", "/a/./b/../c"]
    got = spark.createDataFrame([(h,) for h in links], "href string").select(
        urls.resolve_href_expr(F.lit(base), F.col("href"))
    )
    assert [r[0] for r in got.collect()] == [urljoin(base, h) for h in links]
    at_root = spark.range(1).select(urls.resolve_href_expr(F.lit("https://example.com"), F.lit("x")))
    assert at_root.first()[0] == "https://example.com/x"


def test_dataset_links(one):
    def is_link(href):
        return one(urls.is_dataset_link_expr(F.col("x")), "x string", href)

    assert is_link("/datasets/a")
    assert not is_link("/datasets?page=1")
    assert not is_link("/datasets/a?back=/datasets?page=1")
    assert not is_link("/about")
