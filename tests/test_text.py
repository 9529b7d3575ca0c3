"""Text helpers against the standard library."""

import html
import re
from html.parser import HTMLParser

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.functions import text as t

BLOCKS = set(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section "
    "summary table tbody tfoot thead tr ul".split()
)


class VisibleText(HTMLParser):
    """Brute force: the parser's own events, block tags as line breaks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "head", "noscript", "template"):
            self.hidden += 1
        if tag in BLOCKS:
            self.out.append("\n")
        elif tag in ("td", "th"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "head", "noscript", "template"):
            self.hidden -= 1
        if tag in BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(re.sub(r"[\s\x1c-\x1f]+", " ", data))


def visible(source):
    parser = VisibleText()
    parser.feed(source)
    parser.close()
    lines = (re.sub(r"\s+", " ", line).strip() for line in "".join(parser.out).split("\n"))
    return "\n".join(line for line in lines if line)


def test_visible_text_of_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("html", t.visible_text_expr(F.col("html")).alias("text")).collect()
    assert len(rows) == 250
    assert [r.text for r in rows] == [visible(r.html) for r in rows]


def test_visible_text_of_odd_pages(spark):
    pages = [
        "<p>a<b>b</b> c<br>d</p>",
        '<p title="a>b">x</p><p title=\'q>"\'>y</p>',
        "<table><tr><td>1<td>2<tr><td>3</table>",
        "<!-- <p>no</p> --><script>if(a<b){'</p>'}</script>yes",
        "<HEAD><title>t</title></HEAD><BODY>&lt;p&gt; &amp;lt; &#8217; &#x41;</BODY>",
        "plain 1 < 2 text",
        "",
    ]
    got = spark.createDataFrame([(p,) for p in pages], "html string").select(
        t.visible_text_expr(F.col("html"))
    )
    assert [r[0] for r in got.collect()] == [visible(p) for p in pages]


def test_long_attributes_do_not_overflow(spark):
    page = "<p data-x='" + "a" * 500_000 + "' " + "b " * 200_000 + ">ok</p>" + "<a " + "c" * 300_000
    got = spark.createDataFrame([(page,)], "html string").select(t.visible_text_expr(F.col("html")))
    assert got.first()[0].startswith("ok")


def test_heading(one):
    def heading(source):
        return one(t.page_heading_expr(F.col("x")), "x string", source)

    assert heading("<h1 class='a'>  A <i>b</i>\n &amp; c</h1><h1>second</h1>") == "A b & c"
    assert heading("<p>none</p>") == ""
    assert heading("<!-- <h1>no</h1> --><h1>yes</h1>") == "yes"


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.sampled_from(
            ["&amp;", "&lt;", "&eacute;", "&Eacute;", "&#8364;", "&#x1F600;", "&#128;", "&#0;", "&#xD800;", "a", "&", ";", " "]
        ),
        max_size=12,
    )
)
def test_unescape_like_the_library(spark, parts):
    source = "".join(parts)
    got = spark.createDataFrame([(source,)], "x string").select(t.unescape_expr(F.col("x"))).first()[0]
    assert got == html.unescape(source)


def test_white_space_is_python_white_space(spark):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    samples = [f"{c}a{c}{c}b{c}" for c in spaces] + ["", " ", "a", spaces]
    got = spark.createDataFrame([(s,) for s in samples], "x string").select(
        t.strip_expr(F.col("x")), t.squash_ws_expr(F.col("x"))
    )
    for sample, row in zip(samples, got.collect()):
        assert row[0] == sample.strip()
        assert row[1] == " ".join(sample.split())


def test_first_line_with_a_hit_decides(one):
    def label(text, label_rules):
        return one(t.label_by_line_expr(F.col("x"), label_rules), "x string", text)

    assert label("nothing\nIHC here\nH&E", rules.IMAGE_TYPE_RULES) == "IHC"
    assert label("a specific line", rules.IMAGE_TYPE_RULES) == "IF"  # 'if' inside a word
    assert label("ihc and hematoxylin", rules.IMAGE_TYPE_RULES) == "H&E"
    assert label("Tumor\nnormal", rules.DISEASE_RULES) == "Cancer"
    assert label("frozen", rules.PRESERVATION_TEXT_RULES) == "Fresh Frozen"
    assert label("", rules.DISEASE_RULES) == ""


def test_first_rule_anywhere_decides(one):
    def tissue(text):
        return one(t.detect_first_expr(F.col("x"), rules.TISSUE_RULES), "x string", text)

    assert tissue("skin of the lymph node") == "Lymph Node"
    assert tissue("") == ""


def test_unseen_content_ends_at_its_own_end_tag(one):
    """Content that holds other end tags and lone '<', however much of it, goes as a whole."""
    html = "a<script>" + "x<y </style> </scriptx>" * 50_000 + "</SCRIPT >b<style>c</script>d"
    assert one(t.drop_unseen_expr(F.col("x")), "x string", html) == "ab"
