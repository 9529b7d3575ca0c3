"""Language, toxicity, quality and page text: held-out accuracy, brute force, and the usual cases."""

import collections
import random

import numpy as np
import pytest

from pagecat.llm import html, language, quality, queries, toxicity
from tests.llm import helpers

SF = "/root/testdata/sf0.001"


def test_language_held_out(spark):
    found = queries.op5_language(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    held = found[found.held_out].merge(docs, on="doc_id")
    assert len(found) == len(docs) and len(held) > 20
    assert (held.lang == held.lang_pred).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_language_of_the_usual_cases(spark):
    docs = helpers.table(spark)
    from pyspark.sql import functions as F

    rows = {r.doc_id: r for r in language.detect(docs, F.lit(True)).collect()}
    texts = dict(enumerate(helpers.texts()))
    for i, (text, lang) in texts.items():
        if not any(c.isalpha() for c in text or ""):
            assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
        elif lang and len(text) > 200:
            assert rows[i].lang_pred == lang
    assert language.detect(docs, F.lit(True)).count() == docs.count()
    assert {r.lang_pred for r in language.detect(docs, F.lit(False)).collect()} == {"und"}
    assert language.detect(helpers.table(spark, []), F.lit(True)).count() == 0
    kept = language.annotated(docs, language.train(docs))
    assert kept.columns[:-1] == docs.columns and kept.columns[-1] not in docs.columns and kept.count() == docs.count()


def test_mixture_has_both_languages():
    rnd = random.Random(1)
    model = np.full((2, language.BUCKETS), 0.5)
    for k, lang in enumerate(("aa", "bb")):
        model[k] += language.gram_counts(helpers.prose(rnd, 5000, lang))
    model = np.ascontiguousarray((model / model.sum(axis=1, keepdims=True)).T)
    one = language.mixture(language.gram_counts(helpers.prose(rnd, 200, "aa")), model)
    two = language.mixture(language.gram_counts(helpers.prose(rnd, 140, "aa") + " " + helpers.prose(rnd, 60, "bb")), model)
    assert [k for k, _ in one] == [0] and [k for k, _ in two] == [0, 1]
    assert 0.15 < two[1][1] < 0.5


def segments_by_brute_force(s):
    """Maximal segments by their definition: the best segment, then the same left and right of it."""
    best = max(((sum(s[a:b]), -(b - a), -a, a, b) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    a, b = best[3:]
    return segments_by_brute_force(s[:a]) + [(a, b)] + [(x + b, y + b) for x, y in segments_by_brute_force(s[b:])]


def test_segments_like_brute_force():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        s = rnd.normal(-0.3, 1, rnd.integers(0, 25))
        found = [(a, b) for a, b, _ in toxicity.maximal_segments(s)]
        assert found == segments_by_brute_force(s.tolist())


def toxic_table(spark, n=400):
    rnd = random.Random(3)
    rows = []
    for k in range(n):
        words = helpers.prose(rnd, rnd.choice([5, 80, 400])).split()
        toxic = k % 8 == 0
        for _ in range(4 * toxic):
            words.insert(rnd.randrange(len(words)), rnd.choice(["vilest", "wretchling!", "Zug" + rnd.choice(["o", "a"]) + helpers.prose(rnd, 1)]))
        rows.append((" ".join(words), toxic))
    return rows


def test_toxicity_held_out_and_usual_cases(spark):
    rows = toxic_table(spark)
    train = spark.createDataFrame([(t, int(x)) for t, x in rows[:300]], "text string, toxic int")
    model = toxicity.fit(train)
    test = [*rows[300:], *helpers.texts()]
    docs = helpers.table(spark, test)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    want = {k: x for k, (_, x) in enumerate(rows[300:])}
    assert np.mean([got[k].predicted == x for k, x in want.items()]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert not any(got[k].predicted for k in range(100, len(test)))
    assert toxicity.score(docs, model).count() == docs.count()
    assert toxicity.score(helpers.table(spark, []), model).count() == 0
    one_class = toxicity.fit(train.where("toxic = 0"))
    assert not any(r.predicted for r in toxicity.score(docs, one_class).collect())


def test_labels_of_a_document(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None), (4, "c"), (None, "d"), (5, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (4, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    assert sorted(map(tuple, toxicity.labelled(docs, labels).collect())) == [("a", 1), ("b", 0)]


def plain_measures(text):
    words = (text or "").encode().split()
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    duplicates = sum(1 for i, x in enumerate(lines) if x in lines[:i])
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), duplicates, len(repeated)


def test_measures_like_brute_force():
    rnd = random.Random(2)
    for _ in range(500):
        text = "".join(rnd.choice(["a", "b", "é", " ", " ", "\n", "\t", "#", "|", "\x0b", " ", "漢"]) for _ in range(rnd.randint(0, 60)))
        assert quality.measures(text)[:5] == plain_measures(text), repr(text)
    assert quality.measures(None) == quality.measures("") == (0, 0, 0, 0, 0, 0)


def test_quality_verdicts(spark):
    rnd = random.Random(3)
    good = [helpers.prose(rnd, 150) for _ in range(300)]
    bad = [" | ".join(helpers.prose(rnd, 80).split()), " ".join(w + "###" for w in helpers.prose(rnd, 90).split()), "\n".join([helpers.prose(rnd, 3)] * 4 + [helpers.prose(rnd, 60)] * 2)]
    rows = [(t, "aa") for t in [*good, *bad]] + helpers.texts()
    docs = helpers.table(spark, rows)
    got = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert all(got[i].kept for i in range(300)) and not any(got[i].kept for i in range(300, 303))
    for i, (t, _) in enumerate(rows):
        n = plain_measures(t)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        assert tuple(got[i])[1:6] == n and got[i].base_failed == failed and not (failed and got[i].kept)
    assert quality.judged(docs).count() == docs.count()
    assert quality.judged(helpers.table(spark, [])).count() == 0


def test_verdict_depends_on_the_source(spark):
    rnd = random.Random(5)

    def lines(copies):
        out = []
        for k in range(8):
            out += [helpers.prose(rnd, 10)] + ["More"] * (k < copies)
        return "\n".join(out)

    rows = [(k, lines(2 + k % 4), "aa", "lists") for k in range(300)] + [(k, lines(0), "aa", "prose") for k in range(300, 600)] + [(600, lines(4), "aa", "prose")]
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[2].kept and sum(got[k].kept for k in range(300)) > 280
    assert got[600].reasons == ["dup_line_share_high"] and all(got[k].kept for k in range(300, 600))


def test_thresholds_like_exact_quantiles(spark):
    """Own tails of the group, or of all rows; a sketch's quantile lies within 3 % of the asked rank."""
    rnd = random.Random(4)
    docs = helpers.table(spark, [(helpers.prose(rnd, rnd.randint(60, 90), "aa"), "aa") for _ in range(700)])
    rows = quality.with_shares(quality.measured(docs))
    table = rows.toPandas()
    tail = quality.TAILS["word_length"][0]
    found = quality.thresholds(rows).collect()
    assert found
    for r in found:
        own = table[(table.lang == r.lang) & (table.source == r.source)]
        x = (own if len(own) >= quality.LEAST_ROWS else table).word_length

        def high(e):  # e: ranks by which the quantiles are off, apart or together
            b, c = np.quantile(x, [0.5 - e, 1 - tail + e])
            return b + quality.SPREAD * (c - b)

        def low(e):
            a, b = np.quantile(x, [tail - e, 0.5 + e])
            return b - quality.SPREAD * (b - a)

        assert high(-0.03) <= r.word_length_high <= high(0.03)
        assert low(0.03) <= r.word_length_low <= low(-0.03)
        assert r.symbol_share_high == 0.1  # no symbols, no spread


def test_own_spread_of_symbols_decides(spark):
    """Signs that are common in one source are unusual in another; the spread is the source's own."""
    rnd = random.Random(8)

    def signed(share):
        words = helpers.prose(rnd, 100, "aa").split()
        return " ".join([*words, *["#"] * round(share * len(words))])

    rows = [(k, signed(0.2 + 0.02 * (k % 11)), "aa", "code") for k in range(300)]
    rows += [(k, signed(0.01 * (k % 3)), "aa", "prose") for k in range(300, 600)]
    rows += [(600, signed(0.3), "aa", "prose"), (601, signed(0.3), "aa", "code"), (602, signed(3), "aa", "code")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.reasons for r in quality.judged(docs).collect()}
    assert "symbol_share_high" in got[600] and "symbol_share_high" not in got[601] and "symbol_share_high" in got[602]
    assert not any("symbol_share_high" in got[k] for k in range(600))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><p>Site name</p></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><div class="cookie-banner">We use cookies, as all do.</div>
<article><h1>On  &amp;\n rain</h1><p><b>It rained all day, and &quot;nobody&#8221; minded &copy 2020.<br>At night it
stopped.<p>The river rose, slowly, until the bridge was closed.</p><div class=share><a href=x>Share</a></div><script>var a = "<p>no</p>";</script>
<p>Next day the sun came back.</p><form><label>Mail</label><p>Sign up here now, please do.</p></form></article><aside><p>Other stories you may like.</p></aside>
<section id="comments"><p>Great piece, I was there and it was wet.</p></section><!-- <p>hidden</p> --><footer>&copy; Site</footer>"""
TEXT = 'On & rain\nIt rained all day, and "nobody” minded © 2020. At night it stopped.\nThe river rose, slowly, until the bridge was closed.\nNext day the sun came back.'


def test_main_text(spark):
    rows = [(1, "u", PAGE), (2, "v", None), (3, None, ""), (None, "w", "plain"), (5, "x", "<p"), (6, "y", "<!-- open"), (1, "u", PAGE), (7, "z", "<p>a" * 5000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int")
    got = html.extracted(pages).collect()
    assert sorted((r.page_id or 0, r.url or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in rows)
    by_url = {r.url: r for r in got}
    assert by_url["u"].text == TEXT and by_url["u"].n_chars == len(TEXT)
    assert by_url["v"].text == "" and by_url[None].text == "" and by_url["y"].text == ""
    assert html.extracted(pages.where("page_id < 0")).count() == 0


def test_articles_of_the_table_come_out_whole(spark):
    import html as library
    import re

    got = queries.op4_html(spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    right = 0
    for r in got:
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(library.unescape(re.sub(r"<[^>]*>", " ", b.replace("<b>", "").replace("</b>", ""))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        right += r.text == "\n".join(b for b in blocks if b)
    assert len(got) == len(pages) and right >= 0.98 * len(pages)


def test_chain_probabilities_are_exact():
    """The gradient's expectations come from all labellings: training lowers the exact negative likelihood."""
    rnd = np.random.default_rng(2)
    pages = [((rnd.random((n, len(html.FEATURES))) < 0.3).astype(float), rnd.integers(0, 2, n)) for n in (1, 3, 5)]
    w, t = html.train(pages)

    def loss(w, t):
        total = 0.0
        for x, y in pages:
            scores = {}
            for k in range(1 << len(y)):
                z = [k >> i & 1 for i in range(len(y))]
                e = x @ w
                scores[tuple(z)] = sum(e[i, v] for i, v in enumerate(z)) + sum(t[a, b] for a, b in zip(z, z[1:]))
            total -= scores[tuple(y)] - np.log(sum(np.exp(list(scores.values()))))
            best = max(scores, key=scores.get)
            assert html.viterbi(x, w, t) == list(best)
        return total

    assert loss(w, t) < 0.2 * loss(np.zeros_like(w), np.zeros_like(t))


@pytest.mark.parametrize(
    "page, text",
    [
        ("<head><meta charset=x><h1>One</h1><p>Two long words.</p>", ["One", "Two long words."]),
        ("<head><title>t</title></head><body><p>a</p></body>", ["a"]),
        ("<p>One <svg><text>x</text></svg> two</p>", ["One two"]),
        ("<p>One</p><svg class=i /><p>two</p><svg/><p>three</p>", ["One", "two", "three"]),
        ("<p>One <svg class=i> two</p>", ["One two"]),
        ("<object data=x /><p>One</p>", ["One"]),
        ("<p>The value <math><mi>x</mi></math> is larger</p>", ["The value x is larger"]),
        ("<p>One <script>var a = '<p>';</script>two<style>p{}</style></p>", ["One two"]),
        ("<p>One</p><textarea>two</textarea>", ["One", "two"]),
    ],
)
def test_blocks_of_odd_markup(page, text):
    assert [b.text for b in html.blocks(page)] == text
