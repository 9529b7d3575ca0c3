"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes its leaf blocks in order, each with features of its ancestors' tags and names and of its
text. Two labels (main text or not) form a chain; the weights are trained by gradient ascent on the
exact log-likelihood (forward-backward) over labelled pages, and a page is decoded by Viterbi.

Labelled pages are the hand-labelled ones below and a bounded sample of the table's own pages whose
markup says what is what (an article or main element, and navigation, footers, adverts in theirs). As
other sites mark less, each sampled page is also learned from with its boilerplate inside the article
and with no article element at all.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import by_bytes

# Pages of the table that training takes at most, the ones with the smallest hash.
LABELLED_PAGES = 400
STEPS = 200
RATE = 0.3
PENALTY = 1e-3

# HTML's own element classes, and words that sites put into class, id and role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol optgroup option p pre section"
    " select summary table tbody td tfoot th thead title tr ul".split()
)
# Elements whose content is no text of the page. They stand inside a line and end no block.
RAW_TAGS = ("script", "style", "noscript", "template", "iframe", "title")
DRAWINGS = ("svg",)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT_TAGS = frozenset(["article", "main"])
ASIDE_TAGS = frozenset(["nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "fieldset", "label", "option", "address"])
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent"
    " discussion disclaimer disqus download feedback footer form gdpr header links login masthead menu meta modal nav navbar"
    " navigation newsletter notice pagination pager popup promo promoted recommended related reply replies respond rss search"
    " share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar trending warning"
    " widget".split()
)
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())

_PIECES = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW_TAGS) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|(?=<body\b)|\Z)"
    # A drawing that is closed in its own tag, or never, is a tag without content.
    r"|<(?P<drawing>" + "|".join(DRAWINGS) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?</(?P=drawing)\s*>"
    r"|<[!?][^>]*>|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.I | re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = (
    "bias p heading item cell other_tag in_content in_aside_tag in_aside_name in_content_name in_header first_heading links_some links_most"
    " links_all chars_20 chars_60 chars_200 chars_more stop comma mark_c words_1 words_3 bars digits_many first last"
).split()
F_AT = {f: i for i, f in enumerate(FEATURES)}


class Block:
    """A leaf block: its text, the characters of it inside links, its tag, and what its ancestors say."""

    __slots__ = ("text", "linked", "tag", "content", "aside_tag", "aside_name", "content_name", "header")

    def __init__(self, text: str, linked: int, stack: list):
        self.text, self.linked = text, linked
        self.tag = stack[-1][0] if stack else ""
        self.content = self.aside_tag = self.aside_name = self.content_name = self.header = False
        for tag, aside, content in stack:
            if tag in CONTENT_TAGS:
                self.content = True
            if tag == "header" and not self.content:
                self.header = True
            self.aside_tag |= tag in ASIDE_TAGS
            self.aside_name |= aside
            self.content_name |= content


def _names(rest: str) -> set[str]:
    out: set[str] = set()
    for m in _NAMES.finditer(rest):
        out.update(w.lower() for w in _PART.findall(m[1] or m[2] or m[3] or ""))
    return out


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order: text between block-level tags, references decoded, one space for white space."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, bool, bool]] = []
    texts: list[str] = []
    linked, in_link, at = 0, 0, 0

    def end_block() -> None:
        nonlocal linked
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                out.append(Block(text, linked, stack))
            texts.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            texts.append(piece)
            if in_link:
                linked += len(piece.strip())

    for m in _PIECES.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCK_TAGS:
            if tag == "br":
                texts.append(" ")
            elif tag == "a":
                in_link = 0 if m["close"] else 1
            continue
        end_block()
        in_link = 0
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        # Elements that end where the next of their kind begins.
        if stack and (stack[-1][0] == "p" or (tag == stack[-1][0] and tag in ("li", "td", "th", "tr", "dt", "dd", "option"))):
            stack.pop()
        # What follows a head that nothing closes is no part of it: a head is never an ancestor.
        if tag not in VOID_TAGS and tag != "head" and not m["rest"].rstrip().endswith("/"):
            names = _names(m["rest"]) if "=" in m["rest"] else set()
            stack.append((tag, not names.isdisjoint(ASIDE_WORDS), not names.isdisjoint(CONTENT_WORDS)))
    add(page[at:])
    end_block()
    return out


def features(found: list[Block]) -> np.ndarray:
    """A row of 0/1 features per block."""
    x = np.zeros((len(found), len(FEATURES)))
    seen_heading = False
    for i, b in enumerate(found):
        on = ["bias"]
        heading = len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit()
        on.append("heading" if heading else "p" if b.tag == "p" else "item" if b.tag in ("li", "dd", "dt") else "cell" if b.tag in ("td", "th") else "other_tag")
        if heading and not seen_heading:
            on.append("first_heading")
            seen_heading = True
        on += [n for n, yes in (("in_content", b.content), ("in_aside_tag", b.aside_tag), ("in_aside_name", b.aside_name), ("in_content_name", b.content_name), ("in_header", b.header)) if yes]
        n = len(b.text)
        share = min(1.0, b.linked / n)
        on += ["links_all"] if share > 0.9 else ["links_most"] if share > 0.5 else ["links_some"] if share > 0 else []
        on.append("chars_20" if n < 20 else "chars_60" if n < 60 else "chars_200" if n < 200 else "chars_more")
        words = b.text.count(" ") + 1
        on += ["words_1"] if words == 1 else ["words_3"] if words <= 3 else []
        on += ["stop"] if b.text[-1] in ".!?…。:;\"”»" else []
        on += ["comma"] if "," in b.text else []
        on += ["mark_c"] if "©" in b.text or "®" in b.text else []
        on += ["bars"] if b.text.count("|") + b.text.count("»") + b.text.count("·") > 1 else []
        on += ["digits_many"] if 3 * sum(map(str.isdigit, b.text)) > n else []
        on += ["first"] if i == 0 else []
        on += ["last"] if i == len(found) - 1 else []
        x[i, [F_AT[f] for f in on]] = 1
    return x


def marked(found: list[Block]) -> list[int] | None:
    """Labels that a page's own markup gives; None if it marks no main text."""
    if not any(b.content for b in found):
        return None
    return [int(b.content and not (b.aside_tag or b.aside_name)) for b in found]


# Hand-labelled pages: 1 before the text of a block that belongs to the main text, 0 before others.
HAND_LABELLED = [
    "<body><header id=top><div class=logo>0 Daily Example</div><nav><a href=/>0 Home</a></nav></header><main><h1>1 A long day at the river</h1>"
    "<p>1 The water rose in the night, and by morning the road was closed.</p><p>1 People waited on the hill until noon.</p>"
    "<aside><h3>0 Read more</h3><ul><li><a href=/a>0 Ten bridges</a><li><a href=/b>0 Old mills</a></ul></aside><p>1 Nobody was hurt, the mayor said.</p></main>"
    "<section id=comments><h2>0 2 comments</h2><p>0 I was there, it was worse than you write, believe me.</p><p>0 Thanks for this piece, well done.</p></section>"
    "<footer><p>0 © Example Media, all rights reserved.</p></footer></body>",
    "<body><div class=cookie-notice><p>0 We use cookies to make this site better. By reading on you agree.</p><button>0 OK</button></div>"
    "<div id=menu><ul><li><a href=/x>0 News</a></li><li><a href=/y>0 Sport</a></li></ul></div><div class=content><h1>1 Cooking with beans</h1>"
    "<div>1 Beans need time, water and a little salt at the end.</div><ul><li>1 two cups of beans</li><li>1 one onion, chopped</li></ul>"
    "<div class=ad>0 Buy pots now, cheaper than ever before, only this week!</div><p>1 Serve them warm.</p></div><div class=sidebar><p>0 Sign up for our letter and win a pan.</p></div>"
    "<form class=search><label>0 Search this site</label></form><div class=footer>0 Contact us | Terms | Privacy</div></body>",
    "<body><table><tr><td><a href=/1>0 Start</a></td><td><a href=/2>0 Archive</a></td></tr></table><h2>1 On clocks</h2><p>1 A clock that runs slow is right twice as seldom, my father used to say.</p>"
    "<blockquote><p>1 Time is what we want most.</p></blockquote><p>1 He kept eleven of them, and none agreed.</p><p><a href=/n>0 Next page</a></p><hr><p>0 © 2020 The clock pages</p></body>",
    "<body><nav><a href=/>0 Front page</a></nav><article class=post><header><h1>1 Night trains return</h1><p>1 The line opens in May.</p></header><p>1 Tickets are sold from Monday, the company said, at every station.</p>"
    "<div class=share-buttons><a href=/s>0 Share this</a></div><p>1 The first train leaves at nine.</p><div class=related><a href=/r>0 Ferries too</a></div>"
    "<div id=comments><p>0 At last! I have waited years for this, great news.</p></div><div class=newsletter><form><p>0 Get news by mail every morning.</p></form></div></article>"
    "<div class=banner>0 Sale ends Sunday. Everything must go, do not miss it.</div><footer>0 About us · Jobs · Imprint</footer></body>",
]


def hand_labelled() -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for page in HAND_LABELLED:
        found = blocks(page)
        labels = np.array([int(b.text[0]) for b in found])
        for b in found:
            b.text = b.text[2:]
        out.append((features(found), labels))
    return out


def _padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    longest = max(len(y) for _, y in pages)
    x = np.zeros((len(pages), longest, len(FEATURES)))
    y = np.zeros((len(pages), longest), np.int64)
    here = np.zeros((len(pages), longest), bool)
    for k, (a, b) in enumerate(pages):
        x[k, : len(b)], y[k, : len(b)], here[k, : len(b)] = a, b, True
    return x, y, here


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    most = a.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(a - most).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights (features x labels) and transition weights of the chain."""
    x, y, here = _padded(pages)
    n, longest = y.shape
    w, t = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    own = np.eye(2)[y] * here[..., None]
    seen_w = np.einsum("nlf,nlk->fk", x, own)
    seen_t = np.einsum("nla,nlb->ab", own[:, :-1], own[:, 1:])
    sum_w, sum_t = np.full_like(w, 1e-8), np.full_like(t, 1e-8)
    for _ in range(STEPS):
        e = x @ w
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0]
        for i in range(1, longest):
            step = _logsum(forward[:, i - 1, :, None] + t, 1) + e[:, i]
            forward[:, i] = np.where(here[:, i, None], step, forward[:, i - 1])
        for i in range(longest - 2, -1, -1):
            step = _logsum(t + (e[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
            backward[:, i] = np.where(here[:, i + 1, None], step, 0)
        z = _logsum(forward[:, -1], 1)
        single = np.exp(forward + backward - z[:, None, None]) * here[..., None]
        pair = np.exp(forward[:, :-1, :, None] + t + (e[:, 1:] + backward[:, 1:])[:, :, None, :] - z[:, None, None, None]) * here[:, 1:, None, None]
        g_w = (seen_w - np.einsum("nlf,nlk->fk", x, single)) / n - PENALTY * w
        g_t = (seen_t - pair.sum(axis=(0, 1))) / n - PENALTY * t
        sum_w += g_w**2
        sum_t += g_t**2
        w += RATE * g_w / np.sqrt(sum_w)
        t += RATE * g_t / np.sqrt(sum_t)
    return w, t


def viterbi(x: np.ndarray, w: np.ndarray, t: np.ndarray) -> list[int]:
    """The likeliest labels of a page's blocks."""
    e = (x @ w).tolist()
    (t00, t01), (t10, t11) = t.tolist()
    a, b = e[0]
    back = []
    for e0, e1 in e[1:]:
        from_0, from_1 = (a + t00, b + t10), (a + t01, b + t11)
        back.append((int(from_0[1] > from_0[0]), int(from_1[1] > from_1[0])))
        a, b = max(from_0) + e0, max(from_1) + e1
    out = [int(b > a)]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


def main_text(page: str | None, w: np.ndarray, t: np.ndarray) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, y in zip(found, viterbi(features(found), w, t)) if y)


def labelled(pages: DataFrame, html_col: str, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of at most ``most`` pages that mark their main text, by smallest hash; made in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys, widths = [], [], []
            for t in batch.column(0):
                found = blocks(t.as_py())
                labels = marked(found) if found else None
                if labels and len(found) <= 2000:
                    xs.append(features(found).astype(np.uint8).tobytes())
                    ys.append(bytes(labels))
                    widths.append(len(labels))
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["x", "y"])

    text = F.col(html_col).cast("string")
    chosen = pages.where(text.rlike("(?i)<(article|main)\\b")).select(text.alias("html")).orderBy(F.xxhash64("html"), "html").limit(most)
    out = []
    for r in chosen.mapInArrow(run, "x binary, y binary").collect():
        y = np.frombuffer(r["y"], np.uint8).astype(np.int64)
        out.append((np.frombuffer(r["x"], np.uint8).reshape(len(y), -1).astype(float), y))
    return out


def fit(pages: DataFrame, html_col: str = "html", most: int = LABELLED_PAGES) -> tuple[np.ndarray, np.ndarray]:
    own = sorted(labelled(pages, html_col, most), key=lambda p: (p[0].tobytes(), p[1].tobytes()))
    sequences = hand_labelled() * max(1, len(own) // 20)
    content = [F_AT["in_content"], F_AT["in_content_name"]]
    for x, y in own:
        inside, bare = x.copy(), x.copy()
        inside[:, content[0]] = 1
        bare[:, content] = 0
        sequences += [(x, y), (inside, y), (bare, y)]
    return train(sequences)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (one line per main block), n_chars of every row.

    A null or empty page, or one without main text, has an empty text. Repeated rows give repeated rows,
    an empty table an empty one; other columns are not read.
    """
    rows = pages.select(
        F.struct(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).alias("key"),
        F.col(html_col).cast("string").alias("html"),
    )
    shared = pages.sparkSession.sparkContext.broadcast(fit(rows, "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, t = shared.value

        def work(keys: list, texts: list) -> pa.RecordBatch:
            out = [main_text(x, w, t) for x in texts]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k["page_id"] for k in keys], pa.int64()),
                    pa.array([k["url"] for k in keys], pa.string()),
                    pa.array(out, pa.string()),
                    pa.array([len(x) for x in out], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

        return by_bytes(batches, work)

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
