"""Text helpers: whitespace, HTML entities, tags, visible text, keyword rules."""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separators U+001C..U+001F.
WS = r"[\s\x1C-\x1F]"
_WS_RUN = rf"(?U){WS}+"
_WS_CHARACTERS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# The rest of a tag after its name: quoted values may hold '>'. Possessive: no backtracking.
# Patterns start with a plain '<', which skips text fastest.
TAG_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# The content of a script is skipped by runs of text without '<', not character by character.
_UNSEEN = (
    r"(?s)<(?:!--.*?(?:-->|\z)|"
    r"(?i:(script|style|noscript|template{head})\b(?:[^<]++|<(?!/\1\s*>))*+(?:</\1\s*>|\z)))"
)
_NO_CONTENT = _UNSEEN.format(head="")
_NO_CONTENT_OR_HEAD = _UNSEEN.format(head="|head")
_BREAKS = (
    r"</?(?i:address|article|aside|blockquote|body|br|caption|dd|details|dialog|div|dl|dt|"
    r"fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|legend|li|main|menu|nav|ol|p|"
    rf"pre|section|summary|table|tbody|tfoot|thead|tr|ul)\b{TAG_REST}"
)
_CELLS = rf"</?(?i:t[dh])\b{TAG_REST}"
_TAGS = rf"<[A-Za-z/!?]{TAG_REST}"
# Stands for a line break while white space of the source still is in the text.
_MARK = "\x01"

_NUMBER = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
_NAME = r"^[A-Za-z][A-Za-z0-9]*;?"
_COMMON = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": " "}
# Names with their semicolon, and the old ones that HTML also reads without it.
_OLD_NAMES = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)) + ")"
# Browsers read the C1 range of numeric entities as the Windows code page.
_WINDOWS = {
    str(code): bytes([code]).decode("cp1252")
    for code in range(0x80, 0xA0)
    if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
}
# Code points that a numeric entity drops: controls and what is never a character.
_NO_CHARACTERS = ((0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x7F), (0xFDD0, 0xFDEF))


def let(c: Column, use) -> Column:
    """``use(c)`` with ``c`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def rest_expr(pieces: Column) -> Column:
    """All elements but the first. (A length past any array's end, so it is named only once.)"""
    return F.slice(pieces, 2, 1_000_000_000)


def strip_expr(c: Column) -> Column:
    """Drop white space (all of Unicode's, not only blanks) at both ends."""
    return F.btrim(c, F.lit(_WS_CHARACTERS))


def squash_ws_expr(c: Column) -> Column:
    """Strip, and collapse every run of white space to one blank."""
    return F.trim(F.regexp_replace(c, _WS_RUN, " "))


def _map_of(table: dict[str, str]) -> Column:
    """A map literal (the optimizer folds the parse of a constant)."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _character(code: Column) -> Column:
    """Code point to text; zero, surrogates and numbers past Unicode become U+FFFD, others drop."""
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(code)), 8, "0"))
    plain = F.decode(utf32, "UTF-32")
    windows = F.try_element_at(_map_of(_WINDOWS), code.cast("string"))
    dropped = reduce(lambda a, b: a | b, [code.between(*pair) for pair in _NO_CHARACTERS])
    dropped = ~bad & (dropped | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    return (
        F.when(dropped, "")
        .when(code.between(0x80, 0x9F), F.coalesce(windows, plain))
        .otherwise(plain)
    )


def _number_text(found: Column) -> Column:
    """Text of a numeric entity without '&', however many digits it has."""
    hexadecimal = found.rlike("^#[xX]")
    digits = F.regexp_replace(F.regexp_replace(found, "^#[xX]?0*|;$", ""), "^$", "0")
    # More digits than Unicode has are past its end, and past a bigint.
    code = F.when(F.length(digits) > 7, F.lit(0x110000).cast("bigint")).otherwise(
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    )
    return _character(code)


def unescape_expr(c: Column) -> Column:
    """Replace HTML entities in one pass, so text that spells an entity is never decoded twice."""

    def decode(piece: Column, i: Column) -> Column:
        number = F.regexp_extract(piece, _NUMBER, 0)
        name = F.regexp_extract(piece, _NAME, 0)
        common = reduce(
            lambda chain, item: chain.when(name == f"{item[0]};", item[1]),
            list(_COMMON.items())[1:],
            F.when(name == "amp;", "&"),
        )
        whole = F.coalesce(common, F.try_element_at(_map_of(html5), name))
        old = F.regexp_extract(piece, _OLD_NAMES, 0)

        def followed(text: Column, found: Column) -> Column:
            return F.concat(text, F.substr(piece, F.length(found) + 1))

        decoded = F.when(number != "", followed(_number_text(number), number)).otherwise(
            F.coalesce(
                F.when(name != "", followed(whole, name)),
                F.when(old != "", followed(F.try_element_at(_map_of(html5), old), old)),
            )
        )
        return F.when(i == 0, piece).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), piece)))

    return let(
        c,
        lambda text: F.when(
            text.contains("&"), F.array_join(F.transform(F.split(text, "&"), decode), "")
        ).otherwise(text),
    )


def drop_unseen_expr(html: Column) -> Column:
    """Drop comments, scripts and styles, which hold text that looks like tags."""
    return F.regexp_replace(html, _NO_CONTENT, "")


def inline_text_expr(fragment: Column) -> Column:
    """Text of a cell, link or heading on one line."""
    broken = F.regexp_replace(drop_unseen_expr(fragment), _BREAKS, " ")
    return squash_ws_expr(unescape_expr(F.regexp_replace(broken, _TAGS, "")))


def page_heading_expr(html: Column) -> Column:
    """Text of the first h1, '' if there is none."""
    seen = drop_unseen_expr(html)
    return inline_text_expr(F.regexp_extract(seen, rf"(?is)<h1\b{TAG_REST}(.*?)</h1\s*>", 1))


def visible_text_expr(html: Column) -> Column:
    """Visible text of a page: one line per block, white space collapsed, entities decoded."""
    body = F.regexp_replace(html, _NO_CONTENT_OR_HEAD, "")
    marked = F.regexp_replace(F.regexp_replace(body, _BREAKS, _MARK), _CELLS, " ")
    text = unescape_expr(F.regexp_replace(marked, _TAGS, ""))
    one_line = F.regexp_replace(text, _WS_RUN, " ")
    lines = F.regexp_replace(one_line, f"{_MARK}[ {_MARK}]*", "\n")
    return strip_expr(F.replace(lines, F.lit(" \n"), F.lit("\n")))


def has_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(word) for word in words])


def first_label(c: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Label of the first rule with a word inside the text, null if none."""
    (label, words), *rest = rules
    return reduce(
        lambda chain, rule: chain.when(has_any(c, rule[1]), rule[0]),
        rest,
        F.when(has_any(c, words), label),
    )


def detect_first_expr(text: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """First rule whose word occurs anywhere in the (lower-cased) text, '' if none."""
    return F.coalesce(first_label(text, rules), F.lit(""))


def label_by_line_expr(text: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Label of the first line with a hit; within a line the first rule wins; '' if none."""
    labels = F.transform(F.split(F.lower(text), "\n"), lambda line: first_label(line, rules))
    return F.coalesce(F.get(F.filter(labels, lambda label: label.isNotNull()), F.lit(0)), F.lit(""))
