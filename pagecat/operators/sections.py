"""Sections and key/value lines of a page body. All of it stays inside the page's row."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.functions.text import has_any, rest_expr, strip_expr

Headers = list[tuple[str, str | None]]
KeyRules = list[tuple[str, list[str]]]


def _section_of(first_line: Column, headers: Headers) -> Column:
    (prefix, section), *rest = headers
    return reduce(
        lambda case, h: case.when(first_line.startswith(h[0]), F.lit(h[1]).cast("string")),
        rest,
        F.when(first_line.startswith(prefix), F.lit(section).cast("string")),
    )


def _pieces(body: Column, headers: Headers) -> Column:
    """The body cut before every header line: array of (section, text).

    Each piece has one section, so no state is carried from line to line.
    """
    starts = "|".join(re.escape(prefix) for prefix, _ in headers)
    return F.transform(
        F.split(body, rf"(?U)\n(?=[[\s\x1C-\x1F]&&[^\n]]*(?:{starts}))"),
        lambda piece: F.struct(
            _section_of(strip_expr(F.substring_index(piece, "\n", 1)), headers).alias("section"),
            piece.alias("text"),
        ),
    )


def section_lines_expr(body: Column, headers: Headers = rules.SECTION_HEADERS) -> Column:
    """Lines of known sections: array of (pos, section, line), pos counted over the whole body."""
    lines = F.flatten(
        F.transform(
            _pieces(body, headers),
            lambda piece: F.transform(
                F.split(piece["text"], "\n"),
                lambda line, j: F.struct(
                    F.when(j > 0, piece["section"]).alias("section"), line.alias("line")
                ),
            ),
        )
    )
    numbered = F.transform(
        lines,
        lambda line, i: F.when(
            line["section"].isNotNull(),
            F.struct(
                i.alias("pos"),
                line["section"].alias("section"),
                strip_expr(line["line"]).alias("line"),
            ),
        ),
    )
    return F.filter(numbered, lambda line: line.isNotNull())


def body_sections(
    bodies: DataFrame, headers: Headers = rules.SECTION_HEADERS, body: str = "body"
) -> DataFrame:
    """One row per line of a known section: (…, pos, section, line)."""
    kept = [c for c in bodies.columns if c != body]
    return bodies.select(*kept, F.inline(section_lines_expr(F.col(body), headers)))


def section_first_line(sections: DataFrame, key: str = "dataset_url") -> DataFrame:
    """First non-empty line of every section of every page."""
    return (
        sections.where(F.col("line") != "")
        .groupBy(key, "section")
        .agg(F.min_by("line", "pos").alias("first_line"))
    )


def _key_text(line: Column) -> Column:
    bare = F.when(line.startswith("- "), F.substr(line, F.lit(3))).otherwise(line)
    return F.lower(strip_expr(F.substring_index(bare, ":", 1)))


def _value_text(line: Column) -> Column:
    return strip_expr(F.substr(line, F.instr(line, ":") + 1))


def section_key_values(sections: DataFrame, section: str = "imaging") -> DataFrame:
    """``key: value`` lines of one section, a leading dash dropped, keys in lower case."""
    kept = [c for c in sections.columns if c not in ("section", "line")]
    line = F.col("line")
    return sections.where((F.col("section") == section) & line.contains(":")).select(
        *kept, _key_text(line).alias("key"), _value_text(line).alias("value")
    )


def _field_of(key: Column, key_rules: KeyRules) -> Column:
    (field, words), *rest = key_rules
    return reduce(
        lambda case, rule: case.when(has_any(key, rule[1]), rule[0]),
        rest,
        F.when(has_any(key, words), field),
    )


def _usable(value: Column) -> Column:
    return ~value.isin("", "N/A")


def map_keys(
    key_values: DataFrame, key_rules: KeyRules = rules.IMAGING_RULES, key: str = "dataset_url"
) -> DataFrame:
    """Keys to fields by the words inside them; the first usable value of a field wins.

    One row per page, one column per field, in one aggregate.
    """
    mapped = key_values.where(_usable(F.col("value"))).withColumn(
        "field", _field_of(F.col("key"), key_rules)
    )

    def first(field: str) -> Column:
        here = F.col("field") == field
        value = F.min_by(F.when(here, F.col("value")), F.when(here, F.col("pos")))
        return F.coalesce(value, F.lit("")).alias(field)

    return mapped.groupBy(key).agg(*(first(field) for field, _ in key_rules))


def body_fields_expr(body: Column) -> Column:
    """The imaging fields of a body as (field, value) candidates in line order.

    A line of a text section stands for that section's own field; an imaging line goes by its key.
    Each step is a transform of its own, so a key is cut out once and then tested by every rule.
    """
    known = F.filter(
        _pieces(body, rules.SECTION_HEADERS), lambda piece: piece["section"].isNotNull()
    )

    def lines_of(piece: Column) -> Column:
        useful = F.filter(
            rest_expr(F.split(piece["text"], "\n")),
            lambda line: line.contains(":") | (piece["section"] != "imaging"),
        )
        return F.transform(
            useful,
            lambda line: F.struct(
                piece["section"].alias("section"), strip_expr(line).alias("line")
            ),
        )

    def with_key(entry: Column) -> Column:
        imaging = entry["section"] == "imaging"
        return F.struct(
            entry["section"].alias("section"),
            F.when(imaging, _key_text(entry["line"])).alias("key"),
            F.when(imaging, _value_text(entry["line"])).otherwise(entry["line"]).alias("value"),
        )

    def with_field(entry: Column) -> Column:
        field = F.when(entry["key"].isNull(), entry["section"]).otherwise(
            _field_of(entry["key"], rules.IMAGING_RULES)
        )
        blank = (entry["value"] == "") | (entry["key"].isNotNull() & (entry["value"] == "N/A"))
        return F.when(~blank, F.struct(field.alias("field"), entry["value"].alias("value")))

    steps = F.transform(F.flatten(F.transform(known, lines_of)), with_key)
    return F.filter(F.transform(steps, with_field), lambda c: c["field"].isNotNull())


def first_value_expr(candidates: Column, field: str) -> Column:
    hits = F.filter(candidates, lambda c: c["field"] == field)
    return F.coalesce(F.get(hits, F.lit(0))["value"], F.lit(""))
