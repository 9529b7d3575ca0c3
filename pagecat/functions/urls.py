"""URL helpers: query parameters, listing page URLs, link tests, relative links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat import rules

_PARTS = r"(?s)^([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*:)?"
_SITE = r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?"


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def _encode(c: Column) -> Column:
    # Java leaves '*' and escapes '~'; query strings here do the opposite.
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _pairs(url: Column) -> Column:
    fields = F.filter(
        F.split(F.regexp_extract(url, _PARTS, 2), "&"),
        lambda field: field.rlike("(?s)^[^=]*=."),
    )
    return F.transform(
        fields,
        lambda field: F.struct(
            _decode(F.substring_index(field, "=", 1)).alias("k"),
            _decode(F.substr(field, F.instr(field, "=") + 1)).alias("v"),
        ),
    )


def query_params_expr(url: Column) -> Column:
    """Query string as key -> list of values, in order of first use; blank values dropped."""
    pairs = _pairs(url)
    keys = F.array_distinct(F.transform(pairs, lambda pair: pair["k"]))
    values = F.transform(
        keys,
        lambda key: F.transform(
            F.filter(pairs, lambda pair: pair["k"] == key), lambda pair: pair["v"]
        ),
    )
    return F.map_from_arrays(keys, values)


def set_query_param_expr(url: Column, key: str, value: Column) -> Column:
    """Replace one parameter in place, or append it, and encode the query anew."""
    params = query_params_expr(url)
    new = F.array(value.cast("string"))
    entries = F.transform(
        F.map_entries(params),
        lambda e: F.struct(
            e["key"].alias("k"), F.when(e["key"] == key, new).otherwise(e["value"]).alias("v")
        ),
    )
    appended = F.concat(entries, F.array(F.struct(F.lit(key).alias("k"), new.alias("v"))))
    fields = F.transform(
        F.when(F.map_contains_key(params, key), entries).otherwise(appended),
        lambda e: F.array_join(
            F.transform(e["v"], lambda v: F.concat(_encode(e["k"]), F.lit("="), _encode(v))), "&"
        ),
    )
    base = F.regexp_extract(url, _PARTS, 1)
    scheme = F.regexp_extract(base, _SCHEME, 1)
    fragment = F.regexp_extract(url, _PARTS, 3)
    return F.concat(
        F.lower(scheme),
        F.substr(base, F.length(scheme) + 1),
        F.lit("?"),
        F.array_join(fields, "&"),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def listing_urls(seeds: DataFrame, pages: int) -> DataFrame:
    """URLs of the first pages of every seed: page 0 is the seed untouched."""
    numbered = seeds.withColumn("page_num", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    paged = set_query_param_expr(F.col("url"), "page", F.col("page_num"))
    return numbered.withColumn(
        "page_url", F.when(F.col("page_num") == 0, F.col("url")).otherwise(paged)
    )


def is_dataset_link_expr(
    href: Column, include: str = rules.DATASET_LINK, exclude: str = rules.LISTING_LINK
) -> Column:
    return href.contains(include) & ~href.contains(exclude)


def _without_dots(path: Column) -> Column:
    """Resolve '.' and '..' segments of a path that starts with '/'."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(
            part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        )
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    slash = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.concat(F.array_join(kept, "/"), slash)


def resolve_href_expr(base: Column, href: Column) -> Column:
    """Absolute form of a link found on the page ``base``."""
    page = F.regexp_extract(base, _PARTS, 1)
    site = F.regexp_extract(page, _SITE, 1)
    folder = F.regexp_extract(F.substr(page, F.length(site) + 1), "^(.*/)?", 1)
    path = F.when(href.startswith("/"), href).otherwise(
        F.concat(F.when(folder == "", "/").otherwise(folder), href)
    )
    query = F.regexp_extract(path, r"(?s)^[^?#]*(.*)$", 1)
    plain = F.regexp_extract(path, _PARTS, 1)
    clean = F.when(plain.contains("/."), _without_dots(plain)).otherwise(plain)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page, _SCHEME, 1), href))
        .when(href == "", F.regexp_replace(base, "#.*$", ""))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(site, clean, query))
    )
