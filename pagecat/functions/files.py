"""File helpers: names, types, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagecat.functions.numbers import ratio_text_expr
from pagecat.functions.text import let, strip_expr

# Fixed value: a size as people write it, at the start of a text.
_SIZE = r"(?i)^([0-9.]+)\s*([KMGT]?B)"


def file_name_expr(url: Column) -> Column:
    """Last path segment without the query."""
    return F.substring_index(F.substring_index(url, "/", -1), "?", 1)


def file_type_expr(name: Column) -> Column:
    """Upper-case text after the last dot; the whole name if there is no dot."""
    return F.upper(F.substring_index(name, ".", -1))


def _units(size: Column, step: int, text) -> Column:
    return (
        F.when(size >= step**3, F.concat(text(3), F.lit(" GB")))
        .when(size >= step**2, F.concat(text(2), F.lit(" MB")))
        .when(size >= step, F.concat(text(1), F.lit(" KB")))
        .otherwise(F.concat(size.cast("string"), F.lit(" B")))
    )


def human_size_expr(size: Column) -> Column:
    """Decimal units, two digits."""
    return _units(size, 1000, lambda power: ratio_text_expr(size, 1000**power))


def _binary_size_expr(size: Column) -> Column:
    # Division by a power of two is exact, so ties are true ties.
    return _units(
        size,
        1024,
        lambda power: F.bround(size.cast("double") / F.lit(1024.0**power), 1).cast("decimal(38,1)").cast("string"),
    )


def _truncated(value: Column) -> Column:
    """A double without its fraction; null past 38 digits."""
    return F.coalesce(value.try_cast("bigint").cast("decimal(38,0)"), value.try_cast("decimal(38,0)"))


def parse_size_expr(text: Column) -> Column:
    """Size text -> struct(human, bytes), in units of 1024; (text, 0) where it is no size.

    ``bytes`` is a decimal of 38 digits, so that sizes past the range of a bigint are kept.
    """
    def parts(clean: Column) -> Column:
        return F.struct(
            clean.alias("text"),
            F.regexp_extract(clean, _SIZE, 1).try_cast("double").alias("value"),
            F.upper(F.regexp_extract(clean, _SIZE, 2)).alias("unit"),
        )

    def in_bytes(part: Column) -> Column:
        factor = F.lit(1.0)
        for power, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
            factor = F.when(part["unit"] == unit, 1024.0**power).otherwise(factor)
        size = _truncated(part["value"] * factor)
        return F.struct(part["text"].alias("text"), size.alias("size"))

    def result(sized: Column) -> Column:
        size = sized["size"]
        human = F.when(size.isNull(), sized["text"]).otherwise(_binary_size_expr(size))
        return F.struct(
            human.alias("human"), F.coalesce(size, F.lit(0).cast("decimal(38,0)")).alias("bytes")
        )

    clean = F.replace(strip_expr(text), F.lit(","), F.lit(""))
    return let(let(let(clean, parts), in_bytes), result)


def classify_file_expr(title: Column, name: Column) -> Column:
    """The title where there is one, else a kind read off the file name."""
    lower = F.lower(name)
    bin_size = F.regexp_replace(F.regexp_extract(lower, "([0-9]+)um", 1), "^0+(?=[0-9])", "")
    binned = F.when(bin_size == "", "Binned Output (GZ)").otherwise(
        F.concat(F.lit("Binned Output ("), bin_size, F.lit("μm)"))
    )
    by_name = (
        F.when(lower.endswith(".btf"), "Microscope Image (BTF)")
        .when(lower.contains("square") & lower.endswith(".tar.gz"), binned)
        .when(lower.endswith(".gz"), "Compressed Archive (GZ)")
        .when(lower.endswith(".h5"), "Feature Matrix (H5)")
        .when(lower.endswith(".cloupe"), "Loupe File")
        .otherwise("Other")
    )
    return F.when(F.coalesce(title, F.lit("")) != "", title).otherwise(by_name)
