"""Single-value helpers: donor counts, publication dates, stage status, filled values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecat import rules

_TIME = r"(?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?"
_OFFSET = r"(?:Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:\.\d+)?)?)?)?"
_LONG_DATE = rf"(?s)^\d{{4}}-\d\d-\d\d(?:.{_TIME}{_OFFSET})?$"
_SHORT_DATE = rf"(?s)^\d{{8}}(?:.{_TIME}{_OFFSET})?$"


def donor_count_expr(count: Column) -> Column:
    """Donor count as text; zero and missing are ''."""
    return F.when(count.isNull() | count.isin("", "0"), "").otherwise(count)


def date_published_expr(published: Column) -> Column:
    """Day of an ISO instant in its own offset; anything else stays as it is; missing is ''."""
    day = F.when(published.rlike(_LONG_DATE), F.substring(published, 1, 10)).when(
        published.rlike(_SHORT_DATE),
        F.concat_ws(
            "-",
            F.substring(published, 1, 4),
            F.substring(published, 5, 2),
            F.substring(published, 7, 2),
        ),
    )
    real = F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    return F.when(real, day).otherwise(F.coalesce(published, F.lit("")))


def stage_status_expr(exit_code: Column, kind: str = "stage") -> Column:
    """Status of a stage by its exit code, as the runner or one of the wrappers names it."""
    names, other = rules.STAGE_STATUS[kind]
    (first, name), *rest = names.items()
    chain = reduce(
        lambda case, item: case.when(exit_code == item[0], item[1]),
        rest,
        F.when(exit_code == first, name),
    )
    return chain.otherwise(other)


def filled_expr(c: Column, dtype: T.DataType) -> Column:
    """Whether a value counts as filled: not null, not '', not 0, not false, not empty."""
    if isinstance(dtype, T.StringType):
        test = c != ""
    elif isinstance(dtype, T.BooleanType):
        test = c
    elif isinstance(dtype, T.NumericType):
        test = c != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))
