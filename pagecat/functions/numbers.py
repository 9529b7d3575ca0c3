"""Rounding to a fixed number of digits as IEEE arithmetic does it.

A quotient such as 1015 / 1000 is no exact double: the nearest one lies just below 1.015, so two
digits give 1.01. Decimals alone cannot see that, so where the decimal value is a tie the double
itself decides. A double times a power of two is a whole number that fits a bigint, with a power for every
range of values, which makes the comparison exact. Past 2**53 an amount is no exact double itself; its
decimal quotient then gives the nearest double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


# Values below 2**a times 2**b fit a bigint; the range below starts where b bits are enough.
_SHIFTS = [(0, 60), (10, 52), (20, 42), (30, 32), (34, 28), (44, 18)]


def _whole(c: Column) -> Column:
    return c.cast("bigint").cast("decimal(20,0)")


def _over_tie(value: Column, numerator: Column, denominator: int, shift: int) -> Column:
    """Sign of ``value - numerator / denominator`` (value a double, scaled by 2**shift)."""
    scaled = _whole(value * F.lit(float(2**shift))) * F.lit(Decimal(denominator))
    return F.signum(scaled - numerator * F.lit(Decimal(2**shift)))


def ratio_text_expr(amount: Column, step: int) -> Column:
    """``amount / step`` as text with two digits (amount a bigint, step a power of ten)."""
    exact = amount.cast("decimal(20,0)")
    nearest = F.bround(exact * F.lit(Decimal(1) / Decimal(step)), 2).cast("decimal(20,2)").cast("string")
    # Most amounts are no tie and not negative: whole numbers give their nearest hundredth without decimals.
    unit = F.lit(step // 100).cast("bigint")
    hundredths = F.call_function("div", amount, unit) + F.when(amount % unit > step // 200, 1).otherwise(0)
    plain = F.concat(
        F.call_function("div", hundredths, F.lit(100)).cast("string"),
        F.lit("."),
        F.lpad((hundredths % 100).cast("string"), 2, "0"),
    )
    below = F.floor(exact * F.lit(Decimal(100) / Decimal(step))).cast("decimal(20,0)")
    quotient = (exact * F.lit(Decimal(1) / Decimal(step))).cast("double")
    value = F.when(amount < 2**53, amount / F.lit(float(step))).otherwise(quotient)
    # A tie with two digits is at least 0.005, whose last bit is worth 2**-60. Scaled values stay
    # below 2**62, and the last bit of the smallest value of a range is a whole number.
    side = _over_tie(value, exact, step, 8)
    for below_power, shift in reversed(_SHIFTS):
        side = F.when(value < 2.0**below_power, _over_tie(value, exact, step, shift)).otherwise(side)
    up = (side > 0) | ((side == 0) & (below % 2 == 1))
    tie = F.when(up, below + 1).otherwise(below) * F.lit(Decimal("0.01"))
    is_tie = amount % (step // 100) == step // 200
    return (
        F.when(is_tie, tie.cast("decimal(20,2)").cast("string"))
        .when(amount >= 0, plain)
        .otherwise(nearest)
    )


def round_one_digit_expr(value: Column) -> Column:
    """A double of at most 100 to one digit."""
    hundredths = F.round(value * 100).cast("bigint")
    is_tie = (hundredths % 10 == 5) & (hundredths / F.lit(100.0) == value)
    exact = hundredths.cast("decimal(20,0)")
    side = F.when(value < 1, _over_tie(value, exact, 100, 57)).otherwise(
        _over_tie(value, exact, 100, 52)
    )
    tenths = (hundredths - 5) / F.lit(10.0)
    up = (side > 0) | ((side == 0) & (tenths % 2 == 1))
    return F.when(is_tie, F.when(up, tenths + 1).otherwise(tenths) / F.lit(10.0)).otherwise(
        F.bround(value, 1)
    )
