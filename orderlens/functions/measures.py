"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def net_amount(price: str = "unit_price", quantity: str = "quantity",
               discount: str = "discount") -> Column:
    """Exact net amount of a line: price and discount are decimals, so sums do not depend
    on the order in which tasks deliver them."""
    return (F.col(price) * F.col(quantity) * (F.lit(1) - F.col(discount))).cast("decimal(18,4)")


def exact_avg(value: Column) -> Column:
    """Average as exact decimal sum over count, as a double."""
    return F.sum(value).cast("double") / F.count(value)


def rule_return_flag(net: Column, discount: Column, discount_min: float,
                     net_max: float) -> Column:
    limit = F.lit(str(discount_min)).cast("decimal(10,4)")
    ceiling = F.lit(str(net_max)).cast("decimal(18,4)")
    return F.when((discount >= limit) & (net < ceiling), 1).otherwise(0)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is NULL."""
    return F.when(condition, 1).otherwise(0)


def year_quarter(date: str | Column) -> Column:
    """'1997Q2'; NULL for a NULL date."""
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def safe_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Quotient rounded to ``places`` half away from zero; NULL for a zero denominator.

    A half counts as one when it is met to ten decimals, as if the quotient were first
    turned into a decimal; plain arithmetic does this without a decimal object per row.
    """
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    scale = 10.0 ** places
    half = F.lit(0.5 + scale * 5e-11)
    return F.signum(quotient) * F.floor(F.abs(quotient) * F.lit(scale) + half) / F.lit(scale)


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two dates, or elapsed whole 24-hour periods between timestamps
    once both sides are dates."""
    return F.datediff(later, earlier)


def within_days(later: Column, earlier: Column, days: int) -> Column:
    """False, not NULL, where one side is missing."""
    return F.coalesce(F.datediff(later, earlier) <= days, F.lit(False))


def parse_date(text: str | Column, strict: bool = False) -> Column:
    """Parse a date: malformed text becomes NULL, or raises when ``strict``."""
    return F.to_date(text) if strict else F.try_to_timestamp(text).cast("date")


def draw_hash(*parts: Column | str, seed: int) -> Column:
    """Stable pseudo-random text of a row: the same row draws the same value in every run,
    also when a lost task is computed again."""
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def uniform(hash_text: Column, start: int = 1) -> Column:
    """A number in [0, 1) from eight hex digits of ``draw_hash``."""
    return F.conv(F.substring(hash_text, start, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))
