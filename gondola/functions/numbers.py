"""Prices, rounding and exact cent arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola import dims


def round_half_up(c: Column, digits: int = 2) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d``: the same in every engine, unlike ``round``."""
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def cents(c: Column) -> Column:
    """Whole cents of a non-negative price as BIGINT."""
    return F.floor(c * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def in_price_range(c: Column) -> Column:
    return c.between(F.lit(dims.PRICE_MIN), F.lit(dims.PRICE_MAX))


def norm_price(c: Column) -> Column:
    """Two decimals inside the accepted range, NULL outside it."""
    return F.when(in_price_range(c), round_half_up(c))


def parse_brl(c: Column) -> Column:
    """``R$ 1.234,56`` -> 1234.56; NULL when it is no number."""
    text = F.replace(F.replace(c, F.lit("R$"), F.lit("")), F.lit("."), F.lit(""))
    return safe_to_float(F.trim(F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")),
                                                 r"[\s ]+", "")))


def safe_to_float(c: Column) -> Column:
    """DOUBLE or NULL, never an error and never NaN."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def comma_to_float(c: Column) -> Column:
    """Number in text: ``4.5``, ``4,5``, ``R$ 1.234,50``.

    With a comma, points group thousands and the comma is the decimal sign.
    """
    text = F.regexp_replace(c.cast("string"), r"(?i)r\$|[\s\u00A0]+", "")
    brazilian = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return safe_to_float(F.when(F.contains(text, F.lit(",")), brazilian).otherwise(text))


def price_consistency(price: Column, unit_price: Column) -> Column:
    """Unit price at most 10 % above the price; TRUE when either is missing or 0."""
    missing = price.isNull() | unit_price.isNull() | (price == 0) | (unit_price == 0)
    return missing | (unit_price <= price * F.lit(1.1))


def price_tier(price: Column) -> Column:
    tier = F.lit(dims.TOP_TIER)
    for limit, name in reversed(dims.PRICE_TIERS):
        tier = F.when(price < limit, name).otherwise(tier)
    return tier


def mean_of_cents(total: Column, n: Column) -> Column:
    """Mean price with two decimals from an exact cent sum: integer half-up division.

    The division is floored, so that negative sums round half up as well.
    """
    twice, count = total * 2 + n, F.nullif(n * 2, F.lit(0))
    return F.when(n > 0, F.call_function("div", twice - F.pmod(twice, count), count)
                  / F.lit(100.0))


def exact_price_sums(price: Column) -> dict[str, Column]:
    """Aggregates of whole cents: count, sum and sum of squares, the same in any row order."""
    c = cents(price).cast("decimal(19,0)")
    return {"n": F.count(price), "s": F.sum(c), "q": F.sum((c * c).cast("decimal(38,0)"))}


def mean_and_deviation(n: Column, s: Column, q: Column) -> tuple[Column, Column]:
    """Mean and sample deviation in currency units from :func:`exact_price_sums`."""
    mean = F.when(n > 0, s.cast("double") / n.cast("double") / F.lit(100.0))
    return mean, stddev_of_cents(n, s, q)


def exact_mean(c: Column, digits: int) -> Column:
    """Aggregate: mean of a value with ``digits`` decimals, added up in whole numbers."""
    scale = float(10 ** digits)
    return F.sum(F.floor(c * F.lit(scale) + F.lit(0.5)).cast("bigint")) / F.count(c) / F.lit(scale)


def stddev_of_cents(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation in currency units; NULL below two values."""
    return F.sqrt(variance_of_cents(n, total, squares))


def variance_of_cents(n: Column, total: Column, squares: Column) -> Column:
    """Sample variance in currency units from exact sums of cents and squared cents.

    The difference of the two large products is taken in whole numbers.
    """
    count, whole = n.cast("decimal(19,0)"), total.cast("decimal(19,0)")
    spread = (count * squares.cast("decimal(38,0)") - whole * whole).cast("double")
    return F.when(n > 1, spread / (n * (n - 1)).cast("double") / F.lit(10000.0))
