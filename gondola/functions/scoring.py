"""Row-level quality: completeness, score, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola import dims
from gondola.functions.numbers import in_price_range, round_half_up


def _present(name: str) -> Column:
    c = F.col(name)
    filled = c.isNotNull() & ((c != 0) if name == "price" else (c != ""))
    return F.when(filled, 1).otherwise(0)


def data_completeness() -> Column:
    """Share of the six key fields that are filled, in percent with one decimal."""
    filled = sum((_present(n) for n in dims.COMPLETENESS_FIELDS[1:]),
                 _present(dims.COMPLETENESS_FIELDS[0]))
    return round_half_up(filled * F.lit(100.0) / F.lit(float(len(dims.COMPLETENESS_FIELDS))), 1)


def quality_score(completeness: Column, valid: Column) -> Column:
    """40 % completeness, 30 valid code, 20 valid price, 10 brand."""
    score = (completeness * F.lit(0.4)
             + F.when(valid, 30).otherwise(0)
             + F.when(in_price_range(F.col("price")), 20).otherwise(0)
             + _present("brand") * 10)
    return round_half_up(score, 1)


def quality_flags(valid: Column, completeness: Column, category: Column) -> Column:
    """Flag names as a JSON array in text."""
    price = F.col("price")
    rules = [
        ("invalid_ean", ~valid & F.col("ean").isNotNull() & (F.col("ean") != "")),
        ("price_outlier", (price < dims.PRICE_MIN) | (price > dims.PRICE_MAX)),
        ("missing_brand", F.col("brand").isNull()),
        ("low_completeness", completeness < dims.MIN_COMPLETENESS),
        ("uncategorized", category == dims.UNCATEGORIZED),
    ]
    named = [F.when(rule, F.lit(f'"{name}"')) for name, rule in rules]
    return F.concat(F.lit("["), F.concat_ws(", ", *named), F.lit("]"))
