"""Product codes: cleaning, check digit, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola import dims


def norm_ean(c: Column) -> Column:
    digits = F.regexp_replace(c, r"[^0-9]", "")
    return F.when(F.length(digits).isin(*dims.EAN_LENGTHS), digits)


def check_digit(body: Column) -> Column:
    """Check digit of a 12-digit code: weights 1 and 3 in turn, complement to ten.

    The number is bound once, as the element of a one-item array: where the
    optimizer copies the expression into a filter, the input is not multiplied.
    """
    def digit_of(n: Column) -> Column:
        total = F.lit(0)
        for i in range(12):
            digit = F.call_function("div", n, F.lit(10 ** (11 - i))) % 10
            total = total + (digit if i % 2 == 0 else digit * 3)
        return ((F.lit(10) - total % 10) % 10).cast("int")

    return F.get(F.transform(F.array(body.try_cast("bigint")), digit_of), 0)


def with_validity(df: DataFrame, column: str = "ean", cleaned: str = "ean_normalized",
                  valid: str = "ean_valid", error: str | None = None) -> DataFrame:
    """Add the cleaned code, whether it is accepted (never NULL), and why not.

    The steps are separate projections, so the code is cleaned and its check digit
    computed once per row however often they are used.
    """
    raw, clean = F.col(column), F.col(cleaned)
    body = F.when(F.length(clean) == 13, F.substring(clean, 1, 12))
    out = df.withColumn(cleaned, norm_ean(raw)).withColumn("_body", body)
    out = out.withColumn("_check", check_digit(F.col("_body")).cast("string"))
    last = F.substring(clean, 13, 1)
    passes = F.col("_check").isNull() | (F.col("_check") == last)
    added = {valid: clean.isNotNull() & passes}
    if error:
        added[error] = (
            F.when(raw.isNull() | (raw == ""), F.lit("Empty EAN"))
            .when(clean.isNull(), F.concat(F.lit("Invalid format: "), raw))
            .when(~passes, F.concat(F.lit("Invalid check digit: expected "), F.col("_check"),
                                    F.lit(", got "), last)))
    return out.withColumns(added).drop("_body", "_check")


def searched_ean(term: Column) -> Column:
    """The search term itself when it has the form of a product code."""
    value = F.trim(term)
    return F.when(value.rlike(r"^([0-9]{8}|[0-9]{12,14})$"), value)


def resolved_ean(market: Column, returned: Column, searched: Column,
                 trusted: str = dims.TRUSTED_SEARCH_MARKET) -> tuple[Column, Column]:
    """(code, provenance): trusted search first, then the market's answer, then the search."""
    has_returned = returned.isNotNull() & (returned != "")
    from_search = searched.isNotNull() & ((market == trusted) | ~has_returned)
    code = F.when(from_search, searched).when(has_returned, returned)
    source = (F.when(from_search, F.lit("search_term"))
              .when(has_returned, F.lit("market_response")))
    return code, source


def resolve_ean(market: Column, returned: Column, searched: Column,
                trusted: str = dims.TRUSTED_SEARCH_MARKET) -> Column:
    code, source = resolved_ean(market, returned, searched, trusted)
    return F.struct(code.alias("ean"), source.alias("ean_source"))
