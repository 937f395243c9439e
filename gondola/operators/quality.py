"""Dataset quality: one aggregate per batch, then rules over its numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola import dims
from gondola.functions import numbers

r4 = lambda c: numbers.round_half_up(c, 4)


def profile(df: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """Every count the checks need, one row per batch, from one pass.

    ``df`` is a Silver table after deduplication. All aggregates combine before
    the shuffle, so a batch may be of any size. Means and deviations come from whole cents
    and tenths, so a price at a limit stays on its side whatever the order of rows.
    """
    price = F.col("price")
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in dims.NULL_RATE_LIMITS]
    score = F.col("data_completeness")
    brand = F.lower("brand")
    sums = numbers.exact_price_sums(price)
    mean, std = numbers.mean_and_deviation(*(F.col(f"_{k}") for k in sums))
    out = df.groupBy(*keys).agg(
        *[c.alias(f"_{k}") for k, c in sums.items()],
        F.count(F.lit(1)).alias("n"), *nulls,
        F.count("price").alias("n_price"),
        F.count_if((price < dims.PRICE_MIN) | (price > dims.PRICE_MAX)).alias("out_of_range"),
        F.count_if(price < 0).alias("negative"),
        F.count("ean").alias("n_ean"),
        F.count_if(F.col("ean").isNotNull() & F.col("ean_valid")).alias("n_valid_ean"),
        F.coalesce(F.sum("duplicate_count"), F.lit(0)).alias("dup_removed"),
        F.count_if(F.col("duplicate_count") > 0).alias("dup_kept_rows"),
        F.count_if(F.col("is_duplicate")).alias("dup_marked"),
        numbers.exact_mean(score, 1).alias("avg_completeness"), F.min(score).alias("min_completeness"),
        F.count_if(score < dims.MIN_COMPLETENESS).alias("n_incomplete"),
        F.count_if(brand.isin(dims.SUSPICIOUS_BRANDS)).alias("n_suspicious"),
        F.count_if(F.col("category_normalized") == dims.UNCATEGORIZED).alias("n_uncategorized"))
    return out.withColumns({"mean_price": mean, "std_price": std}).drop(*[f"_{k}" for k in sums])


def with_outliers(df: DataFrame, prof: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """Add ``n_outlier``: prices above mean + 3 sample deviations of their batch.

    The limits have one row per batch; adaptive execution broadcasts them if they are small.
    """
    limits = prof.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                         (F.col("mean_price") + 3 * F.col("std_price")).alias("_limit"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    counts = (df.join(limits, same).groupBy(*keys)
              .agg(F.count_if(F.col("price") > F.col("_limit")).alias("n_outlier"))
              .select(*[F.col(k).alias(f"_o_{k}") for k in keys], "n_outlier"))
    back = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    return prof.join(counts, back, "left").drop(*[f"_o_{k}" for k in keys])


def rate(part: str, whole: str = "n") -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


def null_issue(column: str) -> Column:
    return rate(f"null_{column}") > F.lit(dims.NULL_RATE_LIMITS[column])


def failed_checks() -> dict[str, Column]:
    """The seven checks as "this one failed" conditions over :func:`with_outliers` rows."""
    return {
        "null_rates": reduce(lambda a, b: a | b, [null_issue(c) for c in dims.NULL_RATE_LIMITS]),
        "price_validation": (F.col("n_price") == 0) | (F.col("out_of_range") > 0)
        | (F.col("n_outlier") > 0) | (F.col("negative") > 0),
        "ean_validation": rate("n_valid_ean", "n_ean") < dims.MIN_EAN_VALID_RATE,
        "duplicates": (F.col("dup_removed") > 0) | (F.col("dup_marked") > 0),
        "completeness": (F.col("n") == 0)
        | (F.col("avg_completeness") < dims.MIN_COMPLETENESS),
        "brands": (rate("null_brand") > dims.MAX_MISSING_BRAND_RATE)
        | (F.col("n_suspicious") > 0),
        "categories": rate("n_uncategorized") > dims.MAX_UNCATEGORIZED_RATE,
    }


def status_of(passed: Column) -> Column:
    """OK / WARNING / ALERT / CRITICAL from the number of passed checks."""
    share = passed / F.lit(float(dims.TOTAL_CHECKS))
    return (F.when(passed == dims.TOTAL_CHECKS, "OK").when(share >= 0.7, "WARNING")
            .when(share >= 0.5, "ALERT").otherwise("CRITICAL"))


def status(checked: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """Passed checks, score in percent (two decimals) and status per batch."""
    fails = failed_checks()
    passed = sum((F.when(c, 0).otherwise(1) for c in fails.values()), F.lit(0))
    failed = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in fails.items()])
    out = checked.select(*keys, "n", passed.alias("checks_passed"), failed.alias("failed_checks"))
    score = numbers.round_half_up(F.col("checks_passed") * F.lit(100.0)
                                  / F.lit(float(dims.TOTAL_CHECKS)))
    return out.withColumns({"quality_score": score, "status": status_of(F.col("checks_passed"))})


def recommendations(checked: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """One row per batch and recommendation, in rule order (``position`` from 1)."""
    pct = lambda c: F.format_string("%.1f", numbers.round_half_up(c * 100.0, 1))
    text = []  # fixed values: the texts of the recommendations
    for c, limit in dims.NULL_RATE_LIMITS.items():
        advice = (F.lit(f"Fill or remove records with missing {c} (critical field)")
                  if limit == 0.0 else
                  F.concat(F.lit(f"Investigate missing {c} ("), pct(r4(rate(f"null_{c}"))),
                           F.lit("% null)")))
        text.append(F.when(null_issue(c), advice))
    some_price = F.col("n_price") > 0
    text += [
        F.when(some_price & (F.col("out_of_range") > 0),
               F.concat(F.lit("Review "), F.col("out_of_range").cast("string"),
                        F.lit(" out-of-range prices"))),
        F.when(some_price & (F.col("n_outlier") > 0),
               F.concat(F.lit("Investigate "), F.col("n_outlier").cast("string"),
                        F.lit(" price outliers"))),
        F.when(failed_checks()["ean_validation"],
               F.lit("Improve EAN quality - many invalid EANs detected")),
        F.when(F.col("dup_removed") > 0,
               F.concat(F.lit("Duplicates detected and removed ("),
                        pct(r4(rate("dup_removed"))), F.lit("%)"))),
        F.when(failed_checks()["completeness"],
               F.lit("Improve data completeness - many records missing key fields")),
    ]
    return (checked.select(*keys, F.posexplode(F.array_compact(F.array(*text)))
                           .alias("pos", "recommendation"))
            .select(*keys, (F.col("pos") + 1).alias("position"), "recommendation"))


def null_rate_issues(prof: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """Columns whose null rate is above their limit, with severity."""
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"null_{c}").alias("null_count"),
                     r4(rate(f"null_{c}")).alias("null_rate"), F.lit(limit).alias("threshold"),
                     F.lit("CRITICAL" if limit == 0.0 else "WARNING").alias("severity"),
                     null_issue(c).alias("bad"))
            for c, limit in dims.NULL_RATE_LIMITS.items()]
    return (prof.select(*keys, F.explode(F.array(*rows)).alias("r")).filter("r.bad")
            .select(*keys, "r.column_name", "r.null_count", "r.null_rate", "r.threshold",
                    "r.severity"))


def examples(df: DataFrame, bad: Column, columns: Sequence[str], k: int,
             keys: Sequence[str] = ("market",), order: Sequence[str] = ("record_id",)
             ) -> DataFrame:
    """First ``k`` bad rows per batch in a total order (limited before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.filter(bad).select(*dict.fromkeys([*keys, *order, *columns]))
            .withColumn("example", F.row_number().over(w)).filter(F.col("example") <= k)
            .select(*keys, "example", *columns))


def gate(df: DataFrame, statuses: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """Rows of batches that are not CRITICAL (semi join)."""
    good = (statuses.filter(F.col("status") != "CRITICAL")
            .select(*[F.col(k).alias(f"_g_{k}") for k in keys]))
    return df.join(good, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys], "left_semi")


def assess(df: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """Profile with outlier counts: the input of status and recommendations."""
    return with_outliers(df, profile(df, keys), keys)
