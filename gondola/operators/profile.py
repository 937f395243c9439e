"""Descriptive summaries of a layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions import numbers
from gondola.operators.ordered import cents_round, price_stats

r2 = numbers.round_half_up


def describe(df: DataFrame, keys: Sequence[str], column: str, extra: dict[str, Column]
             ) -> DataFrame:
    """count, mean, std, min, exact quartiles, max of a two-decimal column per group.

    Equal values are counted first (``price_stats``), so quartiles need memory for
    distinct values, not for rows.
    """
    s = price_stats(df, keys, column, extra=[("_low", F.min(column), "min"),
                                             ("_high", F.max(column), "max")])
    cols = [*keys, F.col("n_prices").alias("count"), "mean", r2(F.col("stddev")).alias("std"),
            F.col("_low").alias("min"), cents_round(F.col("q25")).alias("q25"),
            cents_round(F.col("median")).alias("q50"), cents_round(F.col("q75")).alias("q75"),
            F.col("_high").alias("max")]
    out = s.select(*cols)
    if not extra:
        return out
    more = df.groupBy(*keys).agg(*[c.alias(n) for n, c in extra.items()])
    return out.join(more, list(keys)) if keys else out.crossJoin(F.broadcast(more))


def bronze_profile(df: DataFrame) -> DataFrame:
    """One row: records, repeats of (market, product id), bad prices, code coverage, nulls.

    Repeats come from a distinct count over the pair, which combines map-side.
    """
    pairs = df.groupBy("market", "source_product_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price") <= 0).alias("bad"),
        F.count("ean").alias("eans"), F.count_if(F.col("brand").isNull()).alias("nb"),
        F.count_if(F.col("category").isNull()).alias("nc"))
    n = F.sum("n")
    return pairs.agg(
        n.alias("records"), (n - F.count(F.lit(1))).alias("duplicates"),
        F.sum("bad").alias("invalid_prices"), F.sum("eans").alias("with_ean"),
        numbers.round_half_up(F.try_divide(F.sum("eans") * 100.0, n), 1).alias("ean_pct"),
        F.sum("nb").alias("null_brand"), F.sum("nc").alias("null_category"))


def impute_median(df: DataFrame, keys: Sequence[str] = ("market",)) -> DataFrame:
    """Fill a missing price with the median of its market and label where it came from.

    Medians have one row per market; adaptive execution broadcasts them by their size.
    """
    medians = price_stats(df, keys).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        cents_round(F.col("median")).alias("_median"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    p = F.col("price_normalized")
    label = (F.when(p.isNotNull(), "valid").when(F.col("_median").isNotNull(), "imputed")
             .otherwise("missing"))
    return df.join(medians, same, "left").select(
        *df.columns, F.coalesce(p, F.col("_median")).alias("price_filled"),
        label.alias("price_quality"))


def mean_of_tenths(name: str) -> Column:
    """Aggregate: mean of a one-decimal score with two decimals, by exact integers."""
    tenths = F.floor(F.col(name) * 10 + 0.5).cast("bigint")
    n = F.count(name)
    return F.call_function("div", F.sum(tenths) * 20 + n, n * 2) / 100.0


def daily_quality(df: DataFrame) -> DataFrame:
    """Quality measures per market and collection day."""
    return df.groupBy("market", F.to_date("collected_at").alias("day")).agg(
        F.count(F.lit(1)).alias("records"),
        mean_of_tenths("data_completeness").alias("avg_completeness"),
        mean_of_tenths("quality_score").alias("avg_score"),
        F.count_if("ean_valid").alias("valid_eans"),
        F.count_if(F.col("price_normalized").isNull()).alias("missing_prices"))


def score_histogram(df: DataFrame, bins: int = 10) -> DataFrame:
    """Records per equal-width bin between the lowest and the highest score.

    Scores repeat, so they are counted per value first; the range is one row.
    """
    counts = df.groupBy("quality_score").agg(F.count(F.lit(1)).alias("n"))
    span = counts.agg(F.min("quality_score").alias("lo"), F.max("quality_score").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.try_divide(F.col("quality_score") - F.col("lo"), width)
    slot = F.least(F.floor(F.coalesce(place, F.lit(0.0))) + 1, F.lit(bins))
    return (counts.crossJoin(F.broadcast(span)).withColumn("bin", slot.cast("bigint"))
            .groupBy("bin").agg(F.sum("n").alias("records"),
                                F.min("quality_score").alias("lowest"),
                                F.max("quality_score").alias("highest")))
