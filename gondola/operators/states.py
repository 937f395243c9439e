"""Month states: what a month contributes to summaries, kept so that it is read once.

A state row holds exact sums and mergeable sketches. Years, all time and medians over
many months come from merging rows, and a new or corrected month replaces its own
folder only: older records are never read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.functions import numbers
from gondola.operators.ordered import descending, micros

KLL_K = 800  # rank error of a median at most about half a percent (99 % confidence)
HLL_LG_K = 12  # relative standard error of distinct counts about 1.6 percent
ENTRY = ["product_name_normalized", "category_normalized", "brand_normalized", "ean"]


def month_of(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def kll_rank_bound(k: int = KLL_K) -> float:
    """Published rank error of a KLL sketch of size ``k`` at 99 % confidence."""
    return 2.296 / k ** 0.9021


def market_states(df: DataFrame, price: str = "price_normalized") -> DataFrame:
    """One row per market and month: counts, cents, range, sketches of codes and prices."""
    c = numbers.cents(F.col(price))
    return df.groupBy("market", month_of(F.col("collected_at")).alias("month")).agg(
        F.count(F.lit(1)).alias("records"), F.count(c).alias("priced"), F.sum(c).alias("cents"),
        F.min(price).alias("lo"), F.max(price).alias("hi"),
        F.hll_sketch_agg("ean", HLL_LG_K).alias("codes"),
        F.kll_sketch_agg_double(F.col(price).cast("double"), KLL_K).alias("prices"))


def catalog_states(df: DataFrame) -> DataFrame:
    """One row per month, catalogue entry and market: range, cents and the newest price."""
    c = numbers.cents(F.col("price_normalized"))
    age = F.struct(descending(micros(F.col("collected_at"))).alias("age"), "record_id")
    newest = F.min_by(F.struct("market", F.col("price_normalized").alias("price"),
                               "collected_at"), age)
    return (df.filter(F.col("ean").isNotNull())
            .groupBy(month_of(F.col("collected_at")).alias("month"), *ENTRY, "market").agg(
                F.min("price_normalized").alias("lo"), F.max("price_normalized").alias("hi"),
                F.sum(c).alias("cents"), F.count(c).alias("priced"),
                newest.alias("latest"), F.min(age).alias("latest_age")))


def refresh(states: DataFrame, path: str) -> str:
    """Write state rows; folders of the months they hold are replaced, others stay."""
    (states.hint("rebalance", "month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
    return path


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """All state rows; the month stays text, so that filters on it prune folders."""
    fields = spark.read.parquet(path).schema.fields
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "month" else f
                         for f in fields])
    return spark.read.schema(text).parquet(path)


def in_months(df: DataFrame, months: Sequence[str]) -> DataFrame:
    """Records of the named months; on a partitioned layer use its folders instead."""
    return df.filter(month_of(F.col("collected_at")).isin(list(months)))


def market_rollup(states: DataFrame) -> DataFrame:
    """Market states merged to months, years and all time (NULL year, NULL month)."""
    parts = states.withColumns({"year": F.substring("month", 1, 4),
                                "month": F.substring("month", 6, 2)})
    sets = [[F.col("market"), F.col("year"), F.col("month")],
            [F.col("market"), F.col("year")], [F.col("market")]]
    return parts.groupingSets(sets, "market", "year", "month").agg(
        F.sum("records").alias("records"), F.sum("priced").alias("priced"),
        (F.sum("cents") / 100.0).alias("price_sum"), F.min("lo").alias("min_price"),
        F.max("hi").alias("max_price"), F.hll_union_agg("codes").alias("codes"),
        F.kll_merge_agg_double("prices").alias("prices"))


def distinct_codes(rollup: DataFrame) -> DataFrame:
    """Estimated distinct product codes of every rollup row."""
    return rollup.select("market", "year", "month",
                         F.hll_sketch_estimate("codes").alias("codes"))


def medians(rollup: DataFrame) -> DataFrame:
    """Approximate median of every rollup row, with the error its rank may have."""
    some = F.col("priced") > 0
    median = F.when(some, F.kll_sketch_get_quantile_double("prices", F.lit(0.5)))
    return rollup.select("market", "year", "month", F.col("records").alias("record_count"),
                         "priced", median.alias("median_price"),
                         F.lit(kll_rank_bound()).alias("rank_bound"))


def catalog_rollup(states: DataFrame) -> DataFrame:
    """Catalogue entries over all stored months: price range, mean, newest price per market."""
    per = states.groupBy(*ENTRY, "market").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("cents").alias("s"),
        F.sum("priced").alias("n"), F.min_by("latest", "latest_age").alias("latest"))
    return per.groupBy(*ENTRY).agg(
        F.min("lo").alias("min_price"), F.max("hi").alias("max_price"),
        numbers.mean_of_cents(F.sum("s"), F.sum("n")).alias("avg_price"),
        F.count(F.lit(1)).alias("market_count"),
        F.sort_array(F.collect_list("latest")).alias("latest_by_market")).select(
        F.col("product_name_normalized").alias("product_name"),
        F.col("category_normalized").alias("category"), F.col("brand_normalized").alias("brand"),
        "ean", "min_price", "max_price", "avg_price", "market_count", "latest_by_market")
