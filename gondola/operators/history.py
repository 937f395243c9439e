"""Partitions over time, catalogue views, and duplicate detection across records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.functions import numbers
from gondola.operators.ordered import best_row, descending, islands, micros


def partition_date() -> Column:
    """Date of a year / month / day folder."""
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"),
                       F.col("day").cast("int"))


def partition_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Inclusive date range; reads only the folders inside it."""
    return df.filter(partition_date().between(F.lit(first).cast("date"),
                                              F.lit(last).cast("date")))


def within_retention(df: DataFrame, today: Column, days: int) -> DataFrame:
    """Rows of folders not older than ``days`` (the rest may be archived)."""
    return df.filter(partition_date() >= F.date_sub(today, days))


def beyond_retention(df: DataFrame, today: Column, days: int) -> DataFrame:
    return df.filter(partition_date() < F.date_sub(today, days))


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the Parquet files below a folder: no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row: the bytes of all files below a folder."""
    return _listing(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def storage_report(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and files per market and day, from the file listing."""
    files = _listing(spark, path)
    part = lambda c: F.regexp_extract("path", f"/{c}=([^/]+)/", 1).alias(c)
    return (files.select(*map(part, ("market", "year", "month", "day")), "length")
            .groupBy("market", "year", "month", "day").agg(
                F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Level 1: newest record per (market, ean, day), with how many share the key."""
    keys = ["market", "ean", "day"]
    rows = df.filter(F.col("ean").isNotNull()).select(
        "market", "ean", F.to_date("collected_at").alias("day"), "collected_at", "record_id")
    out = best_row(rows, keys, [descending(micros(F.col("collected_at"))), F.col("record_id")],
                   [F.count(F.lit(1)).alias("records")])
    return out.select(*keys, "record_id", "records")


def cross_market_duplicates(df: DataFrame) -> DataFrame:
    """Level 2: lowest and highest priced record of codes sold in several markets."""
    rows = df.filter(F.col("ean").isNotNull() & F.col("price_normalized").isNotNull())
    p = F.col("price_normalized")
    per = rows.groupBy("ean", "market").agg(
        F.min(F.struct(p, "market", "record_id")).alias("low"),
        F.min(F.struct((-p).alias("neg"), "market", "record_id")).alias("high"))
    return (per.groupBy("ean").agg(F.min("low").alias("low"), F.min("high").alias("high"),
                                   F.count(F.lit(1)).alias("markets"))
            .filter("markets > 1")
            .select("ean", F.col("low.record_id").alias("low_record"),
                    F.col("high.record_id").alias("high_record"), "markets"))


def fuzzy_duplicates(df: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Level 3: same market and name, another code, price within ``tolerance``.

    ``df`` has one row per (market, name, code). Rows are put in price order per
    (market, name); a partner within the limit exists exactly when the neighbour above or
    below is one, because a neighbour is never further away. Partner codes are these
    neighbours, and a chain of partners is a group: numbered by price from 1, represented
    by its cheapest record. Pairs are not enumerated, and a group may be of any size.
    """
    rows = df.filter(F.col("ean_normalized").isNotNull()
                     & F.col("price_normalized").isNotNull()
                     & F.col("product_name_normalized").isNotNull()).select(
        "record_id", "market", "product_name_normalized", "ean_normalized", "price_normalized",
        numbers.cents(F.col("price_normalized")).alias("c"))
    c = F.col("c")
    below = (c - F.col("lower_c")) <= F.lit(tolerance) * F.col("lower_c")
    above = (F.col("upper_c") - c) <= F.lit(tolerance) * c
    seen = islands(rows, ["market", "product_name_normalized"], ["c", "record_id"],
                   {"lower_c": "c", "lower_ean": "ean_normalized"},
                   {"upper_c": "c", "upper_ean": "ean_normalized"}, below, "record_id")
    return seen.select(
        "record_id", "market", "product_name_normalized", "ean_normalized", "price_normalized",
        F.when(below, F.col("lower_ean")).alias("lower_partner"),
        F.when(above, F.col("upper_ean")).alias("upper_partner"),
        F.col("island").alias("group_no"), F.col("island_first").alias("representative"),
        (F.coalesce(below, F.lit(False)) | F.coalesce(above, F.lit(False)))
        .alias("is_fuzzy_duplicate"))
