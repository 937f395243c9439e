"""Native tables over landed files: partitioned by month, clustered by product."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLUSTERS = 16
KEY = ["market", "source_product_id"]


@contextmanager
def native_tables(spark: SparkSession, path: str, bronze: DataFrame,
                  clusters: int = CLUSTERS) -> Iterator[dict[str, str]]:
    """CREATE TABLE AS SELECT: ``records`` and ``products``, clustered by the same key.

    A task writes one cluster, so each month has one file per cluster that it needs. The
    tables are dropped at the end; the files stay below ``path``.
    """
    tag = uuid.uuid4().hex
    tables = {name: f"bronze_{name}_{tag}" for name in ("records", "products")}
    key = ", ".join(KEY)
    try:
        spark.sql(f"""
            CREATE TABLE {tables['records']} USING PARQUET PARTITIONED BY (collected_date)
            CLUSTERED BY ({key}) SORTED BY ({key}) INTO {clusters} BUCKETS
            LOCATION '{path}/records' AS
            SELECT /*+ REPARTITION({clusters}, {key}) */ record_id, {key}, search_term, price,
                   collected_at,
                   CAST(date_trunc('month', to_timestamp(collected_at)) AS DATE) AS collected_date
            FROM {{bronze}}""", bronze=bronze)
        spark.sql(f"""
            CREATE TABLE {tables['products']} USING PARQUET
            CLUSTERED BY ({key}) SORTED BY ({key}) INTO {clusters} BUCKETS
            LOCATION '{path}/products' AS
            SELECT /*+ REPARTITION({clusters}, {key}) */ {key}, max(collected_at) AS newest
            FROM {tables['records']} GROUP BY {key}""")
        yield tables
    finally:
        for name in tables.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def with_newest(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Every record beside the newest date of its product: a merge join without a shuffle."""
    products = spark.table(tables["products"]).hint("merge")
    return spark.table(tables["records"]).join(products, KEY)


def months_with_newest(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    return with_newest(spark, tables).groupBy("market", "collected_date").agg(
        F.count(F.lit(1)).alias("records"), F.min("record_id").alias("first_record"),
        F.max("newest").alias("newest_of_product"))
