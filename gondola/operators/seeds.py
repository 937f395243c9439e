"""Search seeds: distinct product codes, and code-by-market search lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola import dims
from gondola.functions import ean


def distinct_eans(records: DataFrame) -> DataFrame:
    """One row per valid code with the name of its first record (by ``record_id``)."""
    coded = ean.with_validity(records.select("ean", "product_name", "record_id"))
    return (coded.filter("ean_valid").groupBy(F.col("ean_normalized").alias("ean"))
            .agg(F.min_by("product_name", "record_id").alias("descricao_referencia")))


def trimmed_distinct(seed: DataFrame) -> DataFrame:
    code = F.trim(F.col("ean").cast("string"))
    return seed.select(code.alias("ean")).filter(F.length("ean") > 0).distinct()


def search_configs(seed: DataFrame, markets=tuple(dims.MARKET_CEPS)) -> DataFrame:
    """Every code searched in every market.

    The market list is a short literal, so each code is exploded in place: the
    product needs no join and no shuffle.
    """
    each = [F.struct(F.lit(m).alias("market"), F.lit(cep).cast("string").alias("cep"))
            for m, cep in markets]
    return (trimmed_distinct(seed).select("ean", F.explode(F.array(*each)).alias("m"))
            .select("m.market", F.col("ean").alias("search_term"), "m.cep"))


def default_searches(spark: SparkSession) -> DataFrame:
    """Searches used when no seed file exists."""
    return spark.createDataFrame(dims.DEFAULT_SEARCHES,
                                 "market STRING, search_term STRING, cep STRING")


def searches(spark: SparkSession, path: str) -> DataFrame:
    """Searches for the codes of a seed file; the default list if there is no such file."""
    from gondola.sources import writers

    try:
        return search_configs(writers.read_seed(spark, path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return default_searches(spark)
