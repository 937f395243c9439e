"""Declared schemas: no layer relies on inference."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED_FIELDS = ["market", "product_name", "search_term", "collected_at"]
NUMERIC_FIELDS = ["price", "unit_price", "wholesale_price"]

BRONZE_FIELDS = [
    "market", "product_name", "price", "unit_price", "category", "brand", "source_product_id",
    "sku", "ean", "searched_ean", "ean_source", "search_term", "cep", "collected_at",
    "source_url", "image_url", "wholesale_price",
]


def _field(name: str) -> T.StructField:
    kind = T.DoubleType() if name in NUMERIC_FIELDS else T.StringType()
    return T.StructField(name, kind, True)


RECORD = T.StructType([_field(n) for n in BRONZE_FIELDS])

BRONZE = T.StructType(RECORD.fields + [
    T.StructField("record_id", T.StringType(), True),
    T.StructField("bronze_ingestion_timestamp", T.StringType(), True),
    T.StructField("bronze_run_id", T.StringType(), True),
    T.StructField("bronze_data_version", T.StringType(), True),
    T.StructField("bronze_error_flag", T.BooleanType(), True),
])

BRONZE_PARTITIONS = ["market", "year", "month", "day", "run_id"]
SILVER_PARTITIONS = ["market", "year", "month", "day", "transformation_id"]

SILVER_REQUIRED = ["market", "product_name_normalized", "price_normalized", "unit_price",
                   "category_normalized", "ean", "collected_at"]

PAYLOAD = T.StructType([
    T.StructField("market", T.StringType()),
    T.StructField("search_term", T.StringType()),
    T.StructField("cep", T.StringType()),
    T.StructField("collected_at", T.StringType()),
    T.StructField("raw_response_type", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
])

# DDL text. Nested payload shapes, only the fields that are read. Numbers are read as
# text, so that one bad value gives NULL in one field and keeps its record.
GRAPHQL = (
    "data STRUCT<search STRUCT<products STRUCT<edges ARRAY<STRUCT<node STRUCT<"
    "id STRING, sku STRING, name STRING, brand STRUCT<name STRING>, "
    "offers STRUCT<highPrice STRING, lowPrice STRING>, "
    "breadcrumbList STRUCT<itemListElement ARRAY<STRUCT<name STRING>>>, "
    "image ARRAY<STRUCT<url STRING>>>>>>>>"
)
SEARCH_HITS = (
    "hits ARRAY<STRUCT<objectID STRING, sku STRING, name STRING, barcode STRING, brand STRING, "
    "category STRING, sale_price STRING, wholesale_sale_price STRING, image STRING>>"
)

SEED = "ean STRING, descricao_referencia STRING"
LEGACY_PRODUCT = (
    "ean STRING, descricao STRING, marca STRING, preco_unitario DOUBLE, "
    "preco_atacado DOUBLE, rede STRING"
)

RUN_AUDIT = (
    "layer STRING, run_id STRING, market STRING, "
    "execution STRUCT<run_date STRING, completed_at STRING, duration_seconds DOUBLE, "
    "status STRING>, "
    "records STRUCT<input BIGINT, output BIGINT, deduplicated BIGINT, errors BIGINT, "
    "deduplication_rate DOUBLE>, "
    "quality STRUCT<quality_score DOUBLE, status STRING, checks_passed INT>, "
    "null_rates MAP<STRING, DOUBLE>, batch_id STRING, source STRING"
)
