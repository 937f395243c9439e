"""Bronze-shaped price records derived from star-schema tables.

Every ``lineitem`` row becomes one shelf observation: region is the market, part
the product. The same view feeds payloads (JSON, HTML), so that the flatteners
work on data that grows with the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.functions import ean as ean_fn
from gondola.functions.numbers import round_half_up

MARKETS = ["africa", "america", "asia", "europe", "middle_east"]

# fixed values: part type -> raw shelf category; dairy parts are dealt over four by their key
CATEGORY_OF_TYPE = {
    "SMALL": "Refrigerantes", "MEDIUM": "Carnes e Aves", "LARGE": "PADARIA",
    "STANDARD": "Brinquedos",
}
DAIRY_TYPE = "ECONOMY"
DAIRY_CATEGORIES = ["Leite e Derivados", "Leites", "Queijos", "Bebidas Lácteas"]

# with the date, what the id of a record is made of
IDENTITY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """17 record fields plus ``record_id``; ``collected_at`` stays a timestamp.

    Markets are found first, while rows are narrow. Products are merged in at every size:
    narrow rows are dealt by product, wide rows are made after that and are not shuffled,
    and what is summed up or deduplicated per product next finds its rows together.
    """
    products = _products(_coded(read(spark, sf_dir, "part"))).hint("merge")
    found = _placed(spark, sf_dir).join(products, F.col("l_partkey") == F.col("p_partkey"))
    found = found.withColumn("collected_at", F.col("l_shipdate"))
    return _record(found.withColumn("record_id", _record_id()))


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with market, ``collected_at`` and the raw columns of their product.

    ``record_id`` holds the columns that the text of the id is made of. What is dealt anew
    goes as these rows; the texts of a record, several times as wide, are made by
    :func:`records` where it arrives.
    """
    part = _coded(read(spark, sf_dir, "part")).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "_digit").hint("merge")
    return (_placed(spark, sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
            .withColumns({"record_id": F.struct(*IDENTITY), "collected_at": F.col("l_shipdate")})
            .drop("p_partkey", "l_shipdate", *IDENTITY))


def records(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The records of raw observations, with the ``keep`` columns beside them."""
    lines = raw.select(*[c for c in raw.columns if c != "record_id"], "record_id.*")
    found = _products(lines.withColumn("p_partkey", F.col("l_partkey")), lines.columns)
    return _record(found.withColumn("record_id", _record_id()), keep)


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their market."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    markets = (read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"),
                                                  F.col("n_regionkey") == F.col("r_regionkey"))
               .select("n_nationkey", F.replace(F.lower("r_name"), F.lit(" "), F.lit("_"))
                       .alias("market")))
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # one by one: the size of a joined dimension is not known before it is run
    return (lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(markets, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(*lines.columns, "market"))


def _body() -> Column:
    """The first 12 digits of a product's code."""
    return F.concat(F.lit("789"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))


def _coded(part: DataFrame) -> DataFrame:
    """Products with the check digit of their code."""
    return part.withColumn("_digit", ean_fn.check_digit(_body()))


def _products(part: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """What depends on the product alone; ``keep`` names other columns that stay."""
    key = F.col("p_partkey")
    part = part.withColumn("_body", _body())
    code = (F.when(key % 11 == 0, F.lit(None).cast("string"))
            .when(key % 13 == 0, F.substring("_body", 5, 8))
            .when(key % 7 == 0, F.concat("_body", ((F.col("_digit") + 1) % 10).cast("string")))
            .otherwise(F.concat("_body", F.col("_digit").cast("string"))))
    unit = F.when(key % 3 == 0, "ML ").when(key % 3 == 1, " Kg ").otherwise(" un ")
    dairy = F.array(*map(F.lit, DAIRY_CATEGORIES))[(key % len(DAIRY_CATEGORIES)).cast("int")]
    category = F.when(F.col("p_type") == DAIRY_TYPE, dairy)
    for kind, raw in CATEGORY_OF_TYPE.items():
        category = F.when(F.col("p_type") == kind, raw).otherwise(category)
    made = part.select(
        *keep, "p_partkey", code.alias("ean"), category.alias("category"),
        F.concat(F.lit("  "), F.upper("p_name"), F.lit("  "), F.col("p_size").cast("string"),
                 unit).alias("product_name"),
        F.when(key % 5 == 1, F.concat(F.upper("p_brand"), F.lit(" S/A")))
        .when(key % 5 != 0, F.col("p_brand")).alias("brand"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("_noun"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), key.cast("string"))
        .alias("_slug"))
    return made.withColumn("search_term", F.when((key % 4 == 0) & F.col("ean").isNotNull(),
                                                 F.col("ean")).otherwise(F.col("_noun")))


def _record_id() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("bigint"),
        F.floor(F.col("l_extendedprice") * 100.0 + 0.5).cast("bigint"),
        F.date_format("collected_at", "yyyyMMdd"))


def _record(base: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    key, slug = F.col("l_partkey"), F.col("_slug")
    each = F.col("l_extendedprice") / F.col("l_quantity")
    site = F.when(key % 17 == 0, F.lit("ftp://")).otherwise(F.lit("https://"))
    return base.select(
        F.col("market"), F.col("product_name"),
        F.when(F.col("l_linenumber") != 7, round_half_up(each)).alias("price"),
        round_half_up(each * (F.lit(1.0) - F.col("l_discount"))).alias("unit_price"),
        "category", "brand", key.cast("string").alias("source_product_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sku"), "ean",
        ean_fn.searched_ean(F.col("search_term")).alias("searched_ean"),
        F.when(F.col("ean").isNotNull(), F.lit("market_response")).alias("ean_source"),
        "search_term", F.when(F.col("market") == "america", F.lit("04543010")).alias("cep"),
        "collected_at",
        F.concat(site, F.col("market"), F.lit(".example/p/"), slug).alias("source_url"),
        F.when(key % 10 == 0, F.concat(F.lit("/img/"), slug))
        .when(key % 9 != 0, F.concat(F.lit("https://img.example/"), slug)).alias("image_url"),
        F.when(F.col("l_linenumber") != 1, round_half_up(
            each * (F.lit(1.0) + F.col("l_tax") - F.col("l_discount")))).alias("wholesale_price"),
        "record_id", *keep)


# --- payload views ------------------------------------------------------------

def graphql_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested JSON answer per observation: 0, 1 or 2 edges, 0 to 3 breadcrumbs.

    Prices go in as whole-cent text, as a web service prints them.
    """
    o = observations(spark, sf_dir)
    num = F.col("source_product_id").cast("bigint")
    crumbs = F.slice(F.array(F.struct(F.lit("Home").alias("name")),
                             F.struct(F.col("category").alias("name")),
                             F.struct(F.col("product_name").alias("name"))),
                     F.lit(1), (num % 4).cast("int"))
    images = F.when(F.col("image_url").isNotNull(),
                    F.array(F.struct(F.col("image_url").alias("url")),
                            F.struct(F.lit("https://img.example/second").alias("url"))))
    node = F.struct(
        F.col("source_product_id").alias("id"), F.col("sku"), F.col("product_name").alias("name"),
        F.when(F.col("brand").isNotNull(), F.struct(F.col("brand").alias("name"))).alias("brand"),
        F.struct(_money_text("price").alias("highPrice"),
                 _money_text("wholesale_price").alias("lowPrice")).alias("offers"),
        F.struct(crumbs.alias("itemListElement")).alias("breadcrumbList"),
        images.alias("image"))
    edge = F.struct(node.alias("node"))
    edges = (F.when(num % 6 == 5, F.slice(F.array(edge), 1, 0))
             .when(num % 6 == 4, F.array(edge, edge)).otherwise(F.array(edge)))
    body = F.to_json(F.struct(F.struct(F.struct(F.struct(edges.alias("edges")).alias("products"))
                                       .alias("search")).alias("data")))
    return _payload(o, "graphql_response", body)


def search_hit_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search answer per observation with two hits, or none."""
    o = observations(spark, sf_dir)
    hit = F.struct(F.col("source_product_id").alias("objectID"), F.col("sku"),
                   F.col("product_name").alias("name"), F.col("ean").alias("barcode"),
                   F.col("brand"), F.col("category"), _money_text("price").alias("sale_price"),
                   _money_text("wholesale_price").alias("wholesale_sale_price"),
                   F.col("image_url").alias("image"))
    num = F.col("source_product_id").cast("bigint")
    hits = F.when(num % 5 == 3, F.slice(F.array(hit), 1, 0)).otherwise(F.array(hit, hit))
    return _payload(o, "search_response", F.to_json(F.struct(hits.alias("hits"))))


def html_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result page per observation: two product cards and a plain link."""
    o = observations(spark, sf_dir)
    num = F.col("source_product_id").cast("bigint")
    text = F.concat(F.trim("product_name"), F.lit(" &amp; Cia"))
    money = F.concat(F.lit("R$ "), F.regexp_replace(F.replace(
        F.concat(F.floor(F.col("price")).cast("string"), F.lit(","),
                 F.lpad((F.floor(F.col("price") * 100.0 + 0.5).cast("bigint") % 100)
                        .cast("string"), 2, "0")),
        F.lit("."), F.lit("")), r"(?<=\d)(?=(\d{3})+,)", "."))
    link = F.concat(F.lit("/produto/p-"), F.col("source_product_id"),
                    F.when(num % 2 == 0, F.lit("?ref=1")).otherwise(F.lit("")))
    heading = F.when(num % 3 != 0, F.concat(F.lit("<h2 class=\"t\"><b>"), text,
                                            F.lit("</b></h2>"))).otherwise(F.lit(""))
    alt = F.when(num % 6 != 0, F.concat(F.lit(" alt=\""), text, F.lit("\""))).otherwise(F.lit(""))
    span = F.coalesce(F.concat(F.lit("<span class=\"b text-price-default c\">"), money,
                               F.lit("</span>")), F.lit(""))
    card = F.concat(F.lit("<a class=\"c\" data-testid=\"search-product-card\" href=\""), link,
                    F.lit("\"><img src=\""), F.coalesce("image_url", F.lit("/none.png")),
                    F.lit("\""), alt, F.lit(">"), heading, span, F.lit("</a>"))
    body = F.concat(F.lit("<html><a href=\"/x\">all</a>"), card, F.lit("<p>-</p>\n"), card,
                    F.lit("</html>"))
    return _payload(o, "html_response", body)


def _money_text(name: str) -> Column:
    whole = F.floor(F.col(name) * 100.0 + 0.5).cast("bigint")
    return F.concat(F.call_function("div", whole, F.lit(100)).cast("string"), F.lit("."),
                    F.lpad((whole % 100).cast("string"), 2, "0"))


def _payload(o: DataFrame, kind: str, body: Column) -> DataFrame:
    return o.select("market", "search_term", "cep",
                    F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
                    .alias("collected_at"),
                    F.lit(kind).alias("raw_response_type"), body.alias("raw_payload"),
                    "record_id")


def legacy_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy catalogue shape from ``part``; some names hold a comma or a quote."""
    key = F.col("p_partkey")
    name = (F.when(key % 10 == 0, F.concat("p_name", F.lit(" 41,5g")))
            .when(key % 10 == 1, F.concat("p_name", F.lit(' 12"')))
            .otherwise(F.col("p_name")))
    return read(spark, sf_dir, "part").select(
        F.lpad(key.cast("string"), 8, "0").alias("ean"), name.alias("descricao"),
        F.col("p_brand").alias("marca"), F.col("p_retailprice").alias("preco_unitario"),
        round_half_up(F.col("p_retailprice") * 0.9).alias("preco_atacado"),
        F.lower("p_type").alias("rede"))
