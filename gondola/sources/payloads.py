"""Flatten raw answers (nested JSON, result-page HTML) into 17-field records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola import schemas
from gondola.functions import ean as ean_fn
from gondola.functions import html
from gondola.functions.numbers import safe_to_float
from gondola.functions.text import blank_to_null

# fixed values: the site roots each market's records point to
GRAPHQL_MARKET, GRAPHQL_URL = "atacadao", "https://www.atacadao.com.br/"
HITS_MARKET, HITS_URL = "mix_mateus", "https://www.mixmateus.com.br/"
HTML_MARKET, HTML_URL = "carrefour", "https://mercado.carrefour.com.br/"


def project_record(df: DataFrame, fields: dict[str, Column], keep: tuple[str, ...] = ()
                   ) -> DataFrame:
    """Canonical 17-column projection; absent fields are NULL, numbers are safe casts."""
    searched = ean_fn.searched_ean(F.col("search_term"))
    code, source = ean_fn.resolved_ean(fields["market"], fields.get("ean", F.lit(None)), searched)
    made = {**fields, "searched_ean": searched, "ean": code, "ean_source": source,
            "search_term": F.col("search_term"), "cep": F.col("cep"),
            "collected_at": F.col("collected_at")}
    out = []
    for name in schemas.BRONZE_FIELDS:
        c = made.get(name, F.lit(None))
        c = safe_to_float(c) if name in schemas.NUMERIC_FIELDS else c.cast("string")
        out.append(c.alias(name))
    return df.select(*out, *keep)


def second_to_last(items: Column, field: str) -> Column:
    """Field of the last-but-one element, NULL below two elements."""
    return F.when(F.size(items) >= 2, F.element_at(items, -2)[field])


def first_item(items: Column, field: str) -> Column:
    return F.get(items, 0)[field]


def flatten_graphql(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per product edge of a nested product-search answer."""
    doc = F.from_json("raw_payload", schemas.GRAPHQL)
    nodes = payloads.select("*", F.explode(doc["data"]["search"]["products"]["edges"])
                            .alias("edge")).withColumn("n", F.col("edge.node"))
    price = F.col("n.offers.highPrice")
    return project_record(nodes, {
        "market": F.lit(GRAPHQL_MARKET), "product_name": F.col("n.name"), "price": price,
        "unit_price": price,
        "category": second_to_last(F.col("n.breadcrumbList.itemListElement"), "name"),
        "brand": F.col("n.brand.name"), "source_product_id": F.col("n.id"),
        "sku": F.col("n.sku"), "ean": F.col("search_term"), "source_url": F.lit(GRAPHQL_URL),
        "image_url": first_item(F.col("n.image"), "url"),
        "wholesale_price": F.col("n.offers.lowPrice")}, keep)


def flatten_search_hits(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per hit of a flat search answer."""
    doc = F.from_json("raw_payload", schemas.SEARCH_HITS)
    hits = payloads.select("*", F.explode(doc["hits"]).alias("h"))
    return project_record(hits, {
        "market": F.lit(HITS_MARKET), "product_name": F.col("h.name"),
        "price": F.col("h.sale_price"), "unit_price": F.col("h.sale_price"),
        "category": F.col("h.category"), "brand": F.col("h.brand"),
        "source_product_id": F.col("h.objectID"), "sku": F.col("h.sku"),
        "ean": F.col("h.barcode"), "source_url": F.lit(HITS_URL),
        "image_url": F.col("h.image"),
        "wholesale_price": F.col("h.wholesale_sale_price")}, keep)


def html_cards(payloads: DataFrame, body: str = "raw_payload") -> DataFrame:
    return payloads.select("*", F.explode(html.cards(F.col(body))).alias("card"))


def flatten_html(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per product card that has a name or a price.

    Cards are cut up inside the array, before the explode: a filter on the parts
    then stays above the explode and no expression runs twice.
    """
    parts = F.transform(html.cards(F.col("raw_payload")), html.raw_card)
    cards = payloads.select("*", F.inline(parts)).drop("raw_payload")
    cards = cards.withColumns({
        "href": html.unescape(F.col("href")),
        "name": F.coalesce(blank_to_null(html.clean_text(F.col("h2"))),
                           html.unescape(F.col("alt"))),
        "amount": html.price_text(F.col("span"))})
    cards = cards.filter(F.col("name").isNotNull() | F.col("amount").isNotNull())
    return project_record(cards, {
        "market": F.lit(HTML_MARKET), "product_name": F.col("name"), "price": F.col("amount"),
        "unit_price": F.col("amount"), "source_url": html.url_join(HTML_URL, F.col("href")),
        "source_product_id": html.product_id(F.col("href")),
        "image_url": html.unescape(F.col("src"))}, keep)
