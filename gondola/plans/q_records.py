"""Queries on sources, payloads and the Bronze layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola import dims, schemas
from gondola.functions import ean as ean_fn
from gondola.functions import html, numbers
from gondola.operators import audit, bronze, seeds
from gondola.plans.lake import Lake
from gondola.plans.oracle_views import r
from gondola.plans.registry import query
from gondola.session import fresh_path
from gondola.sources import adapter, payloads, writers

ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
iso = ISO.format("collected_at")


# --- sources ---------------------------------------------------------------------

@query("scan_parquet_bronze", f"""
SELECT record_id, market, product_name, price, {iso} AS collected_at, bronze_run_id,
 '1.0.0' AS bronze_data_version, FALSE AS bronze_error_flag, strftime(run_ts, '%Y') AS year,
 strftime(run_ts, '%m') AS month, strftime(run_ts, '%d') AS day, bronze_run_id AS run_id
FROM obs""")
def scan_parquet_bronze(lake: Lake):
    return lake.bronze.select(
        "record_id", "market", "product_name", "price", "collected_at", "bronze_run_id",
        "bronze_data_version", "bronze_error_flag", "year", "month", "day", "run_id")


@query("scan_parquet_silver_union", """
SELECT record_id, market, product_name_normalized, price_normalized, unit_price,
 category_normalized, ean, collected_at FROM kept""")
def scan_parquet_silver_union(lake: Lake):
    df = writers.read_silver(lake.spark, lake.kept_paths())
    return df.select("record_id", *schemas.SILVER_REQUIRED)


@query("scan_csv_seed", """
SELECT min(record_id) AS first_record, ean FROM cleaned WHERE ean_valid GROUP BY ean""")
def scan_csv_seed(lake: Lake):
    path = lake._once("seed_scan", lambda p: writers.write_seed_csv(
        ean_fn.with_validity(lake.obs).filter("ean_valid").groupBy("ean")
        .agg(F.min("record_id").alias("descricao_referencia")), p))
    return writers.read_seed(lake.spark, path).select(
        "ean", F.col("descricao_referencia").alias("first_record"))


_DEFAULTS = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")"
                      for row in dims.DEFAULT_SEARCHES)


_CEPS = ", ".join(f"('{m}', {repr(c) if c else 'NULL'})" for m, c in dims.MARKET_CEPS)


@query("seed_fallback", f"""
SELECT * FROM (VALUES {_DEFAULTS}) AS t(market, search_term, cep)
UNION ALL
SELECT m.market, e.ean, m.cep FROM (SELECT DISTINCT trim(ean) AS ean FROM obs
 WHERE trim(ean) <> '') e, (VALUES {_CEPS}) AS m(market, cep)""")
def seed_fallback(lake: Lake):
    """Searches of a seed file, and the default list where there is no such file."""
    path = lake._once("seed_all", lambda p: writers.write_seed_csv(
        lake.obs.select("ean").distinct().withColumn("descricao_referencia", F.lit("x")), p))
    return (seeds.searches(lake.spark, fresh_path(lake.spark, "no-seed"))
            .unionByName(seeds.searches(lake.spark, path)))


_LEGACY_SQL = f"""
SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS ean,
 CASE p_partkey % 10 WHEN 0 THEN p_name || ' 41,5g' WHEN 1 THEN p_name || ' 12"' ELSE p_name END
  AS descricao, p_brand AS marca, p_retailprice AS preco_unitario,
 {r('p_retailprice * 0.9::DOUBLE')} AS preco_atacado, lower(p_type) AS rede FROM part"""


def _legacy(lake: Lake):
    path = lake._once("legacy", lambda p: writers.write_seed_csv(
        adapter.legacy_products(lake.spark, lake.sf_dir), p))
    return writers.read_legacy(lake.spark, path)


@query("scan_csv_legacy", _LEGACY_SQL)
def scan_csv_legacy(lake: Lake):
    return _legacy(lake)


@query("scan_sql_legacy", f"SELECT ean, descricao, rede FROM ({_LEGACY_SQL}) "
       "WHERE preco_unitario > preco_atacado")
def scan_sql_legacy(lake: Lake):
    _legacy(lake).createOrReplaceTempView("produtos")
    return lake.spark.sql(
        "SELECT ean, descricao, rede FROM produtos WHERE preco_unitario > preco_atacado")


@query("legacy_like_sort", f"SELECT descricao, rede, preco_unitario FROM ({_LEGACY_SQL}) "
       "WHERE descricao LIKE '%ring%' ORDER BY preco_unitario, descricao")
def legacy_like_sort(lake: Lake):
    return (_legacy(lake).filter(F.col("descricao").like("%ring%"))
            .select("descricao", "rede", "preco_unitario")
            .orderBy("preco_unitario", "descricao"))


@query("legacy_group_count", f"SELECT rede, count(*) AS quantidade FROM ({_LEGACY_SQL}) "
       "GROUP BY rede")
def legacy_group_count(lake: Lake):
    return _legacy(lake).groupBy("rede").agg(F.count(F.lit(1)).alias("quantidade"))


@query("scan_json_payload", f"""
SELECT kind AS raw_response_type, market, count(*) AS payloads, min({iso}) AS first_seen,
 max({iso}) AS last_seen
FROM obs, (VALUES ('graphql_response'), ('search_response')) AS k(kind) GROUP BY kind, market""")
def scan_json_payload(lake: Lake):
    return (writers.read_payloads(lake.spark, lake.payload_path())
            .groupBy("raw_response_type", "market")
            .agg(F.count(F.lit(1)).alias("payloads"), F.min("collected_at").alias("first_seen"),
                 F.max("collected_at").alias("last_seen")))


_UNESC = ("replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
          "'&amp;', '&')")


@query("scan_html_payload", f"""
SELECT page_id, length(html) AS n_chars,
 trim({_UNESC.format("regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')")},
  chr(9) || chr(10) || chr(13) || ' ') AS heading,
 {_UNESC.format("nullif(regexp_extract(html, 'href=\"([^\"]+)\"', 1), '')")} AS first_href
FROM pages""")
def scan_html_payload(lake: Lake):
    page = F.col("html")
    return lake.table("pages").select(
        "page_id", F.length(page).alias("n_chars"),
        F.coalesce(html.tag_text(page, "h1"), F.lit("")).alias("heading"),
        html.attr(page, "href").alias("first_href"))


# --- sinks: write, read back, compare with what should be there --------------------

@query("sink_bronze_partitioned", """
SELECT market, strftime(run_ts, '%Y') AS year, strftime(run_ts, '%m') AS month,
 strftime(run_ts, '%d') AS day, bronze_run_id AS run_id, count(*) AS records,
 min(record_id) AS first_record FROM obs GROUP BY ALL""")
def sink_bronze_partitioned(lake: Lake):
    return (lake.bronze.groupBy(*schemas.BRONZE_PARTITIONS)
            .agg(F.count(F.lit(1)).alias("records"), F.min("record_id").alias("first_record")))


@query("sink_raw_jsonl", """
SELECT market, search_term, count(*) * 2 AS payloads FROM obs GROUP BY ALL""")
def sink_raw_jsonl(lake: Lake):
    return (writers.read_payloads(lake.spark, lake.payload_path())
            .groupBy("market", "search_term").agg(F.count(F.lit(1)).alias("payloads")))


@query("sink_silver_partitioned", """
SELECT market, strftime(run_ts, '%Y') AS year, strftime(run_ts, '%m') AS month,
 strftime(run_ts, '%d') AS day, '20250101_SV_0000' AS transformation_id,
 count(*) AS records, CAST(sum(c) AS BIGINT) AS cents FROM kept GROUP BY ALL""")
def sink_silver_partitioned(lake: Lake):
    out = lake.kept.withColumn("silver_transformation_id", F.lit("20250101_SV_0000"))
    path = lake._once("silver_partitioned", lambda p: writers.write_silver(out, p))
    back = lake.spark.read.schema(
        "record_id STRING, price_normalized DOUBLE, market STRING, year STRING, month STRING, "
        "day STRING, transformation_id STRING").parquet(path)
    return back.groupBy(*schemas.SILVER_PARTITIONS).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(numbers.cents(F.col("price_normalized"))).alias("cents"))


@query("sink_csv_seed", """
SELECT ean, (list(product_name ORDER BY record_id))[1] AS descricao_referencia
FROM cleaned WHERE ean_valid GROUP BY ean""")
def sink_csv_seed(lake: Lake):
    path = fresh_path(lake.spark, "seed")
    writers.write_seed_csv(seeds.distinct_eans(lake.obs), path)
    return writers.read_seed(lake.spark, path)


@query("sink_run_metadata", """
SELECT 'bronze' AS layer, market, bronze_run_id AS run_id, count(*) AS records,
 strftime(run_ts, '%Y-%m-%d') AS run_date, 'SUCCESS' AS status FROM obs
GROUP BY market, bronze_run_id, run_ts
UNION ALL
SELECT 'silver', market, strftime(run_ts, '%Y%m%d') || '_SV_' || substr(md5(bronze_run_id), 1, 4),
 n, strftime(run_ts, '%Y-%m-%d'), CASE WHEN status = 'CRITICAL' THEN 'FAILED' ELSE 'SUCCESS' END
FROM run_judged""")
def sink_run_metadata(lake: Lake):
    return lake.audit().select(
        "layer", "market", "run_id", F.col("records.output").alias("records"),
        F.col("execution.run_date").alias("run_date"),
        F.col("execution.status").alias("status"))


# --- payload flattening ------------------------------------------------------------

_EDGES = """(SELECT *, CASE l_partkey % 6 WHEN 5 THEN 0 WHEN 4 THEN 2 ELSE 1 END AS n_edges,
  l_partkey % 4 AS n_crumbs, CASE WHEN regexp_full_match(search_term, '[0-9]{8}|[0-9]{12,14}')
   THEN search_term END AS code FROM obs)"""


@query("flatten_graphql", f"""
SELECT record_id, 'atacadao' AS market, product_name, price, price AS unit_price,
 CASE n_crumbs WHEN 2 THEN 'Home' WHEN 3 THEN category END AS category, brand,
 source_product_id, sku, search_term AS ean, code AS searched_ean,
 'market_response' AS ean_source, search_term, cep, {iso} AS collected_at,
 'https://www.atacadao.com.br/' AS source_url, image_url, wholesale_price
FROM {_EDGES}, range(2) AS e(i) WHERE i < n_edges""")
def flatten_graphql(lake: Lake):
    return payloads.flatten_graphql(lake.graphql, ("record_id",))


@query("flatten_search_hits", f"""
SELECT record_id, 'mix_mateus' AS market, product_name, price, price AS unit_price, category,
 brand, source_product_id, sku, coalesce(ean, code) AS ean, code AS searched_ean,
 CASE WHEN ean IS NOT NULL THEN 'market_response' WHEN code IS NOT NULL THEN 'search_term' END
  AS ean_source, search_term, cep, {iso} AS collected_at,
 'https://www.mixmateus.com.br/' AS source_url, image_url, wholesale_price
FROM {_EDGES}, range(2) AS e(i) WHERE l_partkey % 5 <> 3""")
def flatten_search_hits(lake: Lake):
    return payloads.flatten_search_hits(lake.search_hits, ("record_id",))


_CARDS = """(SELECT *, CASE WHEN l_partkey % 3 <> 0 OR l_partkey % 6 <> 0
   THEN trim(product_name) || ' & Cia' END AS card_name,
  '/produto/p-' || source_product_id || CASE WHEN l_partkey % 2 = 0 THEN '?ref=1' ELSE '' END
   AS href, CASE WHEN regexp_full_match(search_term, '[0-9]{8}|[0-9]{12,14}')
   THEN search_term END AS code FROM obs)"""


@query("flatten_html", f"""
SELECT record_id, 'carrefour' AS market, card_name AS product_name, price, price AS unit_price,
 CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS brand, source_product_id,
 CAST(NULL AS VARCHAR) AS sku, code AS ean, code AS searched_ean,
 CASE WHEN code IS NOT NULL THEN 'search_term' END AS ean_source, search_term, cep,
 {iso} AS collected_at, 'https://mercado.carrefour.com.br' || href AS source_url,
 coalesce(image_url, '/none.png') AS image_url, CAST(NULL AS DOUBLE) AS wholesale_price
FROM {_CARDS}, range(2) AS e(i) WHERE card_name IS NOT NULL OR price IS NOT NULL""")
def flatten_html(lake: Lake):
    return payloads.flatten_html(lake.html, ("record_id",))


def _graphql_nodes(lake: Lake):
    p = lake.graphql
    doc = F.from_json("raw_payload", schemas.GRAPHQL)
    return p.select("record_id", F.explode(doc["data"]["search"]["products"]["edges"])
                    .alias("edge")).select("record_id", "edge.node")


@query("nested_array_negative_index", f"""
SELECT record_id, CASE n_crumbs WHEN 2 THEN 'Home' WHEN 3 THEN category END AS category
FROM {_EDGES}, range(2) AS e(i) WHERE i < n_edges""")
def nested_array_negative_index(lake: Lake):
    crumbs = F.col("node.breadcrumbList.itemListElement")
    return _graphql_nodes(lake).select(
        "record_id", payloads.second_to_last(crumbs, "name").alias("category"))


@query("nested_array_first", f"""
SELECT record_id, image_url FROM {_EDGES}, range(2) AS e(i) WHERE i < n_edges""")
def nested_array_first(lake: Lake):
    return _graphql_nodes(lake).select(
        "record_id", payloads.first_item(F.col("node.image"), "url").alias("image_url"))


def _cards(lake: Lake):
    return payloads.html_cards(lake.html)


@query("html_extract_cards", "SELECT record_id, CAST(2 AS BIGINT) AS cards FROM obs")
def html_extract_cards(lake: Lake):
    pages = lake.html
    return pages.select("record_id",
                        F.size(html.cards(F.col("raw_payload"))).cast("bigint").alias("cards"))


@query("html_extract_attr", f"""
SELECT record_id, href, coalesce(image_url, '/none.png') AS src,
 CASE WHEN l_partkey % 6 <> 0 THEN trim(product_name) || ' & Cia' END AS alt
FROM {_CARDS}, range(2) AS e(i)""")
def html_extract_attr(lake: Lake):
    return _cards(lake).select("record_id", *[html.attr(F.col("card"), a).alias(a)
                                              for a in ("href", "src", "alt")])


@query("html_extract_tag_text", f"""
SELECT record_id, CASE WHEN l_partkey % 3 <> 0 THEN trim(product_name) || ' & Cia' END AS heading
FROM {_CARDS}, range(2) AS e(i)""")
def html_extract_tag_text(lake: Lake):
    return _cards(lake).select("record_id", html.tag_text(F.col("card")).alias("heading"))


@query("html_unescape", f"""
SELECT page_id, {_UNESC.format("replace(replace(html, '&copy;', '©'), '&middot;', '·')")}
 AS decoded FROM pages""")
def html_unescape(lake: Lake):
    return lake.table("pages").select("page_id", html.unescape(F.col("html")).alias("decoded"))


@query("html_extract_price", f"SELECT record_id, price FROM {_CARDS}, range(2) AS e(i)")
def html_extract_price(lake: Lake):
    return _cards(lake).select("record_id", html.price(F.col("card")).alias("price"))


@query("html_extract_id", """
SELECT page_id, nullif(regexp_extract(url, '-(\\d+)(?:\\?|$)', 1), '') AS dash_id,
 nullif(regexp_extract(replace(url, '/', '-'), '-(\\d+)(?:\\?|$)', 1), '') AS product_id
FROM pages""")
def html_extract_id(lake: Lake):
    return lake.table("pages").select(
        "page_id", html.product_id(F.col("url")).alias("dash_id"),
        html.product_id(F.replace("url", F.lit("/"), F.lit("-"))).alias("product_id"))


@query("url_join", f"""
SELECT record_id, CASE WHEN regexp_matches(href, '^https?://') THEN href
  ELSE 'https://shop.example/' || ltrim(href, '/') END AS url
FROM (SELECT record_id, coalesce(image_url, '') AS href FROM obs)""")
def url_join(lake: Lake):
    return lake.obs.select("record_id", html.url_join("https://shop.example/",
                                                      F.col("image_url")).alias("url"))


@query("card_filter", f"""
SELECT count(*) AS kept_cards FROM {_CARDS}, range(2) AS e(i)
WHERE card_name IS NOT NULL OR price IS NOT NULL""")
def card_filter(lake: Lake):
    flat = payloads.flatten_html(lake.html)
    return flat.agg(F.count(F.lit(1)).alias("kept_cards"))


@query("coalesce_name", f"SELECT record_id, card_name FROM {_CARDS}, range(2) AS e(i)")
def coalesce_name(lake: Lake):
    card = F.col("card")
    name = F.coalesce(F.nullif(html.tag_text(card), F.lit("")), html.attr(card, "alt"))
    return _cards(lake).select("record_id", name.alias("card_name"))


_RECORD = ", ".join("collected_at_text AS collected_at" if c == "collected_at" else c
                    for c in schemas.BRONZE_FIELDS if c not in ("ean", "ean_source"))


@query("project_product_record", f"""
SELECT record_id, {_RECORD}, coalesce(ean, searched_ean) AS ean,
 CASE WHEN ean IS NOT NULL THEN 'market_response' WHEN searched_ean IS NOT NULL
  THEN 'search_term' END AS ean_source
FROM (SELECT *, {iso} AS collected_at_text FROM obs)""")
def project_product_record(lake: Lake):
    o = lake.obs.withColumn("collected_at", F.date_format("collected_at",
                                                          "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    fields = {c: F.col(c) for c in schemas.BRONZE_FIELDS}
    return payloads.project_record(o, fields, ("record_id",))


_DIRTY = """CASE WHEN l_partkey % 7 = 0 THEN 'n/d' WHEN l_partkey % 7 = 1
  THEN CAST(p_size AS VARCHAR) || ',5' ELSE CAST(p_size AS VARCHAR) || '.25' END"""


def _dirty_prices(lake: Lake):
    """Price text as a web form gives it: a word, a decimal comma or a decimal point."""
    key = F.col("p_partkey") % 7
    size = F.col("p_size").cast("string")
    raw = (F.when(key == 0, F.lit("n/d")).when(key == 1, F.concat(size, F.lit(",5")))
           .otherwise(F.concat(size, F.lit(".25"))))
    return lake.table("part").select(
        F.col("p_partkey").cast("string").alias("record_id"), raw.alias("price"),
        F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).alias("product_name"),
        F.lower("p_type").alias("market"),
        F.when(F.col("p_partkey") % 8 != 0, F.col("p_brand")).alias("search_term"))


_DIRTY_VIEW = f"""(SELECT CAST(p_partkey AS VARCHAR) AS record_id,
  {_DIRTY.replace('l_partkey', 'p_partkey')} AS price,
  CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS product_name, lower(p_type) AS market,
  CASE WHEN p_partkey % 8 <> 0 THEN p_brand END AS search_term FROM part)"""


@query("safe_to_float", f"SELECT record_id, TRY_CAST(price AS DOUBLE) AS price FROM {_DIRTY_VIEW}")
def safe_to_float(lake: Lake):
    return _dirty_prices(lake).select("record_id",
                                      numbers.safe_to_float(F.col("price")).alias("price"))


@query("searched_ean", """
SELECT record_id, CASE WHEN regexp_full_match(trim(search_term), '[0-9]{8}|[0-9]{12,14}')
 THEN trim(search_term) END AS searched_ean FROM obs""")
def searched_ean(lake: Lake):
    return lake.obs.select("record_id",
                           ean_fn.searched_ean(F.col("search_term")).alias("searched_ean"))


@query("resolve_ean", """
SELECT record_id, CASE WHEN searched_ean IS NOT NULL AND market = 'europe' THEN searched_ean
  ELSE coalesce(ean, searched_ean) END AS ean,
 CASE WHEN searched_ean IS NOT NULL AND (market = 'europe' OR ean IS NULL) THEN 'search_term'
  WHEN ean IS NOT NULL THEN 'market_response' END AS ean_source
FROM (SELECT record_id, market, searched_ean,
  CASE WHEN l_linenumber % 2 = 0 THEN ean END AS ean FROM obs)""")
def resolve_ean(lake: Lake):
    odd = F.split_part("sku", F.lit("-"), F.lit(2)).cast("int") % 2
    returned = F.when(odd == 0, F.col("ean"))
    e = ean_fn.resolve_ean(F.col("market"), returned, F.col("searched_ean"), trusted="europe")
    return lake.obs.select("record_id", e.alias("e")).select("record_id", "e.ean",
                                                             "e.ean_source")


# --- Bronze ------------------------------------------------------------------------

@query("bronze_enrich", f"""
SELECT record_id, {ISO.format('run_ts')} AS bronze_ingestion_timestamp, bronze_run_id,
 '1.0.0' AS bronze_data_version, FALSE AS bronze_error_flag FROM obs""")
def bronze_enrich(lake: Lake):
    out = bronze.enrich(lake.obs, F.col("bronze_run_id"), F.col("run_ts"))
    return out.select("record_id", "bronze_ingestion_timestamp", "bronze_run_id",
                      "bronze_data_version", "bronze_error_flag")


@query("bronze_coerce_types", f"""
SELECT record_id, TRY_CAST(replace(price, ',', '.') AS DOUBLE) AS price, product_name
FROM {_DIRTY_VIEW}""")
def bronze_coerce_types(lake: Lake):
    return bronze.coerce_types(_dirty_prices(lake)).select("record_id", "price", "product_name")


@query("bronze_required_fields", f"""
SELECT record_id, 'product_name' AS field, 'missing_required' AS rule FROM {_DIRTY_VIEW}
WHERE product_name IS NULL
UNION ALL SELECT record_id, 'search_term', 'missing_required' FROM {_DIRTY_VIEW}
WHERE search_term IS NULL""")
def bronze_required_fields(lake: Lake):
    return bronze.violations(_dirty_prices(lake), ["market", "product_name", "search_term"], [])


@query("bronze_type_check", f"""
SELECT record_id, 'price' AS field, 'not_a_number' AS rule FROM {_DIRTY_VIEW}
WHERE price IS NOT NULL AND TRY_CAST(replace(price, ',', '.') AS DOUBLE) IS NULL""")
def bronze_type_check(lake: Lake):
    return bronze.violations(_dirty_prices(lake), [], ["price"])


def _null_rate_sql(columns: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"{r(f'count(*) FILTER (WHERE {c} IS NULL) * 1.0::DOUBLE / count(*)', 4)} AS null_rate "
        "FROM obs" for c in columns)
    return f"SELECT * FROM ({rows}) WHERE null_count > 0"


@query("bronze_null_rates", _null_rate_sql(schemas.BRONZE_FIELDS))
def bronze_null_rates(lake: Lake):
    return bronze.null_rates(lake.obs, schemas.BRONZE_FIELDS)


@query("bronze_batch_counts", f"""
SELECT market, count(*) AS total_records, count(*) FILTER (WHERE NOT bad) AS valid_records,
 count(*) FILTER (WHERE bad) AS invalid_records
FROM (SELECT market, product_name IS NULL OR search_term IS NULL
  OR TRY_CAST(replace(price, ',', '.') AS DOUBLE) IS NULL AS bad FROM {_DIRTY_VIEW})
GROUP BY market""")
def bronze_batch_counts(lake: Lake):
    d = _dirty_prices(lake).withColumns({
        "collected_at": F.lit("2025-01-01T00:00:00Z"), "unit_price": F.col("price"),
        "wholesale_price": F.lit(None).cast("string")})
    return bronze.batch_counts(d, ["market"])


_ROW = " || chr(31) || ".join(
    f"coalesce('=' || {f'CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)' if c in schemas.NUMERIC_FIELDS else c}, '')"
    for c in audit.BUSINESS_COLUMNS)


@query("bronze_batch_hash", f"""
SELECT market, bronze_run_id, count(*) AS records, concat_ws('-', count(*),
 sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)), sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)))
 AS batch_id
FROM (SELECT market, bronze_run_id, md5({_ROW}) AS h FROM obs) GROUP BY market, bronze_run_id""")
def bronze_batch_hash(lake: Lake):
    """Identity of every batch: equal content, equal identity."""
    return lake.obs.groupBy("market", "bronze_run_id").agg(
        F.count(F.lit(1)).alias("records"),
        bronze.batch_hash(audit.BUSINESS_COLUMNS).alias("batch_id"))


@query("date_parts", """
SELECT record_id, strftime(collected_at, '%Y') AS year, strftime(collected_at, '%m') AS month,
 strftime(collected_at, '%d') AS day FROM obs""")
def date_parts(lake: Lake):
    parts = bronze.date_parts(F.col("collected_at"))
    return lake.obs.select("record_id", *[c.alias(n) for n, c in parts.items()])


@query("run_id", """
SELECT market, bronze_run_id AS run_id, count(*) AS records,
 regexp_full_match(bronze_run_id, '[0-9]{8}_[0-9]{6}_[0-9a-f]{8}') AS well_formed
FROM obs GROUP BY ALL""")
def run_id(lake: Lake):
    return lake.obs.groupBy("market", F.col("bronze_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("records"),
        F.bool_and(F.col("bronze_run_id").rlike(r"^[0-9]{8}_[0-9]{6}_[0-9a-f]{8}$"))
        .alias("well_formed"))


@query("empty_batch_guard", """
SELECT market, bronze_run_id AS run_id, count(*) FILTER (WHERE price > 80000) AS records,
 CASE WHEN count(*) FILTER (WHERE price > 80000) = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 CASE WHEN count(*) FILTER (WHERE price > 80000) = 0 THEN 'Empty batch' END AS error
FROM obs GROUP BY ALL""")
def empty_batch_guard(lake: Lake):
    """Every run is announced; only expensive records arrive, so some runs are empty."""
    runs = lake.obs.select("market", F.col("bronze_run_id").alias("run_id")).distinct()
    arrived = lake.obs.filter("price > 80000").withColumnRenamed("bronze_run_id", "run_id")
    return bronze.batch_guard(runs, arrived, ["market", "run_id"])


# --- seeds -------------------------------------------------------------------------

@query("seed_distinct_eans", """
SELECT ean, (list(product_name ORDER BY record_id))[1] AS descricao_referencia
FROM cleaned WHERE ean_valid GROUP BY ean""")
def seed_distinct_eans(lake: Lake):
    return seeds.distinct_eans(lake.obs)


@query("seed_trim_distinct", "SELECT DISTINCT trim(ean) AS ean FROM obs WHERE trim(ean) <> ''")
def seed_trim_distinct(lake: Lake):
    padded = lake.obs.select(F.concat(F.lit(" "), F.col("ean"), F.lit(" ")).alias("ean"))
    return seeds.trimmed_distinct(padded)


@query("seed_cross_markets", """
SELECT m.market, e.ean AS search_term, m.cep FROM (SELECT DISTINCT ean FROM obs
 WHERE ean IS NOT NULL) e, (VALUES ('atacadao', '04543010'), ('carrefour', NULL),
 ('mix_mateus', NULL)) AS m(market, cep)""")
def seed_cross_markets(lake: Lake):
    return seeds.search_configs(lake.obs.select("ean"))
