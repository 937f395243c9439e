"""Ready-made analyses over Bronze, Silver and the run documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gondola import dims, schemas
from gondola.functions import ean, numbers, text, units
from gondola.operators import (audit, bronze, history, json_paths, profile, quality, silver,
                               states)
from gondola.plans import clustered
from gondola.plans.lake import Lake
from gondola.plans.oracle_views import r
from gondola.plans.q_records import iso
from gondola.plans.registry import query
from gondola.session import fresh_path, reliable_checkpoint
from gondola.sources import adapter, archive, writers


# --- Bronze ---------------------------------------------------------------------------

@query("bronze_by_partition", f"""
SELECT record_id, market, product_name, price, {iso} AS collected_at FROM obs
WHERE market = 'america' AND strftime(run_ts, '%Y-%m') = '1998-03'""")
def bronze_by_partition(lake: Lake):
    return lake.bronze.filter("market = 'america' AND year = '1998' AND month = '03'").select(
        "record_id", "market", "product_name", "price", "collected_at")


@query("bronze_date_range", """
SELECT record_id, market, bronze_run_id AS run_id FROM obs WHERE market = 'asia'
 AND CAST(run_ts AS DATE) BETWEEN DATE '1997-11-15' AND DATE '1998-04-01'""")
def bronze_date_range(lake: Lake):
    return history.partition_range(lake.bronze.filter("market = 'asia'"), "1997-11-15",
                                   "1998-04-01").select("record_id", "market", "run_id")


@query("bronze_by_run", """
SELECT record_id, market, price FROM obs WHERE market = 'europe'
 AND bronze_run_id = (SELECT max(bronze_run_id) FROM obs WHERE market = 'europe')""")
def bronze_by_run(lake: Lake):
    runs = lake.audit("bronze").filter("market = 'europe'")
    newest = runs.agg(F.max("run_id")).first()[0]
    return lake.bronze.filter((F.col("market") == "europe") & (F.col("run_id") == newest)).select(
        "record_id", "market", "price")


@query("bronze_by_term", """
SELECT market, count(*) AS records FROM obs WHERE search_term = 'ring' GROUP BY market
ORDER BY records DESC, market""")
def bronze_by_term(lake: Lake):
    return (lake.obs.filter(F.col("search_term") == "ring").groupBy("market")
            .agg(F.count(F.lit(1)).alias("records")).orderBy(F.desc("records"), "market"))


@query("bronze_term_sizes", "SELECT search_term, count(*) AS records FROM obs "
       "GROUP BY search_term")
def bronze_term_sizes(lake: Lake):
    return lake.obs.groupBy("search_term").agg(F.count(F.lit(1)).alias("records"))


_CENTS = "CAST(floor(price * 100.0 + 0.5) AS BIGINT)"
_MEAN = (f"(CAST((2 * sum({_CENTS}) + count(price)) // (2 * count(price)) AS DOUBLE) / 100.0)")


@query("bronze_price_compare", f"""
SELECT market, product_name, min(price) AS min_price, max(price) AS max_price,
 CASE WHEN count(price) > 0 THEN {_MEAN} END AS mean_price, count(*) AS records
FROM obs GROUP BY ALL""")
def bronze_price_compare(lake: Lake):
    c = numbers.cents(F.col("price"))
    return lake.obs.groupBy("market", "product_name").agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        numbers.mean_of_cents(F.sum(c), F.count(c)).alias("mean_price"), F.count(F.lit(1)).alias("records"))


@query("bronze_market_avg", f"""
SELECT market, count(*) AS records, {_MEAN} AS avg_price FROM obs GROUP BY market""")
def bronze_market_avg(lake: Lake):
    c = numbers.cents(F.col("price"))
    return lake.obs.groupBy("market").agg(
        F.count(F.lit(1)).alias("records"), numbers.mean_of_cents(F.sum(c), F.count(c)).alias("avg_price"))


@query("bronze_approx_median")
def bronze_approx_median(lake: Lake):
    """Median of raw prices per market, merged from the sketches of its months.

    Sketches draw random numbers, so SQL holds the bound of the rank instead
    (``bronze_median_bound``).
    """
    return states.medians(states.market_rollup(lake.raw_months).filter("year IS NULL")).select(
        "market", "record_count", "median_price", "rank_bound")


@query("bronze_median_bound", """
SELECT market, count(*) AS record_count, TRUE AS close FROM obs GROUP BY market""")
def bronze_median_bound(lake: Lake):
    """The approximate median lies within one percent of ranks of the middle."""
    found = bronze_approx_median(lake)
    ranks = (lake.obs.select("market", "price").join(found, "market")
             .groupBy("market", "record_count").agg(
                 F.count("price").alias("n"),
                 F.count_if(F.col("price") < F.col("median_price")).alias("below"),
                 F.count_if(F.col("price") <= F.col("median_price")).alias("upto")))
    return ranks.select("market", "record_count",
                        ((F.col("below") <= F.col("n") * 0.51)
                         & (F.col("upto") >= F.col("n") * 0.49)).alias("close"))


@query("bronze_describe", f"""
SELECT count(price) AS count, {_MEAN} AS mean, {r('stddev_samp(price)')} AS std,
 min(price) AS min, {r('quantile_cont(price, 0.25)')} AS q25, {r('quantile_cont(price, 0.5)')}
 AS q50, {r('quantile_cont(price, 0.75)')} AS q75, max(price) AS max,
 {r('count(ean) * 100.0::DOUBLE / count(*)', 1)} AS ean_coverage_pct FROM obs""")
def bronze_describe(lake: Lake):
    return profile.describe(lake.obs, [], "price", {
        "ean_coverage_pct": numbers.round_half_up(F.count("ean") * 100.0 / F.count(F.lit(1)), 1)})


@query("bronze_profile", f"""
SELECT count(*) AS records, count(*) - (SELECT count(*) FROM (SELECT DISTINCT market,
  source_product_id FROM obs)) AS duplicates,
 count(*) FILTER (WHERE price <= 0) AS invalid_prices, count(ean) AS with_ean,
 {r('count(ean) * 100.0::DOUBLE / count(*)', 1)} AS ean_pct,
 count(*) FILTER (WHERE brand IS NULL) AS null_brand,
 count(*) FILTER (WHERE category IS NULL) AS null_category FROM obs""")
def bronze_profile(lake: Lake):
    return profile.bronze_profile(lake.obs)


_LANDED = ([(f.name, f.dataType.simpleString()) for f in schemas.BRONZE.fields
            if f.name != "market"] + [(c, "string") for c in schemas.BRONZE_PARTITIONS])
# what every landed record has; other columns are those of the records
_ALWAYS = {"bronze_ingestion_timestamp", "bronze_data_version", "bronze_error_flag",
           *schemas.BRONZE_PARTITIONS}
_SCHEMA_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, "
    f"count({'*' if c in _ALWAYS else c}) AS present FROM obs" for c, t in _LANDED)


@query("bronze_schema", _SCHEMA_SQL)
def bronze_schema(lake: Lake):
    """Columns and types of the landed files, and how many records have a value in each."""
    landed = lake.bronze
    counts = landed.agg(*[F.count(c).alias(c) for c in landed.columns])
    types = {f.name: f.dataType.simpleString() for f in landed.schema}
    kind = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return (counts.unpivot([], landed.columns, "column_name", "present")
            .select("column_name", F.element_at(kind, F.col("column_name")).alias("data_type"),
                    "present"))


def _paths(kind: str, rows: list[tuple[str, str, str]]) -> str:
    """One line per path of an answer: how many values each observation contributes."""
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS raw_response_type, '{path}' AS path, '{t}' AS type, "
        f"CAST(sum({n}) AS BIGINT) AS n FROM shaped" for path, t, n in rows)


def _has(column: str, times: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN {times} ELSE 0 END"


_NODE = "$.data.search.products.edges[].node"
_CRUMBS = f"{_NODE}.breadcrumbList.itemListElement"
_ANSWER = _paths("graphql_response", [
    ("$", "OBJECT", "1"), ("$.data", "OBJECT", "1"), ("$.data.search", "OBJECT", "1"),
    ("$.data.search.products", "OBJECT", "1"), ("$.data.search.products.edges", "ARRAY", "1"),
    ("$.data.search.products.edges[]", "OBJECT", "e"), (_NODE, "OBJECT", "e"),
    (f"{_NODE}.id", "STRING", "e"), (f"{_NODE}.sku", "STRING", "e"),
    (f"{_NODE}.name", "STRING", "e"), (f"{_NODE}.brand", "OBJECT", _has("brand", "e")),
    (f"{_NODE}.brand.name", "STRING", _has("brand", "e")), (f"{_NODE}.offers", "OBJECT", "e"),
    (f"{_NODE}.offers.highPrice", "STRING", _has("price", "e")),
    (f"{_NODE}.offers.lowPrice", "STRING", _has("wholesale_price", "e")),
    (f"{_NODE}.breadcrumbList", "OBJECT", "e"), (_CRUMBS, "ARRAY", "e"),
    (f"{_CRUMBS}[]", "OBJECT", "e * m"), (f"{_CRUMBS}[].name", "STRING",
     "e * (m - CASE WHEN m >= 2 AND category IS NULL THEN 1 ELSE 0 END)"),
    (f"{_NODE}.image", "ARRAY", _has("image_url", "e")),
    (f"{_NODE}.image[]", "OBJECT", _has("image_url", "2 * e")),
    (f"{_NODE}.image[].url", "STRING", _has("image_url", "2 * e"))]) + " UNION ALL " + _paths(
    "search_response", [
        ("$", "OBJECT", "1"), ("$.hits", "ARRAY", "1"), ("$.hits[]", "OBJECT", "h"),
        ("$.hits[].objectID", "STRING", "h"), ("$.hits[].sku", "STRING", "h"),
        ("$.hits[].name", "STRING", "h"), ("$.hits[].barcode", "STRING", _has("ean", "h")),
        ("$.hits[].brand", "STRING", _has("brand", "h")),
        ("$.hits[].category", "STRING", _has("category", "h")),
        ("$.hits[].sale_price", "STRING", _has("price", "h")),
        ("$.hits[].wholesale_sale_price", "STRING", _has("wholesale_price", "h")),
        ("$.hits[].image", "STRING", _has("image_url", "h"))])


@query("bronze_read_payloads", f"""
WITH shaped AS (
 SELECT *, l_partkey % 4 AS m, CASE l_partkey % 6 WHEN 5 THEN 0 WHEN 4 THEN 2 ELSE 1 END AS e,
  CASE WHEN l_partkey % 5 = 3 THEN 0 ELSE 2 END AS h FROM obs)
SELECT raw_response_type, path, type, n AS "values" FROM ({_ANSWER}) WHERE n > 0
UNION ALL SELECT k.kind, NULL, 'MALFORMED', count(*)
FROM obs, (VALUES ('graphql_response'), ('search_response')) AS k(kind)
WHERE cep IS NOT NULL GROUP BY k.kind""")
def bronze_read_payloads(lake: Lake):
    """Paths and types of all raw answers; answers with a postal code come once more, cut off."""
    logs = writers.read_payloads(lake.spark, lake.payload_path())
    whole, cut = F.col("raw_payload"), F.expr("substr(raw_payload, 1, length(raw_payload) - 1)")
    both = F.when(F.col("cep").isNull(), F.array(whole)).otherwise(F.array(whole, cut))
    answers = logs.select("raw_response_type", F.explode(both).alias("raw_payload"))
    return json_paths.json_paths(answers, "raw_payload", ["raw_response_type"])


@query("bronze_price_rules", """
SELECT market, count(*) FILTER (WHERE NOT price > 0) AS not_positive,
 count(*) FILTER (WHERE unit_price > price) AS unit_above_retail,
 count(*) FILTER (WHERE wholesale_price > price) AS wholesale_above_retail,
 count(*) FILTER (WHERE NOT coalesce(price = 0 OR unit_price = 0
  OR unit_price <= price * 1.1::DOUBLE, TRUE)) AS inconsistent FROM obs GROUP BY market""")
def bronze_price_rules(lake: Lake):
    return lake.obs.groupBy("market").agg(
        F.count_if(~(F.col("price") > 0)).alias("not_positive"),
        F.count_if(F.col("unit_price") > F.col("price")).alias("unit_above_retail"),
        F.count_if(F.col("wholesale_price") > F.col("price")).alias("wholesale_above_retail"),
        F.count_if(~numbers.price_consistency(F.col("price"), F.col("unit_price"))).alias("inconsistent"))


@query("bronze_url_check", """
SELECT market, count(*) FILTER (WHERE NOT regexp_matches(source_url, '^https?://'))
 AS bad_source_url, count(*) FILTER (WHERE NOT regexp_matches(image_url, '^https?://'))
 AS bad_image_url FROM obs GROUP BY market""")
def bronze_url_check(lake: Lake):
    bad = {n: F.count_if(~F.col(n).rlike("^https?://")) for n in ("source_url", "image_url")}
    return lake.obs.groupBy("market").agg(*[c.alias(f"bad_{n}") for n, c in bad.items()])


@query("bronze_replay_check", """
SELECT market, source_product_id, count(*) AS records FROM obs GROUP BY ALL
HAVING count(*) > 1""")
def bronze_replay_check(lake: Lake):
    return (lake.obs.groupBy("market", "source_product_id").agg(F.count(F.lit(1)).alias("records"))
            .filter("records > 1"))


@query("bronze_replayed_batches", """
SELECT market, bronze_run_id AS run_id FROM obs WHERE month(run_ts) % 2 = 0 GROUP BY ALL""")
def bronze_replayed_batches(lake: Lake):
    """All batches are offered; the audit knows those of even months, and these come out."""
    batches = lake.bronze.groupBy("market", "run_id").agg(
        bronze.batch_hash(audit.BUSINESS_COLUMNS).alias("batch_id"))
    known = lake.audit("bronze").filter(F.substring("run_id", 5, 2).cast("int") % 2 == 0)
    return audit.replayed_batches(batches, known).select("market", "run_id")


@query("bigquery_ctas", """
SELECT r.market, collected_date, count(*) AS records, min(r.record_id) AS first_record,
 max(p.newest) AS newest_of_product
FROM (SELECT *, CAST(date_trunc('month', collected_at) AS DATE) AS collected_date FROM obs) r
JOIN (SELECT market, source_product_id, strftime(max(collected_at), '%Y-%m-%dT%H:%M:%SZ') AS newest
 FROM obs GROUP BY ALL) p USING (market, source_product_id)
GROUP BY r.market, collected_date""")
def bigquery_ctas(lake: Lake):
    """Native tables made from the landed files, clustered alike, joined where they lie."""
    with clustered.native_tables(lake.spark, fresh_path(lake.spark, "native"), lake.bronze) as t:
        return reliable_checkpoint(clustered.months_with_newest(lake.spark, t))


# --- run documents -----------------------------------------------------------------------

@query("audit_run_stats", """
SELECT market, count(*) AS total_runs, CAST(sum(n) AS BIGINT) AS total_records,
 min(d) AS earliest, max(d) AS latest
FROM (SELECT market, strftime(run_ts, '%Y-%m-%d') AS d, count(*) AS n FROM obs
 GROUP BY market, bronze_run_id, run_ts) GROUP BY market""")
def audit_run_stats(lake: Lake):
    return audit.run_stats(lake.audit("bronze"))


_RUN_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS field, {r(f'count(*) FILTER (WHERE {c} IS NULL) * 1.0::DOUBLE / count(*)', 4)}"
    " AS rate FROM obs GROUP BY market, bronze_run_id" for c in audit.BUSINESS_COLUMNS)
_UNITS = "CAST(floor(rate * 10000 + 0.5) AS BIGINT)"


@query("audit_null_rates", f"""
SELECT field, count(*) AS runs, max(rate) AS max_rate,
 CAST((2 * sum({_UNITS}) + count(*)) // (2 * count(*)) AS DOUBLE) / 10000.0 AS mean_rate
FROM ({_RUN_NULLS}) WHERE rate > 0 GROUP BY field""")
def audit_null_rates(lake: Lake):
    return audit.null_rate_stats(lake.audit("bronze"))


@query("audit_silver_metrics", f"""
SELECT market, CAST(sum(n) AS BIGINT) AS records_output, CAST(sum(dups) AS BIGINT)
 AS deduplicated, {r('avg(quality_score)')} AS quality_score, CAST(0 AS DOUBLE) AS duration_s
FROM (SELECT j.market, j.n, j.quality_score, p.dup_removed AS dups
 FROM run_judged j JOIN run_profile p USING (market, bronze_run_id)) GROUP BY market""")
def audit_silver_metrics(lake: Lake):
    return audit.silver_metrics(lake.audit("silver"))


_SILVER_RUN = """(SELECT strftime(run_ts, '%Y%m%d') || '_SV_' || substr(md5(bronze_run_id), 1, 4)
  AS run_id, market, strftime(run_ts, '%Y-%m-%d') AS run_date,
  CASE WHEN status = 'CRITICAL' THEN 'FAILED' ELSE 'SUCCESS' END AS status, quality_score,
  bronze_run_id, n FROM run_judged)"""


@query("audit_recent_runs", f"""
SELECT run_id, market, run_date, status, quality_score FROM {_SILVER_RUN}
ORDER BY run_date DESC, run_id DESC, market LIMIT 10""")
def audit_recent_runs(lake: Lake):
    return audit.recent_runs(lake.audit("silver"))


@query("audit_health_checks", f"""
SELECT check_name, value, CASE WHEN ok THEN 'OK' WHEN check_name = 'ean_validity' THEN 'ALERT'
 ELSE 'WARNING' END AS status FROM (
 SELECT 'recent_transformations' AS check_name, CAST(count(*) FILTER (WHERE
  run_date = (SELECT max(run_date) FROM {_SILVER_RUN})) AS DOUBLE) AS value, value > 0 AS ok
 FROM {_SILVER_RUN}
 UNION ALL SELECT 'quality', {r('avg(quality_score)')} AS value, value > 80 FROM {_SILVER_RUN}
 UNION ALL SELECT 'ean_validity', {r('avg(CASE WHEN ean_valid THEN 1.0::DOUBLE ELSE 0 END)', 4)}
  AS value, value > 0.80 FROM kept)""")
def audit_health_checks(lake: Lake):
    """As of the newest run, the checks that SQL can know."""
    return _health(lake).filter("check_name != 'disk_usage'")


@query("audit_health")
def audit_health(lake: Lake):
    """As of the newest run: recent runs, score, code validity, and stored bytes (in GB)."""
    return _health(lake)


def _health(lake: Lake):
    runs = lake.audit("silver")
    now = F.lit(runs.agg(F.max("execution.run_date")).first()[0]).cast("date")
    return audit.health(runs, lake.kept, history.stored_bytes(lake.spark, lake.kept_path()), now)


@query("audit_bronze_alerts", f"""
SELECT 'high_null_rate' AS alert, field, max(rate) AS value FROM ({_RUN_NULLS})
GROUP BY field HAVING max(rate) > 0.80
UNION ALL SELECT 'no_runs_today', NULL, NULL WHERE NOT EXISTS
 (SELECT 1 FROM obs WHERE CAST(run_ts AS DATE) = DATE '2030-01-01')""")
def audit_bronze_alerts(lake: Lake):
    return audit.bronze_alerts(lake.audit("bronze"), F.lit("2030-01-01").cast("date"))


@query("storage_report")
def storage_report(lake: Lake):
    """Files and bytes of every folder of the landed Bronze files."""
    return history.storage_report(lake.spark, lake.bronze_path())


@query("storage_folders", """
SELECT DISTINCT market, strftime(run_ts, '%Y') AS year, strftime(run_ts, '%m') AS month,
 strftime(run_ts, '%d') AS day, TRUE AS has_files, TRUE AS has_bytes FROM obs""")
def storage_folders(lake: Lake):
    """The folders of the report; sizes have no SQL form."""
    return storage_report(lake).select(
        "market", "year", "month", "day", (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > 0).alias("has_bytes"))


@query("retention_select", """
SELECT market, CAST(run_ts AS DATE) AS partition_date, count(*) AS records FROM obs
WHERE CAST(run_ts AS DATE) >= (SELECT max(CAST(run_ts AS DATE)) FROM obs) - 365
GROUP BY ALL""")
def retention_select(lake: Lake):
    newest = lake.audit("bronze").agg(F.max("execution.run_date")).first()[0]
    kept = history.within_retention(lake.bronze, F.lit(newest).cast("date"), 365)
    return kept.groupBy("market", history.partition_date().alias("partition_date")).agg(
        F.count(F.lit(1)).alias("records"))


@query("retention_archive", """
SELECT CASE WHEN CAST(run_ts AS DATE) >= (SELECT max(CAST(run_ts AS DATE)) FROM obs) - 365
 THEN 'live' ELSE 'archive' END AS root, market, CAST(run_ts AS DATE) AS partition_date,
 count(*) AS records, min(record_id) AS first_record, max(record_id) AS last_record
FROM obs GROUP BY ALL""")
def retention_archive(lake: Lake):
    """Folders beyond the retention moved from a copy of Bronze to an archive beside it."""
    newest = lake.audit("bronze").agg(F.max("execution.run_date")).first()[0]
    roots = {name: fresh_path(lake.spark, f"bronze-{name}") for name in ("live", "archive")}
    lake.land_bronze(roots["live"])
    archive.archive_expired(lake.spark, roots["live"], roots["archive"],
                            dt.date.fromisoformat(newest), 365)
    sides = [writers.read_bronze(lake.spark, path).withColumn("root", F.lit(name))
             for name, path in roots.items()]
    return sides[0].unionByName(sides[1]).groupBy(
        "root", "market", history.partition_date().alias("partition_date")).agg(
        F.count(F.lit(1)).alias("records"), F.min("record_id").alias("first_record"),
        F.max("record_id").alias("last_record"))


@query("incomplete_runs", """
SELECT DISTINCT market, bronze_run_id AS run_id FROM obs
WHERE strftime(run_ts, '%m') = '02' AND market = 'asia'""")
def incomplete_runs(lake: Lake):
    """Runs with data and no success document; one market's February documents are withheld."""
    docs = lake.audit("bronze").filter(~((F.col("market") == "asia")
                                         & F.col("execution.run_date").like("%-02-01")))
    return audit.incomplete_runs(lake.bronze, docs)


# --- Silver --------------------------------------------------------------------------------

@query("silver_price_per_unit", f"""
SELECT record_id, price_normalized / nullif(q * CASE u WHEN 'l' THEN 1000.0::DOUBLE
 WHEN 'kg' THEN 1000.0::DOUBLE WHEN 'mg' THEN 0.001::DOUBLE ELSE 1.0::DOUBLE END, 0)
 AS price_per_unit
FROM (SELECT record_id, price_normalized, unit_raw AS u, CAST(replace(nullif(regexp_extract(
  lower(product_name), '{dims.VOLUME_PATTERN}', 1), ''), ',', '.') AS DOUBLE) AS q
 FROM cleaned)""")
def silver_price_per_unit(lake: Lake):
    name = F.col("product_name")
    base = units.to_base_unit(units.volume_quantity(name), units.volume_unit(name))
    return lake.silver.select("record_id", F.try_divide("price_normalized", base)
                              .alias("price_per_unit"))


@query("silver_impute_median", """
SELECT record_id, market, coalesce(price_normalized, floor(CAST(m AS DOUBLE) + 0.5) / 100.0)
 AS price_filled, CASE WHEN price_normalized IS NOT NULL THEN 'valid'
  WHEN m IS NOT NULL THEN 'imputed' ELSE 'missing' END AS price_quality
FROM (SELECT *, median(c) OVER (PARTITION BY market) AS m FROM cleaned)""")
def silver_impute_median(lake: Lake):
    return profile.impute_median(lake.silver).select("record_id", "market", "price_filled",
                                                     "price_quality")


_MULTI = ", ".join(f"('{raw}', '{s}')" for raw, many in dims.CATEGORY_MULTI.items()
                   for s in many)


_MULTI = ", ".join(f"('{raw}', '{s}')" for raw, many in dims.CATEGORY_MULTI.items()
                   for s in many)
_CHILDREN = ", ".join(f"('{parent}', '{child}')" for parent, children
                      in dims.CATEGORY_CHILDREN.items() for child in children)
_NODES = f"""edges(parent, child) AS (VALUES {_CHILDREN}),
up(node, ancestor, depth) AS (SELECT child, parent, CAST(1 AS BIGINT) FROM edges UNION ALL
 SELECT up.node, e.parent, up.depth + 1 FROM up JOIN edges e ON e.child = up.ancestor),
standards AS (SELECT record_id, lower(trim(c.category)) AS k,
  coalesce(m.standard, c.category_normalized) AS standard
 FROM cleaned c LEFT JOIN (VALUES {_MULTI}) AS m(raw, standard) ON lower(trim(c.category)) = m.raw)"""


@query("silver_category_multi", f"""
WITH RECURSIVE {_NODES}
SELECT record_id, standard, node AS child, coalesce(depth, 0) AS depth
FROM standards LEFT JOIN up ON ancestor = standard AND lower(node) = k""")
def silver_category_multi(lake: Lake):
    """Every standard of a record's category, with the node below it that the category names."""
    return silver.category_levels(lake.silver, ["record_id"]).withColumnRenamed(
        "parent", "standard")


@query("silver_category_levels", f"""
WITH RECURSIVE {_NODES}
SELECT standard AS parent, node AS child, depth, count(*) AS records,
 count(DISTINCT record_id) AS distinct_records
FROM standards JOIN up ON ancestor = standard AND lower(node) = k GROUP BY ALL""")
def silver_category_levels(lake: Lake):
    """Records below each standard, per child that their category names."""
    levels = silver.category_levels(lake.silver, ["record_id"]).filter("child IS NOT NULL")
    return levels.groupBy("parent", "child", "depth").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("record_id").alias("distinct_records"))


@query("silver_change_counts", """
SELECT market, count(*) FILTER (WHERE product_name IS DISTINCT FROM product_name_normalized)
 AS product_names_updated, count(price_normalized) AS prices_validated,
 count(*) FILTER (WHERE brand IS DISTINCT FROM brand_normalized) AS brands_normalized,
 count(*) FILTER (WHERE category IS DISTINCT FROM category_normalized) AS categories_mapped
FROM cleaned GROUP BY market""")
def silver_change_counts(lake: Lake):
    def changed(a: str, b: str):
        return F.count_if(~F.col(a).eqNullSafe(F.col(b)))
    return lake.silver.groupBy("market").agg(
        changed("product_name", "product_name_normalized").alias("product_names_updated"),
        F.count("price_normalized").alias("prices_validated"),
        changed("brand", "brand_normalized").alias("brands_normalized"),
        changed("category", "category_normalized").alias("categories_mapped"))


@query("silver_dedup_index", """
SELECT record_id, kept_id AS duplicate_of_id FROM ranked WHERE rn > 1""")
def silver_dedup_index(lake: Lake):
    """The kept index after two runs: records until the end of 1995, then the later ones."""
    return lake.dedup_index.pairs()


def _tenths(c: str) -> str:
    return (f"(CAST((20 * sum(CAST(floor({c} * 10 + 0.5) AS BIGINT)) + count({c})) "
            f"// (2 * count({c})) AS DOUBLE) / 100.0)")


@query("silver_daily_quality", f"""
SELECT market, CAST(collected_at AS DATE) AS day, count(*) AS records,
 {_tenths('data_completeness')} AS avg_completeness, {_tenths('quality_score')} AS avg_score,
 count(*) FILTER (WHERE ean_valid) AS valid_eans,
 count(*) FILTER (WHERE price_normalized IS NULL) AS missing_prices
FROM kept GROUP BY ALL""")
def silver_daily_quality(lake: Lake):
    return profile.daily_quality(lake.kept)


@query("silver_latest_file", f"""
SELECT market, run_id, source FROM (SELECT market, run_id, bronze_run_id AS source, row_number()
 OVER (PARTITION BY market ORDER BY run_id DESC) AS pos FROM {_SILVER_RUN}) WHERE pos = 1""")
def silver_latest_file(lake: Lake):
    newest = lake.audit("silver").groupBy("market").agg(
        F.max(F.struct("run_id", "source")).alias("m"))
    return newest.select("market", "m.run_id", "m.source")


@query("silver_score_histogram", """
SELECT CAST(least(floor((quality_score - lo) / ((hi - lo) / 10.0::DOUBLE)) + 1, 10) AS BIGINT)
 AS bin, count(*) AS records, min(quality_score) AS lowest, max(quality_score) AS highest
FROM kept, (SELECT min(quality_score) AS lo, max(quality_score) AS hi FROM kept) GROUP BY bin""")
def silver_score_histogram(lake: Lake):
    return profile.score_histogram(lake.kept, 10)


@query("silver_score_describe", f"""
SELECT count(*) AS count, {r('avg(quality_score)')} AS mean, {r('stddev_samp(quality_score)')}
 AS std, min(quality_score) AS min, {r('quantile_cont(quality_score, 0.25)')} AS q25,
 {r('quantile_cont(quality_score, 0.5)')} AS q50, {r('quantile_cont(quality_score, 0.75)')}
 AS q75, max(quality_score) AS max FROM kept""")
def silver_score_describe(lake: Lake):
    return profile.describe(lake.kept, [], "quality_score", {})


@query("silver_ean_rate", f"""
SELECT coalesce(market, 'ALL') AS market, count(*) FILTER (WHERE ean_valid) AS valid,
 count(*) AS records, {r('count(*) FILTER (WHERE ean_valid) * 1.0::DOUBLE / count(*)', 4)}
 AS valid_rate FROM kept GROUP BY ROLLUP (market)""")
def silver_ean_rate(lake: Lake):
    ok = F.count_if("ean_valid")
    return lake.kept.rollup("market").agg(
        ok.alias("valid"), F.count(F.lit(1)).alias("records"),
        numbers.round_half_up(ok / F.count(F.lit(1)), 4).alias("valid_rate")).withColumn(
        "market", F.coalesce("market", F.lit("ALL")))


@query("silver_price_describe", f"""
SELECT category_normalized, count(price) AS count, CASE WHEN count(price) > 0 THEN {_MEAN} END
 AS mean, {r('stddev_samp(price)')} AS std, min(price) AS min,
 {r('quantile_cont(price, 0.25)')} AS q25, {r('quantile_cont(price, 0.5)')} AS q50,
 {r('quantile_cont(price, 0.75)')} AS q75, max(price) AS max
FROM kept GROUP BY category_normalized""")
def silver_price_describe(lake: Lake):
    return profile.describe(lake.kept, ["category_normalized"], "price", {})


@query("silver_price_outliers", """
SELECT record_id, product_name, price, category_normalized FROM kept,
 (SELECT avg(price) + 3 * stddev_samp(price) AS lim FROM kept) WHERE price > lim""")
def silver_price_outliers(lake: Lake):
    sums = numbers.exact_price_sums(F.col("price"))
    mean, std = numbers.mean_and_deviation(*map(F.col, sums))
    lim = lake.kept.agg(*[c.alias(k) for k, c in sums.items()]).select((mean + 3 * std).alias("lim"))
    return (lake.kept.select("record_id", "product_name", "price", "category_normalized")
            .join(F.broadcast(lim), F.col("price") > F.col("lim")).drop("lim"))


@query("silver_brand_consolidation", """
SELECT count(DISTINCT brand) AS brands_before, count(DISTINCT brand_normalized) AS brands_after,
 count(DISTINCT brand) - count(DISTINCT brand_normalized) AS consolidated FROM kept""")
def silver_brand_consolidation(lake: Lake):
    pairs = lake.kept.select("brand", "brand_normalized").distinct()
    return pairs.agg(
        F.count_distinct("brand").alias("brands_before"),
        F.count_distinct("brand_normalized").alias("brands_after")).withColumn(
        "consolidated", F.col("brands_before") - F.col("brands_after"))


@query("silver_top_brands", """
SELECT brand_normalized, count(*) AS records FROM kept WHERE brand_normalized IS NOT NULL
GROUP BY brand_normalized ORDER BY records DESC, brand_normalized LIMIT 10""")
def silver_top_brands(lake: Lake):
    return (lake.kept.filter("brand_normalized IS NOT NULL").groupBy("brand_normalized")
            .agg(F.count(F.lit(1)).alias("records")).orderBy(F.desc("records"), "brand_normalized")
            .limit(10))


@query("silver_dedup_impact", f"""
SELECT count(*) + CAST(sum(duplicate_count) AS BIGINT) AS records_input,
 CAST(sum(duplicate_count) AS BIGINT) AS records_deduplicated, count(*) AS records_output,
 {r('sum(duplicate_count) * 1.0::DOUBLE / (count(*) + sum(duplicate_count))', 4)}
 AS deduplication_rate FROM kept""")
def silver_dedup_impact(lake: Lake):
    return silver.dedup_summary(lake.kept)


@query("silver_low_score", """
SELECT record_id, product_name, quality_score FROM cleaned WHERE quality_score < 60""")
def silver_low_score(lake: Lake):
    return lake.silver.filter("quality_score < 60").select("record_id", "product_name",
                                                           "quality_score")


@query("silver_dup_patterns", """
SELECT market, count(DISTINCT ean) AS eans, count(DISTINCT product_name_normalized) AS names,
 count(*) AS records FROM kept WHERE duplicate_count > 0 GROUP BY market""")
def silver_dup_patterns(lake: Lake):
    return lake.kept.filter("duplicate_count > 0").groupBy("market").agg(
        F.count_distinct("ean").alias("eans"),
        F.count_distinct("product_name_normalized").alias("names"), F.count(F.lit(1)).alias("records"))


@query("silver_lineage", """
SELECT record_id, k.market, bronze_run_id, run_records FROM kept k
JOIN (SELECT market, bronze_run_id, count(*) AS run_records FROM obs GROUP BY ALL) b
 USING (market, bronze_run_id)""")
def silver_lineage(lake: Lake):
    runs = lake.audit("bronze").select("market", F.col("run_id").alias("bronze_run_id"),
                                       F.col("records.input").alias("run_records"))
    return lake.kept.select("record_id", "market", "bronze_run_id").join(
        runs, ["market", "bronze_run_id"])


@query("silver_rank_dedup_sql", """
SELECT market, source_product_id, record_id, price FROM (SELECT *, row_number() OVER (
 PARTITION BY market, source_product_id ORDER BY collected_at DESC, record_id) AS rn FROM obs)
WHERE rn = 1""")
def silver_rank_dedup_sql(lake: Lake):
    """Top-1 by window: Spark limits each group before the shuffle (WindowGroupLimit)."""
    lake.obs.createOrReplaceTempView("bronze_records")
    return lake.spark.sql("""
        SELECT market, source_product_id, record_id, price FROM (
          SELECT market, source_product_id, record_id, price, ROW_NUMBER() OVER (
            PARTITION BY market, source_product_id ORDER BY collected_at DESC, record_id) AS rn
          FROM bronze_records) WHERE rn = 1""")


_RANK = "CASE market WHEN 'america' THEN 0 WHEN 'europe' THEN 1 WHEN 'asia' THEN 2 ELSE 3 END"


@query("ean_cross_market_resolve", f"""
SELECT product_name_normalized, arg_min(ean, ord) AS best_ean
FROM (SELECT product_name_normalized, ean, row_number() OVER (ORDER BY {_RANK}, ean) AS ord
 FROM kept WHERE ean_valid) GROUP BY product_name_normalized""")
def ean_cross_market_resolve(lake: Lake):
    """Best valid code per product name, in the given market order."""
    rank = F.lit(3)
    for i, m in enumerate(["america", "europe", "asia"]):
        rank = F.when(F.col("market") == m, i).otherwise(rank)
    return (lake.kept.filter("ean_valid").groupBy("product_name_normalized")
            .agg(F.min_by("ean", F.struct(rank, "ean")).alias("best_ean")))


_BEST = ", ".join(f"min(CASE WHEN market = '{m}' THEN price_normalized END) AS {m}"
                  for m in adapter.MARKETS)


@query("ean_master", f"SELECT ean, {_BEST} FROM kept WHERE ean IS NOT NULL GROUP BY ean")
def ean_master(lake: Lake):
    return (lake.kept.filter("ean IS NOT NULL").groupBy("ean")
            .pivot("market", lake.markets()).agg(F.min("price_normalized")))


@query("dedup_exact_level1", """
SELECT market, ean, day, record_id, records FROM (
 SELECT *, count(*) OVER (PARTITION BY market, ean, day) AS records, row_number() OVER (
  PARTITION BY market, ean, day ORDER BY collected_at DESC, record_id) AS pos
 FROM (SELECT *, CAST(collected_at AS DATE) AS day FROM cleaned WHERE ean IS NOT NULL))
WHERE pos = 1""")
def dedup_exact_level1(lake: Lake):
    return history.exact_duplicates(lake.silver)


@query("dedup_cross_market_level2", """
SELECT ean, low_record, high_record, markets FROM (
 SELECT ean, count(DISTINCT market) AS markets,
  (list(record_id ORDER BY price_normalized, market, record_id))[1] AS low_record,
  (list(record_id ORDER BY price_normalized DESC, market, record_id))[1] AS high_record
 FROM kept WHERE ean IS NOT NULL AND price_normalized IS NOT NULL GROUP BY ean)
WHERE markets > 1""")
def dedup_cross_market_level2(lake: Lake):
    return history.cross_market_duplicates(lake.kept)


@query("dedup_fuzzy_level3", """
WITH RECURSIVE rows_ AS MATERIALIZED (
 SELECT *, row_number() OVER (PARTITION BY market, product_name_normalized ORDER BY c, record_id) i
 FROM kept WHERE ean_normalized IS NOT NULL AND price_normalized IS NOT NULL
  AND product_name_normalized IS NOT NULL),
chain(market, name, i, c, group_no, representative) AS (
 SELECT market, product_name_normalized, i, c, CAST(1 AS BIGINT), record_id FROM rows_ WHERE i = 1
 UNION ALL
 SELECT t.market, t.name, n.i, n.c,
  t.group_no + CASE WHEN n.c - t.c <= 0.05::DOUBLE * t.c THEN 0 ELSE 1 END,
  CASE WHEN n.c - t.c <= 0.05::DOUBLE * t.c THEN t.representative ELSE n.record_id END
 FROM chain t JOIN rows_ n ON n.market = t.market AND n.product_name_normalized = t.name
  AND n.i = t.i + 1)
SELECT a.record_id, a.market, a.product_name_normalized, a.ean_normalized, a.price_normalized,
 CASE WHEN a.c - d.c <= 0.05::DOUBLE * d.c THEN d.ean_normalized END AS lower_partner,
 CASE WHEN u.c - a.c <= 0.05::DOUBLE * a.c THEN u.ean_normalized END AS upper_partner,
 t.group_no, t.representative,
 EXISTS (SELECT 1 FROM kept b WHERE b.market = a.market
  AND b.product_name_normalized = a.product_name_normalized
  AND b.ean_normalized <> a.ean_normalized AND b.price_normalized IS NOT NULL
  AND CAST(abs(a.c - b.c) AS DOUBLE) <= 0.05::DOUBLE * least(a.c, b.c)) AS is_fuzzy_duplicate
FROM rows_ a JOIN chain t ON t.market = a.market AND t.name = a.product_name_normalized AND t.i = a.i
LEFT JOIN rows_ d ON d.market = a.market AND d.product_name_normalized = a.product_name_normalized
 AND d.i = a.i - 1
LEFT JOIN rows_ u ON u.market = a.market AND u.product_name_normalized = a.product_name_normalized
 AND u.i = a.i + 1""")
def dedup_fuzzy_level3(lake: Lake):
    """Near-priced records of one name: partner codes, group and its representative.

    The check query walks every chain row by row, and tests every pair.
    """
    return history.fuzzy_duplicates(lake.kept)


@query("gold_catalog_view", f"""
SELECT product_name_normalized AS product_name, category_normalized AS category,
 brand_normalized AS brand, ean, min(price_normalized) AS min_price,
 max(price_normalized) AS max_price, CASE WHEN count(c) > 0 THEN
 (CAST((2 * sum(c) + count(c)) // (2 * count(c)) AS DOUBLE) / 100.0) END AS avg_price,
 count(DISTINCT market) AS market_count,
 (SELECT string_agg(l.market || '@' || strftime(l.collected_at, '%Y-%m-%d'), ','
   ORDER BY l.market) FROM catalog_latest l
  WHERE l.product_name_normalized = k.product_name_normalized AND l.ean = k.ean
  AND l.category_normalized = k.category_normalized
  AND l.brand_normalized IS NOT DISTINCT FROM k.brand_normalized) AS latest_by_market
FROM kept k WHERE ean IS NOT NULL GROUP BY ALL""")
def gold_catalog_view(lake: Lake):
    view = states.catalog_rollup(lake.catalog_months)
    latest = F.transform("latest_by_market", lambda s: F.concat_ws(
        "@", s["market"], F.date_format(s["collected_at"], "yyyy-MM-dd")))
    return view.withColumn("latest_by_market", F.array_join(latest, ","))


@query("product_fingerprint", """
SELECT record_id, market, CASE WHEN product_name_normalized IS NOT NULL
 THEN CAST('0x' || substr(md5(market || product_name_normalized), 1, 15) AS BIGINT) END AS product_id
FROM kept""")
def product_fingerprint(lake: Lake):
    """A 60-bit product id per market and name; NULL without a name."""
    digest = F.md5(F.concat("market", "product_name_normalized"))
    product_id = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return lake.kept.select("record_id", "market", product_id.alias("product_id"))


@query("year_summary", """
SELECT market, year, month, count(*) AS records, count(price_normalized) AS priced,
 CAST(sum(c) AS DOUBLE) / 100.0 AS price_sum, min(price_normalized) AS min_price,
 max(price_normalized) AS max_price
FROM (SELECT *, strftime(collected_at, '%Y') AS year, strftime(collected_at, '%m') AS month
 FROM cleaned) GROUP BY market, ROLLUP (year, month)""")
def year_summary(lake: Lake):
    """Merged from month states: a new month adds its rows, old records are not read."""
    return states.market_rollup(lake.months).drop("codes", "prices")


@query("year_codes")
def year_codes(lake: Lake):
    """Estimated distinct product codes per market: months, years and all time."""
    return states.distinct_codes(states.market_rollup(lake.months))


@query("year_codes_bound", """
SELECT market, year, month, TRUE AS close
FROM (SELECT market, strftime(collected_at, '%Y') AS year, strftime(collected_at, '%m') AS month
 FROM cleaned) GROUP BY market, ROLLUP (year, month)""")
def year_codes_bound(lake: Lake):
    """Estimates lie within six standard errors (and one code) of the exact counts."""
    exact = lake.silver.select("market", "ean", states.month_of(F.col("collected_at")).alias("m"))
    exact = exact.distinct().withColumns({"year": F.substring("m", 1, 4),
                                          "month": F.substring("m", 6, 2)})
    sets = [[F.col("market"), F.col("year"), F.col("month")],
            [F.col("market"), F.col("year")], [F.col("market")]]
    counts = exact.groupingSets(sets, "market", "year", "month").agg(
        F.count_distinct("ean").alias("n"))
    found = year_codes(lake)
    same = [counts[c].eqNullSafe(found[c]) for c in ("market", "year", "month")]
    gap = F.abs(found["codes"] - counts["n"])
    return counts.join(found, same).select(
        counts["market"], counts["year"], counts["month"],
        (gap <= F.lit(0.1) * counts["n"] + 1).alias("close"))
