"""Queries on Gold: the five tables, their parts, and measures over the history."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions import numbers, text
from gondola.operators import audit, gold
from gondola.plans.lake import Lake
from gondola.plans.oracle_views import market_name, r
from gondola.plans.pipeline import BUILDERS, publish_gold
from gondola.plans.registry import query
from gondola.session import fresh_path
from gondola.sources import adapter


@query("gold_latest_date", "SELECT d AS latest_date FROM last_day")
def gold_latest_date(lake: Lake):
    return gold.latest_date(lake.kept)


@query("gold_date_filter", """
SELECT record_id, market, price_normalized FROM kept
WHERE collected_date = (SELECT d FROM last_day)""")
def gold_date_filter(lake: Lake):
    return gold.on_date(lake.kept).select("record_id", "market", "price_normalized")


@query("gold_daily_kpis", """
SELECT * FROM daily_all WHERE kpi_date = (SELECT CAST(d AS VARCHAR) FROM last_day)""")
def gold_daily_kpis(lake: Lake):
    return gold.daily_kpis(lake.kept)


@query("gold_market_name", f"""
SELECT market, {market_name('market')} AS titled, {market_name('market', False)} AS plain,
 count(*) AS records FROM obs GROUP BY market""")
def gold_market_name(lake: Lake):
    m = F.col("market")
    return lake.obs.groupBy("market").agg(F.count(F.lit(1)).alias("records")).select(
        "market", text.market_name(m).alias("titled"),
        text.market_name(m, title_fallback=False).alias("plain"), "records")


@query("gold_product_latest_per_market", """
SELECT ean, market, record_id, price_normalized, collected_at FROM newest_per_market""")
def gold_product_latest_per_market(lake: Lake):
    return gold.latest_per_market(lake.kept).select("ean", "market", "record_id",
                                                    "price_normalized", "collected_at")


@query("gold_product_metrics", "SELECT * FROM product_table")
def gold_product_metrics(lake: Lake):
    return gold.product_metrics(lake.kept)


@query("gold_argmin_argmax", """
SELECT ean, cheapest_market, cheapest_price, most_expensive_market, most_expensive_price
FROM product_table""")
def gold_argmin_argmax(lake: Lake):
    return gold.product_metrics(lake.kept).select(
        "ean", "cheapest_market", "cheapest_price", "most_expensive_market",
        "most_expensive_price")


@query("gold_days_since", """
SELECT event_type, floor(epoch_us(max(last_ts) OVER ()) / 86400000000.0
  - epoch_us(last_ts) / 86400000000.0)::BIGINT AS days_since
FROM (SELECT event_type, user_id, max(ts) AS last_ts FROM events GROUP BY ALL)""".replace(
    "SELECT event_type, floor", "SELECT event_type, user_id, floor"))
def gold_days_since(lake: Lake):
    """Whole 24-hour periods since the last event of each user and type."""
    e = lake.table("events")
    newest = F.broadcast(e.agg(F.max("ts").alias("newest")))
    per = e.groupBy("event_type", "user_id").agg(F.max("ts").alias("last_ts"))
    gap = (F.unix_micros(F.col("newest").cast("timestamp"))
           - F.unix_micros(F.col("last_ts").cast("timestamp")))
    days = F.floor(gap / F.lit(float(gold.DAY_MICROS))).cast("bigint")
    return per.crossJoin(newest).select("event_type", "user_id", days.alias("days_since"))


@query("gold_category_metrics", "SELECT * FROM category_table")
def gold_category_metrics(lake: Lake):
    return gold.category_metrics(lake.kept)


@query("gold_snapshot_latest", "SELECT market, ean, record_id FROM day_rows")
def gold_snapshot_latest(lake: Lake):
    return gold.snapshot_latest(lake.kept).select("market", "ean", "record_id")


@query("gold_cheapest_per_category", """
SELECT category_normalized, cheapest_ean, cheapest_price FROM cheap""")
def gold_cheapest_per_category(lake: Lake):
    return gold.cheapest_per_category(gold.snapshot_latest(lake.kept))


@query("gold_products_snapshot", "SELECT * FROM snapshot")
def gold_products_snapshot(lake: Lake):
    return gold.products_snapshot(lake.kept)


_PRICES = """price_id, market, ean, product_name, price, unit_price, price_date,
 collection_timestamp, category, price_tier, volume"""


@query("gold_market_prices", f"SELECT {_PRICES} FROM price_table")
def gold_market_prices(lake: Lake):
    return gold.market_prices(lake.kept)


@query("gold_price_tier", """
SELECT record_id, CASE WHEN price_normalized / 1000 < 10 THEN 'Budget'
  WHEN price_normalized / 1000 < 50 THEN 'Standard' ELSE 'Premium' END AS price_tier
FROM cleaned WHERE price_normalized IS NOT NULL""")
def gold_price_tier(lake: Lake):
    """Tiers of the price in thousands, so that all three occur."""
    p = F.col("price_normalized")
    return lake.silver.filter(p.isNotNull()).select(
        "record_id", numbers.price_tier(p / 1000).alias("price_tier"))


@query("gold_union_markets", """
SELECT market, count(*) AS records, CAST(sum(c) AS BIGINT) AS cents FROM kept GROUP BY market""")
def gold_union_markets(lake: Lake):
    parts = [lake.spark.read.parquet(p) for p in lake.kept_paths()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("market").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(numbers.cents(F.col("price_normalized"))).alias("cents"))


_TABLES_SQL = """
SELECT 'products_snapshot' AS table_name, count(*) AS records FROM snapshot
UNION ALL SELECT 'market_prices', count(*) FROM price_table
UNION ALL SELECT 'daily_kpis', count(*) FROM daily_all
 WHERE kpi_date = (SELECT CAST(d AS VARCHAR) FROM last_day)
UNION ALL SELECT 'product_metrics', count(*) FROM product_table
UNION ALL SELECT 'category_metrics', count(*) FROM category_table"""


def _counts(lake: Lake, files: dict[str, str]):
    out = None
    for name, path in files.items():
        schema = BUILDERS[name](lake.kept).schema
        one = (lake.spark.read.schema(schema).parquet(path).agg(F.count(F.lit(1)).alias("records"))
               .select(F.lit(name).alias("table_name"), "records"))
        out = one if out is None else out.unionByName(one)
    return out


@query("sink_gold_tables", _TABLES_SQL)
def sink_gold_tables(lake: Lake):
    result = publish_gold(lake.kept, fresh_path(lake.spark, "gold"))
    return _counts(lake, result.files_created)


@query("gold_table_isolation", f"""
SELECT table_name, records, 'PARTIAL' AS status FROM ({_TABLES_SQL})
WHERE table_name NOT IN ('products_snapshot')""")
def gold_table_isolation(lake: Lake):
    """A table that cannot be built (its score column is gone) leaves the other four."""
    result = publish_gold(lake.kept.drop("quality_score"), fresh_path(lake.spark, "gold"))
    return _counts(lake, result.files_created).withColumn("status", F.lit(result.status))


@query("pipeline_totals", """
SELECT 'bronze' AS layer, count(DISTINCT bronze_run_id) AS runs, count(*) AS records,
 CAST(0 AS BIGINT) AS errors FROM obs
UNION ALL SELECT 'silver', count(*), CAST(sum(n) AS BIGINT),
 count(*) FILTER (WHERE status = 'CRITICAL') FROM run_judged""")
def pipeline_totals(lake: Lake):
    return audit.layer_totals(lake.audit())


# --- measures over the history -----------------------------------------------------------

@query("gold_current_by_category", """
SELECT market, product_name, current_price, is_cheapest FROM snapshot
WHERE category = 'Laticínios' ORDER BY current_price, market, product_name""")
def gold_current_by_category(lake: Lake):
    return (gold.products_snapshot(lake.kept).filter(F.col("category") == "Laticínios")
            .select("market", "product_name", "current_price", "is_cheapest")
            .orderBy("current_price", "market", "product_name"))


@query("gold_trend_30d", f"""
SELECT price_date, market, (CAST((2 * sum(c) + count(c)) // (2 * count(c)) AS DOUBLE) / 100.0)
  AS avg_price, min(price) AS min_price, max(price) AS max_price
FROM (SELECT CAST(collected_at AS DATE) AS price_date, market, price_normalized AS price, c
  FROM cleaned WHERE price_normalized IS NOT NULL AND category_normalized = 'Laticínios')
WHERE price_date BETWEEN (SELECT max(CAST(collected_at AS DATE)) FROM cleaned) - 30
 AND (SELECT max(CAST(collected_at AS DATE)) FROM cleaned)
GROUP BY price_date, market ORDER BY price_date DESC, market""")
def gold_trend_30d(lake: Lake):
    rows = gold.last_days(lake.silver, 30)
    p = F.col("price_normalized")
    c = numbers.cents(p)
    return (rows.filter(p.isNotNull() & (F.col("category_normalized") == "Laticínios"))
            .groupBy(gold.day(F.col("collected_at")).alias("price_date"), "market")
            .agg(numbers.mean_of_cents(F.sum(c), F.count(c)).alias("avg_price"),
                 F.min(p).alias("min_price"), F.max(p).alias("max_price"))
            .orderBy(F.desc("price_date"), "market"))


@query("gold_kpi_90d", """
SELECT kpi_date, market, avg_price, price_volatility_index, data_completeness FROM daily_all
WHERE CAST(kpi_date AS DATE) >= (SELECT d FROM last_day) - 90
ORDER BY kpi_date DESC, market""")
def gold_kpi_90d(lake: Lake):
    kpis = gold.daily_kpis(gold.last_days(lake.kept, 90), all_dates=True)
    return (kpis.select("kpi_date", "market", "avg_price", "price_volatility_index",
                        "data_completeness").orderBy(F.desc("kpi_date"), "market"))


@query("gold_top_spread", """
SELECT ean, product_name, cheapest_market, cheapest_price, most_expensive_price, price_spread,
 price_competitiveness_score FROM product_table WHERE category = 'Laticínios'
ORDER BY price_spread DESC, ean LIMIT 20""")
def gold_top_spread(lake: Lake):
    return (gold.product_metrics(lake.kept).filter(F.col("category") == "Laticínios")
            .select("ean", "product_name", "cheapest_market", "cheapest_price",
                    "most_expensive_price", "price_spread", "price_competitiveness_score")
            .orderBy(F.desc("price_spread"), "ean").limit(20))


@query("gold_category_listing", """
SELECT category, market, product_count, avg_price, price_competitiveness FROM category_table
ORDER BY category, market""")
def gold_category_listing(lake: Lake):
    return (gold.category_metrics(lake.kept)
            .select("category", "market", "product_count", "avg_price", "price_competitiveness")
            .orderBy("category", "market"))


@query("gold_price_rank", """
SELECT market, ean, category_normalized AS category, price_normalized AS price,
 row_number() OVER (PARTITION BY category_normalized, ean
  ORDER BY price_normalized NULLS LAST, market, record_id) AS price_rank
FROM newest_per_market""")
def gold_price_rank(lake: Lake):
    """Rank of each market's current price for a product: at most one row per market."""
    return gold.price_rank(gold.latest_per_market(lake.kept))


@query("gold_price_lag", f"""
SELECT price_date, market, record_id, price, prev_price,
 sign((price - prev_price) * 100.0 / prev_price)
  * {r('abs((price - prev_price) * 100.0 / prev_price)')} AS price_change_pct
FROM (SELECT CAST(collected_at AS DATE) AS price_date, market, record_id,
  price_normalized AS price, lag(price_normalized) OVER (PARTITION BY market
   ORDER BY collected_at, record_id) AS prev_price
 FROM cleaned WHERE price_normalized IS NOT NULL AND ean =
  (SELECT ean FROM cleaned WHERE ean IS NOT NULL GROUP BY ean ORDER BY count(*) DESC, ean
   LIMIT 1))""")
def gold_price_lag(lake: Lake):
    """Every observation of the most observed product with the price before it."""
    seen = lake.silver.filter(F.col("ean").isNotNull())
    top = seen.groupBy("ean").count().orderBy(F.desc("count"), "ean").first()
    return gold.price_history(lake.silver, top[0] if top else "")


@query("gold_scorecard", """
SELECT market, market_name, kpi_date, avg_price, price_volatility_index, data_completeness,
 new_products_count, price_change_count FROM daily_all
WHERE kpi_date = (SELECT CAST(d AS VARCHAR) FROM last_day) ORDER BY market""")
def gold_scorecard(lake: Lake):
    return gold.daily_kpis(lake.kept).select(
        "market", "market_name", "kpi_date", "avg_price", "price_volatility_index",
        "data_completeness", "new_products_count", "price_change_count").orderBy("market")


@query("gold_best_deals", """
SELECT ean, product_name, category, brand, cheapest_market, cheapest_price,
 most_expensive_price, price_spread, last_collected FROM product_table WHERE price_spread > 10
ORDER BY price_spread DESC, ean LIMIT 50""")
def gold_best_deals(lake: Lake):
    return (gold.product_metrics(lake.kept).filter(F.col("price_spread") > 10)
            .select("ean", "product_name", "category", "brand", "cheapest_market",
                    "cheapest_price", "most_expensive_price", "price_spread", "last_collected")
            .orderBy(F.desc("price_spread"), "ean").limit(50))


_PIVOT = ", ".join(f"max(CASE WHEN market = '{m}' THEN price_normalized END) AS {m}_price"
                   for m in adapter.MARKETS)


@query("gold_price_pivot", f"""
SELECT ean, product_name_normalized AS product_name, {_PIVOT},
 min(price_normalized) AS min_price, max(price_normalized) AS max_price
FROM kept GROUP BY ean, product_name_normalized""")
def gold_price_pivot(lake: Lake):
    p = F.col("price_normalized")
    wide = [F.max(F.when(F.col("market") == m, p)).alias(f"{m}_price") for m in lake.markets()]
    return lake.kept.groupBy("ean", F.col("product_name_normalized").alias("product_name")).agg(
        *wide, F.min(p).alias("min_price"), F.max(p).alias("max_price"))


@query("gold_price_change", "SELECT * FROM moves")
def gold_price_change(lake: Lake):
    return gold.price_changes(lake.silver)


@query("gold_daily_price_changes", f"""
SELECT market, price_date, count(*) FILTER (WHERE price <> previous_price) AS price_change_count,
 count(*) AS compared,
 {r('CAST(sum(CAST(price_change_pct AS DECIMAL(20, 2))) AS DOUBLE) / count(*)')}
  AS avg_price_change_pct FROM moves WHERE previous_price IS NOT NULL GROUP BY ALL""")
def gold_daily_price_changes(lake: Lake):
    return gold.daily_price_changes(lake.silver)


@query("gold_new_products", """
SELECT market, first_date, count(*) AS new_products_count
FROM (SELECT market, ean, min(CAST(collected_at AS DATE)) AS first_date FROM cleaned
 WHERE ean IS NOT NULL GROUP BY ALL) GROUP BY ALL""")
def gold_new_products(lake: Lake):
    return gold.new_products(lake.silver)


@query("gold_market_share", f"""
SELECT market, category_normalized AS category, CAST(s AS DOUBLE) / 100.0 AS market_value,
 {r('CAST(s * 100 AS DOUBLE) / CAST(sum(s) OVER (PARTITION BY category_normalized) AS DOUBLE)')}
  AS market_share_pct
FROM (SELECT market, category_normalized, sum(c) AS s FROM kept WHERE c IS NOT NULL
 GROUP BY ALL)""")
def gold_market_share(lake: Lake):
    return gold.market_share(lake.kept)
