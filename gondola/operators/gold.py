"""Gold: the five analytics tables and the measures built on them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions import numbers
from gondola.functions.text import market_name
from gondola.operators.ordered import (best_row, cents_round, descending, micros, neighbours,
                                       price_stats)

r2 = numbers.round_half_up
DAY_MICROS = 86_400_000_000


def day(c: Column) -> Column:
    return F.to_date(c)


def stamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def latest_date(df: DataFrame) -> DataFrame:
    """One row: the newest collection date."""
    return df.agg(F.max(day(F.col("collected_at"))).alias("latest_date"))


def on_date(df: DataFrame, date: str | None = None) -> DataFrame:
    """Rows of one day (default: the newest). The filter reaches the Parquet scan.

    The newest date is read first (one row) so that it enters the plan as a literal.
    """
    if date is None:
        newest = latest_date(df).first()[0]
        date = newest.isoformat() if newest else "0001-01-01"
    return df.filter(day(F.col("collected_at")) == F.lit(date).cast("date"))


def daily_kpis(df: DataFrame, date: str | None = None, all_dates: bool = False) -> DataFrame:
    """Price level, spread and completeness per market for one day, or for every day."""
    rows = df if all_dates else on_date(df, date)
    rows = rows.withColumn("kpi_date", day(F.col("collected_at")))
    changed = F.count_if(F.contains(F.col("quality_flags"), F.lit("PRICE_CHANGE")))
    extra = [("price_change_count", changed, "sum")]
    has_change = "price_change_pct" in df.columns
    if has_change:
        extra += [("_chg", F.sum("price_change_pct"), "sum"),
                  ("_chg_n", F.count("price_change_pct"), "sum")]
    s = price_stats(rows, ["kpi_date", "market"], extra=extra).filter("n_prices > 0")
    std = F.coalesce(F.col("stddev"), F.lit(0.0))
    change = (F.coalesce(r2(F.col("_chg") / F.nullif(F.col("_chg_n"), F.lit(0))), F.lit(0.0))
              if has_change else F.lit(0.0))
    return s.select(
        F.col("kpi_date").cast("string").alias("kpi_date"), "market",
        market_name(F.col("market")).alias("market_name"),
        F.col("n_rows").alias("total_products"), F.col("mean").alias("avg_price"),
        cents_round(F.col("median")).alias("median_price"), r2(std).alias("price_std_dev"),
        F.col("low").alias("price_min"), F.col("high").alias("price_max"),
        F.when((F.col("median") > 0) & (std > 0), r2(std / F.col("median") * 100.0))
        .otherwise(0.0).alias("price_volatility_index"),
        r2(F.col("n_prices") * 100.0 / F.col("n_rows")).alias("data_completeness"),
        F.lit(0).cast("bigint").alias("new_products_count"), "price_change_count",
        change.alias("avg_price_change_pct"))


def latest_per_market(df: DataFrame) -> DataFrame:
    """Newest row per (ean, market); rows without a code are left out."""
    cols = ["ean", "market", "price_normalized", "product_name_normalized",
            "category_normalized", "brand_normalized", "unit_normalized", "collected_at",
            "record_id"]
    return best_row(df.filter(F.col("ean").isNotNull()).select(*cols), ["ean", "market"],
                    [descending(micros(F.col("collected_at"))), F.col("record_id")])


def product_metrics(df: DataFrame) -> DataFrame:
    """Cross-market comparison of each product code over its newest rows."""
    latest = latest_per_market(df).withColumn("c", numbers.cents(F.col("price_normalized")))
    seen = [micros(F.col("collected_at")), F.col("market"), F.col("record_id")]
    priced = F.col("c").isNotNull()
    cheap = F.min_by("market", F.when(priced, F.struct(F.col("c"), *seen)))
    dear = F.min_by("market", F.when(priced, F.struct(-F.col("c"), *seen)))
    first = F.min_by(F.struct("product_name_normalized", "category_normalized",
                              "brand_normalized", "unit_normalized"), F.struct(*seen))
    g = latest.groupBy("ean").agg(
        F.count(F.lit(1)).alias("markets_selling"), F.count("c").alias("n"),
        F.sum("c").alias("s"), F.sum((F.col("c") * F.col("c")).cast("decimal(20,0)")).alias("q"),
        F.min("c").alias("lo"), F.max("c").alias("hi"), cheap.alias("cheap"),
        dear.alias("dear"), first.alias("f"), F.max("collected_at").alias("last_ts"))
    g = g.filter("n > 0").crossJoin(F.broadcast(
        df.agg(F.max("collected_at").alias("newest"))))
    lo, hi = F.col("lo"), F.col("hi")
    var = numbers.variance_of_cents(F.col("n"), F.col("s"), F.col("q"))
    score = F.when(var > 0, F.greatest(F.lit(0.0), F.lit(100.0) - var * 10.0)).otherwise(100.0)
    age = micros(F.col("newest")) - micros(F.col("last_ts"))
    return g.select(
        F.col("ean").alias("product_id"), "ean",
        F.col("f.product_name_normalized").alias("product_name"),
        F.col("f.category_normalized").alias("category"),
        F.col("f.brand_normalized").alias("brand"), F.col("f.unit_normalized").alias("volume"),
        "markets_selling",
        market_name(F.col("cheap"), title_fallback=False).alias("cheapest_market"),
        (lo / 100.0).alias("cheapest_price"),
        market_name(F.col("dear"), title_fallback=False).alias("most_expensive_market"),
        (hi / 100.0).alias("most_expensive_price"),
        ((hi - lo) / 100.0).alias("price_spread"),
        r2((hi - lo) * 100.0 / lo).alias("price_spread_pct"),
        numbers.mean_of_cents(F.col("s"), F.col("n")).alias("avg_price_across_markets"),
        stamp_text(F.col("last_ts")).alias("last_collected"),
        F.floor(age / F.lit(float(DAY_MICROS))).cast("bigint").alias("days_since_update"),
        numbers.round_half_up(score, 1).alias("price_competitiveness_score"))


def category_metrics(df: DataFrame) -> DataFrame:
    """Price level of each (market, category) and how tight its prices are."""
    keys = ["market", "category_normalized"]
    s = price_stats(df, keys, extra=[("newest", F.max("collected_at"), "max")])
    codes = (df.select(*keys, "ean").groupBy(*keys)
             .agg(F.count_distinct("ean").alias("product_count")))
    joined = s.filter("n_prices > 0").join(codes, keys)
    spread = F.greatest(F.lit(0.0), F.lit(100.0) - F.col("stddev") / F.col("median") * 100.0)
    return joined.select(
        F.concat_ws("_", "market", "category_normalized").alias("category_id"), "market",
        market_name(F.col("market")).alias("market_name"),
        F.col("category_normalized").alias("category"), "product_count",
        F.col("mean").alias("avg_price"), cents_round(F.col("median")).alias("median_price"),
        F.col("low").alias("price_range_min"), F.col("high").alias("price_range_max"),
        numbers.round_half_up(spread, 1).alias("price_competitiveness"),
        stamp_text(F.col("newest")).alias("last_updated"))


def snapshot_latest(df: DataFrame, date: str | None = None) -> DataFrame:
    """Newest row per (market, ean) of one day; rows without a code are left out."""
    rows = on_date(df, date).filter(F.col("ean").isNotNull())
    return best_row(rows, ["market", "ean"],
                    [descending(micros(F.col("collected_at"))), F.col("record_id")])


def cheapest_per_category(latest: DataFrame) -> DataFrame:
    """Code of the lowest price of each category over all markets."""
    order = F.struct("price_normalized", micros(F.col("collected_at")), "market", "record_id")
    return (latest.filter(F.col("price_normalized").isNotNull())
            .groupBy("category_normalized")
            .agg(F.min_by("ean", order).alias("cheapest_ean"),
                 F.min("price_normalized").alias("cheapest_price")))


def products_snapshot(df: DataFrame, date: str | None = None) -> DataFrame:
    """Current price per market and product, with the cheapest code of its category marked.

    Categories are a fixed list, so the cheapest codes are broadcast: a hot category
    stays where its rows are.
    """
    latest = snapshot_latest(df, date)
    best = F.broadcast(cheapest_per_category(latest)
                       .select("category_normalized", "cheapest_ean"))
    j = latest.join(best, "category_normalized", "left")
    change = F.col("price_change_pct") if "price_change_pct" in df.columns else F.lit(0.0)
    return j.select(
        F.concat_ws("_", "market", "ean").alias("product_id"), "market", "ean",
        F.col("product_name_normalized").alias("product_name"),
        F.col("category_normalized").alias("category"), F.col("brand_normalized").alias("brand"),
        F.col("price_normalized").alias("current_price"),
        F.lit(None).cast("double").alias("previous_price"), change.alias("price_change_pct"),
        F.when(F.col("ean") == F.col("cheapest_ean"), 1).otherwise(0).alias("is_cheapest"),
        F.col("unit_normalized").alias("volume"),
        stamp_text(F.col("collected_at")).alias("collected_at"),
        day(F.col("collected_at")).cast("string").alias("collection_date"),
        market_name(F.col("market")).alias("market_name"),
        F.col("quality_score").alias("data_quality_score"))


def market_prices(df: DataFrame) -> DataFrame:
    """Every priced observation with its tier: a projection, no shuffle."""
    p = F.col("price_normalized")
    return df.filter(p.isNotNull()).select(
        F.concat_ws("_", F.md5("record_id"), "market", "ean").alias("price_id"), "market", "ean",
        F.col("product_name_normalized").alias("product_name"), p.alias("price"),
        r2(F.col("unit_price")).alias("unit_price"),
        day(F.col("collected_at")).cast("string").alias("price_date"),
        stamp_text(F.col("collected_at")).alias("collection_timestamp"),
        F.col("category_normalized").alias("category"),
        numbers.price_tier(p).alias("price_tier"), F.col("unit_normalized").alias("volume"))


# --- measures over the history ---------------------------------------------------

def daily_prices(df: DataFrame) -> DataFrame:
    """Closing price per (market, ean, day): the newest priced row of the day."""
    rows = (df.filter(F.col("ean").isNotNull() & F.col("price_normalized").isNotNull())
            .withColumn("price_date", day(F.col("collected_at")))
            .select("market", "ean", "price_date", "price_normalized", "collected_at",
                    "record_id"))
    return best_row(rows, ["market", "ean", "price_date"],
                    [descending(micros(F.col("collected_at"))), F.col("record_id")])


def change_pct(now: Column, before: Column) -> Column:
    """Change in percent; two decimals, half up on the magnitude."""
    moved = (now - before) * 100.0 / before
    return F.signum(moved) * r2(F.abs(moved))


def price_changes(df: DataFrame) -> DataFrame:
    """Previous closing price and change per (market, ean, day).

    A product has one row per day, so its window is bounded by the days.
    """
    w = Window.partitionBy("market", "ean").orderBy("price_date")
    d = daily_prices(df).withColumn("previous_price", F.lag("price_normalized").over(w))
    return d.select("market", "ean", "price_date", F.col("price_normalized").alias("price"),
                    "previous_price",
                    change_pct(F.col("price_normalized"), F.col("previous_price"))
                    .alias("price_change_pct"))


def daily_price_changes(df: DataFrame) -> DataFrame:
    """Products whose price moved and the mean move, per market and day."""
    c = price_changes(df).filter("previous_price is not null")
    moved = F.col("price") != F.col("previous_price")
    pct = F.sum(F.col("price_change_pct").cast("decimal(20,2)")).cast("double")
    return c.groupBy("market", "price_date").agg(
        F.count_if(moved).alias("price_change_count"), F.count(F.lit(1)).alias("compared"),
        r2(pct / F.count(F.lit(1))).alias("avg_price_change_pct"))


def new_products(df: DataFrame) -> DataFrame:
    """Product codes first seen on each day, per market."""
    first = (df.filter(F.col("ean").isNotNull()).groupBy("market", "ean")
             .agg(F.min(day(F.col("collected_at"))).alias("first_date")))
    return first.groupBy("market", "first_date").agg(
        F.count(F.lit(1)).alias("new_products_count"))


def market_share(df: DataFrame) -> DataFrame:
    """Share of a market in the summed prices of its category, in percent.

    Category totals come from the (market, category) sums, a table of that many
    rows: exact integer cents, no window over the records.
    """
    per = (df.filter(F.col("price_normalized").isNotNull())
           .groupBy("market", "category_normalized")
           .agg(F.sum(numbers.cents(F.col("price_normalized"))).alias("c")))
    total = per.groupBy("category_normalized").agg(F.sum("c").alias("t"))
    return per.join(total, "category_normalized").select(
        "market", F.col("category_normalized").alias("category"),
        (F.col("c") / 100.0).alias("market_value"),
        r2(F.col("c") * 100.0 / F.col("t")).alias("market_share_pct"))


def last_days(df: DataFrame, days: int) -> DataFrame:
    """Rows of the newest ``days`` days before the newest date, and of that date."""
    newest = latest_date(df).first()[0]
    if newest is None:
        return df.filter(F.lit(False))
    d = day(F.col("collected_at"))
    return df.filter((d >= F.lit(newest - timedelta(days=days))) & (d <= F.lit(newest)))


def price_rank(latest: DataFrame) -> DataFrame:
    """Price position of each market per (category, ean).

    ``latest`` holds one row per (market, ean), so a window group never exceeds
    the number of markets.
    """
    w = Window.partitionBy("category_normalized", "ean").orderBy(
        F.asc_nulls_last("price_normalized"), "market", "record_id")
    return latest.select("market", "ean", F.col("category_normalized").alias("category"),
                         F.col("price_normalized").alias("price"),
                         F.row_number().over(w).cast("bigint").alias("price_rank"))


def price_history(df: DataFrame, code: str) -> DataFrame:
    """All priced observations of one product with the observation before, per market."""
    rows = (df.filter((F.col("ean") == code) & F.col("price_normalized").isNotNull())
            .select("market", "collected_at", "record_id",
                    F.col("price_normalized").alias("price")))
    out = neighbours(rows, ["market"], ["collected_at", "record_id"],
                     {"prev_price": "price"})
    return out.select(day(F.col("collected_at")).alias("price_date"), "market", "record_id",
                      "price", "prev_price",
                      change_pct(F.col("price"), F.col("prev_price")).alias("price_change_pct"))
