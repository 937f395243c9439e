"""Queries on Silver: scalar cleaning, deduplication, dataset quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola import dims
from gondola.functions import ean, html, numbers, scoring, text, units
from gondola.operators import containment, quality, silver
from gondola.plans.lake import Lake
from gondola.plans.oracle_views import check_digit, norm_brand, norm_name, r, title_case
from gondola.plans.registry import query


# --- scalars -------------------------------------------------------------------------

@query("norm_name", f"""
SELECT record_id, {norm_name('product_name')} AS product_name_normalized FROM obs""")
def norm_name_(lake: Lake):
    return lake.obs.select("record_id", text.norm_name(F.col("product_name")).alias("product_name_normalized"))


@query("title_case", f"""
SELECT record_id, {title_case("replace(source_url, 'https', '')")} AS titled FROM obs""")
def title_case_(lake: Lake):
    url = F.replace("source_url", F.lit("https"), F.lit(""))
    return lake.obs.select("record_id", text.title_case(url).alias("titled"))


@query("strip_accents", """
SELECT doc_id, strip_accents(text) AS plain FROM documents""")
def strip_accents(lake: Lake):
    return lake.table("documents").select("doc_id", text.strip_accents(F.col("text"))
                                          .alias("plain"))


_VOL = dims.VOLUME_PATTERN


@query("extract_volume", f"""
SELECT record_id, TRY_CAST(replace(nullif(regexp_extract(lower(product_name), '{_VOL}', 1), ''),
  ',', '.') AS DOUBLE) AS quantity,
 nullif(regexp_extract(lower(product_name), '{_VOL}', 2), '') AS unit FROM obs""")
def extract_volume(lake: Lake):
    return (lake.obs.select("record_id", units.extract_volume(F.col("product_name")).alias("v"))
            .select("record_id", "v.quantity", "v.unit"))


@query("extract_unit", f"""
SELECT doc_id, nullif(regexp_extract(lower(text), '{_VOL}', 2), '') AS unit FROM documents""")
def extract_unit(lake: Lake):
    return lake.table("documents").select("doc_id", units.volume_unit(F.col("text"))
                                          .alias("unit"))


@query("norm_unit", "SELECT record_id, unit_normalized FROM cleaned")
def norm_unit(lake: Lake):
    return lake.obs.select("record_id",
                           units.norm_unit(units.volume_unit(F.col("product_name"))).alias("unit_normalized"))


@query("to_base_unit", f"""
SELECT record_id, q * CASE u WHEN 'l' THEN 1000.0::DOUBLE WHEN 'kg' THEN 1000.0::DOUBLE
  WHEN 'mg' THEN 0.001::DOUBLE ELSE 1.0::DOUBLE END AS base_quantity
FROM (SELECT record_id, CAST(replace(nullif(regexp_extract(lower(product_name), '{_VOL}', 1),
  ''), ',', '.') AS DOUBLE) AS q, regexp_extract(lower(product_name), '{_VOL}', 2) AS u
 FROM obs)""")
def to_base_unit(lake: Lake):
    return lake.obs.select("record_id", units.to_base_unit(
        units.volume_quantity(F.col("product_name")), units.volume_unit(F.col("product_name"))).alias("base_quantity"))


@query("norm_price", f"""
SELECT record_id, CASE WHEN price BETWEEN 0.01 AND 100000 THEN {r('price')} END
 AS price_normalized FROM obs""")
def norm_price(lake: Lake):
    """Prices come as text, every other one in Brazilian notation."""
    number = F.col("price").cast("decimal(18,2)").cast("string")
    local = F.concat(F.lit("R$ "), F.replace(number, F.lit("."), F.lit(",")))
    given = F.when(F.crc32("record_id") % 2 == 0, local).otherwise(number)
    return lake.obs.select("record_id", numbers.norm_price(numbers.comma_to_float(given))
                           .alias("price_normalized"))


@query("price_consistency", """
SELECT record_id, coalesce(price = 0 OR unit_price = 0
 OR unit_price <= price * 1.1::DOUBLE, TRUE) AS consistent FROM obs""")
def price_consistency(lake: Lake):
    return lake.obs.select("record_id", numbers.price_consistency(
        F.col("price"), F.col("unit_price")).alias("consistent"))


@query("norm_category", "SELECT record_id, category_normalized FROM cleaned")
def norm_category(lake: Lake):
    return lake.obs.select("record_id", text.norm_category(F.col("category"))
                           .alias("category_normalized"))


@query("fuzzy_dim_join", """
SELECT DISTINCT lower(trim(category)) AS term, (SELECT arg_min(standard, ord)
  FROM category_dim WHERE contains(lower(trim(category)), pattern)
   OR contains(pattern, lower(trim(category)))) AS standard
FROM obs WHERE trim(category) <> '' """)
def fuzzy_dim_join(lake: Lake):
    """First category, in order, whose pattern holds the term or is held by it."""
    rows = [F.struct(F.lit(i).alias("ord"), F.lit(p).alias("pattern"), F.lit(s).alias("standard"))
            for i, p, s in dims.category_rows()]
    dim = lake.spark.range(1).select(F.inline(F.array(*rows)))
    terms = lake.obs.select(text.category_key(F.col("category")).alias("term"))
    return containment.first_match(terms.filter("term is not null"), dim)


@query("category_hierarchy", """
SELECT record_id, category_normalized AS top_level, CAST(1 AS BIGINT) AS depth FROM cleaned""")
def category_hierarchy(lake: Lake):
    levels = text.category_hierarchy(text.norm_category(F.col("category")))
    return lake.obs.select("record_id", F.get(levels, 0).alias("top_level"),
                           F.size(levels).cast("bigint").alias("depth"))


@query("norm_brand", f"""
SELECT record_id, {norm_brand('brand')} AS brand_normalized FROM obs""")
def norm_brand_(lake: Lake):
    return lake.obs.select("record_id", text.norm_brand(F.col("brand"))
                           .alias("brand_normalized"))


@query("norm_ean", "SELECT record_id, ean_normalized FROM cleaned")
def norm_ean(lake: Lake):
    dashed = F.concat(F.substring("ean", 1, 3), F.lit("-"), F.expr("substring(ean, 4)"))
    return lake.obs.select("record_id", ean.norm_ean(dashed).alias("ean_normalized"))


@query("ean13_check_digit", f"""
SELECT p_partkey, CAST({check_digit("('789' || lpad(CAST(p_partkey AS VARCHAR), 9, '0'))")}
 AS INTEGER) AS check_digit FROM part""")
def ean13_check_digit(lake: Lake):
    body = F.concat(F.lit("789"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    return lake.table("part").select("p_partkey", ean.check_digit(body).alias("check_digit"))


_CHK = f"CAST({check_digit('ean')} AS VARCHAR)"


@query("ean_validate", f"""
SELECT record_id, ean_valid AS valid, ean_normalized AS cleaned_ean,
 CASE WHEN ean IS NULL THEN 'Empty EAN'
  WHEN ean_normalized IS NULL THEN 'Invalid format: ' || ean
  WHEN length(ean_normalized) = 13 AND {_CHK} <> substr(ean, 13, 1)
  THEN 'Invalid check digit: expected ' || {_CHK} || ', got ' || substr(ean, 13, 1) END AS error
FROM cleaned""")
def ean_validate(lake: Lake):
    return ean.with_validity(lake.obs.select("record_id", "ean"), "ean", "cleaned_ean", "valid",
                             "error").drop("ean")


@query("ean_valid", "SELECT record_id, ean_valid FROM cleaned")
def ean_valid(lake: Lake):
    return ean.with_validity(lake.obs.select("record_id", "ean")).select("record_id",
                                                                         "ean_valid")


@query("data_completeness", "SELECT record_id, data_completeness FROM cleaned")
def data_completeness(lake: Lake):
    return lake.obs.select("record_id", scoring.data_completeness().alias("data_completeness"))


@query("quality_score", "SELECT record_id, quality_score FROM cleaned")
def quality_score(lake: Lake):
    rows = ean.with_validity(lake.obs).withColumn("completeness", scoring.data_completeness())
    return rows.select("record_id", scoring.quality_score(
        F.col("completeness"), F.col("ean_valid")).alias("quality_score"))


@query("quality_flags", "SELECT record_id, quality_flags FROM cleaned")
def quality_flags(lake: Lake):
    return lake.silver.select("record_id", "quality_flags")


@query("dedup_consecutive_words", """
SELECT doc_id, array_to_string(list_filter(w, lambda x, i: i = 1 OR lower(x) <> lower(w[i - 1])),
 ' ') AS text FROM (SELECT doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')
 AS w FROM documents)""")
def dedup_consecutive_words(lake: Lake):
    return lake.table("documents").select(
        "doc_id", text.dedup_consecutive_words(F.col("text")).alias("text"))


@query("sanitize_string", """
SELECT doc_id, trim(regexp_replace(text, '[^a-zA-Z0-9 \\t\\n\\r\\f\\v\\-]', '', 'g'), ' ')
 AS clean FROM documents""")
def sanitize_string(lake: Lake):
    return lake.table("documents").select("doc_id", text.sanitize_string(F.col("text"))
                                          .alias("clean"))


@query("silver_normalize", """
SELECT record_id, product_name_normalized, price_normalized, unit_normalized,
 category_normalized, brand_normalized, ean_normalized, ean_valid, quality_score,
 data_completeness, quality_flags FROM cleaned""")
def silver_normalize(lake: Lake):
    return lake.silver.select(
        "record_id", "product_name_normalized", "price_normalized", "unit_normalized",
        "category_normalized", "brand_normalized", "ean_normalized", "ean_valid",
        "quality_score", "data_completeness", "quality_flags")


# --- deduplication ---------------------------------------------------------------------

_DEDUP_INPUT = [*silver.DEDUP_KEYS, "record_id", "ean_valid", "data_completeness",
                "collected_at", "price"]


@query("dedup_best_record", """
SELECT record_id, market, ean_normalized, product_name_normalized, price_normalized,
 collected_at FROM kept""")
def dedup_best_record(lake: Lake):
    """Only the columns asked for go through the shuffle with the winners."""
    rows = lake.silver.select(*_DEDUP_INPUT, "price_normalized")
    return silver.deduplicate(rows).select(
        "record_id", "market", "ean_normalized", "product_name_normalized",
        "price_normalized", "collected_at")


@query("dedup_duplicate_count", "SELECT record_id, duplicate_count FROM kept")
def dedup_duplicate_count(lake: Lake):
    return silver.deduplicate(lake.silver.select(*_DEDUP_INPUT)).select("record_id",
                                                                        "duplicate_count")


@query("dedup_mark_losers", """
SELECT record_id, market, rn > 1 AS is_duplicate,
 CASE WHEN rn > 1 THEN kept_id END AS duplicate_of_id FROM ranked""")
def dedup_mark_losers(lake: Lake):
    return silver.mark_losers(lake.silver).select("record_id", "market", "is_duplicate",
                                                  "duplicate_of_id")


@query("dedup_switch", """
SELECT TRUE AS remove_duplicates, count(*) AS records FROM kept
UNION ALL SELECT FALSE, count(*) FROM cleaned""")
def dedup_switch(lake: Lake):
    counts = [silver.deduplicate(lake.silver.select(*_DEDUP_INPUT), on).agg(F.count(F.lit(1)).alias("records"))
              .select(F.lit(on).alias("remove_duplicates"), "records") for on in (True, False)]
    return counts[0].unionByName(counts[1])


_SUMMARY = f"""count(*) + CAST(sum(duplicate_count) AS BIGINT) AS records_input,
 CAST(sum(duplicate_count) AS BIGINT) AS records_deduplicated, count(*) AS records_output,
 {r('sum(duplicate_count) * 1.0::DOUBLE / (count(*) + sum(duplicate_count))', 4)}
 AS deduplication_rate FROM kept"""


@query("dedup_rate", f"SELECT market, {_SUMMARY} GROUP BY market")
def dedup_rate(lake: Lake):
    return silver.dedup_summary(lake.kept, ("market",))


# --- dataset quality ----------------------------------------------------------------------

_LIMIT_ROWS = ", ".join(f"('{c}', {v}, '{'CRITICAL' if v == 0 else 'WARNING'}')"
                        for c, v in dims.NULL_RATE_LIMITS.items())
_NULL_CASE = " ".join(f"WHEN '{c}' THEN null_{c}" for c in dims.NULL_RATE_LIMITS)


@query("dq_null_rates", f"""
SELECT market, column_name, null_count, {r('null_count * 1.0::DOUBLE / n', 4)} AS null_rate,
 CAST(threshold AS DOUBLE) AS threshold, severity
FROM (SELECT *, CASE column_name {_NULL_CASE} END AS null_count FROM market_profile,
 (VALUES {_LIMIT_ROWS}) AS t(column_name, threshold, severity))
WHERE null_count * 1.0 / n > threshold""")
def dq_null_rates(lake: Lake):
    return quality.null_rate_issues(quality.profile(lake.kept))


@query("dq_price_range", f"""
SELECT s.market, example, price, n.out_of_range,
 {r('n.out_of_range * 1.0::DOUBLE / n.n', 4)} AS rate
FROM (SELECT market, price, row_number() OVER (PARTITION BY market ORDER BY record_id) AS example
 FROM kept WHERE price < 0.01 OR price > 100000) s JOIN market_profile n USING (market)
WHERE example <= 3""")
def dq_price_range(lake: Lake):
    bad = (F.col("price") < dims.PRICE_MIN) | (F.col("price") > dims.PRICE_MAX)
    counts = lake.kept.groupBy("market").agg(
        F.count_if(bad).alias("out_of_range"), F.count(F.lit(1)).alias("n"))
    rate = numbers.round_half_up(F.col("out_of_range") / F.col("n"), 4)
    ex = quality.examples(lake.kept, bad, ["price"], 3)
    return ex.join(counts, "market").select("market", "example", "price", "out_of_range",
                                            rate.alias("rate"))


@query("dq_price_outliers", f"""
SELECT market, n_outlier, {r('n_outlier * 1.0::DOUBLE / n_price', 4)} AS rate,
 {r('mean_price')} AS mean, {r('std_price')} AS std_dev,
 {r('mean_price + 3 * std_price')} AS threshold FROM market_assessed WHERE n_outlier > 0""")
def dq_price_outliers(lake: Lake):
    p = quality.assess(lake.kept)
    r2 = numbers.round_half_up
    return p.filter("n_outlier > 0").select(
        "market", "n_outlier", r2(F.col("n_outlier") / F.col("n_price"), 4).alias("rate"),
        r2(F.col("mean_price")).alias("mean"), r2(F.col("std_price")).alias("std_dev"),
        r2(F.col("mean_price") + 3 * F.col("std_price")).alias("threshold"))


@query("dq_price_negative", """
SELECT market, negative, pos AS example, record_id, price FROM (
 SELECT market, record_id, price, count(*) OVER (PARTITION BY market) AS negative,
  row_number() OVER (PARTITION BY market ORDER BY record_id) AS pos
 FROM (SELECT market, record_id, price - 1000.0::DOUBLE AS price FROM kept) WHERE price < 0)
WHERE pos <= 3""")
def dq_price_negative(lake: Lake):
    """Negative prices per market with three examples; shelf prices are lowered to have some."""
    lowered = lake.kept.withColumn("price", F.col("price") - F.lit(1000.0))
    bad = F.col("price") < 0
    n = lowered.filter(bad).groupBy("market").agg(F.count(F.lit(1)).alias("negative"))
    shown = quality.examples(lowered, bad, ["record_id", "price"], 3, order=["record_id"])
    return shown.join(n, "market").select("market", "negative", "example", "record_id", "price")


@query("dq_price_all_null", """
SELECT market, strftime(collected_at, '%Y-%m-%d') AS day, 'All prices are null' AS issue
FROM kept GROUP BY ALL HAVING count(price) = 0""")
def dq_price_all_null(lake: Lake):
    day = F.date_format("collected_at", "yyyy-MM-dd").alias("day")
    return (lake.kept.groupBy("market", day).agg(F.count("price").alias("n")).filter("n = 0")
            .select("market", "day", F.lit("All prices are null").alias("issue")))


@query("dq_ean_validity", f"""
SELECT market, {r('n_valid_ean * 1.0::DOUBLE / n_ean', 4)} AS valid_rate, n_valid_ean,
 n_valid_ean * 1.0 / n_ean < 0.80 AS is_issue, example, ean, error
FROM market_profile JOIN (SELECT market, ean, row_number() OVER (PARTITION BY market
  ORDER BY record_id) AS example, 'Invalid check digit: expected ' || {_CHK} || ', got '
  || substr(ean, 13, 1) AS error FROM kept WHERE NOT ean_valid AND ean IS NOT NULL)
 USING (market) WHERE example <= 5""")
def dq_ean_validity(lake: Lake):
    k = lake.kept
    k = ean.with_validity(k, error="error")
    bad = F.col("ean").isNotNull() & ~F.col("ean_valid")
    ex = quality.examples(k, bad, ["ean", "error"], 5)
    n = F.count("ean")
    ok = F.count_if(F.col("ean").isNotNull() & F.col("ean_valid"))
    rates = k.groupBy("market").agg(
        numbers.round_half_up(ok / n, 4).alias("valid_rate"), ok.alias("n_valid_ean"),
        (ok / n < dims.MIN_EAN_VALID_RATE).alias("is_issue"))
    return ex.join(rates, "market").select("market", "valid_rate", "n_valid_ean", "is_issue",
                                           "example", "ean", "error")


@query("dq_duplicates", f"""
SELECT market, dup_removed, {r('dup_removed * 1.0::DOUBLE / n', 4)} AS rate, dup_kept_rows,
 dup_marked FROM market_profile""")
def dq_duplicates(lake: Lake):
    p = quality.profile(lake.kept)
    return p.select("market", "dup_removed",
                    numbers.round_half_up(quality.rate("dup_removed"), 4).alias("rate"),
                    "dup_kept_rows", "dup_marked")


@query("dq_completeness", f"""
SELECT market, {r('avg_completeness', 1)} AS avg_score, min_completeness AS min_score,
 n_incomplete, avg_completeness < 50 AS is_issue FROM market_profile""")
def dq_completeness(lake: Lake):
    p = quality.profile(lake.kept)
    return p.select("market", numbers.round_half_up(F.col("avg_completeness"), 1)
                    .alias("avg_score"), F.col("min_completeness").alias("min_score"),
                    "n_incomplete",
                    (F.col("avg_completeness") < dims.MIN_COMPLETENESS).alias("is_issue"))


@query("dq_brands", f"""
SELECT market, null_brand AS missing, {r('null_brand * 1.0::DOUBLE / n', 4)} AS missing_rate,
 n_suspicious, null_brand * 1.0 / n > 0.20 AS is_issue FROM market_profile""")
def dq_brands(lake: Lake):
    rate = quality.rate("null_brand")
    return quality.profile(lake.kept).select(
        "market", F.col("null_brand").alias("missing"),
        numbers.round_half_up(rate, 4).alias("missing_rate"), "n_suspicious",
        (rate > dims.MAX_MISSING_BRAND_RATE).alias("is_issue"))


@query("dq_categories", f"""
SELECT market, n_uncategorized, {r('n_uncategorized * 1.0::DOUBLE / n', 4)} AS rate,
 n_uncategorized * 1.0 / n > 0.10 AS is_issue FROM market_profile""")
def dq_categories(lake: Lake):
    rate = quality.rate("n_uncategorized")
    return quality.profile(lake.kept).select(
        "market", "n_uncategorized", numbers.round_half_up(rate, 4).alias("rate"),
        (rate > dims.MAX_UNCATEGORIZED_RATE).alias("is_issue"))


@query("dq_status", "SELECT market, n, checks_passed, failed_checks, quality_score, status "
       "FROM market_judged")
def dq_status(lake: Lake):
    return quality.status(quality.assess(lake.kept))


_TERMS = ["market", "search_term"]
_PCT = "printf('%.1f', {})"


def _advice_sql() -> str:
    rules = []
    for c, limit in dims.NULL_RATE_LIMITS.items():
        if limit == 0:
            advice = f"'Fill or remove records with missing {c} (critical field)'"
        else:
            rate = r(f"{r(f'null_{c} * 1.0::DOUBLE / n', 4)} * 100.0", 1)
            advice = f"'Investigate missing {c} (' || {_PCT.format(rate)} || '% null)'"
        rules.append((f"null_{c} * 1.0 / n > {limit}", advice))
    dup = r(f"{r('dup_removed * 1.0::DOUBLE / n', 4)} * 100.0", 1)
    rules += [
        ("n_price > 0 AND out_of_range > 0",
         "'Review ' || CAST(out_of_range AS VARCHAR) || ' out-of-range prices'"),
        ("n_price > 0 AND n_outlier > 0",
         "'Investigate ' || CAST(n_outlier AS VARCHAR) || ' price outliers'"),
        ("coalesce(n_valid_ean * 1.0 / nullif(n_ean, 0), 0) < 0.80",
         "'Improve EAN quality - many invalid EANs detected'"),
        ("dup_removed > 0",
         f"'Duplicates detected and removed (' || {_PCT.format(dup)} || '%)'"),
        ("n = 0 OR avg_completeness < 50",
         "'Improve data completeness - many records missing key fields'"),
    ]
    union = " UNION ALL ".join(
        f"SELECT market, search_term, {i} AS ord, {advice} AS recommendation "
        f"FROM term_assessed WHERE {rule}" for i, (rule, advice) in enumerate(rules))
    return (f"SELECT market, search_term, row_number() OVER (PARTITION BY market, search_term "
            f"ORDER BY ord) AS position, recommendation FROM ({union})")


@query("dq_recommendations", _advice_sql())
def dq_recommendations(lake: Lake):
    return quality.recommendations(quality.assess(lake.kept, _TERMS), _TERMS)


@query("quality_gate", """
SELECT record_id, k.market, k.search_term FROM kept k JOIN term_judged t
 ON k.market = t.market AND k.search_term = t.search_term WHERE t.status <> 'CRITICAL'""")
def quality_gate(lake: Lake):
    statuses = quality.status(quality.assess(lake.kept, _TERMS), _TERMS)
    return quality.gate(lake.kept, statuses, _TERMS).select("record_id", *_TERMS)
