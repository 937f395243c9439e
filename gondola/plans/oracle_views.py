"""ANSI SQL views the check queries build on: the layers said a second way, in SQL."""

from __future__ import annotations

from gondola import dims


def r(x: str, digits: int = 2) -> str:
    """Half-up rounding, the same arithmetic as the Spark side."""
    scale = 10 ** digits
    return f"(floor(({x}) * {scale}.0 + 0.5) / {scale}.0)"


def mean(cents: str) -> str:
    """Mean of whole cents with two decimals, in integers."""
    n, s = f"count({cents})", f"sum({cents})"
    return f"(CAST((2 * {s} + {n}) // (2 * {n}) AS DOUBLE) / 100.0)"


def median(cents: str) -> str:
    return f"(floor(CAST(median({cents}) AS DOUBLE) + 0.5) / 100.0)"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def market_name(c: str, title: bool = True) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in dims.MARKET_NAMES.items())
    other = title_case(c) if title else c
    return f"(CASE {c} {whens} ELSE {other} END)"


def title_case(c: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({c}), "
            f"'[a-z]+|[^a-z]+'), lambda x: upper(x[1:1]) || x[2:]), '')")


def norm_name(c: str) -> str:
    plain = f"trim(regexp_replace(strip_accents(lower(trim({c}))), '\\s+', ' ', 'g'))"
    kept = f"regexp_replace({title_case(plain)}, '[^a-zA-Z0-9 \\-()/]', '', 'g')"
    return f"nullif(trim(regexp_replace({kept}, '\\s+', ' ', 'g')), '')"


def norm_brand(c: str) -> str:
    base = (f"regexp_replace(trim(regexp_replace({title_case(f'trim({c})')}, '\\s+', ' ', 'g')),"
            f" '(\\s+(s/a|ltda|inc|ltd|llc)\\.?)+$', '', 'i')")
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in dims.BRAND_ALIASES.items())
    return f"nullif(CASE {base} {whens} ELSE {base} END, '')"


def check_digit(body: str) -> str:
    return (f"((10 - list_sum(list_transform(range(1, 13), lambda i: "
            f"CAST(substr({body}, CAST(i AS INTEGER), 1) AS INTEGER) * "
            f"CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)) % 10) % 10)")


def _values(rows: list[tuple]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


_UNIT = ("nullif(regexp_extract(lower(product_name), "
         f"'{dims.VOLUME_PATTERN}', 2), '')")
_PRESENT = " + ".join(
    f"CASE WHEN {c} IS NOT NULL AND {c} <> {'0' if c == 'price' else chr(39) * 2} "
    "THEN 1 ELSE 0 END" for c in dims.COMPLETENESS_FIELDS)

VIEWS: dict[str, str] = {}

VIEWS["shelf"] = """
 SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
        l_tax, l_shipdate, p_name, p_brand, p_type, p_size,
        replace(lower(r_name), ' ', '_') AS market,
        '789' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS body,
        split_part(p_name, ' ', 2) AS noun
 FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

VIEWS["coded"] = f"""
 SELECT *, CASE WHEN l_partkey % 11 = 0 THEN NULL
                WHEN l_partkey % 13 = 0 THEN substr(body, 5, 8)
                WHEN l_partkey % 7 = 0 THEN body || CAST((chk + 1) % 10 AS VARCHAR)
                ELSE body || CAST(chk AS VARCHAR) END AS ean,
        replace(p_name, ' ', '-') || '-' || CAST(l_partkey AS VARCHAR) AS slug,
        l_extendedprice / l_quantity AS each_price
 FROM (SELECT *, CAST({check_digit('body')} AS INTEGER) AS chk FROM shelf)"""

VIEWS["obs"] = f"""
 SELECT market,
  '  ' || upper(p_name) || '  ' || CAST(p_size AS VARCHAR)
   || CASE l_partkey % 3 WHEN 0 THEN 'ML ' WHEN 1 THEN ' Kg ' ELSE ' un ' END AS product_name,
  CASE WHEN l_linenumber <> 7 THEN {r('each_price')} END AS price,
  {r('each_price * (1.0::DOUBLE - l_discount)')} AS unit_price,
  CASE p_type WHEN 'ECONOMY' THEN CASE l_partkey % 4 WHEN 0 THEN 'Leite e Derivados'
    WHEN 1 THEN 'Leites' WHEN 2 THEN 'Queijos' ELSE 'Bebidas Lácteas' END
   WHEN 'SMALL' THEN 'Refrigerantes'
   WHEN 'MEDIUM' THEN 'Carnes e Aves' WHEN 'LARGE' THEN 'PADARIA'
   WHEN 'STANDARD' THEN 'Brinquedos' END AS category,
  CASE WHEN l_partkey % 5 = 1 THEN upper(p_brand) || ' S/A'
       WHEN l_partkey % 5 <> 0 THEN p_brand END AS brand,
  CAST(l_partkey AS VARCHAR) AS source_product_id,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sku,
  ean, CASE WHEN l_partkey % 4 = 0 AND ean IS NOT NULL THEN ean END AS searched_ean,
  CASE WHEN ean IS NOT NULL THEN 'market_response' END AS ean_source,
  CASE WHEN l_partkey % 4 = 0 AND ean IS NOT NULL THEN ean ELSE noun END AS search_term,
  CASE WHEN market = 'america' THEN '04543010' END AS cep,
  l_shipdate AS collected_at,
  CASE WHEN l_partkey % 17 = 0 THEN 'ftp://' ELSE 'https://' END || market || '.example/p/'
   || slug AS source_url,
  CASE WHEN l_partkey % 10 = 0 THEN '/img/' || slug
       WHEN l_partkey % 9 <> 0 THEN 'https://img.example/' || slug END AS image_url,
  CASE WHEN l_linenumber <> 1
       THEN {r('each_price * (1.0::DOUBLE + l_tax - l_discount)')} END AS wholesale_price,
  concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT),
   CAST(floor(l_extendedprice * 100.0 + 0.5) AS BIGINT), strftime(l_shipdate, '%Y%m%d'))
   AS record_id,
  CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS run_ts,
  strftime(l_shipdate, '%Y%m01') || '_000000_'
   || substr(md5(market || '-' || strftime(l_shipdate, '%Y%m01')), 1, 8) AS bronze_run_id,
  l_partkey, l_linenumber
 FROM coded"""

VIEWS["category_dim"] = (" SELECT * FROM (VALUES " + _values(dims.category_rows())
                         + ") AS d(ord, pattern, standard)")

VIEWS["category_map"] = f"""
 SELECT category AS raw, coalesce(
   (SELECT standard FROM category_dim WHERE pattern = lower(trim(category))),
   (SELECT arg_min(standard, ord) FROM category_dim
    WHERE contains(lower(trim(category)), pattern) OR contains(pattern, lower(trim(category)))),
   '{dims.UNCATEGORIZED}') AS standard
 FROM (SELECT DISTINCT category FROM obs WHERE trim(category) <> '')"""

VIEWS["scored"] = f"""
 SELECT obs.*, {norm_name('product_name')} AS product_name_normalized,
  CASE WHEN price BETWEEN 0.01 AND 100000 THEN {r('price')} END AS price_normalized,
  {_UNIT} AS unit_raw,
  CASE {_UNIT} WHEN 'l' THEN 'L' WHEN 'ml' THEN 'ml' WHEN 'kg' THEN 'kg' WHEN 'g' THEN 'g'
   ELSE CASE WHEN {_UNIT} IS NOT NULL THEN 'un' END END AS unit_normalized,
  coalesce(m.standard, '{dims.UNCATEGORIZED}') AS category_normalized,
  {norm_brand('brand')} AS brand_normalized,
  CASE WHEN length(regexp_replace(ean, '[^0-9]', '', 'g')) IN (8, 12, 13, 14)
       THEN regexp_replace(ean, '[^0-9]', '', 'g') END AS ean_normalized,
  coalesce(CASE WHEN length(ean) = 13
    THEN CAST(substr(ean, 13, 1) AS INTEGER) = {check_digit('ean')}
    ELSE length(ean) IN (8, 12, 14) END, FALSE) AS ean_valid,
  {r(f'({_PRESENT}) * 100.0::DOUBLE / 6.0', 1)} AS data_completeness
 FROM obs LEFT JOIN category_map m ON obs.category = m.raw"""

VIEWS["cleaned"] = f"""
 SELECT *, {r('''data_completeness * 0.4::DOUBLE + CASE WHEN ean_valid THEN 30 ELSE 0 END
   + CASE WHEN price BETWEEN 0.01 AND 100000 THEN 20 ELSE 0 END
   + CASE WHEN brand <> '' THEN 10 ELSE 0 END''', 1)} AS quality_score,
  '[' || concat_ws(', ',
   CASE WHEN NOT ean_valid AND ean IS NOT NULL THEN '"invalid_ean"' END,
   CASE WHEN price < 0.01 OR price > 100000 THEN '"price_outlier"' END,
   CASE WHEN brand IS NULL THEN '"missing_brand"' END,
   CASE WHEN data_completeness < 50 THEN '"low_completeness"' END,
   CASE WHEN category_normalized = 'Uncategorized' THEN '"uncategorized"' END) || ']'
   AS quality_flags,
  CAST(floor(price_normalized * 100.0 + 0.5) AS BIGINT) AS c
 FROM scored"""

VIEWS["ranked"] = """
 SELECT *, row_number() OVER w AS rn,
  count(*) OVER (PARTITION BY market, ean_normalized, product_name_normalized) AS grp,
  first_value(record_id) OVER w AS kept_id
 FROM cleaned
 WINDOW w AS (PARTITION BY market, ean_normalized, product_name_normalized
  ORDER BY ean_valid DESC, data_completeness DESC, collected_at DESC, price ASC NULLS LAST,
           record_id)"""

VIEWS["kept"] = """
 SELECT *, CAST(grp - 1 AS BIGINT) AS duplicate_count, FALSE AS is_duplicate,
        CAST(collected_at AS DATE) AS collected_date
 FROM ranked WHERE rn = 1"""


def _profile(keys: str) -> str:
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
                      for c in dims.NULL_RATE_LIMITS)
    names = ", ".join(f"'{b}'" for b in dims.SUSPICIOUS_BRANDS)
    return f"""
 SELECT {keys}, count(*) AS n, {nulls}, count(price) AS n_price,
  count(*) FILTER (WHERE price < 0.01 OR price > 100000) AS out_of_range,
  count(*) FILTER (WHERE price < 0) AS negative,
  avg(price) AS mean_price, stddev_samp(price) AS std_price, count(ean) AS n_ean,
  count(*) FILTER (WHERE ean IS NOT NULL AND ean_valid) AS n_valid_ean,
  CAST(coalesce(sum(duplicate_count), 0) AS BIGINT) AS dup_removed,
  count(*) FILTER (WHERE duplicate_count > 0) AS dup_kept_rows,
  count(*) FILTER (WHERE is_duplicate) AS dup_marked,
  avg(data_completeness) AS avg_completeness, min(data_completeness) AS min_completeness,
  count(*) FILTER (WHERE data_completeness < 50) AS n_incomplete,
  count(*) FILTER (WHERE lower(brand) IN ({names})) AS n_suspicious,
  count(*) FILTER (WHERE category_normalized = 'Uncategorized') AS n_uncategorized
 FROM kept GROUP BY {keys}"""


def _assessed(keys: list[str], profile: str) -> str:
    on = " AND ".join(f"k.{x} IS NOT DISTINCT FROM p.{x}" for x in keys)
    return f"""
 SELECT p.*, (SELECT count(*) FROM kept k WHERE {on}
              AND k.price > p.mean_price + 3 * p.std_price) AS n_outlier FROM {profile} p"""


def _judged(keys: str, assessed: str) -> str:
    nulls = " OR ".join(f"null_{c} * 1.0 / n > {limit}"
                        for c, limit in dims.NULL_RATE_LIMITS.items())
    fails = {
        "null_rates": nulls,
        "price_validation": "n_price = 0 OR out_of_range > 0 OR n_outlier > 0 OR negative > 0",
        "ean_validation": "coalesce(n_valid_ean * 1.0 / nullif(n_ean, 0), 0) < 0.80",
        "duplicates": "dup_removed > 0 OR dup_marked > 0",
        "completeness": "n = 0 OR avg_completeness < 50",
        "brands": "null_brand * 1.0 / n > 0.20 OR n_suspicious > 0",
        "categories": "n_uncategorized * 1.0 / n > 0.10",
    }
    passed = " + ".join(f"CASE WHEN {f} THEN 0 ELSE 1 END" for f in fails.values())
    failed = ", ".join(f"CASE WHEN {f} THEN '{n}' END" for n, f in fails.items())
    return f"""
 SELECT *, {r('checks_passed * 100.0::DOUBLE / 7.0')} AS quality_score,
  CASE WHEN checks_passed = 7 THEN 'OK' WHEN checks_passed >= 4.9 THEN 'WARNING'
       WHEN checks_passed >= 3.5 THEN 'ALERT' ELSE 'CRITICAL' END AS status
 FROM (SELECT {keys}, n, {passed} AS checks_passed, concat_ws(',', {failed}) AS failed_checks
       FROM {assessed})"""


VIEWS["market_profile"] = _profile("market")
VIEWS["market_assessed"] = _assessed(["market"], "market_profile")
VIEWS["market_judged"] = _judged("market", "market_assessed")
VIEWS["term_profile"] = _profile("market, search_term")
VIEWS["term_assessed"] = _assessed(["market", "search_term"], "term_profile")
VIEWS["term_judged"] = _judged("market, search_term", "term_assessed")
VIEWS["run_profile"] = _profile("market, bronze_run_id, run_ts")
VIEWS["run_assessed"] = _assessed(["market", "bronze_run_id", "run_ts"], "run_profile")
VIEWS["run_judged"] = _judged("market, bronze_run_id, run_ts", "run_assessed")

# --- Gold ---------------------------------------------------------------------------
VIEWS["last_day"] = " SELECT max(collected_date) AS d FROM kept"

VIEWS["daily_all"] = f"""
 SELECT CAST(collected_date AS VARCHAR) AS kpi_date, market,
  {market_name('market')} AS market_name, count(*) AS total_products, {mean('c')} AS avg_price,
  {median('c')} AS median_price, {r('coalesce(stddev_samp(price_normalized), 0)')}
  AS price_std_dev, min(price_normalized) AS price_min, max(price_normalized) AS price_max,
  CASE WHEN median(price_normalized) > 0 AND coalesce(stddev_samp(price_normalized), 0) > 0
   THEN {r('stddev_samp(price_normalized) / median(price_normalized) * 100')} ELSE 0.0::DOUBLE
   END AS price_volatility_index,
  {r('count(c) * 100.0::DOUBLE / count(*)')} AS data_completeness,
  CAST(0 AS BIGINT) AS new_products_count,
  count(*) FILTER (WHERE contains(quality_flags, 'PRICE_CHANGE')) AS price_change_count,
  CAST(0 AS DOUBLE) AS avg_price_change_pct
 FROM kept GROUP BY collected_date, market HAVING count(c) > 0"""

VIEWS["newest_per_market"] = """
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ean, market
   ORDER BY collected_at DESC, record_id) AS pos FROM kept WHERE ean IS NOT NULL) WHERE pos = 1"""

VIEWS["product_table"] = f"""
 SELECT ean AS product_id, ean,
  (list(product_name_normalized ORDER BY collected_at, market, record_id))[1] AS product_name,
  (list(category_normalized ORDER BY collected_at, market, record_id))[1] AS category,
  (list(brand_normalized ORDER BY collected_at, market, record_id))[1] AS brand,
  (list(unit_normalized ORDER BY collected_at, market, record_id))[1] AS volume,
  count(*) AS markets_selling,
  (list({market_name('market', False)} ORDER BY c, collected_at, market, record_id)
   FILTER (WHERE c IS NOT NULL))[1] AS cheapest_market,
  min(price_normalized) AS cheapest_price,
  (list({market_name('market', False)} ORDER BY c DESC, collected_at, market, record_id)
   FILTER (WHERE c IS NOT NULL))[1] AS most_expensive_market,
  max(price_normalized) AS most_expensive_price,
  CAST(max(c) - min(c) AS DOUBLE) / 100.0 AS price_spread,
  {r('(max(c) - min(c)) * 100.0::DOUBLE / min(c)')} AS price_spread_pct,
  {mean('c')} AS avg_price_across_markets,
  {text('max(collected_at)')} AS last_collected,
  date_diff('day', max(collected_at), (SELECT max(collected_at) FROM kept))
   AS days_since_update,
  CASE WHEN count(c) > 1 AND max(c) > min(c) THEN {r('''greatest(0.0::DOUBLE, 100.0::DOUBLE -
   greatest(CAST(count(c) AS DOUBLE) * CAST(sum(c * c) AS DOUBLE)
            - CAST(sum(c) AS DOUBLE) * CAST(sum(c) AS DOUBLE), 0.0::DOUBLE)
   / (CAST(count(c) AS DOUBLE) * (CAST(count(c) AS DOUBLE) - 1)) / 10000.0 * 10.0)''', 1)}
   ELSE 100.0::DOUBLE END AS price_competitiveness_score
 FROM newest_per_market GROUP BY ean HAVING count(c) > 0"""

VIEWS["category_table"] = f"""
 SELECT market || '_' || category_normalized AS category_id, market,
  {market_name('market')} AS market_name, category_normalized AS category,
  count(DISTINCT ean) AS product_count, {mean('c')} AS avg_price,
  {median('c')} AS median_price, min(price_normalized) AS price_range_min,
  max(price_normalized) AS price_range_max,
  {r('''greatest(0.0::DOUBLE, 100 - coalesce(stddev_samp(price_normalized)
     / median(price_normalized) * 100, 100))''', 1)} AS price_competitiveness,
  {text('max(collected_at)')} AS last_updated
 FROM kept GROUP BY market, category_normalized HAVING count(c) > 0"""

VIEWS["day_rows"] = """
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY market, ean
   ORDER BY collected_at DESC, record_id) AS pos
  FROM kept WHERE ean IS NOT NULL AND collected_date = (SELECT d FROM last_day)) WHERE pos = 1"""

VIEWS["cheap"] = """
 SELECT category_normalized, ean AS cheapest_ean, price_normalized AS cheapest_price
 FROM (SELECT *, row_number() OVER (PARTITION BY category_normalized
   ORDER BY price_normalized, collected_at, market, record_id) AS best
  FROM day_rows WHERE price_normalized IS NOT NULL) WHERE best = 1"""

VIEWS["snapshot"] = f"""
 SELECT market || '_' || ean AS product_id, market, ean,
  product_name_normalized AS product_name, d.category_normalized AS category,
  brand_normalized AS brand, price_normalized AS current_price,
  CAST(NULL AS DOUBLE) AS previous_price, CAST(0 AS DOUBLE) AS price_change_pct,
  CASE WHEN ean = cheapest_ean THEN 1 ELSE 0 END AS is_cheapest, unit_normalized AS volume,
  {text('collected_at')} AS collected_at, CAST(collected_date AS VARCHAR) AS collection_date,
  {market_name('market')} AS market_name, quality_score AS data_quality_score
 FROM day_rows d LEFT JOIN cheap USING (category_normalized)"""

VIEWS["price_table"] = f"""
 SELECT md5(record_id) || '_' || market || CASE WHEN ean IS NULL THEN '' ELSE '_' || ean END
   AS price_id, market, ean, product_name_normalized AS product_name, price_normalized AS price,
  {r('unit_price')} AS unit_price, CAST(collected_date AS VARCHAR) AS price_date,
  {text('collected_at')} AS collection_timestamp, category_normalized AS category,
  CASE WHEN price_normalized < 10 THEN 'Budget' WHEN price_normalized < 50 THEN 'Standard'
   ELSE 'Premium' END AS price_tier, unit_normalized AS volume, collected_date
 FROM kept WHERE price_normalized IS NOT NULL"""

VIEWS["catalog_latest"] = """
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_name_normalized,
  category_normalized, brand_normalized, ean, market ORDER BY collected_at DESC, record_id)
  AS pos FROM kept WHERE ean IS NOT NULL) WHERE pos = 1"""

VIEWS["closing"] = """
 SELECT market, ean, collected_date AS price_date, price_normalized AS price
 FROM (SELECT *, CAST(collected_at AS DATE) AS collected_date, row_number() OVER (
   PARTITION BY market, ean, CAST(collected_at AS DATE) ORDER BY collected_at DESC, record_id)
   AS pos FROM cleaned WHERE ean IS NOT NULL AND price_normalized IS NOT NULL)
 WHERE pos = 1"""

VIEWS["moves"] = f"""
 SELECT market, ean, price_date, price, prev AS previous_price,
  sign((price - prev) * 100.0 / prev) * {r('abs((price - prev) * 100.0 / prev)')}
   AS price_change_pct
 FROM (SELECT *, lag(price) OVER (PARTITION BY market, ean ORDER BY price_date) AS prev
       FROM closing)"""
