"""Operators against brute force on small fixtures, and invariants."""

import datetime as dt
import itertools
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gondola import schemas
from gondola.operators import audit, bronze, gold, history, ordered, profile, quality, silver
from gondola.operators import seeds
from gondola.sources import payloads, writers


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def walk(spark):
    """One key holds most of the rows."""
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 60 + [f"k{i % 9}" for i in range(140)]
    data = [(k, rng.randrange(50), i, round(rng.uniform(1, 9), 2)) for i, k in enumerate(keys)]
    return data, spark.createDataFrame(data, "k STRING, t INT, i INT, v DOUBLE")


def test_neighbours_in_slices_equal_plain_window(walk):
    data, df = walk
    want = []
    for _, grp in itertools.groupby(sorted(data, key=lambda r: (r[0] or "", r[1], r[2])),
                                    key=lambda r: r[0]):
        grp = list(grp)
        for n, r in enumerate(grp):
            want.append((r[2], grp[n - 1][3] if n else None,
                         grp[n + 1][3] if n + 1 < len(grp) else None))
    out = ordered.neighbours(df, ["k"], ["t", "i"], {"b": "v"}, {"a": "v"})
    assert rows_of(out, "i", "b", "a") == sorted(want, key=repr)


def test_price_stats_are_exact(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc"), rng.choice([None, round(rng.uniform(0.01, 99), 2)]))
            for _ in range(500)] + [("lonely", 5.0), ("empty", None)]
    df = spark.createDataFrame(data, "k STRING, price_normalized DOUBLE")
    for r in ordered.price_stats(df, ["k"]).collect():
        all_rows = [v for k, v in data if k == r["k"]]
        v = [x for x in all_rows if x is not None]
        assert (r["n_rows"], r["n_prices"]) == (len(all_rows), len(v))
        if not v:
            assert r["mean"] is None and r["median"] is None
            continue
        assert r["median"] == pytest.approx(statistics.median(v), abs=1e-9)
        assert r["mean"] == pytest.approx(statistics.mean(v), abs=0.00501)
        if len(v) > 1:
            assert r["stddev"] == pytest.approx(statistics.stdev(v), rel=1e-9)
        else:
            assert r["stddev"] is None


def test_dedup_invariants(lake):
    s, k = lake.silver, silver.deduplicate(lake.silver)
    n = s.count()
    got = k.agg(F.count("*"), F.sum("duplicate_count")).first()
    assert got[0] + got[1] == n
    assert k.groupBy(*silver.DEDUP_KEYS).count().filter("count > 1").isEmpty()
    marked = silver.mark_losers(s)
    assert marked.count() == n
    assert marked.filter("is_duplicate").count() == got[1]
    kept_ids = k.select("record_id")
    assert marked.filter("NOT is_duplicate").select("record_id").exceptAll(kept_ids).isEmpty()


def test_dedup_prefers_valid_full_new_cheap(spark):
    base = dict(market="m", product_name="Leite 1L", category="leite", brand="b",
                source_product_id="1", sku="s", searched_ean=None, ean_source=None,
                search_term="t", cep=None, source_url=None, image_url=None, unit_price=1.0,
                wholesale_price=None, ean="7891000100103")
    t = dt.datetime(2025, 1, 1)
    data = [dict(base, record_id="a", price=2.0, collected_at=t),
            dict(base, record_id="b", price=None, collected_at=t + dt.timedelta(1)),
            dict(base, record_id="c", price=3.0, collected_at=t + dt.timedelta(1)),
            dict(base, record_id="d", price=2.5, collected_at=t + dt.timedelta(1)),
            dict(base, record_id="n1", ean=None, price=1.0, collected_at=t),
            dict(base, record_id="n2", ean=None, price=0.5, collected_at=t)]
    schema = schemas.RECORD.simpleString()[7:-1].replace("collected_at:string",
                                                         "collected_at:timestamp_ntz")
    df = spark.createDataFrame([[d.get(c) for c in [*schemas.BRONZE_FIELDS, "record_id"]]
                                for d in data], f"struct<{schema},record_id:string>")
    kept = silver.deduplicate(silver.normalize(df))
    assert rows_of(kept, "record_id", "duplicate_count") == [("d", 3), ("n2", 1)]


def test_batch_hash_ignores_order_and_partitions(lake):
    h = bronze.batch_hash(audit.BUSINESS_COLUMNS)
    a = lake.obs.agg(h).first()[0]
    b = lake.obs.repartition(13).orderBy("sku").agg(h).first()[0]
    doubled = lake.obs.union(lake.obs.limit(1)).agg(h).first()[0]
    assert a == b and a != doubled


def test_bronze_violations(spark):
    df = spark.createDataFrame([("1", "n", None, "1,5", None), ("2", None, "t", "abc", None),
                                ("3", "n", "t", None, None)],
                               "record_id STRING, product_name STRING, search_term STRING, "
                               "price STRING, unit_price STRING")
    v = bronze.violations(df, ["product_name", "search_term"], ["price"])
    assert rows_of(v, "record_id", "field", "rule") == [
        ("1", "search_term", "missing_required"), ("2", "price", "not_a_number"),
        ("2", "product_name", "missing_required")]
    assert rows_of(bronze.coerce_types(df), "record_id", "price") == [
        ("1", 1.5), ("2", None), ("3", None)]
    assert rows_of(bronze.null_rates(df, ["product_name", "unit_price", "record_id"]),
                   "column_name", "null_rate") == [("product_name", 0.3333), ("unit_price", 1.0)]


def test_quality_status_rules(spark):
    rows = [("ok", "n", 5.0, "7891000100103", "b", "Carnes", "carnes", 0, 100.0, True)] * 3 + \
        [("bad", None, -1.0, "7894001234567", None, "Uncategorized", None, 2, 33.3, False)] * 2
    df = spark.createDataFrame(rows, "market STRING, product_name STRING, price DOUBLE, "
                               "ean STRING, brand STRING, category_normalized STRING, "
                               "category STRING, duplicate_count BIGINT, "
                               "data_completeness DOUBLE, ean_valid BOOLEAN")
    df = df.withColumns({"is_duplicate": F.lit(False)})
    checked = quality.assess(df)
    got = {r["market"]: (r["checks_passed"], r["status"]) for r in
           quality.status(checked).collect()}
    assert got == {"ok": (7, "OK"), "bad": (0, "CRITICAL")}
    advice = [r["recommendation"] for r in quality.recommendations(checked)
              .orderBy("position").collect()]
    assert advice[0] == "Fill or remove records with missing product_name (critical field)"
    assert "Duplicates detected and removed (200.0%)" in advice
    assert quality.gate(df, quality.status(checked)).select("market").distinct().collect() == \
        [("ok",)]
    status = quality.status_of(F.col("p"))
    bands = spark.range(8).select(F.col("id").alias("p")).select("p", status.alias("s"))
    assert [r["s"] for r in bands.orderBy("p").collect()] == \
        ["CRITICAL"] * 4 + ["ALERT", "WARNING", "WARNING", "OK"]


def test_fuzzy_pairs_brute_force(spark):
    rng = random.Random(11)
    data = [(f"r{i:03}", "m", rng.choice("xy"), f"e{i:03}", round(rng.uniform(1, 40), 2))
            for i in range(120)]
    df = spark.createDataFrame(data, "record_id STRING, market STRING, "
                               "product_name_normalized STRING, ean_normalized STRING, "
                               "price_normalized DOUBLE")

    def cents(p):
        return round(p * 100)
    want = [(a[0], any(a[2] == b[2] and a[3] != b[3] and abs(cents(a[4]) - cents(b[4]))
                       <= 0.05 * min(cents(a[4]), cents(b[4])) for b in data)) for a in data]
    got = history.fuzzy_duplicates(df)
    assert rows_of(got, "record_id", "is_fuzzy_duplicate") == sorted(want, key=repr)


def test_price_history_in_slices(lake):
    code = lake.silver.filter("ean IS NOT NULL").groupBy("ean").count().orderBy(
        F.desc("count"), "ean").first()[0]
    cols = ("record_id", "price", "prev_price", "price_change_pct")
    got = {r[0]: r for r in rows_of(gold.price_history(lake.silver, code), *cols)}
    rows = (lake.silver.filter((F.col("ean") == code) & F.col("price_normalized").isNotNull())
            .select("market", "collected_at", "record_id", "price_normalized").collect())
    rows.sort(key=lambda r: tuple(r)[:3])
    for before, row in zip([None, *rows], rows):
        prev = before[3] if before and before[0] == row[0] else None
        assert got[row[2]][1:3] == (row[3], prev)


def test_equal_scores_fall_in_one_bin(spark):
    df = spark.createDataFrame([(7.5,)] * 3, "quality_score double")
    assert [tuple(r) for r in profile.score_histogram(df).collect()] == [(1, 3, 7.5, 7.5)]
    assert profile.score_histogram(df.limit(0)).collect() == []


def test_describe_keeps_raw_limits(spark):
    df = spark.createDataFrame([(1.991,), (1.994,)], "price double")
    row = profile.describe(df, [], "price", {}).first()
    assert (row["min"], row["max"]) == (1.991, 1.994)


def test_variance_and_mean_survive_large_and_negative_sums(spark):
    n, low, high = 1_000_000, 9_999_900, 9_999_901
    squares = [Decimal(n // 2 * (low ** 2 + high ** 2)), Decimal(2 * 100 ** 2 + 101 ** 2)]
    df = spark.createDataFrame([(n, n // 2 * (low + high), squares[0]), (3, -301, squares[1])],
                               "n bigint, s bigint, q decimal(38,0)")
    from gondola.functions import numbers
    got = df.select(numbers.stddev_of_cents(*map(F.col, "nsq")),
                    numbers.mean_of_cents(F.col("s"), F.col("n"))).collect()
    assert abs(got[0][0] - 0.005 * (n / (n - 1)) ** 0.5) < 1e-12
    assert [r[1] for r in got] == [99999.01, -1.0]


def test_gold_invariants(lake):
    p = gold.product_metrics(lake.kept)
    assert p.filter("price_spread < 0 OR cheapest_price > most_expensive_price").isEmpty()
    assert p.filter("price_competitiveness_score NOT BETWEEN 0 AND 100").isEmpty()
    share = gold.market_share(lake.kept).groupBy("category").agg(F.sum("market_share_pct"))
    assert all(abs(r[1] - 100) < 0.1 for r in share.collect())


def test_single_observation_scores(spark):
    t = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([("m", "e", 5.0, "N", "Carnes", "b", "L", t, "r", "[]", 90.0)],
                               "market STRING, ean STRING, price_normalized DOUBLE, "
                               "product_name_normalized STRING, category_normalized STRING, "
                               "brand_normalized STRING, unit_normalized STRING, "
                               "collected_at TIMESTAMP_NTZ, record_id STRING, "
                               "quality_flags STRING, quality_score DOUBLE")
    assert gold.product_metrics(df).first()["price_competitiveness_score"] == 100.0
    assert gold.category_metrics(df).first()["price_competitiveness"] == 0.0
    kpi = gold.daily_kpis(df).first()
    assert (kpi["price_std_dev"], kpi["price_volatility_index"], kpi["total_products"]) == \
        (0.0, 0.0, 1)
    no_price = df.withColumn("price_normalized", F.lit(None).cast("double"))
    assert gold.product_metrics(no_price).isEmpty() and gold.daily_kpis(no_price).isEmpty()
    assert gold.products_snapshot(no_price).first()["is_cheapest"] == 0


def test_impute_labels(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None)],
                               "market STRING, price_normalized DOUBLE")
    got = profile.impute_median(df)
    assert rows_of(got, "market", "price_filled", "price_quality") == sorted([
        ("a", 1.0, "valid"), ("a", 3.0, "valid"), ("a", 2.0, "imputed"),
        ("b", None, "missing")], key=repr)


def test_payload_edge_cases(spark):
    docs = ['{"data":{"search":{"products":{"edges":[{"node":null},{"node":{"id":"1","name":"n",'
            '"offers":{"highPrice":5.5,"lowPrice":"x"},"image":[]}}]}}}}',
            '{"data":{"search":{"products":{}}}}', '{}', 'not json']
    df = spark.createDataFrame([("leite", None, "2025-01-01T00:00:00Z", d) for d in docs],
                               "search_term STRING, cep STRING, collected_at STRING, "
                               "raw_payload STRING")
    got = payloads.flatten_graphql(df)
    assert got.columns == schemas.BRONZE_FIELDS
    assert rows_of(got, "source_product_id", "price", "wholesale_price", "ean", "image_url") == \
        sorted([(None, None, None, "leite", None), ("1", 5.5, None, "leite", None)], key=repr)
    hits = df.withColumn("raw_payload", F.lit('{"hits":[{"objectID":"9","sale_price":3,'
                                              '"barcode":"789"}]}')).limit(1)
    assert rows_of(payloads.flatten_search_hits(hits), "source_product_id", "price", "ean",
                   "ean_source") == [("9", 3.0, "789", "market_response")]


def test_seeds(spark):
    df = spark.createDataFrame([(" 123 ",), ("123",), ("",), (None,), ("4",)], "ean STRING")
    assert rows_of(seeds.trimmed_distinct(df), "ean") == [("123",), ("4",)]
    assert seeds.search_configs(df).count() == 6
    assert rows_of(seeds.default_searches(spark), "market", "cep")[0] == ("atacadao", "04543010")


def test_csv_with_mark_and_quotes(spark, tmp_path):
    path = tmp_path / "legacy.csv"
    path.write_text('﻿ean,descricao,marca,preco_unitario,preco_atacado,rede\n'
                    '71724960,"Leite em Pó 41,5g",Ninho,16.63,16.63,Rede\n'
                    '9,"Say ""hi""",,1,,R\n', encoding="utf-8")
    got = writers.read_legacy(spark, str(path))
    assert rows_of(got, "ean", "descricao", "preco_atacado") == [
        ("71724960", "Leite em Pó 41,5g", 16.63), ("9", 'Say "hi"', None)]


def test_html_pages_are_whole(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>\n1</p>\n")
    assert writers.read_pages(spark, str(tmp_path)).first()["html"] == "<p>\n1</p>\n"


def test_failed_build_keeps_the_old_gold_table(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for date in (None, "day_date"):
        good = spark.createDataFrame([("a", "2024-01-05")], "k string, day_date string")
        writers.write_table(good, path, date)
        broken = good.withColumn("k", F.raise_error(F.lit("broken build")))
        with pytest.raises(Exception, match="broken build"):
            writers.write_table(broken, path, date)
        assert spark.read.parquet(path).select("k").collect() == [("a",)]


def test_health_counts_stored_bytes(spark, lake):
    from gondola.plans.q_cookbook import _health
    size = history.stored_bytes(spark, lake.kept_path()).first()["bytes"]
    row = _health(lake).filter("check_name = 'disk_usage'").first()
    assert size > 0 and row["value"] == size / 1024.0 ** 3 and row["status"] == "OK"


def test_price_islands_cross_slices_of_a_hot_group(spark):
    rng = random.Random(11)
    rows = [(f"r{i:04}", "hot" if i % 3 else rng.choice(["a", "b", None]), "Milk", f"e{i}",
             round(rng.choice([1.0, 50.0]) * 1.002 ** rng.randrange(400)
                   * rng.choice([1, 1, 1, 1.3]), 2)) for i in range(700)]
    df = spark.createDataFrame(
        rows, "record_id string, market string, product_name_normalized string, "
        "ean_normalized string, price_normalized double").repartition(6)
    got = {r["record_id"]: r for r in history.fuzzy_duplicates(df).collect()}
    want, groups = {}, {}
    for rid, market, _, ean, price in rows:
        groups.setdefault(market, []).append((round(price * 100), rid, ean))
    for members in groups.values():
        members.sort()
        number, first = 0, None
        for i, (c, rid, _) in enumerate(members):
            below = i > 0 and c - members[i - 1][0] <= 0.05 * members[i - 1][0]
            above = i + 1 < len(members) and members[i + 1][0] - c <= 0.05 * c
            if not below:
                number, first = number + 1, rid
            want[rid] = (members[i - 1][2] if below else None,
                         members[i + 1][2] if above else None, number, first, below or above)
    assert {k: (r["lower_partner"], r["upper_partner"], r["group_no"], r["representative"],
                r["is_fuzzy_duplicate"]) for k, r in got.items()} == want
    assert max(w[2] for w in want.values()) > 3  # several islands, some over many slices


def test_storage_report_equals_the_folders(spark, lake):
    import os
    from urllib.parse import unquote
    want = {}
    for base, _, names in os.walk(lake.bronze_path()):
        parts = dict(p.split("=", 1) for p in unquote(base).split("/") if "=" in p)
        for name in names:
            if name.endswith(".parquet"):
                key = tuple(parts[c] for c in ("market", "year", "month", "day"))
                files, size = want.get(key, (0, 0))
                want[key] = files + 1, size + os.path.getsize(f"{base}/{name}")
    got = {tuple(r[:4]): (r["files"], r["bytes"])
           for r in history.storage_report(spark, lake.bronze_path()).collect()}
    assert got == want and want


def test_batch_identity_tells_null_from_empty_and_shifted_values(spark):
    rows = {"null": (None, "ab", 1.5), "empty": ("", "ab", 1.5), "shift": ("a", "b", 1.5),
            "shift2": ("ab", "", 1.5), "price": ("a", "b", 1.500001), "nan": ("a", "b", float("nan"))}
    df = spark.createDataFrame([(k, *v) for k, v in rows.items()],
                               "k string, product_name string, brand string, price double")
    ids = {r["k"]: r["h"] for r in df.groupBy("k").agg(
        bronze.batch_hash(["product_name", "brand", "price"]).alias("h")).collect()}
    assert len(set(ids.values())) == len(rows)
