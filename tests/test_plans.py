"""Pipeline, pruning, plans, and every registered query against its SQL."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from gondola.operators import gold, ordered
from gondola.plans import pipeline
from gondola.sources import adapter, writers
from tools.check import TABLES, rows

os.environ.setdefault("PYTHONHASHSEED", "0")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    df = contract.queries()[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, cur.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_filters_prune(lake):
    p = plan_of(lake.bronze.filter("market = 'asia' AND year = '1998'").select("price"))
    assert "PartitionFilters: [isnotnull(market" in p and "PushedFilters: []" in p
    assert "product_name" not in p.split("ReadSchema")[1]


def test_date_filter_is_pushed(lake):
    p = plan_of(gold.on_date(lake.kept, "1998-01-05").select("market"))
    assert "GreaterThanOrEqual(collected_at" in p and "LessThan(collected_" in p


def test_top1_is_limited_before_the_shuffle(spark, sf_dir):
    p = plan_of(contract.queries()["silver_rank_dedup_sql"](spark, sf_dir))
    assert p.count("WindowGroupLimit") == 2


def test_no_query_uses_a_python_worker_or_cartesian(spark, sf_dir):
    for name in ("silver_normalize", "dedup_best_record", "flatten_html", "flatten_graphql",
                 "gold_product_metrics", "dedup_fuzzy_level3", "seed_cross_markets"):
        p = plan_of(contract.queries()[name](spark, sf_dir))
        assert "Python" not in p and "CartesianProduct" not in p, name


def test_pipeline_end_to_end(spark, sf_dir, tmp_path):
    records = adapter.observations(spark, sf_dir).withColumn(
        "collected_at", F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    out = pipeline.run(spark, records, str(tmp_path), gated=False)
    assert [r.status for r in (out["bronze"], out["gold"])] == ["SUCCESS", "SUCCESS"]
    n = records.count()
    assert out["bronze"].records_output == n == out["silver"].records_input
    assert out["silver"].records_output + out["silver"].records_deduplicated == n
    assert set(out["gold"].files_created) == set(pipeline.GOLD_TABLES)
    assert os.path.exists(f"{tmp_path}/bronze/data/_SUCCESS")
    docs = writers.read_audit(spark, f"{tmp_path}/bronze/audit")
    assert docs.agg(F.sum("records.input")).first()[0] == n
    prices = spark.read.parquet(out["gold"].files_created["market_prices"])
    assert prices.filter("price_month IS NULL").isEmpty()


def test_gate_keeps_critical_batches_out(spark, sf_dir, tmp_path):
    records = adapter.observations(spark, sf_dir)
    out = pipeline.run(spark, records, str(tmp_path), gated=True)
    docs = writers.read_audit(spark, f"{tmp_path}/gold/audit")
    assert 0 < docs.agg(F.sum("records.input")).first()[0] < out["silver"].records_output
    for layer in ("bronze", "silver", "gold"):
        docs = writers.read_audit(spark, f"{tmp_path}/{layer}/audit")
        n, seconds = docs.agg(F.count("*"), F.min("execution.duration_seconds")).first()
        assert n > 0 and seconds > 0 and docs.filter(F.col("layer") != layer).isEmpty()


def test_empty_and_faulty_batches(spark, sf_dir, tmp_path):
    records = adapter.observations(spark, sf_dir)
    assert pipeline.land_bronze(records.limit(0), str(tmp_path)).status == "FAILED"
    assert not os.path.exists(f"{tmp_path}/data")
    broken = records.orderBy("record_id").limit(20).withColumn(
        "product_name", F.when(F.col("sku") > "5", F.col("product_name")))
    res = pipeline.land_bronze(broken, str(tmp_path), now=dt.datetime(2025, 1, 2))
    bad = broken.filter("product_name IS NULL").count()
    assert res.records_output == 20 and (res.status == "PARTIAL") == (bad > 0)
    again = writers.read_bronze(spark, f"{tmp_path}/data")
    assert again.filter("bronze_error_flag").count() == bad
    assert again.filter("year = '2025' AND day = '02'").count() == 20


def test_missing_silver_columns_are_named(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "s"))
    with pytest.raises(ValueError, match="price_normalized"):
        writers.read_silver(spark, [str(tmp_path / "s")])


def test_hot_key_plan_has_no_single_task_window(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    out = ordered.neighbours(df, ["k"], ["t"], {"p": "t"})
    assert "_slice" in plan_of(out)
    assert out.filter("p = t - 1 OR (t = 0 AND p IS NULL)").count() == 1000
