"""The kept index equals one run over all records, whatever the batches are."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gondola.operators import silver
from gondola.operators.dedup_index import DedupIndex, key_of


def records(spark, n=600, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = ("hot", "1", "Milk") if i % 3 == 0 else (
            rng.choice(["a", "b"]), rng.choice([None, "1", "2", ""]), rng.choice([None, "X", "Y"]))
        rows.append((f"r{i}", *key, rng.random() < 0.5, rng.choice([50.0, 83.3, 100.0]),
                     dt.datetime(2024, 1, rng.randrange(1, 28)),
                     rng.choice([None, 2.5, 3.5, -1.0])))
    return spark.createDataFrame(
        rows, "record_id string, market string, ean_normalized string, "
        "product_name_normalized string, ean_valid boolean, data_completeness double, "
        "collected_at timestamp, price double")


def pairs_of(df):
    return sorted(tuple(r) for r in df.select("record_id", "duplicate_of_id").collect())


def whole(df):
    return pairs_of(silver.mark_losers(df).filter("is_duplicate"))


@pytest.mark.parametrize("cuts", [[1.0], [0.5, 1.0], [0.1, 0.4, 1.0]])
def test_batches_equal_one_run(spark, tmp_path, cuts):
    df = records(spark)
    part = F.pmod(F.xxhash64("record_id"), F.lit(100)) / 100.0
    index = DedupIndex(spark, str(tmp_path / "index"), 4)
    low = 0.0
    for generation, high in enumerate(cuts, 1):
        index.add(df.filter((part >= low) & (part < high)), generation)
        low = high
    assert pairs_of(index.pairs()) == whole(df)
    index.drop()
    assert pairs_of(DedupIndex(spark, str(tmp_path / "index"), 4).pairs()) == whole(df)


def test_a_better_late_record_rewrites_its_key_only(spark, tmp_path):
    df = records(spark)
    index = DedupIndex(spark, str(tmp_path / "index"), 4).add(df, 1)
    keys = index.best().count()
    late = spark.createDataFrame([("late", "hot", "1", "Milk", True, 100.0,
                                   dt.datetime(2025, 1, 1), 1.0)], df.schema)
    worse = spark.createDataFrame([("worse", "a", "1", "X", False, 0.0,
                                    dt.datetime(2001, 1, 1), None)], df.schema)
    index.add(late.unionByName(worse), 2)
    rows = spark.table(index.winners)
    assert rows.count() == keys + 1
    assert [r["best"]["record_id"] for r in rows.filter("generation = 2").collect()] == ["late"]
    both = df.unionByName(late).unionByName(worse)
    assert pairs_of(index.pairs()) == whole(both)
    hot = {kept for record, kept in whole(both) if record in ("r0", "r3")}
    assert hot == {"late"}


def test_a_run_that_failed_half_way_can_be_repeated(spark, tmp_path):
    df = records(spark)
    first, second = df.filter("price < 3"), df.filter("price >= 3 or price is null")
    index = DedupIndex(spark, str(tmp_path / "index"), 4).add(first, 1)
    members = spark.table(index.members).columns  # these were written, the winners were not
    (second.select(key_of().alias("key"), "record_id", F.lit(2).cast("bigint").alias("generation"))
     .select(members).write.mode("append").insertInto(index.members))
    index.add(second, 2).add(second, 2)
    assert pairs_of(index.pairs()) == whole(df)


def test_the_state_is_not_shuffled(spark, tmp_path):
    df = records(spark)
    index = DedupIndex(spark, str(tmp_path / "index"), 4).add(df, 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = index.pairs()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        plan = index.changed(df)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan[plan.index("max_by"):]
        assert plan.count("Exchange") == 2  # the batch: its candidates, and their buckets
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
