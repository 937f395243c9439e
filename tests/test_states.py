"""Rank selection over value slices, and month states against whole recomputation."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.operators import ordered, states

DAY = dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)


def quart(values):
    return [float(q) for q in np.quantile(np.array(values, float), [.25, .5, .75])]


@pytest.mark.parametrize("bits", [(40, 20), (6,), (9, 6, 3), (60, 40, 20, 2)])
def test_quartiles_by_slices_of_any_width(spark, bits):
    rng = random.Random(5)
    rows = [("hot", rng.randrange(-200, 2000)) for _ in range(900)]
    rows += [("wide", rng.randrange(-2 ** 50, 2 ** 50)) for _ in range(101)]
    rows += [(None, 7), (None, 9), ("one", 3), ("none", None)] + [("tie", 5)] * 40
    hist = (spark.createDataFrame(rows, "k string, c bigint").groupBy("k", "c")
            .agg(F.count(F.lit(1)).alias("n")))
    ranked = ordered.ranked_slices(hist, ["k"], "c", "n", bits)
    got = {r["k"]: [r["q25"], r["median"], r["q75"]] for r in ranked.groupBy("k").agg(
        *[c.alias(n) for n, c in ordered.quartiles("c", "n").items()]).collect()}
    for k in ("hot", "wide", None, "one", "tie"):
        assert got[k] == pytest.approx(quart([c for key, c in rows if key == k and c is not None]))
    assert got["none"] == [None] * 3
    everything = [c for _, c in rows if c is not None]
    whole = ordered.ranked_slices(hist.groupBy("c").agg(F.sum("n").alias("n")), [], "c", "n", bits)
    row = whole.agg(*[c.alias(n) for n, c in ordered.quartiles("c", "n").items()]).first()
    assert list(row) == pytest.approx(quart(everything))


def test_a_million_prices_of_one_market_stay_in_slices(spark):
    """No percentile, no window over a group: each holds at most one slice."""
    prices = spark.range(1_000_000).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("market"),
        ((F.col("id") * 7919 % 999_983) * 1_000 / 100).alias("price"))
    stats = ordered.price_stats(prices, ["market"], "price")
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect_list" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and sum("_slice20" in line for line in windows) >= 2
    want = prices.groupBy("market").agg(F.expr("percentile(price, 0.5)").alias("m")).collect()
    got = {r["market"]: r["median"] for r in stats.collect()}
    assert {r["market"]: pytest.approx(r["m"], abs=1e-6) for r in want} == got


def records(spark, months, seed=1, per=300):
    rng = random.Random(seed)
    rows = []
    for month in months:
        for i in range(per):
            at = dt.datetime(2023 + month // 12, month % 12 + 1, rng.randrange(1, 28),
                             tzinfo=dt.timezone.utc)
            rows.append((f"{month}-{seed}-{i}", rng.choice(["a", "a", "b"]),
                         rng.choice([None, round(rng.uniform(1, 90), 2)]), at,
                         rng.choice([None, str(rng.randrange(400))]),
                         f"Name {rng.randrange(20)}", "Padaria", None))
    return spark.createDataFrame(
        rows, "record_id string, market string, price_normalized double, collected_at timestamp, "
        "ean string, product_name_normalized string, category_normalized string, "
        "brand_normalized string")


def files_of(spark, path):
    return {r["path"]: r["modificationTime"] for r in spark.read.format("binaryFile")
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
            .select("path", "modificationTime").collect()}


def test_a_late_month_touches_its_own_folder_only(spark, tmp_path):
    first, late = records(spark, range(14)), records(spark, [14], seed=2)
    again = records(spark, [3], seed=3)  # a corrected month replaces the old one
    path = str(tmp_path / "states")
    states.refresh(states.market_states(first), path)
    before = files_of(spark, path)
    states.refresh(states.market_states(late.unionByName(again)), path)
    after = files_of(spark, path)
    same = {p: t for p, t in before.items() if "month=2023-04" not in p}
    assert same.items() <= after.items() and len(after) == len(before) + 1
    assert not any(p in after for p in before if "month=2023-04" in p)

    whole = (first.filter(states.month_of(F.col("collected_at")) != "2023-04")
             .unionByName(again).unionByName(late))
    got = states.market_rollup(states.read_states(spark, path))
    want = states.market_rollup(states.market_states(whole))
    cols = ["market", "year", "month", "records", "priced", "price_sum", "min_price", "max_price"]
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty()
    assert got.count() == want.count() == 2 * (15 + 2 + 1)

    exact = {(r["market"], r["year"], r["month"]): r for r in whole.withColumns(
        {"m": states.month_of(F.col("collected_at"))}).withColumns(
        {"year": F.substring("m", 1, 4), "month": F.substring("m", 6, 2)}).groupingSets(
        [[F.col("market"), F.col("year"), F.col("month")], [F.col("market"), F.col("year")],
         [F.col("market")]], "market", "year", "month").agg(
        F.count_distinct("ean").alias("codes"),
        F.collect_list("price_normalized").alias("prices")).collect()}
    for r in states.distinct_codes(got).collect():
        n = exact[r["market"], r["year"], r["month"]]["codes"]
        assert abs(r["codes"] - n) <= 0.06 * n + 1
    for r in states.medians(got).collect():
        v = sorted(exact[r["market"], r["year"], r["month"]]["prices"])
        below = sum(x < r["median_price"] for x in v) / len(v)
        upto = sum(x <= r["median_price"] for x in v) / len(v)
        slack = 2 * r["rank_bound"] + 1 / len(v)
        assert below - slack <= 0.5 <= upto + slack


def test_states_of_months_without_prices_or_codes(spark, tmp_path):
    bare = records(spark, [0, 1]).withColumns({"price_normalized": F.lit(None).cast("double"),
                                               "ean": F.lit(None).cast("string")})
    path = states.refresh(states.market_states(bare), str(tmp_path / "s"))
    rollup = states.market_rollup(states.read_states(spark, path))
    assert {r["median_price"] for r in states.medians(rollup).collect()} == {None}
    assert {r["codes"] for r in states.distinct_codes(rollup).collect()} == {0}
    assert states.market_states(bare.limit(0)).count() == 0


def test_catalogue_merged_from_months(spark, tmp_path):
    df = records(spark, range(6))
    path = states.refresh(states.catalog_states(df), str(tmp_path / "c"))
    got = {r["ean"] + r["product_name"]: r for r in
           states.catalog_rollup(states.read_states(spark, path)).collect()}
    rows = [r for r in df.collect() if r["ean"] is not None]
    groups = {}
    for r in rows:
        groups.setdefault(r["ean"] + r["product_name_normalized"], []).append(r)
    assert groups.keys() == got.keys()
    for key, members in groups.items():
        prices = [m["price_normalized"] for m in members if m["price_normalized"] is not None]
        r = got[key]
        assert (r["min_price"], r["max_price"]) == (min(prices, default=None),
                                                    max(prices, default=None))
        assert r["market_count"] == len({m["market"] for m in members})
        if prices:
            assert r["avg_price"] == pytest.approx(statistics.mean(prices), abs=0.0051)
        for latest in r["latest_by_market"]:
            best = min((m for m in members if m["market"] == latest["market"]),
                       key=lambda m: (-m["collected_at"].timestamp(), m["record_id"]))
            assert latest["price"] == best["price_normalized"]
