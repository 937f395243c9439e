import random

import pytest
from pyspark.sql import functions as F

from gondola.operators import containment


def brute(terms, dim):
    out = {}
    for t in terms:
        hits = [(o, s) for o, p, s in dim if t and p and (p in t or t in p)]
        out[t] = min(hits)[1] if hits else None
    return out


@pytest.mark.parametrize("q", [2, 3, 4])
def test_same_rows_as_comparing_all_pairs(spark, q):
    rng = random.Random(q)
    word = lambda n: "".join(rng.choice("abcç ") for _ in range(rng.randrange(n)))
    terms = [word(12) for _ in range(300)] + ["", None, "zzzz", "ab"] * 2
    dim = [(i, word(9), f"s{i % 7}") for i in range(120)] + [(500, None, "x"), (501, "", "y")]
    t = spark.createDataFrame([(x,) for x in terms], "term string")
    d = spark.createDataFrame(dim, "ord int, pattern string, standard string")
    got = containment.first_match(t, d, q).collect()
    assert len(got) == len(set(terms))
    assert {r["term"]: r["standard"] for r in got} == brute(set(terms), dim)


def test_a_hundred_thousand_patterns_meet_few_terms(spark):
    d = spark.range(100_000).select(
        F.col("id").alias("ord"), F.concat(F.lit("produto "), F.conv(F.col("id") * 7919 + 10**7, 10, 36))
        .alias("pattern"), F.col("id").cast("string").alias("standard"))
    t = d.sample(0.02, seed=1).select(F.concat(F.lit("o "), "pattern", F.lit(" novo")).alias("term"))
    n = t.count()
    found = containment.first_match(t, d)
    assert found.filter("standard is null").count() == 0 and found.count() == n
    assert containment.candidates(t, d).count() < 100 * n  # of 100,000 each
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
