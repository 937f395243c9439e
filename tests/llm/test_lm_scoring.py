"""The language models keep what the corpus holds: no limit on words or bigrams."""

import math
import random
from collections import Counter

import pytest

from gondola.llm import lm_scoring


def by_hand(rows, marked, least):
    """Scores of the sparse models in plain Python."""
    lines = [["<s>", *(t or "").lower().split(), "<s>"] for _, t in rows]
    lines = [x if len(x) > 2 else [] for x in lines]
    pairs, single = [Counter(), Counter()], [Counter(), Counter()]
    for (doc, _), x in zip(rows, lines):
        for side in (0, 1) if doc in marked else (1,):
            pairs[side].update(zip(x, x[1:]))
            single[side].update(x[1:])
    known = {w for w, n in single[1].items() if n >= least}
    kept = {p for p, n in pairs[1].items() if n >= least}

    def loss(side, v, w):
        every, size = sum(single[side].values()), len(known) + 1
        n = (single[side][w] if w in known else
             every - sum(single[side][k] for k in known))
        p = (n + 0.5) / (every + 0.5 * size)
        context = sum(pairs[side][k] for k in kept if k[0] == v)
        return -math.log(((pairs[side][v, w] if (v, w) in kept else 0) + 20 * p) / (context + 20))

    return [(len(x) - 1, sum(loss(1, v, w) - loss(0, v, w) for v, w in zip(x, x[1:])) / (len(x) - 1))
            if x else (0, 0.0) for x in lines]


@pytest.mark.parametrize("parts,shard", [(1, 1 << 20), (7, 1 << 20), (7, 40), (30, 7)])
@pytest.mark.parametrize("least", [1, 3])
def test_all_words_above_the_floor_count(spark, monkeypatch, parts, shard, least):
    monkeypatch.setattr(lm_scoring, "SHARD", shard)
    rng = random.Random(3)
    names = [f"w{k}" for k in range(40)]
    rows = [(k, " ".join(rng.choices(names, range(40, 0, -1), k=rng.randrange(60)))) for k in range(40)]
    rows += [(None, "w1 w2 W3"), (50, None), (51, ""), (52, "only here")]
    rows += [rows[4], rows[4], (4, "another w1 text"), (None, "w1 w2 w3")]
    marked = {1, 2, 3, 4, 52}
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, score string")
    df = df.coalesce(1) if parts == 1 else df.repartition(parts)
    targets = spark.createDataFrame([(d,) for d in [*marked, 2, None]], "doc_id bigint")
    got = lm_scoring.cross_entropy_difference(df, targets, least=least)
    assert got.columns == ["doc_id", "n_tokens", "score"]
    want = sorted((repr(d), n, s) for (d, _), (n, s) in zip(rows, by_hand(rows, marked, least)))
    got = sorted((repr(r["doc_id"]), r["n_tokens"], r["score"]) for r in got.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert max(abs(g[2] - w[2]) for g, w in zip(got, want)) < 1e-5
    assert lm_scoring.cross_entropy_difference(df.limit(0), targets).collect() == []


def test_words_beyond_the_most_frequent_make_a_difference(spark):
    """5,000 words come more often than the technical ones that tell the target."""
    common = [f"c{k}" for k in range(5000)]
    rows = [(k, " ".join(common[k % 50 * 100:k % 50 * 100 + 100])) for k in range(300)]
    rows += [(1000 + k, "enzyme kinase ligand") for k in range(4)]
    rows += [(2000 + k, "sonnet iambic stanza") for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    targets = spark.createDataFrame([(1000 + k,) for k in range(3)], "doc_id bigint")
    got = {r["doc_id"]: r["score"]
           for r in lm_scoring.cross_entropy_difference(df, targets).collect()}
    assert got[1003] > got[2000] + 0.01  # equal where all of them are the unknown word


def test_block_of_several_slices(monkeypatch):
    monkeypatch.setattr(lm_scoring, "SLICE", 5)
    block = lm_scoring._Block()
    text = "one Two three\n\x0bfour  five onetwothree"
    block.add(1, text.encode())
    block.add(2, b" \t ")
    names = list(block.number)
    seq = [names[k] for part in block.parts for k in part]
    assert seq == [*text.lower().encode().split(), b""] and block.lengths == [7, 0]


def test_no_targets_and_only_targets(spark):
    df = spark.createDataFrame([("a", "x y z x y z"), ("b", "x y"), (None, None)],
                               "doc_id string, text string")
    none = spark.createDataFrame([], "doc_id string")
    every = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    for targets in (none, every):
        got = lm_scoring.cross_entropy_difference(df, targets, least=1).collect()
        assert len(got) == 3 and all(abs(r["score"]) < 0.5 for r in got)
        assert {r["doc_id"]: r["n_tokens"] for r in got} == {"a": 7, "b": 3, None: 0}
