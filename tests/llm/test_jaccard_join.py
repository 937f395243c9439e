import random

import pytest
from pyspark.sql import functions as F

from gondola.llm import jaccard_join as jj

SCHEMA = "doc_id bigint, text string, doc string, size int"


def brute(rows, n, num, den):
    """Component of every row, by all pairs."""
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        width = min(n, len(words))
        sets.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)}
                    if width else set())
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if None in (rows[i][0], rows[j][0]) or not a or not b:
                continue
            if den * len(a & b) >= num * len(a | b):
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets)),
                  key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    return sorted(map(tuple, jj.jaccard_components(docs, **options).collect()), key=repr)


def edited(base, edits, rng):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(40)}"
    return " ".join(words)


@pytest.mark.parametrize("cluster_rows,n,num", [(400, 3, 90), (6, 3, 90), (3, 5, 80)])
def test_near_copies_agree_with_all_pairs(spark, cluster_rows, n, num):
    """Large groups of near copies, some linked only through others."""
    rng = random.Random(cluster_rows)
    base = [[f"w{b}x{k}" for k in range(120)] for b in range(3)]
    texts = [edited(base[k % 3], rng.randrange(6), rng) for k in range(90)]
    texts += [" ".join(base[0][:60] + [f"tail{k}y{j}" for j in range(50)]) for k in range(8)]
    texts += texts[:10] + ["", None, "one", "ONE", "two words", "two  Words", "x " * 400]
    rng.shuffle(texts)
    rows = [(10 + k, t) for k, t in enumerate(texts)]
    got = run(spark, rows, n=n, num=num, cluster_rows=cluster_rows)
    assert got == brute(rows, n, num, 100)


def test_nulls_repeated_ids_and_empty(spark):
    rows = [(5, "a b c d"), (5, "p q r s"), (7, "p q r s"), (3, "a b c d"), (None, "a b c d"),
            (None, None), (9, None), (9, None), (8, ""), (2, "A B C D")]
    want = brute(rows, 3, 90, 100)
    # the two texts of document 5 connect their groups
    want = sorted([(d, s, 2 if d in (2, 3, 5, 7) else c) for d, s, c in want], key=repr)
    assert run(spark, rows) == want
    assert run(spark, []) == []


def test_trie_bounds_lose_nothing():
    rng = random.Random(1)
    items = [sorted(rng.sample(range(60), rng.randrange(1, 40))) for _ in range(120)]
    items += [sorted(set(x) ^ {rng.randrange(60)}) for x in items[:60]]
    import numpy as np
    data = [np.array(x, np.uint64).tobytes() for x in items]
    got = jj.join_cluster(list(range(len(items))), [len(x) for x in items], data,
                          [jj.BOTH] * len(items), 80, 100)
    names = dict(got)
    want = brute([(k, " ".join(map(str, x))) for k, x in enumerate(items)], 1, 80, 100)
    assert [(k, names.get(k, k)) for k in range(len(items))] == \
        sorted((d, c) for d, _, c in want)


def test_rank_of_common_words_only_orders(spark):
    """A word that all documents share costs no link."""
    rows = [(k, f"the same start of all texts here then {k} " + " ".join(
        f"u{k // 2}v{j}" for j in range(60))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, jj.jaccard_components(docs).collect())) == \
        sorted(brute(rows, 3, 90, 100))
    assert docs.agg(F.count("*")).first()[0] == 20


def test_sets_and_word_buckets_do_not_stay_on_disk(spark):
    """Sets of small clusters are never stored; what only leads to members goes again."""
    import glob

    from gondola.session import shared_dir

    def left():
        names = ("cluster-sets", "buckets", "shared-tokens", "pivots")
        return [p for n in names for p in glob.glob(f"{shared_dir(spark)}/{n}-*")]
    before = left()
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(20)]
    rows = [(k, t) for k, t in enumerate(texts + [t + " end" for t in texts])]
    assert run(spark, rows) == brute(rows, 3, 90, 100)
    assert left() == before


def test_marked_rules_out_only_what_is_absent(spark):
    from gondola.llm.frames import marked
    docs = spark.createDataFrame([(k,) for k in [None, *range(2000), 5, 2 ** 62, -7]], "id bigint")
    ids = spark.createDataFrame([(5,), (-7,), (2 ** 62,), (None,), (5,)], "doc bigint")
    got = marked(docs, "id", ids, "doc").collect()
    assert len(got) == 2004
    assert {r["id"] for r in got if r["_maybe"]} >= {5, -7, 2 ** 62}
    assert sum(r["_maybe"] for r in got) < 10
    assert not any(r["_maybe"] for r in got if r["id"] is None)
