"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gondola.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, score string, rank string"


def brute(rows, longest, least, top, num=50, den=100):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            if any(len(q) > len(p) and den * b >= num * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in often.items()):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k)
                           for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def made(seed, count=150):
    rng = random.Random(seed)
    words = ["New", "york", "ÉTÉ", "a", "b", "c", "of", "the", "Ünder", "é"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " - ", "\r\n", " "]
    return [(i, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(40))),
             rng.choice(["en", "en", "en", "de", None, "und"])) for i in range(count)]


@pytest.mark.parametrize("seed,longest", [(1, 3), (2, 3), (3, 4), (4, 2)])
def test_equal_to_brute_force(spark, seed, longest):
    rows = made(seed)
    got = phrases.collocations(frame(spark, rows).repartition(5), longest=longest, least=6, top=60)
    assert sorted(map(tuple, got.collect())) == brute(rows, longest, 6, 60)


def test_small_blocks_shards_and_slices(spark, monkeypatch):
    rows = made(9)
    want = brute(rows, 3, 5, 500)
    docs = frame(spark, rows)
    monkeypatch.setattr(phrases, "SLICE", 7)
    monkeypatch.setattr(phrases, "SHARD", 40)
    block = phrases._Block()
    text = "one two, three four five. six seven eight nine"
    block.add(text.encode())
    assert [w.decode() for w in phrases._words(block.row("en", 0)[4])] == re.findall(r"\w+", text)
    got = phrases.collocations(docs.repartition(40), least=5, top=500)  # a block per task
    assert sorted(map(tuple, got.collect())) == want


def test_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, " \t ", None), (4, "a\xa0b c\x1cd", "en"),
            (None, "one two one two", "en"), (None, "one two one two", "en"),
            (5, "long text " * 60_000, "fr"), (6, "x", "de"), (7, "p, q. p; q", "es")] + [
            (8, "lone pair", "pt")] * 10
    got = phrases.collocations(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 10, 2000)
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, rows[:4])).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 400_000_000_000
    found = spark.createDataFrame(
        [("en", [b"a"], big + 7), ("en", [b"b"], big + 5), ("en", [b"a", b"b"], big + 1)],
        "lang string, words array<binary>, f bigint")
    row = phrases.scored(found).first()
    assert row["score"] == 10**6 * (big + 1) ** 2 // ((big + 7) * (big + 5))
    assert (row["l"], row["r"]) == (big + 7, big + 5)


def test_a_gap_is_never_bridged():
    seq = np.array([1, 2, 0, 3, 1, 2, 0], "<u4")
    assert [(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in phrases.adjacent(seq) if k] == [
        (1, 2), (3, 1), (1, 2)]
    assert phrases.unpacked(phrases.packed(seq), "<u4").tolist() == seq.tolist()
    assert phrases._without_runs(np.array([0, 0, 1, 0, 0, 2], "<u4")).tolist() == [1, 0, 2]
