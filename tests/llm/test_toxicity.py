"""What the classifier learns is bounded by its label sample only, and what it reads as disguise."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gondola.llm import toxicity


def char_model(text):
    counts = Counter()
    for word in text.split() * 40:
        padded = f"  {word} "
        counts.update(padded[k:k + 3] for k in range(len(padded) - 2))
    return toxicity.CharModel(counts)


def test_rare_grams_are_smoothed_and_their_number_is_bounded(spark):
    df = spark.createDataFrame([("alpha " * 50 + "beta",), (None,), ("日本語 テスト 123 a1b",)],
                               "t string").select(F.col("t").cast("binary").alias(toxicity.TEXT))
    three, two, after = toxicity.trigram_counts(df)
    assert three["alp"] == 50 and three["bet"] == 1 and three["日本語"] == 1
    assert two["et"] == after["be"] == 1 and two["lp"] == 50
    assert toxicity.CharModel(three, two, after).one["b"] == 2  # beta, a1b
    few = toxicity.trigram_counts(df, share=20)
    assert all(len(grams) <= 20 for grams in few) and "alp" in few[0] and "bet" not in few[0]
    assert toxicity.CharModel(*few).cost("be", "t") < toxicity.CharModel(*few).cost("al", "p")


def plain_fit(texts, labels, folds, least=4):
    """Weights by plain counting; the texts hold words of letters only."""
    toxic, other = Counter(), Counter()
    sizes = Counter(labels[k] for k in labels if folds[k] < 2)
    for k, y in labels.items():
        if folds[k] < 2:
            (toxic if y else other).update({m for w in set(texts[k].lower().split())
                                            for m in [w, *(w[:n] + "*" for n in (4, 5, 6)
                                                           if len(w) >= n)]})
    out = {}
    for m, n in toxic.items():
        if n >= least:
            a, b = n + 0.5, other[m] + 0.5
            weight = (math.log(a / (sizes[1] + 1)) - math.log(b / (sizes[0] + 1))
                      - 1.64 * math.sqrt(1 / a + 1 / b))
            if weight > 0.5:
                out[m] = weight
    return out


def test_fit_and_score_equal_plain_python(spark):
    rng = random.Random(8)
    rude, plain = ["trottel", "idiots", "scum", "dämlich"], ["haus", "garden", "été", "walking", "so"]
    texts = {k: " ".join(rng.choices(plain, k=rng.randrange(1, 30)) + (
        rng.choices(rude, k=2) if k % 3 == 0 else [])) for k in range(240)}
    labels = {k: int(k % 3 == 0) for k in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    table = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    folds = {r[0]: r[1] for r in table.select("doc_id", F.pmod(F.xxhash64(
        F.lit("fold"), "doc_id"), F.lit(3))).collect()}
    model = toxicity.fit(df, table)
    want = plain_fit(texts, labels, folds)
    assert model.weights.keys() == want.keys() and len(want) > 8
    assert all(abs(model.weights[m] - w) < 1e-9 for m, w in want.items())
    for r in toxicity.score(df, model).collect():
        words = set(r["text"].lower().split())
        heavy = [max([w, *(w[:n] + "*" for n in (4, 5, 6) if len(w) >= n)],
                     key=lambda m: want.get(m, 0)) for w in words]
        all_words = r["text"].lower().split()
        found = {m for m in heavy if m in want} | {
            a + b for a, b in zip(all_words, all_words[1:]) if a + b in want}
        top = [*sorted((want[m] for m in found), reverse=True)[:2], 0, 0]
        z = sum(a * b for a, b in zip(model.scale, [top[0], top[1], math.log1p(len(found)), 1.0]))
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9


@pytest.mark.parametrize("rows", [
    [], [(k, 1) for k in range(60)], [(k, 0) for k in range(60)], [(k + 900, k % 2) for k in range(60)],
    [(None, 1), (1, None)], [(1, 1), (2, 0)]])
def test_labels_that_say_nothing_drop_nothing(spark, rows):
    df = spark.createDataFrame([(k, f"some plain text of day {k}" if k % 7 else None, "x")
                                for k in range(100)], "doc_id bigint, text string, score string")
    model = toxicity.fit(df, spark.createDataFrame(rows, "doc_id bigint, toxic int"))
    kept = toxicity.score(df, model, clean_only=True)
    assert kept.count() == 100
    assert toxicity.fit(df.limit(0), spark.createDataFrame(rows, "doc_id bigint, toxic int")
                        ).weights == {}


def test_split_words_of_any_length(spark):
    chars = char_model("plain words")
    read = toxicity.Reader(chars, {"schwachkopf", "dämlich", "däml*", "ass"}, joins=True).find
    assert read("so ein Schwach kopf!") == {"schwachkopf"} == read("schwachk opf")
    assert "dämlich" in read("du dämli ch") and read("DÄM LICH") == {"dämlich"}
    assert read("as s") == read("a ss") == set()  # too short to tell
    assert read("schwach kopfball") == set() and read("schwach") == set() == read("")


def test_forgotten_pieces_are_read_again(monkeypatch):
    monkeypatch.setattr(toxicity, "_CACHED", 20)
    rng = random.Random(2)
    words = [f"{a}{b}word" for a in "abcdefgh" for b in "abcdefgh"]
    texts = [" ".join(rng.choices(words, k=12)) for _ in range(300)]
    wanted = frozenset(words[::3])
    reader = toxicity.Reader(char_model("a"), wanted)
    for text in texts:
        assert reader.find(text) == set(text.split()) & wanted, text


def test_marks_of_toxic_documents_are_all_weighed(spark):
    """60,000 marks stand in four toxic documents and in no other."""
    rude = " ".join(f"{a}{b}{c}{d}" for a in "bcdfghklmnprst" for b in "aeiouyäöü"
                    for c in "bcdfghklmnprstvz" for d in ("ak", "el", "im", "on", "ur", "it",
                                                          "os", "ep", "an", "ig", "ot", "ub"))
    words = rude.split() + [w + "za" for w in rude.split()]
    rows = [(k, " ".join(words) if k < 20 else "plain text of a quiet day") for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k < 20)) for k in range(120)], "doc_id bigint, toxic int")
    weights = toxicity.fit(df, labels).weights
    assert set(words) <= set(weights) and len(weights) > 50_000


def test_letters_set_apart_are_read():
    chars = char_model("the idiot is so blöd and a sot with some other plain words élan")
    for text in ("b l ö d", "b  l  ö  d", "b\nl\nö\nd", "i - d - i - o - t", "¡ s o t", "€ l a n"):
        assert toxicity._SPACED.search(text), text
    wanted = {"blöd", "sot", "idiot"}
    read = toxicity.Reader(chars, wanted, joins=True).find
    assert "blöd" in read("du bist b l ö d heute") and "blöd" in read("b  l\nö  d")
    assert "sot" in read("un s o t ici") and "idiot" in read("you idi ot there")
    assert "idiot" in read("so i - d - i - o - t") and "sot" in read("s.o.t")
    assert toxicity._SPACED.search("plain words of a b day") is None


def test_accented_and_spaced_insults_score_as_toxic(spark):
    rows = [(k, f"wir gehen heute w{k} " + ("blöd und dämlich" if k % 4 == 0 else "nach hause"))
            for k in range(200)]
    rows += [(1000, "wir gehen b l ö d heute"), (1001, "wir gehen b  l  ö  d heute"),
             (1002, "wir gehen bl öd heute"), (1003, "wir gehen nach hause")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)],
                                   "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["predicted"]
           for r in toxicity.score(df, toxicity.fit(df, labels), keep=["doc_id"]).collect()}
    assert [got[k] for k in (1000, 1001, 1002, 1003)] == [1, 1, 1, 0]


def test_no_run_of_single_signs_is_missed_by_the_first_look():
    draw = random.Random(5)
    signs = "ab5@é_日 -*.'\n\t,xy"
    texts = ["", "a", "a b c", "a\nb-c", "x a.b. c.", *("".join(draw.choices(signs, k=draw.randint(1, 14)))
                                                   for _ in range(20000))]
    runs = [t for t in texts if toxicity._SPACED.search(t)]
    assert len(runs) > 500 and all(toxicity._TWO.search(t) for t in runs)
    assert not toxicity._TWO.search("a word and a plain x-ray, two " * 3)
    model = char_model("idiot")
    assert [*toxicity.spaced_words("you i d i o t", model)] == [["idiot"]]
