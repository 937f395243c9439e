"""Every operator against brute force, an exact round trip or held-out accuracy."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gondola.llm import (components, decontaminate, frames, line_dedup, mixing,
                         preference, quality_rules, repair, toxicity, warc)

DOCS = "doc_id bigint, text string, item_ids string, score string"


def docs_of(spark, rows):
    """Documents with extra columns that are named like results."""
    return spark.createDataFrame([(d, t, "x", "y") for d, t in rows], DOCS)


ODD = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "one two three"),
       (5, "long " * 30_000), (6, "a\nb\n\na"), (6, "other text")]


# ---- decontamination ------------------------------------------------------

def test_wu_manber_finds_what_a_scan_finds():
    rng = random.Random(4)
    letters = [bytes([c]) for c in b"abcd"]
    for _ in range(60):
        patterns = [tuple(rng.choice(letters) for _ in range(rng.randrange(1, 5)))
                    for _ in range(6)]
        text = [rng.choice(letters) for _ in range(60)]
        matcher = decontaminate.WuManber((p, str(k)) for k, p in enumerate(patterns))
        got = {(a, b, o) for a, b, owners in matcher.search(text) for o in owners}
        want = {(a, a + len(p), str(k)) for k, p in enumerate(patterns)
                for a in range(len(text) - len(p) + 1) if tuple(text[a:a + len(p)]) == p}
        assert got == want


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination_edges_and_blocks(spark, block_bytes):
    items = [(1, " ".join(f"w{k}" for k in range(14))), (2, "short item"), (3, None), (4, "!!"),
             (None, "nameless words"), (2, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [*ODD, (10, "W3, w4 w5 w6 w7 w8 w9 w10 w11 w12 x SHORT-item"),
            (11, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (12, "nameless words"),
            (13, "w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15")]
    out = decontaminate.decontaminate(docs_of(spark, rows), benchmark, keep=["doc_id", "score"],
                                      block_bytes=block_bytes)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(rows) and out.columns[:2] == ["doc_id", "score"]
    assert (got[10]["n_words"], got[10]["n_hit"], got[10]["n_items"]) == (13, 12, 2)
    assert got[10]["items_sha256"] == hashlib.sha256(b"1,2").hexdigest()
    assert not got[11]["contaminated"] and not got[2]["contaminated"]
    assert (got[12]["n_hit"], got[12]["n_items"]) == (2, 0)
    assert (got[13]["n_hit"], got[13]["item_ids"]) == (12, ["1", "2"])
    assert got[1]["n_words"] == 0 and got[5]["n_words"] == 30_000
    none = decontaminate.decontaminate(docs_of(spark, rows), benchmark.limit(0), clean_only=True)
    assert none.count() == len(rows)
    assert decontaminate.decontaminate(docs_of(spark, []), benchmark).collect() == []


# ---- line dedup -----------------------------------------------------------

def lines_by_hand(rows, least=10):
    keeper = {}
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least:
                keeper[key(line)] = min(keeper.get(key(line), doc), doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or keeper.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,fanout", [(1, 4), (5, 2)])
def test_lines_are_kept_once(spark, batches, fanout):
    rng = random.Random(batches)
    lines = [f"a common line {k}" for k in range(6)] + ["  A COMMON line 1\t", "short", "éèêëàâäôö",
                                                       "éèêëàâäôöü", "ÉÈÊËÀÂÄÔÖÜ"]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(5))) for k in range(40)]
    rows += [*ODD, (None, "a common line 1\nmine alone here")]
    out = line_dedup.dedup_lines(docs_of(spark, rows), batches=batches, fanout=fanout)
    assert sorted(map(tuple, out.collect()), key=repr) == lines_by_hand(rows)


def test_runs_of_earlier_corpora_are_searched(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    text = "this line came before"
    first = line_dedup.dedup_lines(docs_of(spark, [(9, text)]), batches=1, runs=runs)
    later = line_dedup.dedup_lines(docs_of(spark, [(2, text), (3, "a new one here")]),
                                   batches=2, runs=runs)
    assert first.first()["n_dropped"] == 0
    assert {r["doc_id"]: r["n_dropped"] for r in later.collect()} == {2: 1, 3: 0}
    assert line_dedup.dedup_lines(docs_of(spark, [])).collect() == []


# ---- WARC -----------------------------------------------------------------

def test_archives_round_trip(spark, tmp_path):
    pages = [(3, "http://a/\r\nx", "same"), (1, "http://b", "same"), (2, None, None), (4, "u", ""),
             (5, "u", "WARC/1.1\r\n\r\nlike a record\r\n\r\n"), (None, "u", "same"),
             (7, "u", "é" * 70_000), (7, "u", "é" * 70_000)]
    df = spark.createDataFrame([(*p, "z") for p in pages],
                               "page_id bigint, url string, html string, payload string")
    path = str(tmp_path / "warc")
    warc.write_archives(df, path)
    records = warc.read_archives(spark, path)
    got = defaultdict(list)
    for r in records.collect():
        got[r["page_id"]].append(r)
    assert sum(map(len, got.values())) == len(pages)
    assert (got[1][0]["record_type"], bytes(got[1][0]["payload"])) == ("response", b"same")
    assert (got[3][0]["record_type"], got[3][0]["refers_to"]) == ("revisit", 1)
    assert (got[4][0]["record_type"], got[4][0]["refers_to"]) == ("revisit", 2)
    assert got[None][0]["refers_to"] == 1
    assert bytes(got[5][0]["payload"]).decode() == pages[4][2]
    assert {r["record_type"] for r in got[7]} == {"response"} and len(got[7]) == 2
    heads = {r["page_id"]: r for r in warc.resolve(records).collect()}
    assert heads[3]["payload_bytes"] == 4 and heads[2]["payload_bytes"] == 0
    assert heads[2]["payload_digest"] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    raw = b"".join(gzip.open(f).read() for f in (tmp_path / "warc").rglob("part*"))
    kinds = Counter(h["WARC-Type"] for h, _ in warc.parse_archive([raw]))
    assert kinds["response"] == 5 and kinds["revisit"] == 3 and kinds["warcinfo"] >= 1
    empty = str(tmp_path / "none")
    warc.write_archives(df.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_files_roll_and_are_unpacked_in_pieces(spark, tmp_path, monkeypatch):
    rows = [(k, f"http://x/{k}", f"page {k} " * 300) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"), file_bytes=20_000)
    files = list((tmp_path / "w").rglob("*.gz"))
    sizes = [len(gzip.open(f).read()) for f in files]
    assert len(files) > 5 and max(sizes) < 25_000
    assert all(next(warc.parse_archive([gzip.open(f).read()]))[0]["WARC-Type"] == "warcinfo"
               for f in files)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert {(r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in got} == set(rows)
    monkeypatch.setattr(warc, "_PIECE", 7)
    raw = files[0].read_bytes()
    plain = gzip.decompress(raw)
    want = list(warc.parse_archive([plain]))
    assert list(warc.parse_archive(warc.unpacked_pieces(raw))) == want
    two = gzip.compress(plain[:100]) + gzip.compress(plain[100:])  # any number of members
    assert list(warc.parse_archive(warc.unpacked_pieces(two))) == want
    with pytest.raises(ValueError, match="cut off"):
        list(warc.unpacked_pieces(raw[:-20]))
    with pytest.raises(ValueError, match="does not end|no record"):
        list(warc.parse_archive([plain[:-3]]))


def test_small_payloads_are_no_revisits(spark, tmp_path):
    df = spark.createDataFrame([(k, "u", "tiny") for k in range(3)],
                               "page_id bigint, url string, html string")
    warc.write_archives(df, str(tmp_path / "w"), min_bytes=5)
    assert warc.read_archives(spark, str(tmp_path / "w")).filter(
        "record_type = 'response'").count() == 3


# ---- Re-Pair --------------------------------------------------------------

def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    end = 60
    for size in (1, 2, 5_000):
        ids = rng.zipf(1.6, size).clip(0, 59).astype(np.uint32)
        ids[rng.integers(0, size, size // 50)] = end
        ids[-1] = end
        seq, rules = repair.compress(ids, end, least=4)
        assert (repair.expand(seq, rules, end) == ids).all()
        shard = repair.Shard({
            "vocab": end, "width": 4, "doc_ids": [], "n_tokens": size,
            "symbols": seq.astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(),
            "lengths": repair.rule_lengths(rules, end).astype("<u4").tobytes()})
        whole, stops = shard.decode()
        assert (whole == np.where(ids == end, 1, ids)).all()
        for a, b in ((0, size), (size // 3, size // 2), (size - 1, size)):
            assert (shard.range(a, b) == whole[a:b]).all()
        for k in (0, len(stops) // 2, len(stops) - 1):
            assert (shard.document(k) == whole[(stops[k - 1] if k else 0):stops[k]]).all()
    assert len(seq) < size * 0.8


def test_rules_are_expanded_once_and_copied():
    rng, end = np.random.default_rng(3), 20
    for ids in (rng.zipf(1.5, 4_000).clip(0, 20).astype(np.uint32), np.full(700, 4, np.uint32),
                np.array([end], np.uint32), np.empty(0, np.uint32)):
        seq, rules = repair.compress(ids, end, least=4)
        lengths = repair.rule_lengths(rules, end)
        found = repair.expand(seq, rules, end, lengths)
        assert found.dtype == np.uint32 and found.tolist() == ids.tolist()
        assert [len(repair.expand(np.array([end + 1 + k], np.uint32), rules, end))
                for k in range(len(rules))] == lengths.tolist()


def test_the_encoder_asks_for_no_offsets():
    class WithoutOffsets:  # has what the encoder may call, and no other way to encode
        def __init__(self, inner):
            self.encode_batch_fast = inner.encode_batch_fast

    coder = repair.Encoder(tokenizers.path("word_bpe_49k.json"))
    whole = coder.tokenizer
    coder.tokenizer = WithoutOffsets(whole)
    text = "It's the Straße, again: x2y ... again"
    want = whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist() == want


def test_token_files_hold_what_the_tokenizer_gives(spark, tmp_path):
    words = ["It's", "<|endoftext|>", "Straße", "İstanbul", "J̌", "é", "x\x0by", "ab,.",
             "...", "12a", "ｆｕｌｌ", "a b", "don't'st", " ", "THE", "the", "\x1c", "ÀÉ"]
    rng = random.Random(2)
    rows = [*ODD, *[(100 - k, " ".join(rng.choices(words, k=40))) for k in range(50)]]
    path = str(tmp_path / "ids")
    repair.write_shards(docs_of(spark, rows), path, tokenizers.path("word_bpe_49k.json"),
                        shard_tokens=500)
    tk = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tk.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = repair.read_shards(spark, path)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert spark.read.parquet(path).count() > 5
    none = str(tmp_path / "none")
    repair.write_shards(docs_of(spark, []), none, tokenizers.path("word_bpe_49k.json"))
    assert repair.read_shards(spark, none).collect() == []


def test_other_tokenizers_get_whole_texts():
    coder = repair.Encoder(tokenizers.path("byte_bpe_50k.json"))
    text = "Two  blanks\nand a line"
    want = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist() == want


# ---- mixing ---------------------------------------------------------------

def worst_lag(sources, weights):
    """Largest deviation, in blocks, from the given weights, until a source runs out."""
    total = sum(weights.values())
    done, worst = dict.fromkeys(weights, 0), 0.0
    for at, source in enumerate(sources, 1):
        done[source] += 1
        worst = max(worst, *(abs(done[s] - w * at / total) for s, w in weights.items()))
    return worst


@pytest.mark.parametrize("weights", [
    [1 / 3, 2 / 3], [0.45, 0.45, 0.1], [1, 1, 1], [0.9973, 0.0017, 0.001], [7, 7, 5, 1, 13], [4],
    [math.pi, math.e, 1e-3, 2 ** 0.5, 10.01], [1] + [0.0007] * 300])
def test_pfair_stays_within_one_block_of_the_given_weights(weights):
    whole = [round(w / sum(weights) * 2 ** 40) for w in weights]
    blocks = [math.ceil(60_000 * w / sum(weights)) + 1 for w in weights]
    slots = list(mixing.earliest_deadline_first(whole, blocks, stop=True))
    assert len(slots) > 59_000 and [s for s, _, _ in slots] == list(range(len(slots)))
    if len(weights) > 50:
        slots = slots[:8000]
    assert worst_lag([i for _, i, _ in slots], dict(enumerate(weights))) < 1


def test_all_blocks_come_and_the_rest_keeps_its_proportions():
    weights, blocks = [2 ** 30, 2 ** 29, 2 ** 28 + 7], [50, 400, 300]
    slots = [(i, j) for _, i, j in mixing.earliest_deadline_first(weights, blocks)]
    for i, m in enumerate(blocks):
        assert [j for k, j in slots if k == i] == list(range(m))
    out = max(at for at, (i, _) in enumerate(slots) if i == 0)
    assert worst_lag([i for i, _ in slots[:out]], dict(enumerate(weights))) < 1
    rest = [i for i, _ in slots[out + 1:out + 400]]
    assert worst_lag(rest, {1: weights[1], 2: weights[2]}) < 2


def test_mix_keeps_all_rows_and_the_weights(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, rng.choices(["big", "mid", "tiny", None], [60, 25, 12, 3])[0]) for k in range(900)]
    rows += [(None, "big"), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, "t", 0) for r in rows],
                               "doc_id bigint, source string, text string, mix_slot int")
    given = {"big": 2.0, "mid": 1 / 3, "tiny": 0.7, None: 1 / 3}  # the unnamed gets the least
    weights = spark.createDataFrame([("big", 2.0), ("mid", 1 / 3), ("tiny", 0.7), ("absent", 5.0),
                                     ("mid", None)], "source string, weight double")
    got = mixing.mix(df, weights, block_docs=4).orderBy("mix_position").collect()
    assert len(got) == 901 and len({r["mix_position"] for r in got}) == 901
    assert {(r["doc_id"], r["source"]) for r in got} == set(rows)
    slots, seen = [], set()
    for r in got:
        if r["mix_slot"] not in seen:
            seen.add(r["mix_slot"])
            slots.append((r["mix_slot"], r["source"]))
    assert [s for s, _ in slots] == list(range(len(slots)))
    blocks = Counter(s for _, s in slots)
    assert blocks == {s: -(-n // 4) for s, n in Counter(
        s for _, s in set(rows)).items()}
    order = [s for _, s in slots]
    ends = min(max(at for at, x in enumerate(order) if x == s) for s in given)
    assert ends > 10 and worst_lag(order[:ends], given) < 1  # the weights that were given
    cut = mixing.mix(df, weights, block_docs=4, stop=True).collect()
    assert {r["mix_slot"] for r in cut} == set(range(ends + 1))
    assert mixing.mix(df.limit(0), weights).collect() == []
    files = mixing.ordered(df, mixing.mix(df, weights, block_docs=4))
    order = [r["doc_id"] for r in files.select("doc_id").toLocalIterator()]
    at = {r["doc_id"]: r["mix_position"] for r in got}
    assert len(order) == len(rows) and [at[d] for d in order] == sorted(at[d] for d in order)
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 50)  # larger blocks, all rows
    few = mixing.mix(df, weights, block_docs=4).collect()
    assert len(few) == 901 and len({r["mix_position"] for r in few}) == 901
    assert max(r["mix_slot"] for r in few) < 54


def test_ranks_of_a_hot_group_do_not_depend_on_buckets(spark):
    df = spark.createDataFrame([("hot" if k % 3 else f"s{k}", k) for k in range(300)],
                               "source string, id bigint")
    one, many = (frames.ranked(df, ["source"], ["id"], "r", n) for n in (1000, 7))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert one.filter("source = 'hot'").select("r").distinct().count() == 200


# ---- quality rules --------------------------------------------------------

def test_features_against_plain_python(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", "c", "d#", "\n", "e\t"]) for _ in range(n))
             for n in (0, 1, 2, 3, 4, 5, 8, 40, 300)] + [None, "", " \n ", "x y x y x y x", "a b\na b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in quality_rules.features(df).collect():
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        n = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered)), text


def test_limits_follow_the_group(spark):
    rng = random.Random(6)

    def text(symbols):
        words = [f"word{rng.randrange(10 ** 6)}" for _ in range(80)]
        return " ".join(w + "#" * symbols for w in words)

    rows = [(k, text(0), "en", "plain") for k in range(60)]
    rows += [(100 + k, text(2), "en", "code") for k in range(60)]
    rows += [(200, text(2), "en", "plain"), (201, text(2), "en", "code"), (202, None, None, None),
             (203, "too short", "en", "plain"), (204, text(0), None, None), (None, text(0), "en", "plain")]
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "doc_id bigint, text string, lang string, source string, kept int")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(df, least=20).collect()}
    assert len(got) == len(rows)
    assert not got[200]["kept"] and got[201]["kept"] and got[100]["kept"] and got[0]["kept"]
    assert got[202]["base_failed"] and got[203]["base_failed"] and not got[203]["kept"]
    assert got[None]["kept"]
    assert quality_rules.quality_rules(df.limit(0)).collect() == []


# ---- toxicity -------------------------------------------------------------

def test_disguised_words_are_restored():
    text = "the idiot was a moron and the stupid clown is here with some other plain words"
    counts = Counter()
    for word in text.split() * 40:
        padded = f"  {word} "
        counts.update(padded[k:k + 3] for k in range(len(padded) - 2))
    model = toxicity.CharModel(counts)
    for given, want in {"1d10t": "idiot", "m0r0n": "moron", "stuuuupid": "stupid",
                        "$tup1d": "stupid", "i d i o t": "idiot", "c.l.o.w.n": "clown",
                        "plain": "plain", "": ""}.items():
        assert toxicity.restore(given, model) == want


def test_held_out_toxicity(spark):
    rng = random.Random(8)
    plain = [f"{a}{b}er" for a in "bcdfgkl" for b in ("an", "ol", "um", "ir")]
    rude = ["grobian", "dummkopf", "schuft"]
    disguise = [lambda w: w, lambda w: w.replace("o", "0").replace("u", "u"),
                lambda w: w.replace("u", "uuuu"), lambda w: " ".join(w)]
    rows, labels = [], []
    for k in range(400):
        words = rng.choices(plain, k=25)
        if k % 4 == 0:
            for _ in range(3):
                word = rng.choice(rude)
                words[rng.randrange(25)] = word if k < 300 else rng.choice(disguise)(word)
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    rows += [(1000, None), (1001, ""), (None, "x"), (5, rows[5][1])]
    labels += [(None, 1), (2000, None), (3000, 1)]
    df = docs_of(spark, rows)
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"),
                         usable=F.col("doc_id") < 300)
    got = toxicity.score(df, model, keep=["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["predicted"], int(r["doc_id"] % 4 == 0)) for r in got
            if r["doc_id"] is not None and 300 <= r["doc_id"] < 400]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (1000, 1001))
    kept = toxicity.score(df, model, clean_only=True)
    assert kept.count() == sum(1 for r in got if not r["predicted"])
    nothing = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score(df, toxicity.fit(df, nothing)).count() == len(rows)
    assert toxicity.fit(df.limit(0), nothing).weights == {}


# ---- preference -----------------------------------------------------------

def test_prefix_is_rendered_once(spark):
    turn = lambda role, text: (role, text)
    u, a = turn("user", "hi"), turn("assistant", "yes")
    pairs = [(1, [u, a, u], [u, a, turn("assistant", "no")]), (2, [u], [u]), (3, [a], [u]),
             (4, None, [u]), (5, [], []), (6, [turn(None, None), a], [turn(None, None)]),
             (7, [u, a], [u, a, a])]
    df = spark.createDataFrame([(*p, "x") for p in pairs],
                               f"conv_id bigint, chosen {preference.TURNS}, "
                               f"rejected {preference.TURNS}, prompt string")
    got = {r["conv_id"]: r for r in preference.format_pairs(df).collect()}
    show = lambda turns: "".join(f"<|turn|>{r or ''}\n{t or ''}<|end|>\n" for r, t in turns)
    for key, chosen, rejected in pairs:
        c, r = chosen or [], rejected or []
        n = next((k for k in range(min(len(c), len(r))) if c[k] != r[k]), min(len(c), len(r)))
        row = got[key]
        assert (row["n_shared"], row["prompt"]) == (n, show(c[:n]))
        for side, turns in (("chosen", c[n:]), ("rejected", r[n:])):
            assert row[side] == show(turns)
            masked = "".join(row[side][m["start"]:m["start"] + m["length"]]
                             for m in row[f"{side}_mask"])
            assert masked == "".join(f"{t or ''}<|end|>\n" for role, t in turns
                                     if role == "assistant")
    assert preference.format_pairs(df.limit(0)).collect() == []


def test_last_answers_make_pairs(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"),
            (1, 3, "assistant", "b"), (1, 4, "user", "bye"), (2, 0, "user", "only"),
            (3, 1, "assistant", "late"), (3, 0, "user", "early"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pairs = preference.last_answer_pairs(preference.conversations(df))
    got = {r["conv_id"]: ([t["text"] for t in r["chosen"]], [t["text"] for t in r["rejected"]])
           for r in pairs.collect()}
    assert got == {1: (["q", "a", "r", "b"], ["q", "a", "r", "a"]), 2: (["only"], ["only"]),
                   3: (["early", "late"], ["early"]), None: ([None], [None])}


# ---- components -----------------------------------------------------------

def test_components_of_a_long_chain(spark):
    rng = random.Random(9)
    order = rng.sample(range(200), 200)
    edges = [*zip(order[:60], order[1:61]), *zip(order[70:90], order[71:91]), (500, 501), (501, 501)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges * 2, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    want = {n: min(order[:61]) for n in order[:61]} | {n: min(order[70:91]) for n in order[70:91]}
    assert got == want | {500: 500, 501: 500}
    assert components.components(df.limit(0)).collect() == []
