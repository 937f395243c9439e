"""Token counts against the libraries on whole texts."""

import random

import public_tokenizers as tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gondola.llm import token_counts

BYTES = tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(BYTES)
SIGNS = [" ", "  ", "\n", "\t", "a", "b", "é", "1", "<", "<|endoftext|>", " <|endoftext|>", ".",
         "'s", "'ll", " ", "　", "\xa0", "\x1c", "日本", "\x85", "😀", "-", "|>", "\r\n",
         "word ", "́", "​"]


@pytest.fixture(scope="module")
def library():
    return lambda texts: [len(WHOLE.encode(t, add_special_tokens=False)) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(SIGNS) | st.characters(codec="utf-8"), max_size=40).map("".join))
def test_any_text_counts_as_the_library_does(text):
    assert token_counts.counter(BYTES).counts([text.encode()]) == [
        len(WHOLE.encode(text, add_special_tokens=False))]


def test_slices_and_forgotten_words(library, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(400))) for _ in range(200)]
    texts += ["x" * 5000, "ab " * 3000, " " * 3000, "<|endoftext|> " * 300]
    monkeypatch.setattr(token_counts, "SLICE", 50)
    monkeypatch.setattr(token_counts, "REMEMBERED", 100)
    monkeypatch.setattr(token_counts, "BATCH", 40)
    monkeypatch.setattr(token_counts.slices, "__defaults__", (50,))
    counter = token_counts.Counter(BYTES)
    assert counter.counts([t.encode() for t in texts]) == library(texts)
    for text in texts:
        parts = list(token_counts.slices(text.encode()))
        assert b"".join(parts).decode() == text
    assert max(map(len, counter.words)) <= token_counts.LONG


def test_batches_hold_about_equal_bytes():
    texts = [b"x" * n for n in (10, 20, 30, 500, 5, 60, 60, 1)]
    batches = list(token_counts.byte_batches(texts, 100))
    assert [t for b in batches for t in b] == texts
    assert all(sum(map(len, b)) <= 100 or len(b) == 1 for b in batches)


def test_edges(spark, library):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "a<|endoftext|>b"),
            (5, "long " * 300_000), (6, "ü" * 70_000)]
    docs = spark.createDataFrame([(*r, 7, "y") for r in rows],
                                 "doc_id bigint, text string, n_tokens int, source string")
    out = token_counts.count_tokens(docs, BYTES)
    assert out.columns == ["doc_id", "text", "source", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(((i, len((t or "").encode()), n, n > 512) for (i, t), n in
                   zip(rows, library([t or "" for _, t in rows]))), key=repr)
    assert sorted(map(tuple, out.drop("text", "source").collect()), key=repr) == want
    assert token_counts.count_tokens(docs.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_given_texts(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = tokenizers.path(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False))
    got = token_counts.count_tokens(docs, path, keep=["doc_id", "text"]).collect()
    assert len(got) == docs.count()
    assert all(r["n_tokens"] == count(r["text"] or "") for r in got)
