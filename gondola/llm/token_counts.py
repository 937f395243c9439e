"""Token counts of whole texts: batches in Arrow functions that return lengths only.

A text is cut at *safe boundaries*, places where the tokenizer starts a new piece
whatever lies on both sides, so that the counts of the parts add up exactly. For a
byte-level BPE with the usual word pattern and no normalizer, that is every blank
before a character that is neither white space nor the ``<`` a special token may start
with: white space before such a blank is a piece of its own and the blank belongs to the
next word. The parts are then words, and each new word of a batch is encoded once, joined
with others to batches of even size in bytes; a worker remembers its count.

Long texts are taken slice by slice, each ending at a safe boundary, so that memory
follows the slice and not the text. Other kinds of tokenizers (and SentencePiece models)
have no rule here: their texts are encoded whole, many at a time by bytes. No tokenizer
sees begin, end or padding marks, and special strings in a text are read as the library
does by default.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.llm.frames import TEXT, pieces

SLICE = 1 << 20  # bytes of one text split into words at a time
BATCH = 1 << 16  # bytes handed to the tokenizer as one string, and 16 of these in one call
REMEMBERED = 10 << 20  # bytes of words a worker keeps counts of; then it starts anew
LONG = 64  # longer words are not remembered

# a blank before a character that cannot be white space nor open a special token; the
# bytes left out may begin a wide blank (U+0085, U+00A0, U+1680, U+2000.., U+3000)
_SAFE = re.compile(rb" (?=[!-;=-~\xc3-\xdf\xe0\xe4-\xf4])")


def byte_batches(texts: Iterable[bytes], size: int = BATCH) -> Iterator[list[bytes]]:
    """The texts in order, in lists of about ``size`` bytes (a longer text is alone)."""
    batch, held = [], 0
    for text in texts:
        if batch and held + len(text) > size:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += len(text)
    if batch:
        yield batch


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes, each but the first opening at a safe boundary."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


class Counter:
    """Counts tokens of texts; one instance per Python worker."""

    def __init__(self, path: str):
        self.words: dict[bytes, int] = {}
        self.held = 0
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor
            model = SentencePieceProcessor(model_file=path)
            self._many = lambda ts: [len(x) for x in model.encode(ts, num_threads=1)]
            self.by_word = False
            return
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._many = lambda ts: [len(x) for x in self._encode(ts)]
        self.by_word = _splits_at_blanks(json.loads(self.tokenizer.to_str()))
        if self.by_word:
            opens = [t.startswith("Ġ") for t, _ in
                     sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])]
            self.opens = np.array(opens)  # tokens that start with a blank

    def _encode(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def counts(self, texts: Sequence[bytes]) -> list[int]:
        """Tokens of every text."""
        if not self.by_word:
            return [n for batch in byte_batches(texts, 16 * BATCH)
                    for n in self._many([t.decode(errors="replace") for t in batch])]
        totals, group, owners, held = [0] * len(texts), [], [], 0
        for k, text in enumerate(texts):
            for part in slices(text):
                group.append(part)
                owners.append(k)
                held += len(part)
                if held >= SLICE:
                    self._add(group, owners, totals)
                    group, owners, held = [], [], 0
        self._add(group, owners, totals)
        return totals

    def _add(self, parts: list[bytes], owners: list[int], totals: list[int]) -> None:
        """A part that opens with a safe blank splits to an empty first word and words."""
        split = [_SAFE.split(p) for p in parts]
        heads = [ws[0] for ws in split]
        for ws in split:
            del ws[0]
        missing = set().union(*split).difference(self.words)
        if missing and self.held > REMEMBERED:
            self.words, self.held, missing = {}, 0, set().union(*split)
        self._learn(list(missing))
        for k, n, ws in zip(owners, self._direct(heads), split):
            totals[k] += n + sum(map(self.words.__getitem__, ws))
        for word in missing:
            if len(word) > LONG:
                del self.words[word]
            else:
                self.held += len(word)

    def _direct(self, texts: list[bytes]) -> list[int]:
        counts = []
        for batch in byte_batches(texts, 16 * BATCH):
            counts += self._many([t.decode(errors="replace") for t in batch])
        return counts

    def _learn(self, words: list[bytes]) -> None:
        """Words with the blank before them, joined by bytes; a blank inside is encoded alone."""
        into = self.words
        plain = [w for w in words if b" " not in w]
        odd = [w for w in words if b" " in w]
        into.update(zip(odd, self._direct([b" " + w for w in odd])))
        lists = list(byte_batches(plain))
        for at in range(0, len(lists), 16):
            some = lists[at:at + 16]
            joined = [(b" " + b" ".join(ws)).decode(errors="replace") for ws in some]
            for ws, coded in zip(some, self._encode(joined)):
                ids = np.array(coded.ids, np.int64)
                starts = np.flatnonzero(self.opens[ids]).tolist()
                if len(starts) == len(ws):
                    into.update(zip(ws, (b - a for a, b in pairwise([*starts, len(ids)]))))
                else:
                    into.update(zip(ws, self._direct([b" " + w for w in ws])))


def _splits_at_blanks(spec: dict) -> bool:
    """Whether the safe boundary above holds for this tokenizer."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space"))
    added = all(t["content"].startswith("<") and " " not in t["content"] and not t["lstrip"]
                and not t["rstrip"] and not t["single_word"] for t in spec["added_tokens"])
    return (plain and added and spec.get("normalizer") is None and model["type"] == "BPE"
            and not model.get("dropout"))


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text",
                 keep: Sequence[str] | None = None, limit: int = 512) -> DataFrame:
    """``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every text, without a shuffle.

    ``path`` names a ``.json`` tokenizer or a SentencePiece ``.model`` that every worker
    can open. Null and empty texts have no bytes and no tokens; a repeated row is counted
    each time; a text may be of any length that fits a row; an empty table gives no rows.
    Results replace ``keep`` columns (all when None) of the same name.
    """
    added = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    source = docs.select(*kept, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias(TEXT))
    schema = T.StructType([*[source.schema[c] for c in kept],
                           T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in pieces(batches):
            texts = batch.column(len(kept)).to_pylist()
            sizes = [pa.array(list(map(len, texts)), pa.int64()),
                     pa.array(tokens.counts(texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *sizes],
                                             [*kept, *added[:2]])

    return source.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
