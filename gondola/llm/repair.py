"""Token ids in grammar-compressed shards (Re-Pair), with random access.

Documents are dealt to tasks by ranges of the order columns. A task turns its
documents into ids, appends an end mark to each, and closes a shard at about
``shard_tokens`` ids. In a shard the most frequent id pairs are replaced by nonterminals,
many at a time, for a number of rounds; no pair spans two documents.

File format: Parquet, one row per shard. ``symbols`` holds ids below the vocabulary
size, the end mark (the vocabulary size itself) and nonterminals above it, as
little-endian unsigned integers of ``width`` bytes. ``rules`` holds the left and the
right symbol of each nonterminal, ``lengths`` how many ids each one expands to
(four bytes each). With the lengths a reader finds the symbol that covers any id
position, and expands only what it needs.
"""

from __future__ import annotations

import gc
import json
import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import compress as chosen

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gondola.llm.frames import TEXT

SHARD = ("part int, shard int, vocab int, width int, n_tokens bigint, doc_ids array<bigint>, "
         "symbols binary, rules binary, lengths binary")
_JOINED = 256  # words encoded in one call
_CACHED = 500_000  # words a Python worker remembers; more are encoded again
_CHUNK = 1 << 21  # bytes of text taken at a time
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum())  # ASCII punctuation
_BUCKETS = 18  # bits of the pair counting table


class Encoder:
    """Text bytes to ids (little-endian uint32 bytes), one instance per Python worker.

    Where the tokenizer ends every word with a suffix and drops white space, words
    are independent of their neighbours: each distinct word is encoded once, many at
    a time, and remembered. Other tokenizers get whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        self.vocab = self.tokenizer.get_vocab_size()
        suffix = model.get("end_of_word_suffix")
        self.by_word = bool(suffix)
        self.words: dict[bytes, bytes] = {}
        self.letters: dict[bytes, bytes] = {}
        self.signs: dict[bytes, bytes] = {b"": b""}
        if self.by_word:
            self.ends = np.zeros(self.vocab, bool)
            for token, number in self.tokenizer.get_vocab().items():
                self.ends[number] = token.endswith(suffix)

    def _ids(self, text: str) -> bytes:
        return self._numbers(text).tobytes()

    def _numbers(self, text: str) -> np.ndarray:
        """Ids without the offsets of their text, which nothing here reads."""
        found, = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return [self._ids(t.decode(errors="replace")) for t in texts]
        split = [_folded(t).split() for t in texts]
        present = set().union(*split)
        missing = present.difference(self.words)
        if missing:
            if len(self.words) > _CACHED:
                self.words, self.letters, missing = {}, {}, present
            self._learn(list(missing))
        return [b"".join(map(self.words.__getitem__, ws)) for ws in split]

    def _learn(self, missing: list[bytes]) -> None:
        """Letters are looked up without the signs after them, which are a word of their own."""
        stems = [w.rstrip(_SIGNS) for w in missing]
        plain = [s.isalpha() or not s.isascii() and s.decode(errors="replace").isalpha()
                 for s in stems]
        new = list(set(chosen(stems, plain)).difference(self.letters))
        for start in range(0, len(new), _JOINED):
            self._letters(new[start:start + _JOINED])
        words, letters, signs = self.words, self.letters, self.signs
        for word, stem, known in zip(missing, stems, plain):
            if not known:
                words[word] = self._ids(word.decode(errors="replace"))
            elif len(stem) == len(word):
                words[word] = letters[stem]
            else:
                sign = word[len(stem):]
                if sign not in signs:
                    signs[sign] = self._ids(sign.decode())
                words[word] = letters[stem] + signs[sign]

    def _letters(self, stems: list[bytes]) -> None:
        text = b" ".join(stems).decode(errors="replace")
        ids = self._numbers(text)
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) == len(stems):  # one word each, as a letter word gives one at least
            raw = ids.tobytes()
            for stem, lo, hi in zip(stems, [0, *stops], stops):
                self.letters[stem] = raw[lo:hi]
        else:
            for stem in stems:
                self.letters[stem] = self._ids(stem.decode(errors="replace"))


def _folded(text: bytes) -> bytes:
    """A-Z lower-cased, as the tokenizer does; not where a combining mark may follow a letter."""
    return text if b"\xcc" in text or b"\xcd" in text else text.lower()


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """A task has one core: handing texts to threads of the library would only cost."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def compress(symbols: np.ndarray, end: int, rounds: int = 5, per_round: int = 1024,
             least: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Replace frequent pairs, the ``per_round`` most frequent of each round together.

    Pairs are counted in hash buckets; a bucket stands for one of its pairs, others in
    it wait for a later round. Returns the shortened symbols and the (left, right) rules; rule k stands for
    symbol ``end + 1 + k``. Pairs with the end mark are never replaced. In a run of
    overlapping pairs every second one is, from the left.
    """
    seq, rules = symbols.astype(np.uint32), np.empty((0, 2), np.uint32)
    for _ in range(rounds):
        if len(seq) < 2:
            break
        left, right = seq[:-1], seq[1:]
        bucket = (left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)) >> np.uint32(
            32 - _BUCKETS)
        bucket[(left == end) | (right == end)] = 0
        counts = np.bincount(bucket, minlength=1 << _BUCKETS)
        counts[0] = 0  # pairs that fall here by chance stay as they are
        floor = max(least, int(np.partition(counts, -per_round)[-per_round]))
        at = np.flatnonzero(counts[bucket] >= floor)
        if not len(at):
            break
        # one pair stands for a bucket: the last one in it
        keys, slot = left[at].astype(np.uint64) << np.uint64(32) | right[at], bucket[at]
        chosen = np.zeros(1 << _BUCKETS, np.uint64)
        chosen[slot] = keys
        hit = chosen[slot] == keys
        at, slot = at[hit], slot[hit]
        counts = np.bincount(slot, minlength=1 << _BUCKETS)
        kept = np.flatnonzero(counts >= least)
        if not len(kept):
            break
        number = np.full(1 << _BUCKETS, -1, np.int64)
        number[kept] = np.arange(len(kept))
        place = number[slot]
        at, place, pairs = at[place >= 0], place[place >= 0], chosen[kept]
        order = np.arange(len(at))
        opens = np.concatenate([[True], at[1:] != at[:-1] + 1])
        keep = (order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0
        at, place = at[keep], place[keep]
        seq[at] = end + 1 + len(rules) + place
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        seq = seq[stays]
        rules = np.concatenate([rules, np.stack(
            [pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)])
    return seq, rules


def rule_lengths(rules: np.ndarray, end: int) -> np.ndarray:
    """Ids that each rule expands to; a rule only refers to rules before it."""
    lengths: list[int] = []
    for left, right in rules.tolist():
        lengths.append((lengths[left - end - 1] if left > end else 1)
                       + (lengths[right - end - 1] if right > end else 1))
    return np.array(lengths, np.uint32)


def expand(seq: np.ndarray, rules: np.ndarray, end: int,
           lengths: np.ndarray | None = None) -> np.ndarray:
    """All ids of the symbols.

    Every pass expands the outermost nonterminals. With the ``lengths`` of the rules the
    nonterminals that occur are expanded once, and what they stand for is copied to all
    their places, which pays for many symbols.
    """
    if lengths is not None:
        deep = seq > end
        used, which = _distinct(seq[deep] - (end + 1), len(rules))
        text = expand(used + np.uint32(end + 1), rules, end)
        size = np.ones(len(seq), np.int64)
        size[deep] = lengths[used][which]
        flat = np.concatenate([seq, text])  # a plain symbol is its own text
        opens = np.arange(len(seq))
        opens[deep] = len(seq) + (np.cumsum(lengths[used], dtype=np.int64) - lengths[used])[which]
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        return flat[np.repeat(opens - after + size, size) + np.arange(total)]
    while True:
        deep = seq > end
        if not deep.any():
            return seq
        out = np.empty(len(seq) + int(deep.sum()), np.uint32)
        at = np.cumsum(deep) + np.arange(len(seq)) - deep
        out[at[~deep]] = seq[~deep]
        pair = rules[seq[deep] - end - 1]
        out[at[deep]] = pair[:, 0]
        out[at[deep] + 1] = pair[:, 1]
        seq = out


def _distinct(rule: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rules that occur, ascending, and for every occurrence its place among them."""
    seen = np.zeros(n, bool)
    seen[rule] = True
    return np.flatnonzero(seen).astype(np.uint32), (np.cumsum(seen) - 1)[rule]


class Shard:
    """One stored row: whole decoding, one document, or a range of id positions."""

    def __init__(self, row: dict):
        self.end, self.doc_ids, self.n_tokens = row["vocab"], row["doc_ids"], row["n_tokens"]
        self.symbols = np.frombuffer(row["symbols"], f"<u{row['width']}").astype(np.uint32)
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], "<u4")

    def decode(self, end_id: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, and where each document stops."""
        ids = expand(self.symbols, self.rules, self.end, self.lengths)
        stops = np.flatnonzero(ids == self.end) + 1
        return np.where(ids == self.end, np.uint32(end_id), ids).astype("<u4"), stops

    def range(self, start: int, stop: int, end_id: int = 1) -> np.ndarray:
        """The ids at positions [start, stop), expanding only the symbols that cover them."""
        deep = self.symbols > self.end
        size = np.ones(len(self.symbols), np.int64)
        size[deep] = self.lengths[self.symbols[deep] - self.end - 1]
        after = np.cumsum(size)
        lo = int(np.searchsorted(after, start, "right"))
        hi = int(np.searchsorted(after, stop, "left")) + 1
        skip = start - (int(after[lo - 1]) if lo else 0)
        ids = expand(self.symbols[lo:hi], self.rules, self.end)[skip:skip + max(0, stop - start)]
        return np.where(ids == self.end, np.uint32(end_id), ids).astype("<u4")

    def document(self, k: int, end_id: int = 1) -> np.ndarray:
        """The k-th document: it lies between two end marks."""
        marks = np.flatnonzero(self.symbols == self.end)
        part = self.symbols[(marks[k - 1] + 1 if k else 0):marks[k] + 1]
        ids = expand(part, self.rules, self.end)
        return np.where(ids == self.end, np.uint32(end_id), ids).astype("<u4")


def _shard(part: int, number: int, vocab: int, docs: list, texts: list[bytes]) -> pa.RecordBatch:
    mark = np.uint32(vocab).tobytes()
    ids = np.frombuffer(mark.join(texts) + mark, "<u4")
    symbols, rules = compress(ids, vocab)
    width = 2 if vocab + len(rules) < 1 << 16 else 4
    row = {"part": part, "shard": number, "vocab": vocab, "width": width, "n_tokens": len(ids),
           "doc_ids": docs, "symbols": symbols.astype(f"<u{width}").tobytes(),
           "rules": rules.astype("<u4").tobytes(),
           "lengths": rule_lengths(rules, vocab).astype("<u4").tobytes()}
    kinds = [pa.int32()] * 4 + [pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)],
                                      list(row))


def write_shards(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id",
                 text: str = "text", order: Sequence[str] | None = None,
                 shard_tokens: int = 1 << 20) -> None:
    """Write the ids of all documents in ascending ``order`` (``doc_id`` when None).

    A null or empty text is an end mark alone. Rows without id come first and keep a
    null id; repeated rows are written again. A text longer than a shard is a shard
    of its own. No documents write no shard. Other columns are ignored.
    """
    order = list(order or [doc_id])
    rows = (docs.select(*order, F.col(doc_id).cast("bigint").alias("_doc"),
                        F.col(text).cast("binary").alias(TEXT))
            .repartitionByRange(*order).sortWithinPartitions(*order, TEXT)
            .select("_doc", TEXT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, coder = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        docs, coded, size = [], [], 0
        gc.disable()  # nothing here forms cycles, and the word table is large to walk
        for ids, texts in _chunks(batches):
            for doc, value in zip(ids, coder.encode(texts)):
                if docs and size + len(value) // 4 + 1 > shard_tokens:
                    yield _shard(part, number, coder.vocab, docs, coded)
                    docs, coded, size, number = [], [], 0, number + 1
                docs.append(doc)
                coded.append(value)
                size += len(value) // 4 + 1
        if docs:
            yield _shard(part, number, coder.vocab, docs, coded)

    rows.mapInArrow(run, SHARD).write.parquet(path)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc)
            texts.append(value.as_py() or b"")
            size += len(texts[-1])
            if size > _CHUNK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def read_shards(spark: SparkSession, path: str, end_id: int = 1) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, decoded from the files.

    Shards before a shard are summed per part first, so the ordered sum over all
    parts sees one row per part.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy(F.col("part").alias("_p")).agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = (Window.partitionBy("part").orderBy("shard")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (sizes.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(bases, F.col("part") == F.col("_p"))
              .select(F.col("part").alias("_p"), F.col("shard").alias("_s"),
                      (F.col("_base") + F.col("_in")).alias("_start")))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                ids, stops = Shard(row).decode(end_id)
                starts = np.concatenate([[0], stops[:-1]])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
                same = [np.full(len(stops), row[c], np.int32) for c in ("part", "shard")]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, same), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts), pa.array(stops - starts), pa.array(crc, pa.int64())],
                    ["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    decoded = shards.mapInArrow(run, "part int, shard int, doc_id bigint, at bigint, "
                                     "n_tokens bigint, ids_crc32 bigint")
    # the decoded rows meet their shard's start, so symbols are not shuffled
    return (decoded.join(starts, (F.col("part") == F.col("_p")) & (F.col("shard") == F.col("_s")))
            .select("doc_id", (F.col("_start") + F.col("at")).alias("start"), "n_tokens",
                    "ids_crc32"))
