"""Cross-entropy difference scores from matched target and background n-gram models.

Both models are word bigram models over one vocabulary: all words that come at least
``least`` times in the whole corpus; rarer ones are the unknown word. The background is
counted over all documents, the target over the documents marked as such. The same words
and bigrams are kept in both and smoothed with the same weights, so a word that neither
model knows makes no difference. A document's score is the mean over its tokens of
background loss minus target loss: positive where the target explains the text better.

    p(w | v) = (c(v, w) + B p(w)) / (c(v) + B)

where c(v, w) is 0 below the floor, c(v) their sum and p(w) the smoothed share of w. The
log ratio of both models is that of p(w), plus that of c(v) + B, plus a bonus where the
bigram is kept. Every word is a context once and a word once, so a text's sum is one value
per token and one more per kept bigram.

Texts are read once and never shuffled. Documents lie in *blocks* of at most ``BLOCK``
words of a task, as word numbers. A block counts its words and bigrams once, and sends
(block, n-gram, count) to shards by hash of the n-gram, where counts add up; a hot n-gram
has one entry per block there. Shards answer each block with the totals of those of its
n-grams that reach the floor, and blocks score their documents with these answers. Values
are whole multiples of 1 / ``UNIT``, so sums do not depend on blocks or order.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.llm.frames import LARGE_ROWS, TEXT, _arrow_type, pieces, removed, stored_at
from gondola.llm.phrases import (SLICE, _dealt, _pair_shards, _rows, _small_batches, _word_shards,
                                 packed, unpacked)

BLOCK = 1 << 19  # words of a block
SHARD = 1 << 20  # entries of a shard, by their upper bound
RANGE = 1 << 16  # word numbers of a shard of values
UNIT = 1 << 20
BORDER = b""  # the end of a text is a token of its own, and the context of the first word
_BACKOFF, _FLOOR = 20.0, 0.5
_ENTRIES = "shard int, block bigint, keys binary, n binary, t binary"
_ANSWERS = "shard int, block bigint, keys binary, n binary, t binary, at binary, ranks binary"


def _few(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, in memory that goes back to the system when they are done."""
    pa.set_memory_pool(pa.system_memory_pool())
    return pieces(batches, rows)


# ---- blocks -----------------------------------------------------------------

class _Block:
    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[BORDER]  # number 0
        self.parts: list[np.ndarray] = []
        self.ids: list = []
        self.lengths: list[int] = []
        self.size = 0

    def add(self, doc, text: bytes) -> None:
        text, start, tokens = text.lower(), 0, 0
        while start < len(text):
            stop = start + SLICE
            while stop < len(text) and not text[stop:stop + 1].isspace():
                stop += 1
            words = text[start:stop].split()
            if words:
                self.parts.append(np.fromiter(map(self.number.__getitem__, words), "<u4",
                                              len(words)))
            tokens, start = tokens + len(words), stop
        if tokens:
            self.parts.append(np.zeros(1, "<u4"))
            tokens += 1
        self.ids.append(doc)
        self.lengths.append(tokens)
        self.size += tokens

    def row(self, block: int, kind: pa.DataType) -> pa.RecordBatch:
        seq = np.concatenate(self.parts) if self.parts else np.zeros(0, "<u4")
        counts = np.bincount(seq, minlength=len(self.number)).astype("<u4")
        values = [block, int(len(seq)), self.ids, packed(np.array(self.lengths, "<u4")),
                  packed(seq), b" ".join(self.number), packed(counts)]
        kinds = [pa.int64(), pa.int64(), pa.list_(kind), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds)],
            ["block", "tokens", "ids", "lengths", "seq", "words", "n"])


def text_blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Blocks of documents: ids, tokens of each, word numbers, and the words with their counts."""
    source = docs.select(F.col(doc_id).alias("_doc"),
                         F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias(TEXT))
    kind = source.schema["_doc"].dataType
    arrow = _arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(), TaskContext.get().partitionId() << 32
        for batch in _few(batches):
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc, value.as_py())
                if block.size >= BLOCK:
                    yield block.row(number, arrow)
                    block, number = _Block(), number + 1
        if block.ids:
            yield block.row(number, arrow)

    return source.mapInArrow(run, "block bigint, tokens bigint, ids array<"
                             f"{kind.simpleString()}>, lengths binary, seq binary, words binary, "
                             "n binary")


def marked_places(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """(block, marked): places of a block's target documents. Only ids are shuffled."""
    ids = blocks.select("block", F.posexplode("ids").alias("place", "_doc"))
    wanted = targets.select(F.col(targets.columns[0]).alias("_doc")).filter("_doc is not null")
    return (ids.join(wanted.distinct().hint("merge"), "_doc", "left_semi").groupBy("block")
            .agg(F.collect_list("place").alias("marked")))


# ---- counting in shards -----------------------------------------------------

def word_entries(blocks: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            block, words, counts = (c[0].as_py() for c in batch.columns)
            words, counts = words.split(b" "), unpacked(counts, "<u4")
            yield _rows(_ENTRIES, [
                (s, block, b" ".join([words[i] for i in at.tolist()]), packed(counts[at]), None)
                for s, at in _dealt(_word_shards(words, shards))])

    return blocks.select("block", "words", "n").mapInArrow(run, _ENTRIES)


def _pairs(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bigrams of known words, and for every token its bigram's number (0: none)."""
    key = np.zeros(len(seq), "<u8")
    before = np.concatenate([seq[-1:], seq[:-1]]).astype("<u8")  # a text follows a border
    both = (before != 0) & (seq != 0)
    key[both] = before[both] << np.uint64(32) | seq[both]
    keys, places = np.unique(key, return_inverse=True)
    return (keys[1:], places) if len(keys) and keys[0] == 0 else (keys, places + 1)


def _target_tokens(lengths: np.ndarray, marked: list[int] | None) -> np.ndarray:
    flags = np.zeros(len(lengths), bool)
    flags[marked or []] = True
    return np.repeat(flags, lengths)


def pair_entries(relation: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            block, seq, lengths, marked = (c[0].as_py() for c in batch.columns)
            keys, places = _pairs(unpacked(seq, "<u4"))
            wanted = _target_tokens(unpacked(lengths, "<u4"), marked)
            n, t = (np.bincount(p, minlength=len(keys) + 1)[1:].astype("<u4")
                    for p in (places, places[wanted]))
            yield _rows(_ENTRIES, [(s, block, packed(keys[at]), packed(n[at]), packed(t[at]))
                                   for s, at in _dealt(_pair_shards(keys, shards))])

    return relation.select("block", "seq", "lengths", "marked").mapInArrow(run, _ENTRIES)


def counted(entries: DataFrame, least: int, words: bool) -> DataFrame:
    """Totals of every shard: one row of what reaches the floor, and an answer for each block.

    An answer says which of the block's entries these are (``at``), and for words their
    numbers in the shard (``ranks``), for bigrams their totals (``n`` and ``t``).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in _few(batches, 1):
            row = batch.to_pylist()[0]
            if rows and row["shard"] != rows[0]["shard"]:
                yield _totals(rows, least, words)
                rows = []
            rows.append(row)
        if rows:
            yield _totals(rows, least, words)

    return (entries.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, _ANSWERS))


def _totals(rows: list[dict], least: int, words: bool) -> pa.RecordBatch:
    counts = [unpacked(r["n"], "<u4") for r in rows]
    if words:
        keys = pa.array([w for r in rows for w in r["keys"].split(b" ")], pa.binary())
        keys = keys.dictionary_encode()
        names, code = keys.dictionary.to_pylist(), keys.indices.to_numpy()
    else:
        names, code = np.unique(np.concatenate([unpacked(r["keys"], "<u8") for r in rows]),
                                return_inverse=True)
    n, t = np.zeros((2, len(names)), "<u8")
    np.add.at(n, code, np.concatenate(counts))
    if not words:
        np.add.at(t, code, np.concatenate([unpacked(r["t"], "<u4") for r in rows]))
    often = n >= least
    kept, rank = np.flatnonzero(often), (np.cumsum(often) - 1).astype("<u4")
    shard = rows[0]["shard"]
    out = []
    if len(kept):
        key = None if words else packed(np.asarray(names)[kept])
        out.append((shard, None, key, packed(n[kept]), packed(t[kept]), None, None))
    stops = np.cumsum([len(c) for c in counts])
    for r, own in zip(rows, np.split(code, stops[:-1])):
        at = np.flatnonzero(often[own])
        if not len(at):
            continue
        place = packed(at.astype("<u4"))
        if words:
            out.append((shard, r["block"], None, None, None, place, packed(rank[own[at]])))
        else:
            out.append((shard, r["block"], None, packed(n[own[at]]), packed(t[own[at]]), place,
                        None))
    return _rows(_ANSWERS, out)


def _beside(blocks: DataFrame, told: DataFrame) -> DataFrame:
    """Blocks with what they are told. Their large rows stream past a hash table, unsorted."""
    return blocks.join(told.hint("shuffle_hash"), "block", "left")


def numbered(blocks: DataFrame, answers: DataFrame, marks: DataFrame, offsets: dict[int, int],
             shards: int) -> DataFrame:
    """Blocks with the numbers of known words (0: unknown) and their target documents."""
    ids = blocks.schema["ids"].dataType
    kind = _arrow_type(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            block, lengths, seq, words, told, marked = (
                batch.column(c)[0].as_py() for c in
                ("block", "lengths", "seq", "words", "answers", "marked"))
            which = _word_shards(words.split(b" "), shards)
            number, dealt = np.zeros(len(which), "<u4"), dict(_dealt(which))
            for answer in told or []:
                at = dealt[answer["shard"]][unpacked(answer["at"], "<u4")]
                number[at] = unpacked(answer["ranks"], "<u4") + np.uint32(
                    offsets[answer["shard"]] + 1)
            out = [block, batch.column("ids")[0].as_py(), lengths,
                   packed(number[unpacked(seq, "<u4")]), marked]
            kinds = [pa.int64(), kind, pa.binary(), pa.binary(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(out, kinds)],
                ["block", "ids", "lengths", "seq", "marked"])

    told = (answers.filter("block IS NOT NULL").groupBy("block")
            .agg(F.collect_list(F.struct("shard", "at", "ranks")).alias("answers")))
    return (_beside(_beside(blocks.select("block", "ids", "lengths", "seq", "words"), told), marks)
            .mapInArrow(run, f"block bigint, ids {ids.simpleString()}, lengths binary, "
                             "seq binary, marked array<int>"))


# ---- values -----------------------------------------------------------------

def _word_totals(answers: DataFrame, offsets: dict[int, int]) -> DataFrame:
    """(id, n) of the known words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            shard, n = (c[0].as_py() for c in batch.columns)
            n = unpacked(n, "<u8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(n)) + offsets[shard] + 1, pa.int64()), pa.array(n)],
                ["id", "n"])

    return (answers.filter("block IS NULL").select("shard", "n")
            .mapInArrow(run, "id bigint, n bigint"))


def _target_words(relation: DataFrame) -> DataFrame:
    """(id, t): known words of target documents, summed per block; id 0 counts all their tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            seq, lengths, marked = (c[0].as_py() for c in batch.columns)
            own = unpacked(seq, "<u4")[_target_tokens(unpacked(lengths, "<u4"), marked)]
            ids, t = np.unique(own[own != 0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([[0], ids]).astype(np.int64)),
                 pa.array(np.concatenate([[len(own)], t]).astype(np.int64))], ["id", "t"])

    return (relation.filter("marked IS NOT NULL").select("seq", "lengths", "marked")
            .mapInArrow(run, "id bigint, t bigint").groupBy("id").agg(F.sum("t").alias("t")))


def _contexts(answers: DataFrame) -> DataFrame:
    """(id, cn, ct): kept bigrams by their first word, summed per shard before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            keys, n, t = (unpacked(c[0].as_py(), "<u8") for c in batch.columns)
            ids, place = np.unique(keys >> np.uint64(32), return_inverse=True)
            sums = np.zeros((2, len(ids)), np.int64)
            np.add.at(sums[0], place, n.astype(np.int64))
            np.add.at(sums[1], place, t.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int64)), *map(pa.array, sums)], ["id", "cn", "ct"])

    return (answers.filter("block IS NULL").select("keys", "n", "t")
            .mapInArrow(run, "id bigint, cn bigint, ct bigint").groupBy("id")
            .agg(F.sum("cn").alias("cn"), F.sum("ct").alias("ct")))


def _share(count: Column | float, total: float, size: int):
    return (count + _FLOOR) / (total + _FLOOR * size)


def values_in_blocks(relation: DataFrame, values: DataFrame) -> DataFrame:
    """(block, words): each block's known words with their values, by ranges of word numbers.

    ``values`` (id, n, t, value) and the blocks' distinct numbers meet in the range's task:
    the values of a range come first and are held, then the blocks pass by.
    """
    fields = ("shard int, block bigint, id bigint, n bigint, t bigint, value bigint, "
              "ids binary")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            ids = np.unique(unpacked(batch.column(1)[0].as_py(), "<u4"))
            ids = ids[ids != 0]
            yield _rows(fields, [
                (s, batch.column(0)[0].as_py(), None, None, None, None, packed(ids[at]))
                for s, at in _dealt(ids // np.uint32(RANGE))])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None
        for batch in _few(batches, 1 << 14):
            shards = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(shards)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)]):
                part = batch.slice(start, stop - start)
                if shards[start] != shard:
                    held, shard = [], shards[start]
                own = part.filter(part.column(1).is_null())
                if own.num_rows:
                    held.append(np.stack([own.column(c).to_numpy() for c in (2, 3, 4, 5)]))
                asked = part.filter(part.column(1).is_valid()).select([1, 6]).to_pylist()
                if not asked:
                    continue
                table = np.concatenate(held, 1)
                held = [table]
                out = []
                for row in asked:
                    ids = unpacked(row["ids"], "<u4")
                    at = np.searchsorted(table[0], ids)
                    out.append((row["block"], packed(ids), *[
                        packed(np.ascontiguousarray(table[c][at]).astype("<i8"))
                        for c in (1, 2, 3)]))
                yield _rows("block bigint, ids binary, n binary, t binary, value binary", out)

    empty = F.lit(None)
    rows = values.select(F.expr(f"id div {RANGE}").cast("int").alias("shard"),
                         empty.cast("bigint").alias("block"), "id", "n", "t", "value",
                         empty.cast("binary").alias("ids"))
    asked = relation.select("block", "seq").mapInArrow(wanted, fields)
    return (rows.unionByName(asked).repartition("shard")
            .sortWithinPartitions("shard", F.col("block").asc_nulls_first(), "id")
            .mapInArrow(told, "block bigint, ids binary, n binary, t binary, value binary")
            .groupBy("block").agg(F.collect_list(F.struct("ids", "n", "t", "value"))
                                  .alias("words")))


def _scores(blocks: DataFrame, doc_id: str, unknown: float, totals: tuple[int, int],
            size: int, shards: int) -> DataFrame:
    """Rows of documents from blocks with the values of their words and bigrams."""
    item = blocks.schema["ids"].dataType.elementType
    kind = _arrow_type(item)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 1):
            row = {c: batch.column(c)[0].as_py() for c in ("lengths", "seq", "words", "answers")}
            seq, lengths = unpacked(row["seq"], "<u4"), unpacked(row["lengths"], "<u4")
            parts = [(unpacked(w["ids"], "<u4"), *(unpacked(w[c], "<i8") for c in
                                                   ("n", "t", "value"))) for w in row["words"] or []]
            known, n, t, value = ([np.concatenate(x) for x in zip(*parts)] if parts else
                                  [np.zeros(0, "<u4"), *[np.zeros(0, np.int64)] * 3])
            order = np.argsort(known)
            known, n, t, value = known[order], n[order], t[order], value[order]
            worth = np.zeros(len(seq), np.int64)
            some = seq != 0
            place = np.searchsorted(known, seq[some])
            worth[some] = value[place]
            keys, pair = _pairs(seq)
            bonus = np.zeros(len(keys) + 1, np.int64)
            dealt = dict(_dealt(_pair_shards(keys, shards)))
            for a in row["answers"] or []:
                at = dealt[a["shard"]][unpacked(a["at"], "<u4")]
                second = np.searchsorted(known, (keys[at] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                p0 = _share(t[second].astype(float), totals[0], size)
                p1 = _share(n[second].astype(float), totals[1], size)
                c0, c1 = (unpacked(a[c], "<u8").astype(float) for c in ("t", "n"))
                bonus[at + 1] = np.rint(UNIT * (np.log((c0 + _BACKOFF * p0) / (c1 + _BACKOFF * p1))
                                                - np.log(p0 / p1))).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(worth + bonus[pair])])
            stops = np.cumsum(lengths.astype(np.int64))
            sums = sums[stops] - sums[stops - lengths]
            score = np.where(lengths > 0, unknown + sums / (float(UNIT) * np.maximum(lengths, 1)),
                             0.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("ids")[0].as_py(), kind),
                 pa.array(lengths.astype(np.int64)), pa.array(score)],
                [doc_id, "n_tokens", "score"])

    schema = T.StructType([T.StructField(doc_id, item), T.StructField("n_tokens", T.LongType()),
                           T.StructField("score", T.DoubleType())])
    return blocks.select("ids", "lengths", "seq", "words", "answers").mapInArrow(run, schema)


def _offsets(answers: DataFrame) -> dict[int, int]:
    """Number before the first word of each shard: one row per shard comes to the driver."""
    rows = (answers.filter("block IS NULL")
            .select("shard", (F.octet_length("n") / 8).cast("bigint").alias("k"))
            .orderBy("shard").collect())
    start, before = {}, 0
    for r in rows:
        start[r["shard"]] = before
        before += r["k"]
    if before >= 1 << 32:
        raise ValueError("more than 2^32 known words: raise least")
    return start


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id",
                             text: str = "text", least: int = 3) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens`` and ``score``, the mean loss difference per token.

    ``targets`` is a one-column table of target document ids, of any size; it is joined
    with the ids of ``docs`` only. Tokens are pieces without white space, A-Z
    lower-cased, and the end of the text. A null or empty text has no tokens and score
    0. Without targets, or with all documents as targets, scores hardly differ from 0.
    Rows of one id are all targets or none; a null id is never a target; ids that
    repeat in ``targets`` count once. Repeated rows count and are scored each. No documents
    give no rows. Other columns are ignored. ``least`` is the count floor of words and
    bigrams, the same for every corpus.
    """
    spark = docs.sparkSession
    with _small_batches(spark):
        blocks, blocks_path = stored_at(text_blocks(docs, doc_id, text), "lm-blocks", LARGE_ROWS)
        tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
        shards = max(1, -(-tokens // SHARD))
        answers, _ = stored_at(counted(word_entries(blocks, shards), least, True), "lm-words", LARGE_ROWS)
        offsets = _offsets(answers)
        relation, _ = stored_at(numbered(blocks, answers, marked_places(blocks, targets), offsets,
                                         shards), "lm-numbers", LARGE_ROWS)
        removed(spark, blocks_path)
        pairs, _ = stored_at(counted(pair_entries(relation, shards), least, False), "lm-pairs", LARGE_ROWS)
        target, _ = stored_at(_target_words(relation), "lm-targets")
        words = _word_totals(answers, offsets).join(target, "id", "left").join(
            _contexts(pairs), "id", "left").na.fill(0, ["t", "cn", "ct"])
        words, _ = stored_at(words, "lm-word-counts")
        size, known_n, known_t = words.agg(F.count(F.lit(1)), F.sum("n"), F.sum("t")).first()
        size += 1
        marked = target.filter("id = 0").agg(F.sum("t")).first()[0] or 0
        totals = marked, tokens
        unknown = math.log(_share(marked - (known_t or 0), marked, size)
                           / _share(tokens - (known_n or 0), tokens, size))
        ratio = F.log(_share(F.col("t"), marked, size) / _share(F.col("n"), tokens, size))
        context = F.log((F.col("cn") + _BACKOFF) / (F.col("ct") + _BACKOFF))
        value = F.round((ratio - unknown + context) * UNIT).cast("bigint")
        told = values_in_blocks(relation, words.select("id", "n", "t", value.alias("value")))
        found = (pairs.filter("block IS NOT NULL").groupBy("block")
                 .agg(F.collect_list(F.struct("shard", "n", "t", "at")).alias("answers")))
        ready = _beside(_beside(relation.select("block", "ids", "lengths", "seq"), told), found)
        return stored_at(_scores(ready, doc_id, unknown, totals, size, shards), "lm-scores")[0]
