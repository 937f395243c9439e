"""Phrases that are more than their parts, mined level by level over stored relations (SETM).

The occurrence relation of length 1 holds every word with its place. It is stored in
*blocks* (documents of one language, at most ``BLOCK`` words of one task): a row is the
block's part of the relation, sorted by piece and position, as one array of group numbers
in which 0 stands where a piece ends. Two occurrences are adjacent in a piece where
neither is 0, so the merge join by piece and next position is one walk along the array.

Each length repeats the same steps:

1. group-count: every block counts its groups once, (block, group, count) is dealt to
   shards by hash of the group and added up. A hot group has one entry per block there;
2. frequent groups get numbers; each shard tells every block which of its groups stay;
3. semi-join: blocks meet those answers, infrequent occurrences become 0 and the relation
   is stored with the new numbers;
4. extension: the merge join of the stored relation with itself gives the next length,
   as pairs (group at a place, group at the next place): both parts are frequent.

Everything but the frequent groups themselves stays in blocks or shards of bounded size.
Words are compared as bytes and groups as numbers, so counts are exact. Cuts, scores and
containment are DataFrame joins over the frequent groups.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gondola.llm.frames import TEXT, pieces, removed, stored_at

BLOCK = 1 << 20  # words that a task holds before it closes its largest block
SLICE = 1 << 20  # bytes of one text taken at a time
SHARD = 1 << 20  # entries of a shard, by their upper bound
PARTS = 64  # parts of a language that are ranked apart before they meet
GAP = b"\xff"  # no byte of UTF-8: marks the end of a piece
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _BREAKS + b"\t",
                         bytes(range(97, 123)) + GAP * len(_BREAKS) + b" ")
_OCCURRENCES = "lang string, block bigint, n bigint, seq binary, words binary, counts binary"
_ENTRIES = "lang string, shard int, block bigint, keys binary, counts binary"
_ANSWERS = ("lang string, shard int, block bigint, keys binary, totals binary, "
            "at binary, ranks binary")


# ---- arrays in rows ---------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Bytes of an array, place by place, so that equal high bytes lie together."""
    return np.ascontiguousarray(values.view("u1").reshape(-1, values.itemsize).T).tobytes()


def unpacked(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(raw, "u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _rows(fields: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(),
             "binary": pa.binary()}
    names, types = zip(*(f.split() for f in fields.split(", ")))
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[t]) for c, t in zip(columns, types)], list(names))


def _without_runs(seq: np.ndarray) -> np.ndarray:
    """One 0 in place of several."""
    keep = seq != 0
    keep[1:] |= seq[:-1] != 0
    return seq[keep]


# ---- length 1: words in blocks ----------------------------------------------

class _Block:
    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[GAP]  # number 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> int:
        text, start, added = text.translate(_TABLE), 0, 0
        while start < len(text):
            stop = start + SLICE
            if stop < len(text):  # go on to the end of the word
                ends = [e for e in (text.find(b" ", stop), text.find(GAP, stop)) if e >= 0]
                stop = min(ends, default=len(text))
            words = text[start:stop].replace(GAP, b" " + GAP + b" ").split()
            self.parts.append(np.fromiter(map(self.number.__getitem__, words), "<u4", len(words)))
            added += len(words)
            start = stop
        self.parts.append(np.zeros(1, "<u4"))
        self.size += added
        return added

    def row(self, lang: str, block: int) -> tuple:
        seq = _without_runs(np.concatenate(self.parts))
        counts = np.bincount(seq, minlength=len(self.number))[1:].astype("<u4")
        words = GAP.join(list(self.number)[1:])
        return lang, block, int(counts.sum()), packed(seq), words, packed(counts)


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The relation of all words: a row per block with its words, their counts and places."""
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias(TEXT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, held, number = defaultdict(_Block), 0, TaskContext.get().partitionId() << 32
        for batch in pieces(batches):
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                held += open_[name].add(value.as_py())
                if held >= BLOCK:
                    name = max(open_, key=lambda k: open_[k].size)
                    block = open_.pop(name)
                    held -= block.size
                    yield _rows(_OCCURRENCES, [block.row(name, number)])
                    number += 1
        for name in list(open_):
            yield _rows(_OCCURRENCES, [open_.pop(name).row(name, number)])
            number += 1

    return source.mapInArrow(run, _OCCURRENCES)


def _words(raw: bytes) -> list[bytes]:
    return raw.split(GAP) if raw else []


# ---- groups of a block, and their shards ------------------------------------

def adjacent(seq: np.ndarray) -> np.ndarray:
    """Merge join with the next place of the piece: pairs of groups, 0 where there is none."""
    key = np.zeros(len(seq), "<u8")
    left, right = seq[:-1].astype("<u8"), seq[1:]
    both = (left != 0) & (right != 0)
    key[:-1][both] = left[both] << np.uint64(32) | right[both]
    return key


def _pair_groups(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, their counts, and for every place its pair's number (0: none)."""
    key = adjacent(seq)
    keys, places, counts = np.unique(key, return_inverse=True, return_counts=True)
    if len(keys) and keys[0] == 0:
        return keys[1:], counts[1:], places
    return keys, counts, places + 1


def _word_shards(words: list[bytes], shards: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), "<u8", len(words)) % np.uint64(shards)


def _pair_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)) % np.uint64(shards)


def _dealt(which: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, entries of the block in it), in the order of the block's groups."""
    order = np.argsort(which, kind="stable")
    cuts = np.flatnonzero(np.diff(which[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(which[part[0]]), part


def word_entries(table: DataFrame, shards: dict[str, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            lang, block, raw, counts = (c[0].as_py() for c in batch.columns)
            words, counts = _words(raw), unpacked(counts, "<u4")
            yield _rows(_ENTRIES, [
                (lang, s, block, GAP.join([words[i] for i in at.tolist()]), packed(counts[at]))
                for s, at in _dealt(_word_shards(words, shards[lang]))])

    return table.select("lang", "block", "words", "counts").mapInArrow(run, _ENTRIES)


def pair_entries(relation: DataFrame, shards: dict[str, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            lang, block, seq = (c[0].as_py() for c in batch.columns)
            keys, counts, _ = _pair_groups(unpacked(seq, "<u4"))
            counts = counts.astype("<u4")
            yield _rows(_ENTRIES, [(lang, s, block, packed(keys[at]), packed(counts[at]))
                                   for s, at in _dealt(_pair_shards(keys, shards[lang]))])

    return relation.select("lang", "block", "seq").mapInArrow(run, _ENTRIES)


def counted(entries: DataFrame, least: int, words: bool, answers: bool = True) -> DataFrame:
    """Totals of every shard: a row of its frequent groups, and a row for each block it answers.

    Shards are dealt by hash and sorted, so a task takes one shard after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in pieces(batches, 1):
            row = batch.to_pylist()[0]
            if rows and (row["lang"], row["shard"]) != (rows[0]["lang"], rows[0]["shard"]):
                yield _totals(rows, least, words, answers)
                rows = []
            rows.append(row)
        if rows:
            yield _totals(rows, least, words, answers)

    return (entries.repartition("lang", "shard").sortWithinPartitions("lang", "shard")
            .mapInArrow(run, _ANSWERS))


def _totals(rows: list[dict], least: int, words: bool, answers: bool) -> pa.RecordBatch:
    counts = [unpacked(r["counts"], "<u4") for r in rows]
    if words:
        keys = pa.array([w for r in rows for w in _words(r["keys"])], pa.binary())
        keys = keys.dictionary_encode()
        names, code = keys.dictionary.to_pylist(), keys.indices.to_numpy()
    else:
        names, code = np.unique(np.concatenate([unpacked(r["keys"], "<u8") for r in rows]),
                                return_inverse=True)
    totals = np.zeros(len(names), "<u8")
    np.add.at(totals, code, np.concatenate(counts))
    often = totals >= least
    rank = (np.cumsum(often) - 1).astype("<u4")
    lang, shard = rows[0]["lang"], rows[0]["shard"]
    kept = np.flatnonzero(often)
    key = (GAP.join([names[i] for i in kept.tolist()]) if words
           else packed(np.asarray(names)[kept]))
    out = [(lang, shard, None, key, packed(totals[kept]), None, None)] if len(kept) else []
    if answers:
        stops = np.cumsum([len(c) for c in counts])
        for r, own in zip(rows, np.split(code, stops[:-1])):
            at = np.flatnonzero(often[own])
            if len(at):
                out.append((lang, shard, r["block"], None, None, packed(at.astype("<u4")),
                            packed(rank[own[at]])))
    return _rows(_ANSWERS, out)


def kept_places(relation: DataFrame, answers: DataFrame, offsets: dict[tuple[str, int], int],
                shards: dict[str, int], words: bool) -> DataFrame:
    """The semi-join: places of frequent groups under their numbers, others 0.

    A block's answers are at most one number per group of the block. Blocks without any
    frequent group have nothing to extend and go.
    """
    fields = "lang string, block bigint, n bigint, seq binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            row = batch.to_pylist()[0]
            seq, lang = unpacked(row["seq"], "<u4"), row["lang"]
            if words:
                which = _word_shards(_words(row["words"]), shards[lang])
            else:
                keys, _, seq = _pair_groups(seq)
                which = _pair_shards(keys, shards[lang])
            number, dealt = np.zeros(len(which) + 1, "<u4"), dict(_dealt(which))
            for answer in row["answers"]:
                shard = answer["shard"]
                at = dealt[shard][unpacked(answer["at"], "<u4")]
                number[at + 1] = unpacked(answer["ranks"], "<u4") + np.uint32(
                    offsets[lang, shard] + 1)
            seq = _without_runs(number[seq])
            yield _rows(fields, [(lang, row["block"], int((seq != 0).sum()), packed(seq))])

    columns = ["lang", "block", "seq", *(["words"] if words else [])]
    told = (answers.filter("block IS NOT NULL").groupBy("block")
            .agg(F.collect_list(F.struct("shard", "at", "ranks")).alias("answers")))
    return relation.select(*columns).join(told, "block").mapInArrow(run, fields)


# ---- frequent groups as rows ------------------------------------------------

def _groups(answers: DataFrame, offsets: dict[tuple[str, int], int], words: bool) -> DataFrame:
    """(lang, id, word, f) or (lang, id, first, second, f) of the frequent groups."""
    fields = ("lang string, id bigint, word binary, f bigint" if words
              else "lang string, id bigint, first bigint, second bigint, f bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            lang, shard, raw, totals = (c[0].as_py() for c in batch.columns)
            totals = unpacked(totals, "<u8").astype(np.int64)
            ids = np.arange(len(totals)) + offsets[lang, shard] + 1
            if words:
                values = [pa.array(_words(raw), pa.binary())]
            else:
                keys = unpacked(raw, "<u8")
                values = [pa.array((keys >> np.uint64(32)).astype(np.int64)),
                          pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ids)), pa.array(ids, pa.int64()), *values,
                 pa.array(totals)], [f.split()[0] for f in fields.split(", ")])

    return (answers.filter("block IS NULL").select("lang", "shard", "keys", "totals")
            .mapInArrow(run, fields))


def _offsets(answers: DataFrame) -> dict[tuple[str, int], int]:
    """Number before the first group of each shard: one row per shard comes to the driver."""
    size = F.octet_length("totals") / 8
    rows = (answers.filter("block IS NULL").select("lang", "shard", size.cast("bigint").alias("n"))
            .orderBy("lang", "shard").collect())
    start, before = {}, defaultdict(int)
    for r in rows:
        start[r["lang"], r["shard"]] = before[r["lang"]]
        before[r["lang"]] += r["n"]
    if max(before.values(), default=0) >= 1 << 32:
        raise ValueError("more than 2^32 frequent groups of one length in a language: raise least")
    return start


def _shards(sizes: DataFrame) -> dict[str, int]:
    """Shards of each language, from an upper bound ``n`` of its entries."""
    return {r["lang"]: max(1, -(-int(r["n"] or 0) // SHARD)) for r in sizes.collect()}


@contextmanager
def _small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Rows hold megabytes here: few of them go to a worker at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, text: str = "text",
                     lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words that occur ``least`` times, and words per language.

    The first frame has ``lang``, ``words`` (array of binary) and ``f``; the second has
    ``lang`` and ``n``. Both read stored tables; relations are removed when the next
    length is stored.
    """
    spark = docs.sparkSession
    with _small_batches(spark):
        return _levels(docs, longest, least, text, lang)


def _levels(docs: DataFrame, longest: int, least: int, text: str,
            lang: str) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    relation, path = stored_at(occurrences(docs, text, lang), "phrase-words")
    totals = relation.groupBy("lang").agg(F.sum("n").alias("n"))
    totals, _ = stored_at(totals, "phrase-totals")
    shards = _shards(totals)
    answers, _ = stored_at(counted(word_entries(relation, shards), least, True,
                                   longest > 1), "phrase-counts-1")
    offsets = _offsets(answers)
    level = _groups(answers, offsets, True).select("lang", "id", F.array("word").alias("words"), "f")
    level, _ = stored_at(level, "phrase-groups-1")
    found = level.drop("id")
    for length in range(2, longest + 1):
        kept, kept_path = stored_at(
            kept_places(relation, answers, offsets, shards, length == 2), f"phrases-{length - 1}")
        removed(spark, path)
        relation, path = kept, kept_path
        shards = _shards(relation.groupBy("lang").agg(F.sum("n").alias("n")))
        answers, _ = stored_at(counted(pair_entries(relation, shards), least, False,
                                       length < longest), f"phrase-counts-{length}")
        offsets = _offsets(answers)
        level = _joined(_groups(answers, offsets, False), level)
        level, _ = stored_at(level, f"phrase-groups-{length}")
        found = found.unionByName(level.drop("id"))
    removed(spark, path)
    return found, totals


def _joined(pairs: DataFrame, level: DataFrame) -> DataFrame:
    """Words of a longer phrase: all of its first part, and the last of its second."""
    first = level.select("lang", F.col("id").alias("first"), F.col("words").alias("_w"))
    last = level.select("lang", F.col("id").alias("second"),
                        F.slice("words", -1, 1).alias("_last"))
    return (pairs.join(first, ["lang", "first"]).join(last, ["lang", "second"])
            .select("lang", "id", F.concat("_w", "_last").alias("words"), "f"))


# ---- scores -----------------------------------------------------------------

def scored(found: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut of lowest score (ties: the shortest first part).

    The score is floor(10^6 a^2 / (l r)), in whole numbers of up to 38 digits.
    """
    phrases = found.filter(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = phrases.select("lang", "words", "a",
                          F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    left = found.select("lang", F.col("words").alias("_left"), F.col("f").alias("l"))
    right = found.select("lang", F.col("words").alias("_right"), F.col("f").alias("r"))
    cuts = (cuts.withColumns({"_left": F.slice("words", F.lit(1), F.col("k")),
                              "_right": F.expr("slice(words, k + 1, size(words) - k)")})
            .join(left, ["lang", "_left"]).join(right, ["lang", "_right"]))
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) "
                   "* cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) "
                   "* cast(r as decimal(15,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (cuts.groupBy("lang", "words", "a").agg(best.alias("b"))
            .select("lang", "words", "a", "b.l", "b.r", "b.score"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000,
                 contained: tuple[int, int] = (50, 100), text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's best.

    A phrase goes when it lies inside a longer candidate that occurs in ``contained`` (a
    share, as numerator and denominator) of its own occurrences or more. Null texts have no
    words, a null language is ``und``, repeated rows count each time, equal scores go by
    count and phrase; an empty table, or one without frequent phrases, gives no rows. Texts
    of any length that fit a row are read whole; other columns play no part.
    """
    found, totals = frequent_phrases(docs, longest, least, text, lang)
    num, den = contained
    phrases = found.filter(F.size("words") > 1)
    inside = F.expr("""flatten(transform(sequence(2, size(words) - 1), m ->
        transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))""")
    covers = (phrases.filter(F.size("words") > 2)
              .select("lang", F.explode(inside).alias("words"), F.col("f").alias("_longer"))
              .groupBy("lang", "words").agg(F.max("_longer").alias("_longer")))
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", "_part").orderBy(*best)  # the best of parts of a language
    order = Window.partitionBy("lang").orderBy(*best)
    phrase = F.array_join(F.transform("words", lambda w: w.cast("string")), " ")
    return (scored(found).join(covers, ["lang", "words"], "left")
            .filter(F.col("_longer").isNull() | (den * F.col("_longer") < num * F.col("a")))
            .withColumn("phrase", phrase)
            .withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
            .withColumn("_place", F.row_number().over(part)).filter(F.col("_place") <= top)
            .withColumn("rank", F.row_number().over(order).cast("bigint"))
            .filter(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
