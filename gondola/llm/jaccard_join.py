"""N-gram Jaccard self-join with a prefix tree, and its connected documents.

1. A document is the set of hashes of its word n-grams. Equal sets are one class; its
   smallest document stands for it.
2. N-grams have one global order, rare ones first: by the document frequency of their
   rarest word (counted over all documents, the most frequent words are kept), then by
   hash. Two sets that link share an n-gram among the first ``size - least overlap + 1``
   of both (fewer for the smaller set: its core), so only these are shuffled.
3. The documents that share such an n-gram, one of them in its core, form a bucket (several
   where sizes between them are too far apart to link);
   each bucket has a pivot, and all buckets of a pivot are one cluster. Every link lies
   inside a cluster.
4. A cluster of bounded size is joined in one task: its sets are stored in a trie, a
   probe walks the trie and shares partial overlaps between sets with a common start,
   and a subtree goes when what remains of it cannot reach the threshold, or when it
   is linked with the probe already.
5. A larger cluster is never brought together. Its members are compared with the pivot;
   those that link are connected through it, and no pair of them is looked at again.
   Jaccard distance is a metric, so a linked member can only link with others that are
   within twice the distance of the pivot: the ring. The ring meets the linked members
   in blocks, as differences from the pivot (differences of differences are those of the
   sets), and the unlinked members meet each other in blocks, each pair of blocks in a
   trie of its own. No pairs are listed.
6. Links are joined into components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.components import components
from gondola.llm.frames import TEXT, marked, pieces, removed, stored, stored_at

COMMON_WORDS = 1 << 20  # words with a known frequency; the others count as rare
CLUSTER_ROWS = 1000  # members that one task joins in one trie
CLUSTER_BYTES = 32 << 20  # and their items

_word_hash = xxhash.xxh3_64_intdigest
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _words(text: bytes | None) -> np.ndarray:
    return np.array([_word_hash(w) for w in text.lower().split()] if text else [], np.uint64)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n-gram; of the whole sequence when it is shorter."""
    width = min(n, len(words))
    count = len(words) - width + 1 if width else 0
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = (out ^ words[k:k + count]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def prefix_size(size: int, num: int, den: int) -> int:
    """N-grams of which a set shares one with every set it links with."""
    return size - -(-size * num // den) + 1


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc"),
                       F.col(text).cast("binary").alias(TEXT))


def common_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document frequency of the most frequent words, in hash order."""
    def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        words, place = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return words, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            for piece in pieces([batch]):
                sets = [np.unique(_words(t.as_py())) for t in piece.column(1)]
                words, n = np.unique(np.concatenate(sets), return_counts=True)
                parts = [merged([*parts, (words, n)])]
            for words, n in parts:
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)],
                                                 ["word", "n"])

    top = (docs.mapInArrow(run, "word bigint, n bigint").groupBy("word")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(COMMON_WORDS).toArrow())
    words = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], np.minimum(top["n"].to_numpy()[order], 2 ** 31 - 1).astype(np.int32)


def _heads(docs: DataFrame, n: int, num: int, den: int, common) -> DataFrame:
    """(doc, size, s1, s2, prefix): set size, set hash and prefix n-grams of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def one(text: bytes | None) -> tuple:
        words = _words(text)
        if not len(words):
            return 0, None, None, None
        table, counts = shared.value
        freq = np.zeros(len(words), np.int64)
        if len(table):
            at = np.minimum(np.searchsorted(table, words), len(table) - 1)
            freq = np.where(table[at] == words, counts[at], 0)
        found = shingles(words, n)
        rare = freq[:len(found)].copy()
        for k in range(1, min(n, len(words))):
            np.minimum(rare, freq[k:k + len(found)], out=rare)
        found, first = np.unique(found, return_index=True)
        size = len(found)
        s1, s2 = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
        order = np.argsort(rare[first], kind="stable")[:prefix_size(size, num, den)]
        return size, int(s1), int(s2), found[order].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            size, s1, s2, prefix = list(zip(*[one(t.as_py()) for t in batch.column(1)])) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))],
                ["doc", "size", "s1", "s2", "prefix"])

    return docs.mapInArrow(run, "doc bigint, size bigint, s1 bigint, s2 bigint, "
                                "prefix array<bigint>")


def _sets(docs: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """(pivot, doc, size, items) of members; items are sorted hashes as bytes.

    A document meets the list of its clusters (as many as its prefix at most). Only
    texts that a bitmap of the members does not rule out are shuffled.
    """
    wanted = members.groupBy("doc").agg(
        F.collect_list("pivot").alias("pivots"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [np.unique(shingles(_words(t.as_py()), n)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([len(x) for x in found], pa.int64()),
                 pa.array([x.tobytes() for x in found], pa.binary())],
                ["doc", "pivots", "size", "items"])

    near = marked(docs, "doc", members).filter("_maybe").drop("_maybe")
    sets = (near.join(wanted.hint("merge"), "doc").select("doc", "pivots", TEXT)
            .mapInArrow(run, "doc bigint, pivots array<bigint>, size bigint, items binary"))
    return sets.select(F.explode("pivots").alias("pivot"), "doc", "size", "items")


# ---- clusters -------------------------------------------------------------

def _clusters(tokens: DataFrame) -> DataFrame:
    """(pivot, doc) from (doc, token, core, width) rows.

    Sets that link are of the same or of adjacent widths, so a bucket ends where a width
    is missing. Buckets of one document, or without a core one, hold no link. The pivot is
    the core document of least hash, so it is the same in most buckets of a group.
    """
    spark = tokens.sparkSession
    # one row per width of a token: a window holds few rows, however frequent the token is
    by_width = Window.partitionBy("token").orderBy("width")
    widths = (tokens.groupBy("token", "width").agg(F.count(F.lit(1)).alias("n"),
                                                   F.max("core").alias("c"))
              .withColumn("gap", F.col("width") - F.lag("width").over(by_width) > 1)
              .withColumn("part", F.count_if("gap").over(by_width)))
    whole = Window.partitionBy("token", "part")
    several, buckets = stored_at(
        widths.withColumns({"all": F.sum("n").over(whole), "any": F.max("c").over(whole)})
        .filter("all > 1 and any").select("token", "width", "part"), "buckets")
    shared, tokens_at = stored_at(tokens.join(several.hint("merge"), ["token", "width"])
                                  .select("doc", "token", "part", "core"), "shared-tokens")
    removed(spark, buckets)
    first = F.struct((~F.col("core")).alias("o"), F.xxhash64("doc").alias("h"), "doc")
    pivots, pivots_at = stored_at(shared.groupBy("token", "part")
                                  .agg(F.min(first)["doc"].alias("pivot")), "pivots")
    members = stored(shared.join(pivots.hint("merge"), ["token", "part"]).select("pivot", "doc")
                     .distinct(), "members")
    removed(spark, tokens_at)
    removed(spark, pivots_at)
    return members


class _Node:
    __slots__ = ("part", "below", "least", "rest", "member", "children")

    def __init__(self, part: np.ndarray, least: int, rest: int, member: int):
        self.part, self.least, self.rest, self.member = part, least, rest, member
        self.below: list[int] = []  # sets that end here
        self.children: dict[int, _Node] = {}


class Trie:
    """Sets of ranks in one order, with shared starts; probes find the sets that link.

    ``weight`` of a set is (num + den) * items - (den - num) * size: two sets link when
    2 * (num + den) * overlap reaches the sum of their weights.
    """

    def __init__(self, universe: int, num: int, den: int, parents: list[int]):
        self.scale, self.universe, self.parents = 2 * (num + den), universe, parents
        self.root = _Node(np.empty(0, np.int64), 0, 0, -1)
        self.weights: dict[int, int] = {}

    def find(self, k: int) -> int:
        while self.parents[k] != k:
            self.parents[k] = self.parents[self.parents[k]]
            k = self.parents[k]
        return k

    def probe(self, member: int, ranks: np.ndarray, weight: int) -> None:
        """Join ``member`` with every stored set it links with, directly or not."""
        inside = np.zeros(self.universe + 1, np.int64)
        inside[ranks] = 1
        upto = np.cumsum(inside)
        total = int(upto[-1])
        stack = [(node, 0) for node in self.root.children.values()]
        for other in self.root.below:
            self._join(member, other, 0, weight)
        while stack:
            node, overlap = stack.pop()
            if node.member >= 0 and self.find(node.member) == self.find(member):
                continue
            overlap += int(inside[node.part].sum())
            left = min(node.rest, total - int(upto[node.part[-1]]))
            if self.scale * (overlap + left) < weight + node.least:
                continue
            for other in node.below:
                self._join(member, other, overlap, weight)
            stack.extend((child, overlap) for child in node.children.values())

    def _join(self, member: int, other: int, overlap: int, weight: int) -> None:
        if self.scale * overlap >= weight + self.weights[other]:
            a, b = self.find(member), self.find(other)
            self.parents[max(a, b)] = min(a, b)

    def insert(self, member: int, ranks: np.ndarray, weight: int) -> None:
        self.weights[member] = weight
        node, at = self.root, 0
        while at < len(ranks):
            child = node.children.get(int(ranks[at]))
            if child is None:
                child = _Node(ranks[at:], weight, 0, member)
                node.children[int(ranks[at])] = child
                child.below.append(member)
                return
            width = min(len(child.part), len(ranks) - at)
            differ = np.flatnonzero(child.part[:width] != ranks[at:at + width])
            same = int(differ[0]) if len(differ) else width
            if same < len(child.part):
                head = _Node(child.part[:same], child.least,
                             child.rest + len(child.part) - same, child.member)
                child.part = child.part[same:]
                head.children[int(child.part[0])] = child
                node.children[int(ranks[at])] = head
                child = head
            at += same
            child.least = min(child.least, weight)
            child.rest = max(child.rest, len(ranks) - at)
            if child.member >= 0 and self.find(child.member) != self.find(member):
                child.member = -1  # sets of several components below
            node = child
        node.below.append(member)


BOTH, STORE, PROBE, LINKED = range(4)  # roles of a set in a join; linked ones also probe


def join_cluster(docs: Sequence[int], sizes: Sequence[int], items: Sequence[bytes],
                 roles: Sequence[int], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect the linked sets of one join, as (document, least document).

    Probing sets meet the stored ones; those with role ``LINKED`` are connected already.
    """
    sets = [np.frombuffer(x, np.uint64) for x in items]
    values, n = np.unique(np.concatenate(sets), return_counts=True)
    shared = np.flatnonzero(n > 1)  # an item of one member is in no overlap
    rank = np.full(len(values), -1, np.int64)
    rank[shared[np.argsort(-n[shared], kind="stable")]] = np.arange(len(shared))
    order = sorted(range(len(docs)), key=lambda k: (docs[k], sizes[k]))
    parents = list(range(len(docs)))
    together = [place for place, k in enumerate(order) if roles[k] == LINKED]
    for place in together:
        parents[place] = together[0]
    trie = Trie(len(shared), num, den, parents)
    for step in (STORE, PROBE):
        for place, k in enumerate(order):
            if step == STORE and roles[k] not in (BOTH, STORE):
                continue
            if step == PROBE and roles[k] not in (PROBE, LINKED):
                continue
            ranks = rank[np.searchsorted(values, sets[k])]
            ranks = np.sort(ranks[ranks >= 0])
            weight = (num + den) * len(sets[k]) - (den - num) * sizes[k]
            if roles[k] != STORE:
                trie.probe(place, ranks, weight)
            if step == STORE:
                trie.insert(place, ranks, weight)
    pairs = {(docs[k], docs[order[trie.find(place)]]) for place, k in enumerate(order)}
    return [(a, b) for a, b in pairs if a != b]


def _join(rows: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    """(a, b) links of (keys, doc, size, items, role) groups; a task reads one at a time."""
    dealt = (rows.select(*keys, "doc", "size", "items", "role").repartition(*keys)
             .sortWithinPartitions(*keys))
    k = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for batch in pieces(batches) for row in zip(*[c.to_pylist() for c in batch.columns]))
        for _, group in groupby(flat, key=lambda row: row[:k]):
            docs, sizes, items, roles = list(zip(*group))[k:]
            found = join_cluster(docs, sizes, items, roles, num, den) if len(docs) > 1 else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _from_pivot(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(pivot, doc, size, diff, linked, ring): how each member stands to its pivot."""
    pivots = rows.filter("doc = pivot").select(
        "pivot", F.col("size").alias("_psize"), F.col("items").alias("_pitems"))
    pairs = rows.join(pivots.hint("merge"), "pivot").select(
        "pivot", "doc", "size", "_psize", "items", "_pitems")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for size, psize, items, pitems in zip(*[batch.column(k).to_pylist()
                                                    for k in (2, 3, 4, 5)]):
                diff = np.setxor1d(np.frombuffer(items, np.uint64),
                                   np.frombuffer(pitems, np.uint64), assume_unique=True)
                d, both = len(diff), size + psize
                linked = (den - num) * both >= (num + den) * d
                ring = not linked and den * (both - d) >= (2 * num - den) * (both + d)
                out.append((diff.tobytes() if linked or ring else None, linked, ring))
            diffs, linked, ring = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(diffs, pa.binary()), pa.array(linked, pa.bool_()),
                 pa.array(ring, pa.bool_())],
                ["pivot", "doc", "size", "diff", "linked", "ring"])

    return pairs.mapInArrow(run, "pivot bigint, doc bigint, size bigint, diff binary, "
                                 "linked boolean, ring boolean")


def _blocks(side: str, rows: int):
    """Number of blocks of a side: bounded in members and in bytes of items."""
    size = CLUSTER_BYTES // 2
    return F.expr(f"greatest(1L, (n_{side} + {rows - 1}) div {rows}, "
                  f"(bytes_{side} + {size - 1}) div {size})")


def _large(rows: DataFrame, cluster_rows: int, num: int, den: int) -> DataFrame:
    """(a, b) links of clusters that are too large for one task, block against block."""
    stand = stored(_from_pivot(rows, num, den), "from-pivot")
    half = max(1, cluster_rows // 2)
    counts = stand.groupBy("pivot").agg(
        F.count_if("linked").alias("n_linked"), F.count_if("ring").alias("n_ring"),
        F.count_if(~F.col("linked")).alias("n_open"),
        *[F.coalesce(F.sum(F.when(F.col(c), F.length("diff"))), F.lit(0)).alias(f"bytes_{c}")
          for c in ("linked", "ring")],
        F.coalesce(F.sum(F.when(~F.col("linked"), 8 * F.col("size"))), F.lit(0))
        .alias("bytes_open"))
    placed = stand.join(counts, "pivot").withColumn("_h", F.xxhash64("doc"))
    block = lambda side: F.pmod("_h", _blocks(side, half))
    through = stand.filter("linked and doc != pivot").select(
        F.col("doc").alias("a"), F.col("pivot").alias("b"))
    # ring against linked: each block of the one meets each block of the other
    near = placed.filter("n_ring > 0 and (linked or ring)").withColumns({
        "x": F.when(F.col("ring"), F.array(block("ring"))).otherwise(
            F.sequence(F.lit(0).cast("bigint"), _blocks("ring", half) - 1)),
        "y": F.when(F.col("ring"), F.sequence(F.lit(0).cast("bigint"),
                                              _blocks("linked", half) - 1))
        .otherwise(F.array(block("linked")))})
    near = (near.withColumn("x", F.explode("x")).withColumn("y", F.explode("y"))
            .withColumn("role", F.when(F.col("ring"), STORE).otherwise(LINKED))
            .withColumn("items", F.col("diff")))
    # unlinked against unlinked: block i stores, block j > i probes; i = j does both
    far = (placed.filter("not linked").join(rows.select("pivot", "doc", "items"),
                                            ["pivot", "doc"])
           .withColumn("own", block("open"))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                     _blocks("open", half) - 1)))
           .withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other"),
                         "role": F.when(F.col("own") == F.col("other"), BOTH)
                        .when(F.col("own") < F.col("other"), STORE).otherwise(PROBE)}))
    keys = ["pivot", "x", "y"]
    return (through.unionByName(_join(near, keys, num, den))
            .unionByName(_join(far, keys, num, den)))


def links(docs: DataFrame, heads: DataFrame, every: DataFrame, n: int, num: int, den: int,
          cluster_rows: int = CLUSTER_ROWS) -> DataFrame:
    """(a, b) links that connect exactly the classes which are connected by any links.

    ``heads`` has one document of each class, ``every`` (doc, size) of all rows of ``docs``.
    """
    # the smaller set of a link shares more of its n-grams, so fewer of them are its core
    core = F.expr(f"size - (2L * {num} * size + {num + den - 1}) div {num + den} + 1")
    # a little wider than the ratio of two sizes that link, so that rounding parts no pair
    width = F.floor(F.log(F.col("size").cast("double")) / (math.log(den / num) + 0.001))
    heads, heads_at = stored_at(heads.select("doc", width.alias("width"), core.alias("_core"),
                                             "prefix"), "representatives")
    tokens = (heads.select("doc", "width", "_core", F.posexplode("prefix").alias("at", "token"))
              .select("doc", "token", "width", (F.col("at") < F.col("_core")).alias("core")))
    members = _clusters(tokens)
    removed(docs.sparkSession, heads_at)
    # what a cluster holds is known before its sets are made: these are shuffled once, unstored
    held = every.filter("doc is not null").groupBy("doc").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_size"))
    sizes = stored(members.join(held.hint("merge"), "doc").groupBy("pivot").agg(
        F.sum("_rows").alias("_n"), F.sum(8 * F.col("_size")).alias("_bytes")), "sizes")
    large = (F.col("_n") > cluster_rows) | (F.col("_bytes") > CLUSTER_BYTES)
    few = stored(members.join(sizes.filter(~large & (F.col("_n") > 1)), "pivot", "left_semi"),
                 "small-members")
    small = _join(_sets(docs, few, n).withColumn("role", F.lit(BOTH)), ["pivot"], num, den)
    if sizes.filter(large).isEmpty():
        return small
    many = stored(members.join(sizes.filter(large), "pivot", "left_semi"), "large-members")
    many = stored(_sets(docs, many, n), "large-clusters")
    return small.unionByName(_large(many, cluster_rows, num, den))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3,
                       num: int = 90, den: int = 100,
                       cluster_rows: int = CLUSTER_ROWS) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` and ``component_id``.

    Documents link when den * intersection >= num * union of their sets of word n-grams
    (A-Z lower-cased; a shorter text is one n-gram). The component is the smallest
    document id reachable by links. Null and empty texts have no n-grams and link with
    nothing, not even each other. Rows of one id are one document: they are connected.
    Rows without id get their set size and no component, and connect nothing. No
    documents give no rows. Further columns are ignored.
    """
    source = _source(docs, doc_id, text)
    heads = stored(_heads(source, n, num, den, common_words(source)), "heads")
    sets = heads.filter("doc is not null and size > 0")
    classes = stored(sets.groupBy("s1", "s2").agg(F.min("doc").alias("rep")), "classes")
    reps = sets.join(classes.hint("merge"), ["s1", "s2"]).filter("doc = rep")
    edges = links(source, reps.select("doc", "size", "prefix").distinct(),
                  heads.select("doc", "size"), n, num, den, cluster_rows)
    # a repeated id with several texts connects their classes
    same = sets.select("doc", "s1", "s2").join(classes.hint("merge"), ["s1", "s2"])
    least = same.groupBy("doc").agg(F.min("rep").alias("b"), F.max("rep").alias("a"))
    several = same.join(least.filter("a != b").select("doc", "b").hint("merge"), "doc")
    named = components(edges.unionByName(several.select(F.col("rep").alias("a"), "b")))
    return (heads.select("doc", "size", "s1", "s2")
            .join(classes.hint("merge"), ["s1", "s2"], "left")
            .join(named.hint("merge"), F.col("rep") == F.col("node"), "left")
            .select(F.col("doc").alias(doc_id), F.col("size").alias("n_shingles"),
                    F.when(F.col("doc").isNotNull(), F.coalesce("component", "rep", "doc"))
                    .alias("component_id")))
