"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Windows of ``width`` consecutive benchmark words are the patterns; an item with
fewer words is one pattern. Patterns of one length share a block shift table: the
last ``BLOCK`` words under the scan head tell how far the head may jump. At shift
zero the suffix bucket of the block, narrowed by the first word, lists the
patterns, and a direct comparison of all words confirms an occurrence.

The benchmark is cut into blocks of at most ``block_bytes`` of text. Only one
block is broadcast at a time; every block is matched against all documents in a
pass that needs no shuffle, and rows found so far travel with the document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.frames import checkpointed, map_text

BLOCK = 2
# bytes that are not in a word become blanks, A-Z become a-z; UTF-8 bytes >= 0x80 stay
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122
              else 32 for c in range(256))

FIELDS = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
          "contaminated boolean, item_ids array<string>, hit_spans array<bigint>")


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class WuManber:
    """Shift and suffix tables of word windows, one pair of tables per pattern length."""

    def __init__(self, patterns: Iterable[tuple[Sequence[bytes], str | None]]):
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for pattern, owner in patterns:
            owners = by_length.setdefault(len(pattern), {}).setdefault(tuple(pattern), set())
            if owner is not None:
                owners.add(owner)
        self.tables = [self._table(m, found) for m, found in sorted(by_length.items())]

    @staticmethod
    def _table(m: int, patterns: dict[tuple[bytes, ...], set[str]]):
        block = min(BLOCK, m)
        free = m - block + 1
        shift: dict[bytes, int] = {}
        buckets: dict[bytes, dict[bytes, list]] = {}
        for pattern, owners in patterns.items():
            for end in range(block, m + 1):
                key = b" ".join(pattern[end - block:end])
                shift[key] = min(shift.get(key, free), m - end)
            (buckets.setdefault(b" ".join(pattern[m - block:]), {})
             .setdefault(pattern[0], []).append((list(pattern), owners)))
        return m, block, free, shift, buckets

    def search(self, text: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """Every occurrence as (first word, word after the last, items)."""
        n = len(text)
        for m, block, free, shift, buckets in self.tables:
            head = m
            while head <= n:
                key = text[head - 1] if block == 1 else text[head - 2] + b" " + text[head - 1]
                jump = shift.get(key, free)
                if jump:
                    head += jump
                    continue
                first = head - m
                for pattern, owners in buckets[key].get(text[first], ()):
                    if text[first:head] == pattern:
                        yield first, head, owners
                head += 1


def windows(item: list[bytes], width: int) -> Iterator[list[bytes]]:
    if item:
        for start in range(max(1, len(item) - width + 1)):
            yield item[start:start + width]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


@lru_cache(maxsize=2)
def _matcher(items: tuple[tuple[str | None, bytes], ...], width: int) -> WuManber:
    """Tables are built once per Python worker and block."""
    return WuManber((w, item_id) for item_id, text in items for w in windows(words(text), width))


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    """The benchmark in pieces, each read by itself; whole items stay together."""
    items = (benchmark.select(F.col(item_id).cast("string").alias("id"),
                              F.col(text).cast("binary").alias("text"))
             .filter("text is not null").distinct())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield k == n - 1, tuple((r["id"], bytes(r["text"])) for r in part.collect())


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  keep: Sequence[str] | None = None, width: int = 10,
                  item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = 4 << 20, clean_only: bool = False) -> DataFrame:
    """Per document: words, words inside benchmark windows, and the items found.

    One row per input row, repeated rows included, with the ``keep`` columns (all
    when None; a kept column named like a result column gives way). A null or empty
    text has no words and is clean. A null benchmark text has no windows; an item
    without id still marks words, but is not listed. An empty benchmark leaves every
    document clean, and an empty ``docs`` gives no rows. ``clean_only`` drops
    contaminated rows.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep)]
    found = docs.withColumns({"item_ids": F.array().cast("array<string>"),
                              "hit_spans": F.array().cast("array<bigint>")})
    for last, items in _blocks(benchmark, item_id, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(items)
        found = map_text(found, FIELDS, lambda: _scan(shared, width), text,
                         kept if last else [*dict.fromkeys([*kept, text])],
                         extra=("item_ids", "hit_spans"))
        if not last:
            found = checkpointed(found)
    return found.filter("not contaminated") if clean_only else found


def _scan(shared, width: int):
    tables = _matcher(shared.value, width)

    def one(text: bytes | None, owners: list[str], flat: list[int]) -> tuple:
        found, owners = words(text), set(owners)
        spans = list(zip(flat[::2], flat[1::2]))
        for start, end, items in tables.search(found):
            spans.append((start, end))
            owners |= items
        spans, listed = merge_spans(spans), sorted(owners)
        n_hit = sum(end - start for start, end in spans)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        return (len(found), n_hit, len(listed), digest, n_hit > 0, listed,
                [x for span in spans for x in span])
    return one
