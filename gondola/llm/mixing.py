"""Mixing sources to target weights by Pfair scheduling.

Documents of a source, in hash order, form blocks. Time runs in slots, one block each.
With weights that add up to 1, block j (from 0) of a source with weight w is released at
floor(j / w) and due at ceil((j + 1) / w), and each slot takes the released block with the
earliest deadline. All deadlines are met, so at any time a source is less than one block
away from its weight. Windows follow from the weights themselves, in whole numbers over
the whole mix: nothing is rounded to a period, so nothing adds up.

When a source runs out, time goes on with the sum of the other weights: they keep their
proportions, and nothing is dropped or repeated. ``stop`` ends the mix there instead, for
a result that is to target from end to end, and leaves the rest out.

The schedule is made by one task and holds one row per block: ``MAX_BLOCKS`` at most, as
blocks hold more documents where there are more. Documents are then joined with it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.frames import ranked, stored

MAX_BLOCKS = 1 << 22  # blocks of a schedule, but for one more per source
_SCALE = 1 << 80  # parts of a unit of time
_WEIGHT = 1 << 40  # the weights are whole numbers with this sum


def earliest_deadline_first(weights: Sequence[int], blocks: Sequence[int],
                            stop: bool = False) -> Iterator[tuple[int, int, int]]:
    """(slot, source, block) in the order of the slots, for integer weights of any sum.

    Time is the number of blocks that the present sources have had, over the sum of their
    weights. With ``stop`` it ends at the first source that has no block left.
    """
    live, had = sum(w for w, m in zip(weights, blocks) if m), 0
    done = [0] * len(weights)
    waiting = [(0, i) for i, m in enumerate(blocks) if m]
    ready: list[tuple[int, int]] = []
    for slot in range(sum(blocks)):
        had += 1
        now = had * _SCALE // live
        while waiting and (waiting[0][0] < now or not ready):
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, ((done[i] + 1) * _SCALE // weights[i], i))
        i = heapq.heappop(ready)[1]
        yield slot, i, done[i]
        done[i] += 1
        if done[i] < blocks[i]:
            heapq.heappush(waiting, (done[i] * _SCALE // weights[i], i))
            continue
        if stop:
            return
        live, had = live - weights[i], had - done[i]


def tempered_weights(docs: DataFrame, source: str = "source", power: float = 0.5) -> DataFrame:
    """(source, weight) with weights in proportion to a power of the number of documents."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("weight"))


def present_weights(weights: DataFrame, present: DataFrame) -> DataFrame:
    """(source, blocks, w): whole-number weights of the sources that have blocks.

    Sources that no weight names get the least positive weight; a weight that is null
    or not positive counts as unnamed.
    """
    named = weights.filter("weight > 0").groupBy("source").agg(F.sum("weight").alias("weight"))
    joined = present.join(named.withColumnRenamed("source", "_named"),
                          F.col("source").eqNullSafe(F.col("_named")), "left").drop("_named")
    least = named.agg(F.coalesce(F.min("weight"), F.lit(1.0)).alias("_least"))
    whole = joined.crossJoin(F.broadcast(least)).withColumn("x", F.coalesce("weight", "_least"))
    total = whole.agg(F.sum("x").alias("_total"))  # one row, as before
    part = F.round(F.col("x") / F.col("_total") * _WEIGHT).cast("bigint")
    return whole.crossJoin(F.broadcast(total)).select(
        "source", "blocks", F.greatest(part, F.lit(1)).alias("w"))


def schedule(parts: DataFrame, stop: bool = False) -> DataFrame:
    """(source, block, slot) of all blocks, from the (source, blocks, w) of the sources.

    One task reads a row per source and writes a row per block.
    """
    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = list(frames)
        if not found:
            return
        rows = pd.concat(found)
        rows = rows.sort_values("source", na_position="first").reset_index(drop=True)
        names, out = rows["source"].tolist(), []
        for slot, i, block in earliest_deadline_first(
                rows["w"].tolist(), rows["blocks"].tolist(), stop):
            out.append((names[i], block, slot))
            if len(out) == 50_000:
                yield pd.DataFrame(out, columns=["source", "block", "slot"])
                out = []
        yield pd.DataFrame(out, columns=["source", "block", "slot"])

    one = parts.select("source", "blocks", "w").coalesce(1)
    return stored(one.mapInPandas(plan, "source string, block bigint, slot bigint"), "mix-slots")


def mix(docs: DataFrame, weights: DataFrame | None = None, doc_id: str = "doc_id",
        source: str = "source", block_docs: int = 16, stop: bool = False) -> DataFrame:
    """(doc_id, source, mix_source_block, mix_slot, mix_position) of every document.

    ``mix_position`` orders the mix: slots in turn, then the order in the block. Blocks
    hold ``block_docs`` documents of one source (more where that would be over
    ``MAX_BLOCKS``), the last one of a source maybe fewer. ``weights`` (source, weight)
    default to the square root of the document counts. With ``stop``, documents beyond
    the first source that runs out are left out. A null source is a source of its own, a
    null id an id. Rows of one source and id are one document and share its place. Texts
    are not read, so empty and very long ones count like any. Weights of absent sources
    have no effect. No documents give no rows. Only the id and the source are read; other
    columns are left behind.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(source).cast("string").alias("_source"))
    if weights is None:
        weights = tempered_weights(rows, "_source")
    distinct = rows.distinct()
    present = stored(distinct.groupBy(F.col("_source").alias("source")).agg(
        F.count(F.lit(1)).alias("n")), "mix-sources")
    total = present.agg(F.sum("n")).first()[0] or 0
    block_docs = max(block_docs, -(-total // MAX_BLOCKS))
    present = present.select("source", F.expr(f"(n + {block_docs - 1}) div {block_docs}")
                             .alias("blocks"))
    slots = schedule(present_weights(weights, present), stop)
    turns = slots.select(F.col("source").alias("_s"), F.col("block").alias("_b"),
                         F.col("slot").alias("mix_slot"))
    placed = ranked(distinct, ["_source"], ["_id"], "_rank").withColumn(
        "mix_source_block", F.expr(f"_rank div {block_docs}"))
    return (placed.join(turns, F.col("_source").eqNullSafe(F.col("_s"))
                        & (F.col("mix_source_block") == F.col("_b")))
            .select(F.col("_id").alias(doc_id), F.col("_source").alias(source),
                    "mix_source_block", "mix_slot",
                    (F.col("mix_slot") * block_docs + F.expr(f"_rank % {block_docs}"))
                    .alias("mix_position")))


def ordered(docs: DataFrame, places: DataFrame, doc_id: str = "doc_id",
            source: str = "source") -> DataFrame:
    """Rows of docs in the order of :func:`mix`: files written from them follow the mix."""
    at = places.select(F.col(doc_id).alias("_id"), F.col(source).alias("_s"),
                       F.col("mix_position").alias("_at"))
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col(doc_id).alias("_doc"),
                        F.col(source).cast("string").alias("_source"))
    return (whole.join(at, F.col("_doc").eqNullSafe(F.col("_id"))
                       & F.col("_source").eqNullSafe(F.col("_s")))
            .repartitionByRange("_at").sortWithinPartitions("_at").select("_row.*"))
