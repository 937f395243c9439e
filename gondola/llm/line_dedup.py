"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line hashes, bucketed and sorted by hash. Documents come in
batches. The hashes of a new batch are merge-anti-joined with every run: what is
left is new, is written as a run of level 0, and names the document that keeps
each line. When a level holds ``fanout`` runs they are compacted into one run of
the next level, so a batch meets few runs however many batches there were. Runs
are never shuffled to be searched: buckets of a batch meet buckets of a run.

Hashes are 128 bits wide. A batch decides for itself only by its smallest document
id, so batches in ascending id order give the first document of the whole corpus.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm.frames import TEXT, map_text
from gondola.session import fresh_path

_BLANK = b" \t\n\x0b\x0c\r"
_HASH = ["h1", "h2"]


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None for a key that is too short to count."""
    key = line.strip(_BLANK).lower()  # bytes.lower() touches A-Z only
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and sum(b & 0xC0 != 0x80 for b in key) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_chars: int = 10) -> DataFrame:
    """(doc, h1, h2): the distinct counted lines of every document that has an id."""
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc"),
                         F.col(text).cast("binary").alias(TEXT)).filter("doc is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = {line_hash(x, min_chars) for x in (value.as_py() or b"").split(b"\n")}
                keys.discard(None)
                ids.append(np.full(len(keys), doc, np.int64))
                found.extend(keys)
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids) if ids else np.empty(0, np.int64)),
                 pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                ["doc", *_HASH])

    return source.mapInArrow(run, "doc bigint, h1 bigint, h2 bigint")


class LineRuns:
    """The runs of all batches seen so far, level by level."""

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def admit(self, hashes: DataFrame) -> DataFrame:
        """Add a batch of (doc, h1, h2); return those that are not the line's keeper."""
        fresh = hashes.groupBy(*_HASH).agg(F.min("doc").alias("keeper"))
        for level in self.levels:
            for run in level:
                fresh = fresh.join(self.spark.table(run).hint("merge"), _HASH, "left_anti")
        path = self._write(fresh, 0)
        self._compact()
        # by path: a plain file scan lets adaptive execution split a hot line
        keepers = self.spark.read.schema("h1 bigint, h2 bigint, keeper bigint").parquet(path)
        return (hashes.join(keepers.hint("merge"), _HASH, "left")
                .filter("keeper is null or keeper != doc").select("doc", *_HASH))

    def _write(self, run: DataFrame, level: int) -> str:
        name, path = f"line_run_{uuid.uuid4().hex}", fresh_path(self.spark, "line-run")
        (run.select(*_HASH, "keeper").write.option("path", path)
         .bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return path

    def _compact(self) -> None:
        """Merge every full level into one run of the next; runs share no hash."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                full, self.levels[level] = self.levels[level], []
                merged = self.spark.table(full[0])
                for name in full[1:]:
                    merged = merged.unionByName(self.spark.table(name))
                self._write(merged.repartition(self.buckets, *_HASH), level + 1)
            level += 1


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_chars: int = 10, batches: int = 4, fanout: int = 3,
                runs: LineRuns | None = None) -> DataFrame:
    """Per document: lines, dropped lines, kept text and its SHA-256.

    Documents pass in ``batches`` of ascending id. A line of at least ``min_chars``
    code points, ends stripped and A-Z lower-cased, stays in the smallest document
    id that holds it and goes from all others; within that document every repetition
    stays. Shorter lines always stay. A null text is one empty line. Rows without id
    neither drop lines nor keep them from others. Repeated rows of one id count as
    one document and each give a row. No documents give no rows. Only ``doc_id`` and
    ``text`` are read; further columns are ignored. Given ``runs`` of earlier corpora
    are searched and extended.
    """
    spark = docs.sparkSession
    runs = runs or LineRuns(spark, fanout)
    hashes = line_hashes(docs, doc_id, text, min_chars)
    cuts = docs.select(F.percentile_approx(
        F.col(doc_id).cast("bigint"), [k / batches for k in range(1, batches)])).first()[0] or []
    number = sum([(F.col("doc") > c).cast("int") for c in cuts], F.lit(0))
    path = fresh_path(spark, "line-hashes")
    hashes.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    held = spark.read.schema("doc bigint, h1 bigint, h2 bigint, batch int").parquet(path)
    drops = None
    for k in range(len(cuts) + 1):
        gone = runs.admit(held.filter(F.col("batch") == k).drop("batch"))
        drops = gone if drops is None else drops.unionByName(gone)
    return rebuild(docs, drops, doc_id, text, min_chars)


def rebuild(docs: DataFrame, drops: DataFrame, doc_id: str, text: str,
            min_chars: int) -> DataFrame:
    """Join every document with its dropped hashes and put the other lines together."""
    listed = drops.groupBy(F.col("doc").alias("_doc")).agg(
        F.collect_list("h1").alias("_h1"), F.collect_list("h2").alias("_h2"))
    joined = (docs.select(F.col(doc_id), F.col(text).alias("_text"))
              .join(listed, F.col(doc_id).cast("bigint") == F.col("_doc"), "left"))

    def rows():
        def one(value: bytes | None, h1: list | None, h2: list | None) -> tuple:
            lines = (value or b"").split(b"\n")
            if h1:
                gone = {x.tobytes() for x in np.array([h1, h2], np.int64).T}
                kept = [x for x in lines if line_hash(x, min_chars) not in gone]
            else:
                kept = lines
            out = b"\n".join(kept)
            return (len(lines), len(lines) - len(kept), hashlib.sha256(out).hexdigest(), out)
        return one

    out = map_text(joined, "n_lines bigint, n_dropped bigint, kept_sha256 string, _kept binary",
                   rows, "_text", [doc_id], extra=("_h1", "_h2"))
    return out.withColumn("kept_text", F.col("_kept").cast("string")).drop("_kept")
