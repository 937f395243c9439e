"""Deduplication that outlives a run: an index of keys, their members and their best record.

Two bucketed tables share their buckets. ``members`` holds the records of every key;
``winners`` holds the best record of a key, one row per *generation* (run) that changed
it, and the newest generation counts. A new batch is the only thing that is shuffled: it
is dealt to the buckets and joined with the state where the state lies. A better late
record adds one row to ``winners``, and the pairs of its key turn over when they are read;
rows of other keys are not written again.

Repeating a generation (after a failure half way) adds equal rows, which reading ignores.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators.ordered import micros
from gondola.operators.silver import DEDUP_KEYS

# the order of silver.keep_order, as stored values: smaller is better
ORDER = {"invalid": "boolean", "emptiness": "double", "age": "bigint", "unpriced": "boolean",
         "price": "double", "record_id": "string"}


def stored_order() -> Column:
    values = [~F.col("ean_valid"), -F.col("data_completeness"), -micros(F.col("collected_at")),
              F.col("price").isNull(), F.col("price"), F.col("record_id")]
    return F.struct(*[v.alias(name) for v, name in zip(values, ORDER)])


def key_of(keys: list[str] = DEDUP_KEYS) -> Column:
    """One text per key; NULL differs from every value and equals NULL."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("\u0001", *marked))


@dataclass(frozen=True)
class DedupIndex:
    """The index below ``path``, registered in the catalogue of this session."""

    spark: SparkSession
    path: str
    buckets: int = 32

    @property
    def tag(self) -> str:
        return hashlib.md5(self.path.encode()).hexdigest()[:16]

    def _table(self, name: str, fields: str) -> str:
        table = f"dedup_{name}_{self.tag}"
        self.spark.sql(f"""
            CREATE TABLE IF NOT EXISTS {table} ({fields}) USING PARQUET
            CLUSTERED BY (key) INTO {self.buckets} BUCKETS
            LOCATION '{self.path.rstrip('/')}/{name}'""")
        return table

    @property
    def members(self) -> str:
        return self._table("members", "key STRING, record_id STRING, generation BIGINT")

    @property
    def winners(self) -> str:
        fields = ", ".join(f"{name}: {kind}" for name, kind in ORDER.items())
        return self._table("winners", f"key STRING, best STRUCT<{fields}>, "
                           "generation BIGINT")

    def best(self) -> DataFrame:
        """(key, best): each key's record of the newest generation. No shuffle."""
        newest = F.max_by("best", "generation").alias("best")
        return self.spark.table(self.winners).groupBy("key").agg(newest)

    def changed(self, batch: DataFrame) -> DataFrame:
        """(key, best) of keys whose best record is a record of the batch.

        Only the batch is shuffled, once it is down to one candidate per key and task.
        """
        found = (batch.select(key_of().alias("key"), stored_order().alias("_o"))
                 .groupBy("key").agg(F.min("_o").alias("_new"))
                 .repartition(self.buckets, "key"))
        better = F.col("best").isNull() | (F.col("_new") < F.col("best"))
        return (found.join(self.best().hint("merge"), "key", "left").filter(better)
                .select("key", F.col("_new").alias("best")))

    def add(self, batch: DataFrame, generation: int) -> DedupIndex:
        """Take a batch of normalised records into the index."""
        run = F.lit(generation).cast("bigint").alias("generation")
        (batch.select(key_of().alias("key"), "record_id", run)
         .repartition(self.buckets, "key").write.mode("append").insertInto(self.members))
        (self.changed(batch).select("key", "best", run)
         .repartition(self.buckets, "key").write.mode("append").insertInto(self.winners))
        return self

    def pairs(self) -> DataFrame:
        """(record_id, duplicate_of_id) of every record that is not its key's best. No shuffle."""
        records = self.spark.table(self.members).groupBy("key", "record_id").agg(
            F.min("generation").alias("generation"))
        kept = F.col("best.record_id")
        return (records.join(self.best().hint("merge"), "key")
                .filter(F.col("record_id") != kept)
                .select("record_id", kept.alias("duplicate_of_id")))

    def drop(self) -> None:
        """Forget the tables; their files stay, and the next use finds them again."""
        for name in ("members", "winners"):
            self.spark.sql(f"DROP TABLE IF EXISTS dedup_{name}_{self.tag}")
