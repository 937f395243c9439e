"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.session import fresh_path, reliable_checkpoint

TEXT = "_text_utf8"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    return stored_at(df, name)[0]


# for rows of megabytes: pages of few rows, and a codec that needs no buffer of a whole page
LARGE_ROWS = {"compression": "zstd", "parquet.page.size.row.check.min": "1",
              "parquet.page.size.row.check.max": "1", "parquet.block.size.row.check.min": "1",
              "parquet.block.size.row.check.max": "8", "parquet.enable.dictionary": "false"}


def stored_at(df: DataFrame, name: str,
              options: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, so that it can be removed when it is read no more."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``stored_at`` has written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


MARK_BITS = 1 << 26  # of the bitmap below, 64 to a row: a million rows at most


def marked(df: DataFrame, key: str, ids: DataFrame, of: str | None = None) -> DataFrame:
    """``df`` and ``_maybe``: false only where ``key`` is not among the ``of`` values of ``ids``.

    A bitmap of hashed ids is broadcast; its size is bounded whatever the number of ids.
    Null keys are false.
    """
    def place(c: str):
        return F.pmod(F.xxhash64(c), F.lit(MARK_BITS))

    of = of or key
    bit = place(of)
    bitmap = (ids.filter(F.col(of).isNotNull())
              .groupBy(F.call_function("div", bit, F.lit(64)).alias("_word"))
              .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                            (bit % 64).cast("int"))).alias("_bits")))
    word = F.when(F.col(key).isNotNull(), F.call_function("div", place(key), F.lit(64)))
    own = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place(key) % 64).cast("int"))
    return (df.withColumn("_at", word)
            .join(F.broadcast(bitmap), F.col("_at") == F.col("_word"), "left")
            .withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(own) != 0, F.lit(False)))
            .drop("_at", "_word", "_bits"))


def checkpointed(df: DataFrame) -> DataFrame:
    return reliable_checkpoint(df)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made of one batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_text(docs: DataFrame, fields: str, rows: Callable[[], Callable[[bytes | None], tuple]],
             text: str = "text", keep: Sequence[str] | None = None,
             where: Callable[[tuple], bool] | None = None,
             extra: Sequence[str] = ()) -> DataFrame:
    """One result tuple per document, in Arrow batches, without a shuffle.

    ``rows()`` builds the per-task function ``utf8 text (or None) -> tuple``; its
    values become the columns ``fields`` (DDL), next to the ``keep`` columns (all
    when None). ``where`` filters rows by their result. Result columns replace kept
    columns of the same name. Values of the ``extra`` columns are further arguments.
    ``text`` may name a field of a kept struct (``row.text``): it is read there, so that
    texts reach a task once. Memory of a batch is given back before the next one.
    """
    added = T.StructType.fromDDL(fields)
    names = [f.name for f in added]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    root, _, inner = text.partition(".")
    inside = inner and root in kept
    source = docs.select(*kept, *[F.col(c).alias(f"_in_{c}") for c in extra],
                         *([] if inside else [F.col(text).cast("binary").alias(TEXT)]))
    schema = T.StructType([source.schema[c] for c in kept] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = rows()
        for batch in pieces(batches):
            inputs = [pc.struct_field(batch.column(kept.index(root)), inner).cast(pa.binary())
                      if inside else batch.column(batch.num_columns - 1)]
            inputs += [batch.column(len(kept) + i) for i in range(len(extra))]
            found = [one(*row) for row in zip(*map(_values, inputs))]
            out = batch.select(list(range(len(kept))))
            if where is not None:
                mask = [where(r) for r in found]
                out = out.filter(pa.array(mask, pa.bool_()))
                found = [r for r, m in zip(found, mask) if m]
            values = [pa.array([r[i] for r in found], _arrow_type(f.dataType))
                      for i, f in enumerate(added)]
            yield pa.RecordBatch.from_arrays([*out.columns, *values], [*kept, *names])
            del out, values, inputs, found
            pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)


def _values(column: pa.Array) -> Iterator:
    return (v.as_py() for v in column)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    plain = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(),
             "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return plain[kind.simpleString()]


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str = "_rank",
           bucket_rows: int = 100_000) -> DataFrame:
    """0-based position of every row in its group, ordered by hash of ``order``, then ``order``.

    A group may hold any share of the rows: it is cut into buckets of even size by
    the leading part of the hash, buckets are counted, and a row's position is its
    position in the bucket plus the rows of the buckets before. The result does not
    depend on the number of buckets.
    """
    total = df.count()
    parts = max(1, -(-total // bucket_rows))
    spread = F.pmod(F.xxhash64(*order), F.lit(2 ** 62))
    tagged = (df.withColumn("_spread", spread)
              .withColumn("_bucket", F.floor(F.col("_spread") / F.lit(2 ** 62 // parts + 1))))
    sizes = tagged.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*keys).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                          F.col("_bucket").alias("_b"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_spread", *order)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    placed = tagged.withColumn("_in", F.row_number().over(inside) - 1)
    condition = F.col("_bucket") == F.col("_b")
    for s in same:
        condition = condition & s
    return (placed.join(starts, condition)
            .withColumn(rank, F.col("_before") + F.col("_in"))
            .drop("_spread", "_bucket", "_b", "_before", "_in", *[f"_k_{k}" for k in keys]))
