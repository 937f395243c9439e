"""Incremental Bronze: each run takes the answers that landed since the run before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gondola import schemas
from gondola.operators import bronze
from gondola.sources import payloads, writers

FLATTENERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "graphql_response": payloads.flatten_graphql,
    "search_response": payloads.flatten_search_hits,
    "html_response": payloads.flatten_html,
}


def records(landed: DataFrame) -> DataFrame:
    """All answer kinds of a payload log as one table of records.

    The id covers the fields, the file and a number among equal records of that file, so
    equal records are told apart and a repeated batch gives the same ids.
    """
    landed = landed if "_file" in landed.columns else landed.withColumn("_file", F.lit(""))
    out = None
    for kind, flatten in FLATTENERS.items():
        part = flatten(landed.filter(F.col("raw_response_type") == kind), ("_file",))
        out = part if out is None else out.unionByName(part)
    same = F.md5(F.to_json(F.struct(*schemas.BRONZE_FIELDS)))
    number = F.row_number().over(Window.partitionBy("_file", "_same").orderBy("_file"))
    numbered = out.withColumn("_same", same).withColumn("_number", number)
    return numbered.withColumn("record_id", F.md5(F.concat_ws(
        "/", "_file", "_same", "_number"))).drop("_file", "_same", "_number")


def ingest_new(spark: SparkSession, payload_dir: str, bronze_root: str, checkpoint: str
               ) -> StreamingQuery:
    """Take every new payload file once and append its records as one run per batch.

    The run id comes from the batch number and the folder date from the record, so a
    batch repeated after a failure replaces its own files and leaves no second copy.
    """
    def land(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read once, for all kinds
        try:
            write(batch, number)
        finally:
            batch.unpersist()

    def write(batch: DataFrame, number: int) -> None:
        run_id = f"batch_{number:08d}"
        known = F.coalesce(F.col("raw_response_type").isin(*FLATTENERS), F.lit(False))
        (batch.filter(~known).drop("_file").withColumn("run_id", F.lit(run_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id").json(unparsed_path(bronze_root)))
        flat = records(batch)
        bad = F.size(bronze.record_errors()) > 0
        stamp = F.coalesce(F.try_to_timestamp("collected_at"), F.lit("1970-01-01").cast("date"))
        typed = bronze.enrich(bronze.coerce_types(flat.withColumn("_bad", bad)), run_id,
                              error_flag=F.col("_bad")).drop("_bad")
        out = typed.withColumns({**bronze.date_parts(stamp), "run_id": F.lit(run_id)})
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*schemas.BRONZE_PARTITIONS).option("compression", "gzip")
         .parquet(bronze_root))

    stream = spark.readStream.schema(schemas.PAYLOAD).json(payload_dir).select(
        "*", F.col("_metadata.file_path").alias("_file"))
    return (stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def unparsed_path(bronze_root: str) -> str:
    """Answers of a kind that no flattener knows, as they came, by run."""
    return f"{bronze_root.rstrip('/')}_unparsed"


def landed(spark: SparkSession, bronze_root: str) -> DataFrame:
    return writers.read_bronze(spark, bronze_root)
