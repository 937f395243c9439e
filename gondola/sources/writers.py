"""Sinks of the layers and readers of what they wrote."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola import schemas
from gondola.operators import bronze
from gondola.session import lean_writes

# quotes are doubled inside quoted text, and blanks at the ends of a value are kept
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
       "ignoreTrailingWhiteSpace": False}
PAYLOADS_PER_FILE = 500_000


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str],
                      compression: str, dealt: bool = False) -> str:
    """Append partitioned Parquet.

    Rows are dealt by partition values; AQE joins small parts and splits a hot one, so
    neither many tiny files (tasks times markets) nor one huge task comes out. ``dealt``
    says that the rows were dealt so before.
    """
    rows = df if dealt else df.hint("rebalance", *partitions)
    with lean_writes(df.sparkSession):
        (rows.write.mode("append").partitionBy(*partitions)
         .option("compression", compression).parquet(path))
    return path


def dealt_by_run(df: DataFrame, run_ts: str = "run_ts") -> DataFrame:
    """Rows dealt as :func:`write_bronze` needs them, before columns are added."""
    return df.hint("rebalance", "market", run_ts, "bronze_run_id")


def write_bronze(df: DataFrame, path: str, run_ts: str = "run_ts", dealt: bool = False) -> str:
    """Gzip Parquet under market / year / month / day / run_id of the run time."""
    parts = bronze.date_parts(F.col(run_ts))
    out = df.withColumns({**parts, "run_id": F.col("bronze_run_id")}).drop(run_ts)
    return write_partitioned(out, path, schemas.BRONZE_PARTITIONS, "gzip", dealt)


def write_silver(df: DataFrame, path: str, run_ts: str = "run_ts") -> str:
    """Snappy Parquet under market / year / month / day / transformation_id."""
    parts = bronze.date_parts(F.col(run_ts))
    out = df.withColumns({**parts, "transformation_id": F.col("silver_transformation_id")})
    return write_partitioned(out.drop(run_ts), path, schemas.SILVER_PARTITIONS, "snappy")


def write_raw_payloads(df: DataFrame, path: str) -> str:
    """Raw answers as compressed JSON lines, appended; one task reads a file of so many again."""
    (df.write.mode("append").option("compression", "gzip")
     .option("maxRecordsPerFile", PAYLOADS_PER_FILE).json(path))
    return path


def write_seed_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**CSV).csv(path)
    return path


def write_audit(df: DataFrame, path: str) -> str:
    """Append run documents (nested JSON)."""
    with lean_writes(df.sparkSession):
        df.write.mode("append").json(path)
    return path


def write_table(df: DataFrame, path: str, date: str | None = None) -> str:
    """Overwrite one Gold table, stored by the month of its ``date`` column if it has one.

    The table is built next to the old one and takes its place when it is complete, so a
    build that fails leaves the old table. Rows are ordered by date inside a file, so that a filter on days reads only
    the row groups that hold them.
    """
    fresh = f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    if date is None:
        df.write.option("compression", "snappy").parquet(fresh)
    else:
        month = f"{date[:-len('date')]}month"
        (df.withColumn(month, F.substring(date, 1, 7)).hint("rebalance", month)
         .sortWithinPartitions(month, date).write.partitionBy(month)
         .option("compression", "snappy").parquet(fresh))
    _swap(df.sparkSession, fresh, path)
    return path


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a finished table in the place of the old one; the old one goes last."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new, here, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, path, f"{fresh}__old"))
    files = here.getFileSystem(conf)
    if files.exists(here) and not files.rename(here, old):
        raise OSError(f"cannot move {path}")
    if not files.rename(new, here):
        raise OSError(f"cannot move {fresh} to {path}")
    files.delete(old, True)


# --- readers -------------------------------------------------------------------

def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The whole partitioned root; filters on the partition columns prune files."""
    text = ", ".join(f"{c} STRING" for c in schemas.BRONZE_PARTITIONS if c != "market")
    return spark.read.schema(f"{_ddl(schemas.BRONZE)}, {text}").parquet(path)


def read_silver(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union of Silver outputs after a check of the required columns."""
    frames = []
    for path in paths:
        df = spark.read.parquet(path)
        missing = [c for c in schemas.SILVER_REQUIRED if c not in df.columns]
        if missing:
            raise ValueError(f"Missing columns in Silver data for {path}: {missing}")
        if dict(df.dtypes)["collected_at"] == "string":
            df = df.withColumn("collected_at", F.try_to_timestamp("collected_at"))
        frames.append(df)
    if not frames:
        raise ValueError("no Silver paths given")
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=False)
    return out


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAYLOAD).json(path)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SEED).options(**CSV).csv(path)


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    """Legacy catalogue CSV: UTF-8 (a byte-order mark is fine), quoted commas."""
    return (spark.read.schema(schemas.LEGACY_PRODUCT).options(**CSV)
            .option("enforceSchema", True).option("encoding", "UTF-8").csv(path))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML pages, one file per row."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "html")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_AUDIT).json(path)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
