"""Archiving of old Bronze folders: copy, check, then remove; every step can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola import schemas
from gondola.operators import history
from gondola.session import lean_writes, reliable_checkpoint
from gondola.sources import writers

PARTS = schemas.BRONZE_PARTITIONS


def _archived(spark: SparkSession, archive: str) -> DataFrame | None:
    try:
        return writers.read_bronze(spark, archive)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _overwrite(df: DataFrame, path: str) -> None:
    """Replace the folders that ``df`` has rows of; others stay."""
    with lean_writes(df.sparkSession):
        (df.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
         .partitionBy(*PARTS).parquet(path))


def copy_expired(spark: SparkSession, live: str, archive: str, today: dt.date, days: int) -> None:
    """Copy folders older than ``days`` to the archive.

    Folders copied whole are read and written by the same task: they were dealt when they
    were landed, so their rows are not shuffled again, and files come one after the other, so
    they are not sorted either.
    A folder that the archive does not have is copied whole. One that it has (from a run
    that stopped half way, or because late rows came) is completed by the rows it lacks,
    so a half-removed live folder can never shrink the copy.
    """
    limit = F.lit(today)
    expired = history.beyond_retention(writers.read_bronze(spark, live), limit, days)
    old = _archived(spark, archive)
    if old is None:
        return _overwrite(expired, archive)
    folders = history.beyond_retention(old, limit, days).select(*PARTS).distinct()
    folders = reliable_checkpoint(folders)  # as they are before anything is written
    known = expired.join(folders, PARTS, "left_semi")
    same = old.join(known.select(*PARTS).distinct(), PARTS, "left_semi").select(*known.columns)
    lacking = known.exceptAll(same)
    whole = same.join(lacking.select(*PARTS).distinct(), PARTS, "left_semi").unionByName(lacking)
    _overwrite(reliable_checkpoint(whole.hint("rebalance", *PARTS)), archive)
    _overwrite(expired.join(folders, PARTS, "left_anti"), archive)


def remove_archived(spark: SparkSession, live: str, archive: str, today: dt.date,
                    days: int) -> int:
    """Remove expired live folders whose rows the archive holds; returns how many.

    Folders are compared by their number of rows; one that is not complete in the archive
    is an error, and nothing is removed.
    """
    expired = history.beyond_retention(writers.read_bronze(spark, live), F.lit(today), days)
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
    counts = (expired.select(*PARTS, folder.alias("folder")).groupBy(*PARTS)
              .agg(F.count(F.lit(1)).alias("n"), F.min("folder").alias("folder")))
    old = _archived(spark, archive)
    copied = expired.limit(0) if old is None else old
    copied = copied.groupBy(*PARTS).agg(F.count(F.lit(1)).alias("copied"))
    checked = counts.join(copied, PARTS, "left").select(
        "folder", (F.coalesce("copied", F.lit(0)) >= F.col("n")).alias("complete")).collect()
    if not all(r["complete"] for r in checked):
        raise ValueError("the archive lacks rows of expired folders: copy them first")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for r in checked:  # one entry per folder of a day's run
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["folder"]))
        place.getFileSystem(conf).delete(place, True)
    return len(checked)


def archive_expired(spark: SparkSession, live: str, archive: str, today: dt.date,
                    days: int) -> int:
    """Move folders older than ``days`` to the archive; run it again after any failure."""
    copy_expired(spark, live, archive, today, days)
    return remove_archived(spark, live, archive, today, days)
