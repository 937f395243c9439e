"""Archiving repeated after failures at every place."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from gondola import schemas
from gondola.sources import archive, writers

TODAY = dt.date(2024, 3, 31)


@pytest.fixture
def roots(spark, tmp_path):
    live, old = str(tmp_path / "live"), str(tmp_path / "archive")
    write(spark, live, [(m, d, i) for m in ("a market", "b:c") for d in (1, 20, 60, 200)
                        for i in range(5)])
    return live, old


def write(spark, path, rows):
    df = spark.createDataFrame(
        [(f"{m}-{d}-{i}", m, str(i), TODAY - dt.timedelta(days=d)) for m, d, i in rows],
        "record_id string, market string, ean string, at date")
    fields = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in df.columns
              else F.col(f.name) for f in schemas.BRONZE]
    parts = {"year": F.date_format("at", "yyyy"), "month": F.date_format("at", "MM"),
             "day": F.date_format("at", "dd"), "run_id": F.concat(F.lit("r"), F.col("at"))}
    out = df.select(*fields, *[c.alias(n) for n, c in parts.items()])
    writers.write_partitioned(out, path, schemas.BRONZE_PARTITIONS, "gzip")


def ids(spark, path):
    return sorted(r["record_id"] for r in writers.read_bronze(spark, path).collect())


def want(far):
    return sorted(f"{m}-{d}-{i}" for m in ("a market", "b:c")
                  for d in ((60, 200) if far else (1, 20)) for i in range(5))


def test_moves_old_folders(spark, roots):
    live, old = roots
    assert archive.archive_expired(spark, live, old, TODAY, 30) == 4
    assert (ids(spark, live), ids(spark, old)) == (want(False), want(True))
    assert archive.archive_expired(spark, live, old, TODAY, 30) == 0
    assert (ids(spark, live), ids(spark, old)) == (want(False), want(True))


def test_stopped_between_copy_and_removal(spark, roots):
    live, old = roots
    archive.copy_expired(spark, live, old, TODAY, 30)
    assert len(ids(spark, live)) == 40  # nothing is removed yet
    archive.archive_expired(spark, live, old, TODAY, 30)
    assert (ids(spark, live), ids(spark, old)) == (want(False), want(True))


def test_stopped_while_a_folder_was_removed(spark, roots):
    live, old = roots
    write(spark, live, [("a market", 60, i) for i in range(5, 9)])  # a second file of one folder
    archive.copy_expired(spark, live, old, TODAY, 30)
    files = sorted(glob.glob(f"{live}/market=a market/year=2024/month=01/**/*.parquet",
                             recursive=True))
    os.unlink(files[0])
    archive.archive_expired(spark, live, old, TODAY, 30)
    assert ids(spark, live) == want(False)
    assert ids(spark, old) == sorted([*want(True), *[f"a market-60-{i}" for i in range(5, 9)]])


def test_late_rows_join_their_archived_folder(spark, roots):
    live, old = roots
    archive.archive_expired(spark, live, old, TODAY, 30)
    write(spark, live, [("b:c", 60, 7), ("b:c", 60, 7), ("b:c", 60, 1)])
    archive.archive_expired(spark, live, old, TODAY, 30)
    assert ids(spark, live) == want(False)
    assert ids(spark, old) == sorted([*want(True), "b:c-60-7", "b:c-60-7"])


def test_nothing_is_removed_that_the_archive_lacks(spark, roots):
    live, old = roots
    with pytest.raises(ValueError, match="copy them first"):
        archive.remove_archived(spark, live, old, TODAY, 30)
    assert len(ids(spark, live)) == 40


def test_whole_folders_are_copied_as_they_were_dealt(spark, roots):
    live, old = roots
    write(spark, live, [("a market", 60, i) for i in range(5, 9)])  # a second file of one folder
    split = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(split, "1k")  # each file is read by tasks of its own
    try:
        archive.copy_expired(spark, live, old, TODAY, 30)
    finally:
        spark.conf.unset(split)
    assert ids(spark, old) == sorted([*want(True), *[f"a market-60-{i}" for i in range(5, 9)]])
    assert len(glob.glob(f"{old}/**/*.parquet", recursive=True)) == 5  # no shuffle joined two


def plans(spark, do):
    """Texts of the plans that ran, in their order."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    do()
    runs = store.executionsList()
    return [runs.apply(i).physicalPlanDescription() for i in range(before, runs.size())]


def test_folders_are_copied_without_a_sort(spark, roots):
    live, old = roots
    ran = plans(spark, lambda: archive.copy_expired(spark, live, old, TODAY, 30))
    writes = [p for p in ran if "InsertIntoHadoopFsRelationCommand" in p]
    assert len(writes) == 1 and not any("Sort" in p for p in writes)
    assert (ids(spark, live), ids(spark, old)) == (sorted(want(False) + want(True)), want(True))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None


def test_more_folders_than_open_files(spark, tmp_path):
    live, old = str(tmp_path / "live"), str(tmp_path / "archive")
    days = range(31, 91)
    write(spark, live, [("m", d, i) for d in days for i in range(3)])
    split, parts = "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"
    spark.conf.set(split, "0")
    spark.conf.set(parts, "1")  # all folders in one task
    try:
        assert archive.archive_expired(spark, live, old, TODAY, 30) == 60
    finally:
        spark.conf.unset(split)
        spark.conf.unset(parts)
    assert ids(spark, live) == []
    assert ids(spark, old) == sorted(f"m-{d}-{i}" for d in days for i in range(3))
    assert len(glob.glob(f"{old}/**/*.parquet", recursive=True)) == 60
