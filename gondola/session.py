"""Session helpers: a tuned builder and the shared folder for materialised steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}

_WRITES = {
    # what a write has shuffled is removed when it ends, not when the driver collects garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # rows go to the open files of so many folders as they come; only those beyond are sorted
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def build_session(app: str = "gondola", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and skew handling on; extra settings override."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # small inputs get at least as many splits as there are row groups to share
        "spark.sql.files.openCostInBytes": "1m",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[sc.applicationId] = tempfile.mkdtemp(prefix="gondola-")
    return _LOCAL_FALLBACK[sc.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, so a lost executor cannot change the rows."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Writes inside need no sort by folder, which would spill, and leave no shuffle files."""
    before = {key: spark.conf.get(key, None) for key in _WRITES}
    try:
        for key, value in _WRITES.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
