"""End-to-end plan: land records, clean, gate, publish. Three write barriers.

All markets and search batches go through one job per layer; the batch is a
column, not a loop.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola import schemas
from gondola.operators import audit, bronze, gold, quality, silver
from gondola.sources import writers

# fixed values: table -> sub-path below the Gold root, and its date column. Tables
# are stored by the month of that date: folders stay few and large for any history.
GOLD_TABLES = {
    "products_snapshot": ("products_dashboard/products_snapshot", "collection_date"),
    "market_prices": ("price_comparison/market_prices", "price_date"),
    "daily_kpis": ("market_kpis/daily_kpis", "kpi_date"),
    "product_metrics": ("product_intelligence/product_metrics", None),
    "category_metrics": ("product_intelligence/category_metrics", None),
}
BUILDERS = {
    "products_snapshot": gold.products_snapshot, "market_prices": gold.market_prices,
    "daily_kpis": gold.daily_kpis, "product_metrics": gold.product_metrics,
    "category_metrics": gold.category_metrics,
}


@dataclass
class LayerResult:
    """What a layer did; counts come from one aggregate row, never from the data."""
    layer: str
    run_id: str
    status: str
    records_input: int = 0
    records_output: int = 0
    records_deduplicated: int = 0
    duration_ms: float = 0.0
    files_created: dict[str, str] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


def land_bronze(records: DataFrame, root: str, run_id: str | None = None,
                now: datetime | None = None, raw_payloads: DataFrame | None = None
                ) -> LayerResult:
    """Check, type, enrich and append one batch; faulty records stay, flagged."""
    start = time.monotonic()
    if records.isEmpty():
        return LayerResult("bronze", "", "FAILED", errors=["Empty batch"])
    now = now or datetime.now(timezone.utc)
    run_id = run_id or bronze.new_run_id(now)
    stamp = F.lit(now.replace(tzinfo=None)).cast("timestamp_ntz")
    flagged = records.withColumn("_bad", F.size(bronze.record_errors()) > 0)
    typed = bronze.enrich(bronze.coerce_types(flagged), run_id, stamp, F.col("_bad"))
    writers.write_bronze(typed.drop("_bad").withColumn("run_ts", stamp), f"{root}/data")
    files = {"data_batch": f"{root}/data"}
    if raw_payloads is not None:
        files["raw_payload"] = writers.write_raw_payloads(
            raw_payloads, f"{root}/raw/run_id={run_id}")
    landed = (writers.read_bronze(records.sparkSession, f"{root}/data")
              .filter(F.col("run_id") == run_id).withColumn("run_ts", stamp))
    seconds = F.lit(time.monotonic() - start)
    files["metadata"] = writers.write_audit(audit.bronze_runs(landed, seconds), f"{root}/audit")
    docs = writers.read_audit(records.sparkSession, files["metadata"])
    total, bad = (docs.filter(F.col("run_id") == run_id)
                  .agg(F.sum("records.input"), F.sum("records.errors")).first())
    return LayerResult("bronze", run_id, "PARTIAL" if bad else "SUCCESS", total, total,
                       duration_ms=(time.monotonic() - start) * 1000, files_created=files,
                       errors=[f"{bad} records with errors"] if bad else [])


def clean_silver(landed: DataFrame, root: str, transformation_id: str | None = None,
                 keys: Sequence[str] = ("market", "search_term"), remove_duplicates: bool = True
                 ) -> tuple[LayerResult, DataFrame]:
    """Normalise, deduplicate, write, and judge every batch. Returns the batch statuses."""
    start = time.monotonic()
    spark = landed.sparkSession
    tid = transformation_id or silver.new_transformation_id()
    kept = silver.deduplicate(silver.normalize(landed, tid), remove_duplicates)
    partitions = ("year", "month", "day", "run_id")
    out = kept.drop(*partitions).withColumn("run_ts", F.current_timestamp())
    writers.write_silver(out, f"{root}/data")
    written = spark.read.parquet(f"{root}/data").filter(F.col("transformation_id") == tid)
    files = {"products": f"{root}/data", "statuses": f"{root}/statuses/transformation_id={tid}"}
    quality.status(quality.assess(written, keys), keys).write.parquet(files["statuses"])
    statuses = spark.read.parquet(files["statuses"])  # judged once: the gate reads them again
    documents = audit.silver_runs(written.withColumn("run_ts", F.current_timestamp()),
                                  F.lit(time.monotonic() - start))
    files["metadata"] = writers.write_audit(documents, f"{root}/audit")
    row = silver.dedup_summary(written).first()
    critical = statuses.filter("status = 'CRITICAL'").count()
    return LayerResult(
        "silver", tid, "PARTIAL" if critical else "SUCCESS", row["records_input"],
        row["records_output"], row["records_deduplicated"],
        (time.monotonic() - start) * 1000, files,
        [f"{critical} batches with critical quality"] if critical else []), statuses


def publish_gold(kept: DataFrame, root: str, run_id: str | None = None) -> LayerResult:
    """Build and write the five tables, each on its own: one failure leaves the others."""
    start = time.monotonic()
    run_id = run_id or f"gold_{uuid.uuid4().hex[:8]}"
    files: dict[str, str] = {}
    errors: list[str] = []
    for name, build in BUILDERS.items():
        path, partition = GOLD_TABLES[name]
        try:
            files[name] = writers.write_table(build(kept), f"{root}/{path}", partition)
        except Exception as error:  # noqa: BLE001 - reported, the other tables go on
            errors.append(f"{name}: {str(error).splitlines()[0]}")
    status = ("SUCCESS" if not errors else "PARTIAL" if len(errors) < len(files) else "FAILED")
    seconds = F.lit(time.monotonic() - start)
    writers.write_audit(audit.gold_runs(kept, run_id, F.current_timestamp(), seconds,
                                        status, len(files), len(errors)), f"{root}/audit")
    return LayerResult("gold", run_id, status, files_created=files, errors=errors,
                       duration_ms=(time.monotonic() - start) * 1000)


def run(spark: SparkSession, records: DataFrame, root: str, gated: bool = True
        ) -> dict[str, LayerResult]:
    """Bronze -> Silver -> gate -> Gold over every batch in ``records``."""
    landed = land_bronze(records, f"{root}/bronze")
    if landed.status == "FAILED":
        return {"bronze": landed}
    batch = (writers.read_bronze(spark, f"{root}/bronze/data")
             .filter(F.col("run_id") == landed.run_id))
    # a mistyped optional field is NULL by now; only a missing required one ends a record
    whole = F.lit(True)
    for name in schemas.REQUIRED_FIELDS:
        whole = whole & F.col(name).isNotNull()
    rows, dropped = batch.filter(whole), batch.filter(~whole).count()
    if dropped:
        landed.errors.append(f"{dropped} records without a required field left out")
    cleaned, statuses = clean_silver(rows, f"{root}/silver")
    kept = (spark.read.parquet(f"{root}/silver/data")
            .filter(F.col("transformation_id") == cleaned.run_id))
    if gated:
        kept = quality.gate(kept, statuses, ("market", "search_term"))
    if kept.isEmpty():
        return {"bronze": landed, "silver": cleaned}
    return {"bronze": landed, "silver": cleaned,
            "gold": publish_gold(kept, f"{root}/gold")}
