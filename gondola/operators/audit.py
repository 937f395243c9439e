"""Run documents: one nested row per run and layer, and reports over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola import schemas
from gondola.functions import numbers
from gondola.operators import bronze, quality

BUSINESS_COLUMNS = [c for c in schemas.BRONZE_FIELDS if c != "collected_at"]


def _document(layer: str, run: Column, run_ts: Column, seconds: Column, status: Column,
              counts: dict[str, Column], quality_doc: Column, null_rates: Column,
              batch_id: Column, source: Column) -> list[Column]:
    done = F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return [
        F.lit(layer).alias("layer"), run.alias("run_id"), F.col("market"),
        F.struct(F.date_format(run_ts, "yyyy-MM-dd").alias("run_date"),
                 done.alias("completed_at"), seconds.cast("double").alias("duration_seconds"),
                 status.alias("status")).alias("execution"),
        F.struct(*[counts.get(n, F.lit(0)).cast("double" if n == "deduplication_rate"
                                                else "bigint").alias(n)
                   for n in ("input", "output", "deduplicated", "errors",
                             "deduplication_rate")]).alias("records"),
        quality_doc.alias("quality"), null_rates.alias("null_rates"),
        batch_id.alias("batch_id"), source.alias("source")]


def bronze_runs(df: DataFrame, seconds: Column | None = None) -> DataFrame:
    """One document per (market, run) of a Bronze table with a ``run_ts`` column.

    A run with any faulty record is FAILED in its document; records are counted
    once however many errors they have.
    """
    bad = (F.col("bronze_error_flag") if "bronze_error_flag" in df.columns
           else F.size(bronze.record_errors()) > 0)
    g = df.groupBy("market", "bronze_run_id", "run_ts").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"),
        bronze.null_rate_map(BUSINESS_COLUMNS).alias("nulls"),
        bronze.batch_hash(BUSINESS_COLUMNS).alias("batch"))
    empty = F.struct(F.lit(None).cast("double").alias("quality_score"),
                     F.lit(None).cast("string").alias("status"),
                     F.lit(None).cast("int").alias("checks_passed"))
    return g.select(*_document(
        "bronze", F.col("bronze_run_id"), F.col("run_ts"),
        F.lit(0.0) if seconds is None else seconds,
        F.when(F.col("bad") > 0, "FAILED").otherwise("SUCCESS"),
        {"input": F.col("n"), "output": F.col("n") - F.col("bad"), "errors": F.col("bad")},
        empty, F.col("nulls"), F.col("batch"), F.lit(None).cast("string")))


def silver_runs(kept: DataFrame, seconds: Column | None = None) -> DataFrame:
    """One document per (market, run) of a deduplicated Silver table with ``run_ts``."""
    keys = ["market", "bronze_run_id", "run_ts"]
    checked = quality.assess(kept, keys)
    st = quality.status(checked, keys).drop("n", "failed_checks")
    counts = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("kept_rows"),
                                     F.sum("duplicate_count").alias("dups"))
    j = counts.join(st, keys)
    total = F.col("kept_rows") + F.col("dups")
    doc = F.struct(F.col("quality_score"), F.col("status"),
                   F.col("checks_passed").cast("int").alias("checks_passed"))
    run = F.concat(F.date_format("run_ts", "yyyyMMdd"), F.lit("_SV_"),
                   F.substring(F.md5("bronze_run_id"), 1, 4))
    return j.select(*_document(
        "silver", run, F.col("run_ts"), F.lit(0.0) if seconds is None else seconds,
        F.when(F.col("status") == "CRITICAL", "FAILED").otherwise("SUCCESS"),
        {"input": total, "output": F.col("kept_rows"), "deduplicated": F.col("dups"),
         "deduplication_rate": numbers.round_half_up(F.col("dups") / total, 4)},
        doc, F.create_map().cast("map<string,double>"), F.lit(None).cast("string"),
        F.col("bronze_run_id")))


def gold_runs(kept: DataFrame, run_id: str, run_ts: Column, seconds: Column, status: str,
              tables: int, failed: int) -> DataFrame:
    """One document per market of a Gold build: rows read, tables written and failed."""
    none = F.struct(F.lit(None).cast("double").alias("quality_score"),
                    F.lit(None).cast("string").alias("status"),
                    F.lit(None).cast("int").alias("checks_passed"))
    g = kept.groupBy("market").agg(F.count(F.lit(1)).alias("n")).withColumn("run_ts", run_ts)
    return g.select(*_document(
        "gold", F.lit(run_id), F.col("run_ts"), seconds,
        F.lit(status),
        {"input": F.col("n"), "output": F.lit(tables), "errors": F.lit(failed)}, none,
        F.create_map().cast("map<string,double>"), F.lit(None).cast("string"),
        F.lit(None).cast("string")))


def layer_totals(audit: DataFrame) -> DataFrame:
    """Records per layer and runs with errors."""
    return audit.groupBy("layer").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("records.output").alias("records"),
        F.count_if(F.col("execution.status") != "SUCCESS").alias("errors"))


def run_stats(audit: DataFrame) -> DataFrame:
    """Runs, records and date range per market."""
    return audit.groupBy("market").agg(
        F.count(F.lit(1)).alias("total_runs"), F.sum("records.input").alias("total_records"),
        F.min("execution.run_date").alias("earliest"),
        F.max("execution.run_date").alias("latest"))


def null_rate_stats(audit: DataFrame) -> DataFrame:
    """Null rates per field over all runs: how many runs, highest and mean rate."""
    rates = audit.select(F.explode("null_rates").alias("field", "rate"))
    units = F.sum(F.floor(F.col("rate") * 10000 + 0.5).cast("bigint"))
    n = F.count(F.lit(1))
    return rates.groupBy("field").agg(
        n.alias("runs"), F.max("rate").alias("max_rate"),
        (F.call_function("div", units * 2 + n, n * 2) / 10000.0).alias("mean_rate"))


def silver_metrics(audit: DataFrame) -> DataFrame:
    """Sums and means per market over Silver documents."""
    return audit.groupBy("market").agg(
        F.sum("records.output").alias("records_output"),
        F.sum("records.deduplicated").alias("deduplicated"),
        numbers.round_half_up(numbers.exact_mean(F.col("quality.quality_score"), 2))
        .alias("quality_score"),
        F.avg("execution.duration_seconds").alias("duration_s"))


def recent_runs(audit: DataFrame, k: int = 10) -> DataFrame:
    """Newest ``k`` runs."""
    return (audit.select("run_id", "market", F.col("execution.run_date").alias("run_date"),
                         F.col("execution.status").alias("status"),
                         F.col("quality.quality_score").alias("quality_score"))
            .orderBy(F.desc("run_date"), F.desc("run_id"), "market").limit(k))


def _day_of(now: Column, text: Column) -> Column:
    return F.datediff(now, F.to_date(text))


def health(audit: DataFrame, silver: DataFrame, size: DataFrame, now: Column) -> DataFrame:
    """Four status rows: recent runs, mean score, code validity, stored bytes (one row)."""
    recent = F.count_if(_day_of(now, F.col("execution.run_date")) < 1)
    score = numbers.round_half_up(F.coalesce(
        numbers.exact_mean(F.col("quality.quality_score"), 2), F.lit(0.0)))
    a = audit.agg(recent.cast("double").alias("recent_transformations"), score.alias("quality"))
    valid = numbers.round_half_up(F.count_if("ean_valid") / F.count("ean_valid"), 4)
    s = silver.agg(F.coalesce(valid, F.lit(0.0)).alias("ean_validity"))
    d = size.select((F.col("bytes") / F.lit(1024.0 ** 3)).alias("disk_usage"))
    limits = {"recent_transformations": F.col("value") > 0, "quality": F.col("value") > 80,
              "ean_validity": F.col("value") > 0.80, "disk_usage": F.col("value") < 100}
    rows = (a.unpivot([], ["recent_transformations", "quality"], "check_name", "value")
            .unionByName(s.unpivot([], ["ean_validity"], "check_name", "value"))
            .unionByName(d.unpivot([], ["disk_usage"], "check_name", "value")))
    ok = F.lit(False)
    for name, rule in limits.items():
        ok = F.when(F.col("check_name") == name, rule).otherwise(ok)
    bad = F.when(F.col("check_name") == "ean_validity", "ALERT").otherwise("WARNING")
    return rows.select("check_name", "value", F.when(ok, "OK").otherwise(bad).alias("status"))


def bronze_alerts(audit: DataFrame, now: Column, limit: float = 0.80) -> DataFrame:
    """Alert rows: no run on the day ``now``, or a field's null rate above the limit."""
    today = (audit.agg(F.count_if(_day_of(now, F.col("execution.run_date")) == 0).alias("n"))
             .filter("n = 0").select(F.lit("no_runs_today").alias("alert"),
                                     F.lit(None).cast("string").alias("field"),
                                     F.lit(None).cast("double").alias("value")))
    high = (audit.select(F.explode("null_rates").alias("field", "rate")).groupBy("field")
            .agg(F.max("rate").alias("value")).filter(F.col("value") > limit)
            .select(F.lit("high_null_rate").alias("alert"), "field", "value"))
    return today.unionByName(high)


def incomplete_runs(data: DataFrame, audit: DataFrame, keys: Sequence[str] = ("market", "run_id")
                    ) -> DataFrame:
    """Runs that have data but no SUCCESS document (anti join on one row per run)."""
    done = audit.filter(F.col("execution.status") == "SUCCESS").select(*keys)
    return data.select(*keys).distinct().join(done, list(keys), "left_anti")


def replayed_batches(batches: DataFrame, audit: DataFrame) -> DataFrame:
    """Batches whose identity the audit table already holds (semi join)."""
    seen = audit.select("batch_id").filter(F.col("batch_id").isNotNull())
    return batches.join(seen, "batch_id", "left_semi")
