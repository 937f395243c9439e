"""Bronze: typed landing of records, violations, profile, batch identity."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola import schemas
from gondola.functions import numbers

VERSION = "1.0.0"


def new_run_id(now: datetime | None = None, suffix: str | None = None) -> str:
    """``YYYYMMDD_HHMMSS_<8 hex>``: sortable and collision resistant."""
    now = now or datetime.now(timezone.utc)
    return f"{now:%Y%m%d_%H%M%S}_{suffix or uuid.uuid4().hex[:8]}"


def enrich(df: DataFrame, run_id: str | Column, ingested_at: Column | None = None,
           error_flag: Column | None = None) -> DataFrame:
    """Add ingestion time, run id, format version and error flag."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumns({
        "bronze_ingestion_timestamp": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "bronze_run_id": F.lit(run_id) if isinstance(run_id, str) else run_id,
        "bronze_data_version": F.lit(VERSION),
        "bronze_error_flag": F.lit(False) if error_flag is None else error_flag})


def coerce_types(df: DataFrame) -> DataFrame:
    """Text fields to STRING, numeric fields to DOUBLE (decimal comma accepted).

    What cannot be read as a number becomes NULL and is reported by
    :func:`violations`, which looks at the raw values.
    """
    out = {}
    for field in schemas.RECORD.fields:
        if field.name not in df.columns:
            continue
        c = F.col(field.name)
        out[field.name] = (numbers.comma_to_float(c) if field.name in schemas.NUMERIC_FIELDS
                           else c.cast("string"))
    return df.withColumns(out)


def _missing(name: str) -> Column:
    return F.when(F.col(name).isNull(),
                  F.struct(F.lit(name).alias("field"), F.lit("missing_required").alias("rule")))


def _mistyped(name: str) -> Column:
    c = F.col(name)
    bad = c.isNotNull() & numbers.comma_to_float(c).isNull()
    return F.when(bad, F.struct(F.lit(name).alias("field"), F.lit("not_a_number").alias("rule")))


def record_errors(required: Sequence[str] = tuple(schemas.REQUIRED_FIELDS),
                  numeric: Sequence[str] = tuple(schemas.NUMERIC_FIELDS)) -> Column:
    """Array of ``struct(field, rule)`` for the raw values of one record."""
    checks = [_missing(n) for n in required] + [_mistyped(n) for n in numeric]
    return F.array_compact(F.array(*checks))


def violations(df: DataFrame, required: Sequence[str] = tuple(schemas.REQUIRED_FIELDS),
               numeric: Sequence[str] = tuple(schemas.NUMERIC_FIELDS)) -> DataFrame:
    """One row per record and broken rule: ``record_id, field, rule``."""
    return (df.select("record_id", F.explode(record_errors(required, numeric)).alias("e"))
            .select("record_id", "e.field", "e.rule"))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, null_rate`` (four decimals) of every column that has NULLs."""
    nulls = df.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (nulls.unpivot(["_n"], list(columns), "column_name", "null_count")
            .filter(F.col("null_count") > 0)
            .select("column_name", "null_count",
                    numbers.round_half_up(F.col("null_count") / F.col("_n"), 4)
                    .alias("null_rate")))


def null_rate_map(columns: Sequence[str]) -> Column:
    """Aggregate: map of column name to null rate, only rates above zero."""
    entries = []
    for c in columns:
        rate = numbers.round_half_up(F.count_if(F.col(c).isNull()) / F.count(F.lit(1)), 4)
        entries.append(F.struct(F.lit(c).alias("key"), rate.alias("value")))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"] > 0))


def batch_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Records in total, with an error, and without (an error counts its record once)."""
    bad = F.size(record_errors()) > 0
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~bad).alias("valid_records"), F.count_if(bad).alias("invalid_records"))


def row_text(columns: Sequence[str]) -> Column:
    """One text per row: values in column order, NULL told from empty, numbers with six decimals."""
    parts = []
    for name in columns:
        c = F.col(name).cast("string")
        if name in schemas.NUMERIC_FIELDS:
            c = F.coalesce(F.col(name).try_cast("decimal(38,6)").cast("string"), c)
        parts.append(F.coalesce(F.concat(F.lit("="), c), F.lit("")))
    return F.concat_ws("\u001f", *parts)


def batch_hash(columns: Sequence[str]) -> Column:
    """Aggregate: order-free identity of a batch over its business columns.

    Rows are counted and two 60-bit pieces of their MD5 are added up: sums are the same
    under any order and partitioning, and tell repeated records from single ones.
    """
    digest = F.md5(row_text(columns))
    sums = [F.sum(F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)"))
            for start in (1, 16)]
    return F.concat_ws("-", F.count(F.lit(1)).cast("string"), *[s.cast("string") for s in sums])


def date_parts(ts: Column) -> dict[str, Column]:
    return {"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd")}


def batch_guard(batches: DataFrame, records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Announced batches with their record count: a batch without any record is FAILED."""
    counts = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return batches.join(counts, list(keys), "left").select(
        *keys, n.alias("records"), F.when(n == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(n == 0, "Empty batch").alias("error"))
