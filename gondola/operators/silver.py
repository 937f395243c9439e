"""Silver: normalise, score and deduplicate records."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola import dims
from gondola.functions import ean, numbers, scoring, text, units
from gondola.operators.ordered import best_row, descending, micros, nulls_last

DEDUP_KEYS = ["market", "ean_normalized", "product_name_normalized"]


def new_transformation_id(now: datetime | None = None, suffix: str | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    return f"{now:%Y%m%d}_SV_{suffix or uuid.uuid4().hex[:12]}"


def normalize(df: DataFrame, transformation_id: str | None = None) -> DataFrame:
    """The cleaned columns, quality columns and lineage of a Bronze table.

    Projections only: no shuffle, so it runs inside the scan stage. A value used
    several times gets a projection of its own, which keeps generated code small.
    """
    if isinstance(df.schema["collected_at"].dataType, T.StringType):
        df = df.withColumn("collected_at", F.try_to_timestamp("collected_at"))
    coded = ean.with_validity(df.withColumns({
        "_unit": units.volume_unit(F.col("product_name")),
        "_category": text.category_key(F.col("category")),
        "_brand": text.brand_base(F.col("brand")),
        "data_completeness": scoring.data_completeness()}))
    first = coded.withColumns({
        "product_name_normalized": text.norm_name(F.col("product_name")),
        "price_normalized": numbers.norm_price(F.col("price")),
        "unit_normalized": units.norm_unit(F.col("_unit")),
        "category_normalized": text.category_of(F.col("_category")),
        "brand_normalized": text.brand_of(F.col("_brand"))}).drop(
            "_unit", "_category", "_brand")
    out = first.withColumns({
        "quality_score": scoring.quality_score(F.col("data_completeness"), F.col("ean_valid")),
        "quality_flags": scoring.quality_flags(F.col("ean_valid"), F.col("data_completeness"),
                                               F.col("category_normalized"))})
    if transformation_id:
        out = out.withColumns({"silver_transformation_id": F.lit(transformation_id),
                               "silver_ingestion_timestamp": F.current_timestamp()})
    return out


def keep_order() -> list[Column]:
    """Best record first: valid code, fullest, newest, cheapest; the id makes it total."""
    return [~F.col("ean_valid"), descending(F.col("data_completeness")),
            descending(micros(F.col("collected_at"))), *nulls_last(F.col("price")),
            F.col("record_id")]


def deduplicate(df: DataFrame, remove_duplicates: bool = True) -> DataFrame:
    """Keep the best record of each (market, code, name); NULL keys group together.

    The kept row carries ``duplicate_count`` = group size - 1. With the switch off
    every row stays, unmarked.
    """
    flag = {"is_duplicate": F.lit(False)}
    if not remove_duplicates:
        return df.withColumns({**flag, "duplicate_count": F.lit(0).cast("bigint"),
                               "duplicate_of_id": F.lit(None).cast("string")})
    size = (F.count(F.lit(1)) - 1).alias("duplicate_count")
    kept = best_row(df, DEDUP_KEYS, keep_order(), [size])
    return kept.withColumns({**flag, "duplicate_of_id": F.lit(None).cast("string")})


def normalize_kept(df: DataFrame) -> DataFrame:
    """``deduplicate(normalize(df))`` that shuffles the raw columns and the keys only.

    What is made of a record is made again for the kept ones. Columns are the same.
    """
    made = normalize(df)
    judged = [c for c in (*DEDUP_KEYS, "ean_valid", "data_completeness") if c not in df.columns]
    kept = deduplicate(made.select(*df.columns, *judged))
    found = ["duplicate_count", "is_duplicate", "duplicate_of_id"]
    again = normalize(kept.select(*df.columns, *found))
    rest = [c for c in made.columns if c not in DEDUP_KEYS]
    return again.select(*DEDUP_KEYS, *rest, *found)


def mark_losers(df: DataFrame) -> DataFrame:
    """Every record, with ``is_duplicate`` and the id of the record kept instead.

    The winners come from a map-side combined aggregate and join back on the key:
    a hot group is then a skewed join side, which AQE splits, not one window task.
    Exact copies need a ``record_id`` of their own to be told apart.
    """
    winner = F.min_by("record_id", F.struct(*keep_order())).alias("_kept")
    kept = df.groupBy(*DEDUP_KEYS).agg(winner).select(
        *[F.col(k).alias(f"_k_{k}") for k in DEDUP_KEYS], "_kept")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in DEDUP_KEYS]
    lost = F.col("record_id") != F.col("_kept")
    return df.join(kept, same).select(
        *df.columns, lost.alias("is_duplicate"), F.when(lost, F.col("_kept"))
        .alias("duplicate_of_id"))


def dedup_summary(kept: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Records before, removed, after, and the removal rate with four decimals."""
    removed = F.coalesce(F.sum("duplicate_count"), F.lit(0))
    after = F.count(F.lit(1))
    return kept.groupBy(*keys).agg(
        (after + removed).alias("records_input"), removed.alias("records_deduplicated"),
        after.alias("records_output"),
        F.coalesce(numbers.round_half_up(removed / F.nullif(after + removed, F.lit(0)), 4),
                   F.lit(0.0)).alias("deduplication_rate"))


def category_edges(spark: SparkSession) -> DataFrame:
    """The documented (parent, child) dimension."""
    rows = [F.struct(F.lit(parent).alias("parent"), F.lit(child).alias("child"))
            for parent, children in dims.CATEGORY_CHILDREN.items() for child in children]
    return spark.range(1).select(F.inline(F.array(*rows)))


def category_closure(edges: DataFrame) -> DataFrame:
    """(node, ancestor, depth): every ancestor of every child of a (parent, child) dimension.

    A recursion over the dimension alone, of any depth that the session allows (100
    levels); a cycle exceeds it and is reported as an error.
    """
    return edges.sparkSession.sql("""
        WITH RECURSIVE up(node, ancestor, depth) AS (
          SELECT child, parent, CAST(1 AS BIGINT) FROM {edges}
          UNION ALL
          SELECT up.node, e.parent, up.depth + 1 FROM up JOIN {edges} e ON e.child = up.ancestor)
        SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY node, ancestor""", edges=edges)


def category_levels(df: DataFrame, keep: list[str], edges: DataFrame | None = None) -> DataFrame:
    """(keep, parent, child, depth): every standard of a raw category, and its node below it.

    A standard is an ancestor. The child is the node that the raw category names, if it
    lies below that standard at any depth; where it names none, the child is NULL and the
    depth 0. The dimension is joined by (ancestor, name); it stays small or is shuffled,
    as adaptive execution finds.
    """
    edges = category_edges(df.sparkSession) if edges is None else edges
    nodes = category_closure(edges).select(
        F.col("ancestor").alias("_parent"), F.col("node").alias("child"),
        F.lower("node").alias("_child"), F.col("depth").alias("_depth"))
    standards = df.select(*keep, text.category_key(F.col("category")).alias("_key"),
                          F.explode(text.category_multi(F.col("category"))).alias("parent"))
    same = (F.col("parent") == F.col("_parent")) & (F.col("_key") == F.col("_child"))
    depth = F.coalesce(F.col("_depth"), F.lit(0).cast("bigint")).alias("depth")
    return standards.join(nodes, same, "left").select(*keep, "parent", "child", depth)
