"""Best-of-group, exact statistics and ordered access that survive hot groups.

Plain windows put a whole group into one task. These operators combine before
the shuffle, or cut a group into ordered slices, so that one key may hold a
third of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions import numbers
from gondola.session import reliable_checkpoint


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
             extra: Sequence[Column] = ()) -> DataFrame:
    """One whole row per group: the first in ``order``. NULL keys form one group.

    An aggregate keeps one candidate per group and map task, so the shuffle
    carries no losers. ``order`` must be total; use :func:`descending` and
    :func:`nulls_last` to build it.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    out = df.groupBy(*keys).agg(picked, *extra)
    added = [c for c in out.columns if c not in keys and c != "_row"]
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest], *added)


def descending(c: Column) -> Column:
    """Sort key that turns ascending order round, for numbers, flags and timestamps."""
    return -c


def micros(c: Column) -> Column:
    """Microseconds of a timestamp, comparable and negatable."""
    return F.unix_micros(c.cast("timestamp"))


def nulls_last(c: Column) -> list[Column]:
    return [c.isNull(), c]


SLICE_BITS = (40, 20)  # widths of value slices, coarse to fine: 2^40 and 2^20 cents


def ranked_slices(hist: DataFrame, keys: Sequence[str], value: str, count: str,
                  bits: Sequence[int] = SLICE_BITS) -> DataFrame:
    """Histogram rows with ``_before`` (values of their group that are smaller) and ``_total``.

    ``hist`` has one row per (keys, value); NULL values are not ranked. The values of a
    group are cut into slices of 2^bits, coarse to fine. Every level adds up its slices,
    and a position is the sum of what lies before on each level. No window holds more
    than the rows of one slice (2^20 at most; 2^23 coarse slices cover 64 bits), so a
    group may have any number of rows and of distinct values.
    """
    names = [f"_slice{b}" for b in bits]
    cut = hist.withColumns({n: F.shiftright(value, b) for n, b in zip(names, bits)})
    ranked = F.when(F.col(value).isNotNull(), F.col(count))
    out, outer = cut, list(keys)
    sums = cut.groupBy(*keys, *names).agg(F.sum(ranked).alias("_n"))  # of the finest slices
    levels = []
    for depth, name in enumerate(names):
        level = sums.groupBy(*keys, *names[:depth + 1]).agg(F.sum("_n").alias("_n"))
        level = level.withColumn("_before", _before("_n", outer, name))
        if depth == 0:
            level = level.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
        levels.append((level.drop("_n"), [*keys, *names[:depth + 1]]))
        outer = [*keys, *names[:depth + 1]]
    out = out.withColumn("_before0", _before(ranked, outer, value))
    for depth, (level, on) in enumerate(levels):
        side = level.select(*[F.col(k).alias(f"_on{depth}_{k}") for k in on],
                            F.col("_before").alias(f"_before{depth + 1}"),
                            *(["_total"] if depth == 0 else []))
        same = [F.col(k).eqNullSafe(F.col(f"_on{depth}_{k}")) for k in on]
        out = out.join(side, same).drop(*[f"_on{depth}_{k}" for k in on])
    parts = [f"_before{i}" for i in range(len(levels) + 1)]
    position = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    return out.withColumn("_before", position).drop(*parts, *names)


def _before(count: Column | str, part: Sequence[str], order: str) -> Column:
    """Sum of the rows before, in a window of ``part``."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(w), F.lit(0))


def quartiles(value: str, count: str) -> dict[str, Column]:
    """Aggregates over :func:`ranked_slices` rows: exact quartiles, interpolated as usual."""
    out = {}
    for name, k in (("q25", 1), ("median", 2), ("q75", 3)):
        step = (F.col("_total") - 1) * k
        at = {"lo": F.floor(step / 4), "hi": F.ceil(step / 4)}
        lo, hi = (F.max(F.when((F.col("_before") <= r) & (r < F.col("_before") + F.col(count)),
                               F.col(value))) for r in at.values())
        part = F.max(F.pmod(step, F.lit(4)))
        out[name] = (lo * (4 - part) + hi * part) / F.lit(4.0)
    return out


def price_stats(df: DataFrame, keys: Sequence[str], price: str = "price_normalized",
                extra: Sequence[tuple[str, Column, str]] = (), ranks: bool = True) -> DataFrame:
    """Exact count, mean, median, deviation and range of a price per group.

    Level one counts equal prices per group; level two ranks these counts slice by slice
    (:func:`ranked_slices`) and combines them, so no task holds the prices of a group.
    Sums are exact integers, hence independent of row order and of retries. Without
    ``ranks`` the quartiles are left out, and their shuffle with them.

    ``extra`` are ``(name, level-one aggregate, combining function)`` triples;
    ``n_rows`` counts all rows, ``n_prices`` those with a price.
    """
    base = df.withColumn("_c", numbers.cents(F.col(price)))
    hist = base.groupBy(*keys, "_c").agg(
        F.count(F.lit(1)).alias("_n"), *[agg.alias(f"_x_{name}") for name, agg, _ in extra])
    n = F.when(F.col("_c").isNotNull(), F.col("_n"))
    wide = F.col("_c").cast("decimal(20,0)")
    rows = ranked_slices(hist, keys, "_c", "_n") if ranks else hist
    places = quartiles("_c", "_n") if ranks else {}
    stats = rows.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"), F.coalesce(F.sum(n), F.lit(0)).alias("n_prices"),
        F.sum(F.col("_c") * F.col("_n")).alias("_s"),
        F.sum((wide * wide * F.col("_n")).cast("decimal(38,0)")).alias("_q"),
        F.min("_c").alias("_lo"), F.max("_c").alias("_hi"),
        *[c.alias(f"_p_{name}") for name, c in places.items()],
        *[getattr(F, how)(f"_x_{name}").alias(name) for name, _, how in extra])
    count, total, squares = F.col("n_prices"), F.col("_s"), F.col("_q")
    return stats.select(
        *keys, "n_rows", "n_prices", total.alias("sum_cents"),
        numbers.mean_of_cents(total, count).alias("mean"),
        *[(F.col(f"_p_{name}") / F.lit(100.0)).alias(name) for name in places],
        numbers.stddev_of_cents(count, total, squares).alias("stddev"),
        (F.col("_lo") / F.lit(100.0)).alias("low"), (F.col("_hi") / F.lit(100.0)).alias("high"),
        *[name for name, _, _ in extra])


def cents_round(c: Column) -> Column:
    """Two decimals of a value that is a whole number of half cents or finer."""
    return F.floor(F.round(c * F.lit(100.0), 6) + F.lit(0.5)) / F.lit(100.0)


# --- ordered access -------------------------------------------------------------

def _slices(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cut the global order into even slices and fix them in the shared folder.

    The range bounds come from a sample, so the slice number is stored once
    instead of being computed again by each branch.
    """
    cut = df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id())
    return reliable_checkpoint(cut)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               before: dict[str, str], after: dict[str, str] | None = None) -> DataFrame:
    """LAG (``before``) and LEAD (``after``) columns: ``{new name: source column}``.

    ``order`` must be total within ``keys``. A group may hold any share of the rows: it
    spans slices, and the row at a slice edge looks up the edge row of the slice next
    to it. Where groups are bounded, a plain window does the same.
    """
    return _beside(_slices(df, keys, order), keys, order, before, after or {}).drop("_slice")


def _beside(cut: DataFrame, keys: Sequence[str], order: Sequence[str], before: dict[str, str],
            after: dict[str, str]) -> DataFrame:
    """``neighbours`` of rows that are cut into slices already."""
    part = [*keys, "_slice"]
    w = Window.partitionBy(*part).orderBy(*order)
    sources = sorted({*before.values(), *after.values()})
    row = F.struct(*sources)
    edges = cut.groupBy(*part).agg(F.min_by(row, F.struct(*order)).alias("_first"),
                                   F.max_by(row, F.struct(*order)).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_slice")
    edges = edges.select(*[F.col(k).alias(f"_k_{k}") for k in part],
                         F.lag("_last").over(across).alias("_prev"),
                         F.lead("_first").over(across).alias("_next"))
    inner = cut.withColumns({"_pos": F.row_number().over(w),
                             "_end": F.lead(F.lit(1)).over(w).isNull(),
                             **{new: F.lag(src).over(w) for new, src in before.items()},
                             **{new: F.lead(src).over(w) for new, src in after.items()}})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in part]
    joined = inner.join(edges, same, "left")
    fixed = {new: F.when(F.col("_pos") == 1, F.col("_prev")[src]).otherwise(F.col(new))
             for new, src in before.items()}
    fixed |= {new: F.when(F.col("_end"), F.col("_next")[src]).otherwise(F.col(new))
              for new, src in after.items()}
    return joined.withColumns(fixed).select(*cut.columns, *before, *after)


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], before: dict[str, str],
            after: dict[str, str], linked: Column, carry: str) -> DataFrame:
    """Chains of rows that are each linked with the row before, over hot groups.

    ``before`` and ``after`` add columns as :func:`neighbours` does, and ``linked`` says
    over them whether a row belongs to the island of the row before it. Adds
    ``island`` (numbered from 1 within ``keys``) and ``island_first`` (the ``carry`` column
    of the island's first row). Islands may cross any number of slices: a slice hands on
    how many islands began in it and the first row of its last one.
    """
    rows = _beside(_slices(df, keys, order), keys, order, before, after)
    opens = ~F.coalesce(linked, F.lit(False))
    rows = rows.withColumn("_opens", F.when(opens, F.struct(F.col(carry).alias("v"))))
    part = [*keys, "_slice"]
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.withColumns({"_number": F.count("_opens").over(w),
                              "_first": F.last("_opens", ignorenulls=True).over(w)})
    own = F.when(F.col("_opens").isNotNull(), F.struct(*order))
    slices = rows.groupBy(*part).agg(F.count("_opens").alias("_n"),
                                     F.max_by("_opens", own).alias("_last"))
    across = (Window.partitionBy(*keys).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    handed = slices.select(*[F.col(k).alias(f"_k_{k}") for k in part],
                           F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_before"),
                           F.last("_last", ignorenulls=True).over(across).alias("_open"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in part]
    return inner.join(handed, same).select(
        *df.columns, *before, *after, (F.col("_before") + F.col("_number")).alias("island"),
        F.coalesce("_first", "_open")["v"].alias("island_first"))
