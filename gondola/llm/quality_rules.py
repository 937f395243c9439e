"""Quality rules with thresholds that adapt to language and source. DataFrame functions only.

Each measure of a document falls in one of a bounded number of bins: shares in steps of
a thousandth, sizes in eight steps per power of two. The counts of the bins are a
quantile sketch: sketches of any parts of the corpus merge by addition, exactly, whatever
the order. From the sketch of a (language, source) come the limits of its documents; a
group of fewer than ``least`` documents uses the merged sketch of its language, and a
language of fewer the sketch of all. A limit lies well outside the middle half of the
group, so it moves with what is usual there, and a document goes only if it is far off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.frames import stored

_BLANK = r"[\x20\x09-\x0D]"
# share -> least spread, in thousandths: equal documents do not make others outliers
SHARES = {"symbol_share": 2, "line_share": 100, "repeat_share": 60}
SIZES = ("word_size",)
STEPS = 1000


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to every row.

    A null text has no words. Repeated windows are found by sorting 64-bit hashes of the
    windows of one text; text is never exploded to rows.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(value, _BLANK + "+"), "")
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"_words": words, "_lines": lines})
    # (hash, start) of every three-word window, as one sorted array
    windows = F.when(F.size("_words") < 4, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size("_words") - 2), lambda i: F.struct(
            F.xxhash64(F.get("_words", i - 1), F.get("_words", i), F.get("_words", i + 1))
            .alias("h"), i.cast("int").alias("i"))))
    out = out.withColumn("_windows", F.sort_array(windows))
    # starts of windows that a neighbour in hash order equals, back in text order
    n = F.size("_windows")
    same = F.filter("_windows", lambda w, k: (
        (w["h"] == F.get("_windows", k - 1)["h"]) & (k > 0)
        | (w["h"] == F.get("_windows", k + 1)["h"]) & (k + 1 < n)))
    out = out.withColumn("_starts", F.sort_array(F.transform(same, lambda w: w["i"])))
    covered = F.aggregate("_starts", F.struct(F.lit(0).alias("n"), F.lit(-2).alias("at")),
                          lambda a, i: F.struct(
                              (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"), i.alias("at")),
                          lambda a: a["n"])
    return out.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(value).cast("bigint") - F.regexp_count(value, F.lit(_BLANK)),
        "n_symbols": F.regexp_count(value, F.lit(r"[#*$%&|<>]")).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_repeat_words": covered.cast("bigint"),
    }).drop("_words", "_lines", "_windows", "_starts")


def measures() -> dict[str, Column]:
    """Bin of every measure: whole numbers, so they are the same on every engine."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    share = lambda a, b: F.floor(F.lit(STEPS) * F.col(a) / b).cast("bigint")
    size = F.expr("8 * word_chars div greatest(n_words, 1)")
    return {"symbol_share": share("n_symbols", chars),
            "line_share": share("n_dup_lines", F.greatest("n_lines", F.lit(1))),
            "repeat_share": share("n_repeat_words", words),
            "word_size": F.least(size.cast("bigint"), F.lit(8 * STEPS))}


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): bins of each group, at most a few thousand."""
    pairs = [F.struct(F.lit(m).alias("measure"), F.col(m).alias("bin"))
             for m in (*SHARES, *SIZES)]
    return (measured.select("_lang", "_source", F.inline(F.array(*pairs)))
            .groupBy("_lang", "_source", "measure", "bin").agg(F.count(F.lit(1)).alias("n")))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of the wider groups ``keys``: bins of the same value add up."""
    return sketches.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def limits(sketches: DataFrame, keys: list[str], reach: int,
           tail: int | None = None) -> DataFrame:
    """(keys, measure, docs, low, high) from the quartiles of each sketch.

    With ``tail``, the high limit of a share is its ``tail`` hundredth quantile: the least
    bin that so many of the group's documents do not exceed. Bins that tie with it stay.
    """
    group = Window.partitionBy(*keys, "measure")
    running = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (sketches.withColumn("_upto", F.sum("n").over(running))
              .withColumn("_total", F.sum("n").over(group)))
    quartile = lambda q: F.min(F.when(F.col("_upto") * 4 >= F.col("_total") * q, F.col("bin")))
    found = ranked.groupBy(*keys, "measure").agg(
        F.max("_total").alias("docs"), quartile(1).alias("q1"), quartile(2).alias("q2"),
        quartile(3).alias("q3"), *([] if tail is None else [
            F.min(F.when(F.col("_upto") * 100 >= F.col("_total") * tail, F.col("bin")))
            .alias("_tail")]))
    least = F.expr("q2 div 8")
    for name, value in SHARES.items():
        least = F.when(F.col("measure") == name, F.lit(value)).otherwise(least)
    spread = F.greatest(F.col("q3") - F.col("q1"), least, F.lit(1))
    high = F.col("q3") + reach * spread
    if tail is not None:
        high = F.when(F.col("measure").isin(*SHARES), F.col("_tail")).otherwise(high)
    return found.select(*keys, "measure", "docs",
                        (F.col("q1") - reach * spread).alias("low"), high.alias("high"))


def _wide(found: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """One row per group: limits of every measure side by side."""
    picked = [F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{prefix}_{m}_{c}")
              for m in (*SHARES, *SIZES) for c in ("low", "high")]
    return found.groupBy(*[F.col(k).alias(f"{prefix}{k}") for k in keys]).agg(
        F.max("docs").alias(f"{prefix}_docs"), *picked)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  lang: str = "lang", source: str = "source", least: int = 200,
                  reach: int = 6, min_words: int = 50,
                  tail: int | None = None) -> DataFrame:
    """Per row: counts, ``base_failed``, and ``kept`` by the adaptive limits.

    ``base_failed``: fewer than ``min_words`` words, or more than half of them in
    three-word windows that come twice. A document is kept if the base holds and no
    share is over its limit, and its mean word size is between its limits. Limits come
    from documents that pass the base, so short and broken ones do not move them. Null
    languages and sources are groups of their own. Null and empty texts fail the base;
    repeated rows each count and give a row. No documents give no rows. Other columns
    are ignored. With ``tail``, shares are limited by that quantile of the group (see
    ``limits``), no fixed spread decides, and ``over_<measure>`` tells the rules that a
    document of the base breaks.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(lang).cast("string").alias("_lang"),
                       F.col(source).cast("string").alias("_source"), F.col(text).alias("_text"))
    counted = features(rows, "_text").drop("_text").withColumn(
        "base_failed", (F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    measured = stored(counted.withColumns(measures()), "quality")
    fine = stored(sketch(measured.filter("not base_failed")), "quality-sketch")
    by_lang = merge(fine, ["_lang"])
    g = _wide(limits(fine, ["_lang", "_source"], reach, tail), ["_lang", "_source"], "g")
    l = _wide(limits(by_lang, ["_lang"], reach, tail), ["_lang"], "l")  # noqa: E741
    a = _wide(limits(merge(by_lang, []), [], reach, tail), [], "a")
    joined = (measured
              .join(g, F.col("_lang").eqNullSafe(F.col("g_lang"))
                    & F.col("_source").eqNullSafe(F.col("g_source")), "left")
              .join(l, F.col("_lang").eqNullSafe(F.col("l_lang")), "left")
              .join(F.broadcast(a), how="left"))

    def limit(measure: str, side: str) -> Column:
        name = f"_{measure}_{side}"
        return (F.when(F.col("g_docs") >= least, F.col(f"g{name}"))
                .when(F.col("l_docs") >= least, F.col(f"l{name}")).otherwise(F.col(f"a{name}")))

    over = {m: F.col(m) > limit(m, "high") for m in SHARES}
    over |= {m: ~F.col(m).between(limit(m, "low"), limit(m, "high")) for m in SIZES}
    good = ~F.col("base_failed")
    for broken in over.values():
        good = good & ~broken
    rules = [] if tail is None else [
        F.coalesce(~F.col("base_failed") & broken, F.lit(False)).alias(f"over_{m}")
        for m, broken in over.items()]
    return joined.select(F.col("_id").alias(doc_id), "n_words", "word_chars", "n_symbols",
                         "n_dup_lines", "n_repeat_words", "base_failed",
                         F.coalesce(good, F.lit(False)).alias("kept"), *rules)
