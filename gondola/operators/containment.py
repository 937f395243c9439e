"""Joins of texts with a dimension of patterns by containment, without comparing all pairs.

A text can only contain another if it holds all of its q-grams. So the contained side
offers one q-gram, the rarest it has among the patterns, and the containing side all of
its own; they meet in an equi-join and only these candidates are compared. Texts shorter
than q have no q-gram: they meet the equal substrings of the other side. Both directions
are joined, and a term keeps the first match by ordinal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 3


def substrings(c: Column, size: int) -> Column:
    """Distinct substrings of ``size`` characters, as an array."""
    places = F.when(F.length(c) >= size, F.sequence(F.lit(1), F.length(c) - (size - 1)))
    return F.array_distinct(F.transform(places, lambda i: F.substr(c, i, F.lit(size))))


def _shorter(c: Column, q: int) -> Column:
    """Distinct substrings of 1 to q - 1 characters."""
    parts = [F.coalesce(substrings(c, n), F.array().cast("array<string>")) for n in range(1, q)]
    return F.flatten(F.array(*parts))


def candidates(terms: DataFrame, dim: DataFrame, q: int = Q) -> DataFrame:
    """(term, ord, pattern, standard) where one may contain the other; a pair may come twice."""
    term, pattern = F.col("term"), F.col("pattern")
    own = ["ord", "pattern", "standard"]
    long_p, short_p = dim.filter(F.length(pattern) >= q), dim.filter(
        F.length(pattern).between(1, q - 1))
    long_t, short_t = terms.filter(F.length(term) >= q), terms.filter(
        F.length(term).between(1, q - 1))
    p_grams = long_p.select(*own, F.explode(substrings(pattern, q)).alias("gram"))
    t_grams = long_t.select("term", F.size(substrings(term, q)).alias("_all"),
                            F.explode(substrings(term, q)).alias("gram"))
    often = p_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = F.min_by("gram", F.struct("_n", "gram")).alias("gram")
    # a term holds a pattern: the pattern offers its rarest gram
    offered = p_grams.join(often, "gram").groupBy(*own).agg(rarest)
    inside = t_grams.join(offered, "gram").select("term", *own)
    tiny = long_t.unionByName(short_t).select("term", F.explode(_shorter(term, q)).alias("pattern"))
    inside_tiny = tiny.join(short_p, "pattern").select("term", *own)
    # a pattern holds a term: some pattern must know every gram of the term
    known = (t_grams.join(often, "gram").groupBy("term", "_all")
             .agg(rarest, F.count(F.lit(1)).alias("_known")).filter("_known = _all"))
    around = known.join(p_grams, "gram").select("term", *own)
    pieces = dim.select(*own, F.explode(_shorter(pattern, q)).alias("term"))
    around_tiny = short_t.join(pieces, "term").select("term", *own)
    return inside.unionByName(inside_tiny).unionByName(around).unionByName(around_tiny)


def first_match(terms: DataFrame, dim: DataFrame, q: int = Q) -> DataFrame:
    """(term, standard) of every distinct term: its first pattern by ``ord``, else NULL.

    ``dim`` has ``ord``, ``pattern`` and ``standard``. Empty and NULL texts match nothing.
    """
    terms = terms.select("term").distinct()
    hit = (F.contains(F.col("term"), F.col("pattern"))
           | F.contains(F.col("pattern"), F.col("term")))
    best = (candidates(terms, dim, q).filter(hit).groupBy(F.col("term").alias("_term"))
            .agg(F.min_by("standard", "ord").alias("standard")))
    return terms.join(best, F.col("term").eqNullSafe(F.col("_term")), "left").drop("_term")
