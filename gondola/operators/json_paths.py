"""What JSON texts hold: every path at every depth, with types and counts, and what is damaged.

Texts are parsed to VARIANT, so no schema is needed and none is guessed from a sample.
Every text is parsed and reduced to its shape, which keeps all but the values of scalars; what
lies where is the same in all texts of one shape, so a shape is unfolded once and counts as
many times as it comes.
All levels are unfolded in one pass: a container is counted, and beside it goes on to be
exploded by the next level. Rows are aggregated by path at the end, where partial sums
keep the shuffle to one row per path and task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.session import reliable_checkpoint

MALFORMED = "MALFORMED"
LEVELS = 16  # levels of one plan; deeper texts go on from a checkpoint

_IN_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+"'  # what follows the first quote
# Keys are kept whole; a string leaves a quote, a decimal number its point, a number with an
# exponent its letter. Longer numbers stay: what type they have depends on their value.
_TOKEN = (rf'(")(?:({_IN_STRING}\s*+:)|{_IN_STRING})|(?<![-+.\deE])-?(?:'
          r"\d++(?:\.\d++)?+([eE])[-+]?+\d++|\d{1,18}(?:(\.)\d{1,18})?(?![\d.eE]))")
_MARK = "\x01"  # follows what a token leaves; JSON holds no such sign
_VALUES = {f":{_MARK}": ":", f'"{_MARK}': '""', f"e{_MARK}": "1e0", f"E{_MARK}": "1e0",
           f".{_MARK}": "0.5", _MARK: "0"}


def shape(text: Column) -> Column:
    """Valid JSON text with a mark for each scalar: equal for texts of equal paths and types."""
    return F.regexp_replace(text, _TOKEN, f"$1$2$3$4{_MARK}")


def text_of(shape: Column) -> Column:
    """A JSON text that has the shape: all scalars of one type are alike."""
    for mark, value in _VALUES.items():
        shape = F.replace(shape, F.lit(mark), F.lit(value))
    return shape


def nesting(c: Column) -> Column:
    """Depth of brackets outside strings: a bound for the depth of the value."""
    bare = F.regexp_replace(F.regexp_replace(c, f'"{_IN_STRING}', ""), r"[^\[\]{}]+", "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, sign: Column) -> Column:
        now = state["now"] + F.when(sign.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))
    return F.aggregate(F.regexp_extract_all(bare, F.lit(r"[\[\]{}]"), F.lit(0)), zero, step,
                       lambda state: state["most"])


def _type(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), r"^[A-Z_]+", 0)


def _unfold(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Containers (``v``) become counted rows without ``v``, and rows of their elements."""
    done = F.struct("path", "type", F.lit(None).cast("variant").alias("v"))
    both = F.when(F.col("v").isNull(), F.array(done)).otherwise(
        F.array(done, F.struct("path", "type", "v")))
    rows = rows.select(*keep, F.inline(both))
    view = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    element = F.concat("path", F.coalesce(F.concat(F.lit("."), F.col("key")), F.lit("[]")))
    inner, kind = F.col("v").isNotNull(), _type(F.col("value"))
    return view.filter(~inner | F.col("pos").isNotNull()).select(
        *keep, F.when(inner, element).otherwise(F.col("path")).alias("path"),
        F.when(inner, kind).otherwise(F.col("type")).alias("type"),
        F.when(inner & kind.isin("OBJECT", "ARRAY"), F.col("value")).alias("v"))


def json_paths(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """(keep, path, type, values): how many values of each type lie at each path.

    A path starts with ``$``; ``.key`` is a field and ``[]`` any element. JSON null counts
    as VOID. Text that is no JSON (or names a key of an object twice) has the path NULL
    and the type MALFORMED; NULL text is no value.
    """
    valid = F.try_parse_json(column).isNotNull()
    shapes = (df.filter(F.col(column).isNotNull())
              .select(*keep, F.when(valid, shape(F.col(column))).alias("_shape"))
              .groupBy(*keep, "_shape").agg(F.count(F.lit(1)).alias("_times")))
    texts = reliable_checkpoint(shapes).withColumn("_text", text_of(F.col("_shape")))
    depth = texts.agg(F.max(nesting(F.col("_text")))).first()[0] or 0
    texts = texts.withColumn("v", F.try_parse_json("_text"))
    kind = F.coalesce(_type(F.col("v")), F.lit(MALFORMED))
    carried = [*keep, "_times"]
    rows = texts.select(*carried, F.when(F.col("v").isNotNull(), "$").alias("path"),
                        kind.alias("type"),
                        F.when(kind.isin("OBJECT", "ARRAY"), F.col("v")).alias("v"))
    counted = []
    while True:
        for _ in range(min(depth, LEVELS)):
            rows = _unfold(rows, carried)
        depth -= LEVELS
        counted.append(rows.filter("v IS NULL").groupBy(*keep, "path", "type")
                       .agg(F.sum("_times").alias("values")))
        if depth <= 0:
            break
        rows = reliable_checkpoint(rows.filter("v IS NOT NULL"))
    return reduce(DataFrame.unionByName, counted)
