"""Semantic types of string columns, from the shapes of their values.

Every value of every string column is generalised to a pattern in one pass: letters to
``a``, digits to ``9``, all else as it is. Equal patterns are counted before the shuffle, so what
goes on is a row a pattern. Patterns are merged upwards level by level: digits one by one,
runs of digits, words, rows of words. A column is described at the lowest level at which its
most frequent patterns cover a stated share of its values, and its semantic type is the
one whose shape most of its values have.

Defined results: nulls have no pattern (a column of nulls has no row); the empty string's pattern
is empty; values of more than ``LONGEST`` characters have the pattern ``*`` (free text) at every
level; of equally frequent patterns the alphabetically first counts; of equally good types the first listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.frames import sql_id, sql_str, union_all

LONGEST = 64
TOP = 3
SHARE_PERCENT = 90

# What turns a value, and then a level's pattern, into the next level's (read alike by Java's expressions and RE2).
LEVELS = [
    [("([A-Za-z]|[^\\x00-\\x7F])+", "a"), ("[0-9]", "9")],
    [("9+", "9")],
    [("[a9]+", "w")],
    [("w( +w)+", "w+")],
]
# Semantic types by the shape of a pattern of level 1.
TYPES = [
    ("email", "^[a9._%+-]+@[a9-]+(\\.[a9-]+)+$"),
    ("url", "^a://"),
    ("ipv4", "^9\\.9\\.9\\.9$"),
    ("number", "^[+-]?9([.,]9)*$"),
    ("code", "^a[#_-]?9$|^9[#_-]?a$"),
    ("record", "^[{\\[].*[}\\]]$"),
    ("word", "^a$"),
    ("words", "^a([ -]+a)+$"),
]
OTHER = "text"


def _replaced(value: str, steps: list[tuple[str, str]]) -> str:
    for pattern, by in steps:
        value = f"regexp_replace({value}, {sql_str(pattern)}, {sql_str(by)})"
    return value


def value_patterns(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, p0, n``: the values of each string column counted by pattern."""
    parts = []
    for t, df in tables.items():
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if columns:
            cells = ", ".join(f"named_struct('column_name', {sql_str(c)}, 'p0', IF(length({sql_id(c)}) > {LONGEST}, '*', "
                              f"{_replaced(sql_id(c), LEVELS[0])}))" for c in columns)
            parts.append(df.selectExpr(f"{sql_str(t)} AS table_name", f"inline(array({cells}))").where("p0 IS NOT NULL"))
    if not parts:
        raise ValueError("no string column")
    return union_all(parts).groupBy("table_name", "column_name", "p0").agg(F.count(F.lit(1)).alias("n"))


def semantic_types(tables: dict[str, DataFrame], top: int = TOP, share_percent: int = SHARE_PERCENT) -> DataFrame:
    """One row a string column: ``n_values``, the ``level`` that describes it, its most frequent ``patterns`` there (with
    `` | `` between), the values they cover, its ``semantic_type`` and the values of that shape."""
    of = ["table_name", "column_name"]
    counts = value_patterns(tables)
    for i, steps in enumerate(LEVELS[1:], 1):
        counts = counts.withColumn(f"p{i}", F.expr(_replaced(f"p{i - 1}", steps)))
    levels = counts.select(*of, "n", F.inline(F.array(*[F.struct(F.lit(i).alias("level"), F.col(f"p{i}").alias("pattern"))
                                                        for i in range(len(LEVELS))])))
    merged = levels.groupBy(*of, "level", "pattern").agg(F.sum("n").alias("n"))
    total = counts.groupBy(*of).agg(F.sum("n").alias("n_values"))
    rank = F.row_number().over(Window.partitionBy(*of, "level").orderBy(F.col("n").desc(), "pattern"))
    tops = merged.withColumn("rank", rank).where(F.col("rank") <= top)
    described = tops.groupBy(*of, "level").agg(F.sum("n").alias("covered"),
                                               F.array_sort(F.collect_list(F.struct("rank", "pattern"))).alias("ranked"))
    enough = (described.join(total, of)
              .withColumn("order", F.when(100 * F.col("covered") >= share_percent * F.col("n_values"), F.col("level"))
                          .otherwise(F.lit(2 * len(LEVELS)) - F.col("level"))))  # if none covers enough, the highest
    best = enough.groupBy(*of, "n_values").agg(F.min(F.struct("order", "level", "covered", "ranked")).alias("b"))
    shape = F.lit(OTHER)
    for name, pattern in reversed(TYPES):
        shape = F.when(F.col("p1").rlike(pattern), F.lit(name)).otherwise(shape)
    place = {name: i for i, name in enumerate([*[n for n, _ in TYPES], OTHER])}
    ordered = F.create_map(*[F.lit(x) for kv in place.items() for x in kv])
    typed = (counts.withColumn("semantic_type", shape).groupBy(*of, "semantic_type").agg(F.sum("n").alias("n"))
             .groupBy(*of).agg(F.max(F.struct("n", (-ordered[F.col("semantic_type")]).alias("first"), "semantic_type")).alias("t")))
    return best.join(typed, of).select(
        *of, "n_values", F.col("b.level").alias("level"), F.array_join(F.transform("b.ranked", lambda x: x["pattern"]), " | ").alias("patterns"),
        F.col("b.covered").alias("covered"), F.col("t.semantic_type").alias("semantic_type"), F.col("t.n").alias("of_type"))
