"""Column classification and sensitive-data scans.

Name rules are evaluated as one array of conditional expressions per column
row (no join with the rule list). Content rules scan every string column of a
table in a single aggregate pass, whole values, all patterns at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.frames import sql_id, sql_str, union_all
from quarry.functions.patterns import CONTENT_TAG_PREFIX, NAME_RULES, SENSITIVE_PATTERNS
from quarry.sources.tables import spread


def _union(frames):
    return union_all(frames)


def name_tags(columns: DataFrame, rules=NAME_RULES) -> DataFrame:
    """``table_name, column_name, tag, basis='name'`` for every matching rule."""
    hits = F.array(*[F.when(F.col("column_name").rlike(rx), F.lit(tag)) for tag, rx in rules])
    return (columns.select("table_name", "column_name", F.explode(F.array_compact(hits)).alias("tag"))
            .withColumn("basis", F.lit("name")))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def content_tags(tables: dict[str, DataFrame], patterns=SENSITIVE_PATTERNS) -> DataFrame:
    """Columns holding at least one value that matches a sensitive pattern.

    One aggregate pass per table over all its string columns and patterns;
    the aggregates are SQL expression strings (one JVM call each).
    """
    frames = []
    for t, df in tables.items():
        cols = string_columns(df)
        if not cols:
            continue
        cells, aggs = [], []
        for i, c in enumerate(cols):
            for j, (pname, rx) in enumerate(patterns.items()):
                aggs.append(F.expr(f"count_if({sql_id(c)} RLIKE {sql_str(rx)}) AS __h{i}_{j}"))
                cells.append(f"named_struct('column_name', {sql_str(c)}, "
                             f"'tag', {sql_str(CONTENT_TAG_PREFIX + pname)}, 'hits', CAST(__h{i}_{j} AS BIGINT))")
        one = spread(df.select(*[F.col(sql_id(c)) for c in cols])).agg(*aggs)
        frames.append(one.selectExpr(f"{sql_str(t)} AS table_name", f"inline(array({', '.join(cells)}))"))
    hits = _union(frames)
    return (hits.where(F.col("hits") > 0).select("table_name", "column_name", "tag")
            .withColumn("basis", F.lit("content")))


def classify(columns: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    return name_tags(columns).unionByName(content_tags(tables))


def sensitive_scan(texts: dict[str, tuple[DataFrame, str | list[str]]], patterns=SENSITIVE_PATTERNS) -> DataFrame:
    """Per (table, column, pattern): rows scanned, rows with a match, total matches.

    ``texts`` maps a table name to ``(df, text columns)``; each table is one
    pass with every pattern counted over the whole texts of all its columns.
    """
    frames = []
    names = list(patterns)
    for t, (df, cols) in texts.items():
        cols = [cols] if isinstance(cols, str) else list(cols)
        if not cols:
            continue
        counted = spread(df.select(*[F.col(sql_id(c)) for c in cols])).selectExpr(
            *[f"regexp_count({sql_id(c)}, {sql_str(patterns[p])}) AS __n{i}_{j}" for i, c in enumerate(cols) for j, p in enumerate(names)])
        aggs = ["count(1) AS __rows"]
        cells = []
        for i, c in enumerate(cols):
            for j, pname in enumerate(names):
                aggs += [f"count_if(__n{i}_{j} > 0) AS __r{i}_{j}", f"coalesce(sum(__n{i}_{j}), 0) AS __m{i}_{j}"]
                cells.append(f"named_struct('column_name', {sql_str(c)}, 'pattern', {sql_str(pname)}, "
                             f"'rows_with_match', CAST(__r{i}_{j} AS BIGINT), 'match_count', CAST(__m{i}_{j} AS BIGINT))")
        one = counted.agg(*[F.expr(a) for a in aggs])
        frames.append(one.selectExpr(f"{sql_str(t)} AS table_name", "CAST(__rows AS BIGINT) AS rows_scanned",
                                     f"inline(array({', '.join(cells)}))"))
    return _union(frames)


def row_tags(df: DataFrame, key_qn, text_col: str, patterns=SENSITIVE_PATTERNS,
             column_qn: str | None = None) -> DataFrame:
    """``entity_qn, tag`` for every row whose text matches a pattern (one row per tag).

    With ``column_qn`` every hit also tags that column entity, so one regex
    pass over the texts yields the row-level and the column-level tags (the
    repeated column rows collapse in the caller's distinct, map-side).
    """
    hits = F.array(*[F.when(F.col(text_col).rlike(rx), F.lit(CONTENT_TAG_PREFIX + p)) for p, rx in patterns.items()])
    out = spread(df).select(key_qn.alias("entity_qn"), F.explode(F.array_compact(hits)).alias("tag"))
    if column_qn is not None:
        out = out.select(F.explode(F.array(F.col("entity_qn"), F.lit(column_qn))).alias("entity_qn"), "tag")
    return out
