"""Column profiles that merge: one row of sketches for each column and version.

A table's rows are read once, grouped by version: rows, nulls, range, and three
sketches for each column, namely distinct values (HyperLogLog), quantiles (KLL) and the set of values
(theta). The profile of any set of versions is a merge of their rows, never a
rescan: what an append adds to the store is the profile of the append alone. Rules
(NOT NULL) are judged on the merged profile.

What sketches give are estimates: with 2^12 registers, distinct values to about
1.6 % (one standard error; exact below some hundreds), theta sets to about 1.6 %, quantiles to 1.5 % of rank.
Rows, nulls and ranges are exact. The store is a few kilobytes a column and version.

Defined results: the range of a string is that of its length in characters, of a time that of its
seconds since 1970; other types have no range; columns that are all null have no
range, no values and no quantiles; an empty version has no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.frames import sql_id, sql_str, union_all

HLL_LOG2 = 12
QUANTILES = (0.25, 0.5, 0.75)
STORE = ["table_name", "version", "column_name", "row_count", "null_count", "low", "high", "hll", "theta", "kll"]


def _number(field: T.StructField) -> str | None:
    """The column as a number whose range and quantiles are kept (SQL)."""
    c, t = sql_id(field.name), field.dataType
    if isinstance(t, T.NumericType):
        return f"CAST({c} AS DOUBLE)"
    if isinstance(t, T.StringType):
        return f"CAST(length({c}) AS DOUBLE)"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return f"CAST(unix_micros(CAST(CAST({c} AS TIMESTAMP_NTZ) AS TIMESTAMP)) AS DOUBLE) / 1e6"
    return None


def profile_rows(df: DataFrame, table: str, version_col: str | None = None, store_sketches: bool = True) -> DataFrame:
    """The store's rows of one table (columns ``STORE``), from one pass over it. Without a
    version column, all rows are version 1."""
    fields = [f for f in df.schema.fields if f.name != version_col]
    version = f"CAST({sql_id(version_col)} AS BIGINT)" if version_col else "1L"
    aggs, cells = ["count(1) AS __rows"], []
    for i, f in enumerate(fields):
        c, number = sql_id(f.name), _number(f)
        value = f"xxhash64({c})"
        aggs.append(f"count_if({c} IS NULL) AS n{i}")
        low, high, kll = "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS BINARY)"
        if number:
            aggs += [f"min({number}) AS l{i}", f"max({number}) AS h{i}"]
            low, high = f"l{i}", f"h{i}"
            if store_sketches:
                aggs.append(f"kll_sketch_agg_double({number}) AS q{i}")
                kll = f"q{i}"
        hll = theta = "CAST(NULL AS BINARY)"
        if store_sketches:
            aggs += [f"hll_sketch_agg({value}, {HLL_LOG2}) FILTER (WHERE {c} IS NOT NULL) AS d{i}",
                     f"theta_sketch_agg({value}) FILTER (WHERE {c} IS NOT NULL) AS t{i}"]
            hll, theta = f"d{i}", f"t{i}"
        cells.append(f"named_struct('column_name', {sql_str(f.name)}, 'null_count', CAST(n{i} AS BIGINT), 'low', {low}, 'high', {high}, "
                     f"'hll', {hll}, 'theta', {theta}, 'kll', {kll})")
    grouped = df.selectExpr(*[sql_id(f.name) for f in fields], f"{version} AS __version").groupBy("__version")
    return (grouped.agg(*[F.expr(a) for a in aggs])
            .selectExpr(f"{sql_str(table)} AS table_name", "__version AS version", "CAST(__rows AS BIGINT) AS row_count",
                        f"inline(array({', '.join(cells)}))").select(*STORE))


def store_of(tables: dict[str, DataFrame], store_sketches: bool = True) -> DataFrame:
    """The profile rows of several tables, each read once."""
    return union_all([profile_rows(df, t, store_sketches=store_sketches) for t, df in tables.items()])


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("hll").alias("hll"), F.theta_union_agg("theta").alias("theta"), F.kll_merge_agg_double("kll").alias("kll"))


def merge(store: DataFrame) -> DataFrame:
    """One profile a column over all versions in the store."""
    return _merged(store, ["table_name", "column_name"])


def as_of(store: DataFrame) -> DataFrame:
    """The profile of every column at every version: the merge of the versions up to it."""
    versions = store.select("table_name", F.col("version").alias("upto")).distinct()
    return (_merged(store.join(versions, "table_name").where("version <= upto"), ["table_name", "upto", "column_name"])
            .withColumnRenamed("upto", "version"))


def estimates(profiles: DataFrame) -> DataFrame:
    """The sketches read out: distinct values (two ways) and quartiles."""
    values = F.when(F.col("null_count") < F.col("row_count"), F.hll_sketch_estimate("hll")).otherwise(0)
    in_set = F.when(F.col("null_count") < F.col("row_count"), F.theta_sketch_estimate("theta")).otherwise(0)
    quartiles = [F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("kll", F.lit(q))).alias(f"q{round(100 * q)}") for q in QUANTILES]
    return profiles.select("*", values.cast("long").alias("distinct_values"), in_set.cast("long").alias("set_values"), *quartiles).drop(
        "hll", "theta", "kll")


def shared_values(profiles: DataFrame, left: tuple[str, str], right: tuple[str, str]) -> DataFrame:
    """``shared``: about how many values two columns (table, column) of the same type have in common."""
    def one(of):
        return profiles.where((F.col("table_name") == of[0]) & (F.col("column_name") == of[1])).select("theta")
    both = one(left).unionByName(one(right))
    return both.agg(F.theta_sketch_estimate(F.theta_intersection_agg("theta")).alias("shared"))


def not_null_results(profiles: DataFrame, rules: dict[str, tuple[str, ...]]) -> DataFrame:
    """Each NOT NULL rule judged on the profiles: its column's rows, nulls (the violations) and verdict."""
    spark = profiles.sparkSession
    rule = spark.createDataFrame([(t, c) for t, columns in rules.items() for c in columns], "table_name string, column_name string")
    keys = [c for c in ("version",) if c in profiles.columns]
    return (profiles.join(rule, ["table_name", "column_name"])
            .select("table_name", *keys, "column_name", "row_count", F.col("null_count").alias("violations"), (F.col("null_count") == 0).alias("holds")))
