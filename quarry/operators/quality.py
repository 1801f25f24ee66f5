"""Data-quality checks at data size: nulls, lengths, key uniqueness, references.

Every check is one aggregate pass over the columns it needs (Parquet column
pruning keeps the scan narrow). Key checks aggregate *before* they shuffle:
``groupBy(key)`` uses partial (map-side) aggregation, so a key holding a third
of the rows leaves each map task as a single row, and reference checks compare
distinct key sets rather than raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.frames import sql_id, sql_str, union_all

from quarry.operators.metadata import Constraints, ForeignKey


def _union_all(frames: list[DataFrame]) -> DataFrame | None:
    """Union of the frames; None when there is nothing to check."""
    return union_all(frames)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# The builders below write their aggregates as SQL expressions: one
# expression string is one call into the JVM, which keeps driver-side planning
# short when a check spans dozens of tables and hundreds of columns.


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """``table_name, column_name, row_count, null_count`` for every column, one pass."""
    aggs = ["count(1) AS __rows"] + [f"count_if({sql_id(c)} IS NULL) AS __n{i}" for i, c in enumerate(df.columns)]
    one = df.agg(*[F.expr(a) for a in aggs])
    cells = ", ".join(f"named_struct('column_name', {sql_str(c)}, 'null_count', CAST(__n{i} AS BIGINT))"
                      for i, c in enumerate(df.columns))
    return one.selectExpr(f"{sql_str(table)} AS table_name", "CAST(__rows AS BIGINT) AS row_count",
                          f"inline(array({cells}))").select("table_name", "column_name", "row_count", "null_count")


def length_profile(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Max character length and rows over the declared limit, per limited column."""
    cols = list(limits)
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(f"max(length({sql_id(c)})) AS __m{i}")
        aggs.append(f"count_if(length({sql_id(c)}) > {int(limits[c])}) AS __o{i}")
    one = df.agg(*[F.expr(a) for a in aggs])
    cells = ", ".join(
        f"named_struct('column_name', {sql_str(c)}, 'max_length', CAST(coalesce(__m{i}, 0) AS INT), "
        f"'declared_length', CAST({int(limits[c])} AS INT), 'over_limit', CAST(__o{i} AS BIGINT))"
        for i, c in enumerate(cols))
    return one.selectExpr(f"{sql_str(table)} AS table_name", f"inline(array({cells}))")


ROWS_PER_TASK = 500_000


def row_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """The rows of each table (of Parquet tables from the footers alone), in one job."""
    counts = union_all([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("t"), "rows") for t, df in tables.items()])
    return {} if counts is None else {r["t"]: r["rows"] for r in counts.collect()}


def key_counts(keyed: DataFrame, rows: int) -> DataFrame:
    """``n`` rows for each distinct row of ``keyed``, which has about ``rows`` rows.

    Keys of more rows than a task should hold go to as many tasks as they need, a number that
    grows with the table (Spark would join small shuffle blocks into few tasks, by their compressed size). They are
    counted by (key, salt) first, so a frequent key leaves each task as one row.
    """
    names = [_q(c) for c in keyed.columns]
    tasks = rows // ROWS_PER_TASK + 1
    if tasks == 1:
        return keyed.groupBy(*names).agg(F.expr("count(1) AS n"))
    salted = keyed.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int"))
    parts = salted.repartition(tasks, *names, "__salt").groupBy(*names, "__salt").agg(F.expr("count(1) AS n"))
    return parts.drop("__salt").repartition(tasks, *names).groupBy(*names).agg(F.expr("sum(n) AS n"))


def _key_groups(df: DataFrame, table: str, keys: tuple[str, ...], name: str, rows: int = 0) -> DataFrame:
    """One row per key value: its row count and whether a key part is null,
    labelled with the constraint."""
    any_null = " OR ".join(f"{sql_id(k)} IS NULL" for k in keys)
    return (key_counts(df.select(*[_q(k) for k in keys]), rows)
            .selectExpr(f"{sql_str(name)} AS constraint_name", f"{sql_str(table)} AS table_name",
                        f"{sql_str(','.join(keys))} AS key_columns", "n", f"({any_null}) AS _null"))


def _seeded(rows: DataFrame, labels: list[tuple], label_cols: list[str], zero_cols: str) -> DataFrame:
    """Add one neutral row per expected label (n = 0, no flags), so that every
    constraint gets a result row even when its table is empty. Bounded by the
    number of declared constraints."""
    spark = rows.sparkSession
    seed = spark.createDataFrame(labels, ", ".join(f"{c} string" for c in label_cols)).selectExpr(
        *label_cols, *zero_cols.split(","))
    return rows.unionByName(seed)


def _summarize_key_groups(groups: DataFrame, labels: list[tuple]) -> DataFrame:
    # one aggregate for any number of constraints: their key groups are unioned
    # first, so many checks share one small final exchange
    groups = _seeded(groups, labels, ["constraint_name", "table_name", "key_columns"],
                     "CAST(0 AS BIGINT) AS n,false AS _null")
    return groups.groupBy("constraint_name", "table_name", "key_columns").agg(
        F.expr("CAST(count_if(n > 1 AND NOT _null) AS BIGINT) AS duplicate_groups"),
        F.expr("CAST(coalesce(sum(IF(n > 1 AND NOT _null, n, NULL)), 0) AS BIGINT) AS duplicate_rows"),
        F.expr("CAST(coalesce(sum(IF(_null, n, NULL)), 0) AS BIGINT) AS null_key_rows"))


def duplicate_keys(df: DataFrame, table: str, keys: tuple[str, ...], name: str) -> DataFrame:
    """Key groups seen more than once, rows inside them, and rows with a null key part.

    One shuffle on the key (after partial aggregation) answers all three.
    """
    return _summarize_key_groups(_key_groups(df, table, keys, name, row_counts({table: df})[table]), [(name, table, ",".join(keys))])


def _keys(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    return df.select(*[_q(c).alias(f"_k{i}") for i, c in enumerate(cols)])


def orphan_references(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child rows whose non-null key has no parent row (null keys are exempt).

    The child is reduced to ``(key, rows)`` first (partial aggregation, so a
    hot key leaves each map task as one row), then left-outer-joined with the
    parent's distinct keys; one scan of each side answers orphan keys, orphan
    rows and null-key rows. An outer join (rather than an anti-join) keeps
    the optimizer from moving the join below the child's aggregation, which
    would shuffle every child row instead of one row per key. Key columns are
    paired by ordinal position.
    """
    return _summarize_references(_reference_keys(child, parent, fk), [_ref_label(fk)])


def _ref_label(fk: ForeignKey) -> tuple:
    return (fk.name, "orphan", fk.table, fk.ref_table)


def _reference_keys(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """One row per distinct child key: rows holding it, null / orphan flags."""
    names = [f"_k{i}" for i in range(len(fk.columns))]
    any_null = " OR ".join(f"{k} IS NULL" for k in names)
    per_key = _keys(child, fk.columns).groupBy(*names).agg(F.expr("count(1) AS n"))
    parent_keys = _keys(parent, fk.ref_columns).distinct().withColumn("_found", F.lit(True))
    return per_key.join(parent_keys, names, "left").selectExpr(
        f"{sql_str(fk.name)} AS constraint_name", "'orphan' AS check_type",
        f"{sql_str(fk.table)} AS table_name", f"{sql_str(fk.ref_table)} AS ref_table",
        "n", f"({any_null}) AS _null", f"NOT ({any_null}) AND _found IS NULL AS _orphan")


def _summarize_references(keys: DataFrame, labels: list[tuple]) -> DataFrame:
    # one aggregate for any number of references (their key rows are unioned first)
    keys = _seeded(keys, labels, ["constraint_name", "check_type", "table_name", "ref_table"],
                   "CAST(0 AS BIGINT) AS n,false AS _null,false AS _orphan")
    return keys.groupBy("constraint_name", "check_type", "table_name", "ref_table").agg(
        F.expr("CAST(count_if(_orphan) AS BIGINT) AS violating_keys"),
        F.expr("CAST(coalesce(sum(IF(_orphan, n, NULL)), 0) AS BIGINT) AS violating_rows"),
        F.expr("CAST(coalesce(sum(IF(_null, n, NULL)), 0) AS BIGINT) AS null_key_rows"))


def unreferenced_parents(child: DataFrame, parent: DataFrame, fk: ForeignKey, check_name: str) -> DataFrame:
    """Parent rows that no child row references (e.g. orders without lines)."""
    names = [f"_k{i}" for i in range(len(fk.columns))]
    child_keys = _keys(child, fk.columns).distinct()
    lonely = _keys(parent, fk.ref_columns).join(child_keys, names, "left_anti")
    return lonely.agg(F.count(F.lit(1)).cast("long").alias("violating_keys")).select(
        F.lit(check_name).alias("constraint_name"), F.lit("unreferenced").alias("check_type"),
        F.lit(fk.ref_table).alias("table_name"), F.lit(fk.table).alias("ref_table"),
        "violating_keys", F.col("violating_keys").alias("violating_rows"),
        F.lit(0).cast("long").alias("null_key_rows"))


def all_null_profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return _union_all([null_profile(df, t) for t, df in tables.items()])


def all_length_profiles(tables: dict[str, DataFrame], cons: Constraints) -> DataFrame:
    return _union_all([length_profile(tables[t], t, lim) for t, lim in cons.lengths.items() if t in tables])


def all_duplicate_keys(tables: dict[str, DataFrame], cons: Constraints) -> DataFrame:
    checked = [(t, keys) for t, keys in cons.primary_keys.items() if t in tables]
    rows = row_counts({t: tables[t] for t, _ in checked})
    groups = _union_all([_key_groups(tables[t], t, keys, cons.pk_name(t), rows[t]) for t, keys in checked])
    if groups is None:
        return None
    return _summarize_key_groups(groups, [(cons.pk_name(t), t, ",".join(keys)) for t, keys in checked])


def all_reference_checks(tables: dict[str, DataFrame], cons: Constraints,
                         reverse: list[tuple[str, str]] = ()) -> DataFrame:
    checked = [fk for fk in cons.foreign_keys if fk.table in tables and fk.ref_table in tables]
    keys = _union_all([_reference_keys(tables[fk.table], tables[fk.ref_table], fk) for fk in checked])
    frames = [] if keys is None else [_summarize_references(keys, [_ref_label(fk) for fk in checked])]
    by_name = {fk.name: fk for fk in cons.foreign_keys}
    frames += [unreferenced_parents(tables[by_name[n].table], tables[by_name[n].ref_table], by_name[n], check)
               for n, check in reverse]
    return _union_all(frames)


def check_results(tables: dict[str, DataFrame], cons: Constraints) -> DataFrame:
    """Long format ``table_name, check_name, violations`` over all declared rules."""
    parts = []
    dups = all_duplicate_keys(tables, cons)
    if dups is not None:
        # one pass per key check yields both the uniqueness and the not-null result
        parts.append(dups.select("table_name", F.inline(F.array(
            F.struct(F.concat(F.lit("unique:"), "constraint_name").alias("check_name"),
                     F.col("duplicate_groups").alias("violations")),
            F.struct(F.concat(F.lit("not_null:"), "constraint_name").alias("check_name"),
                     F.col("null_key_rows").alias("violations"))))))
    refs = all_reference_checks(tables, cons)
    if refs is not None:
        parts.append(refs.select("table_name", F.concat(F.lit("references:"), "constraint_name").alias("check_name"),
                                 F.col("violating_rows").alias("violations")))
    required = {t: tables[t].select(*[_q(c) for c in columns]) for t, columns in cons.not_null.items() if t in tables}
    if required:
        parts.append(all_null_profiles(required).select("table_name", F.concat(F.lit("not_null:"), "column_name").alias("check_name"),
                                                        F.col("null_count").alias("violations")))
    lengths = all_length_profiles(tables, cons)
    if lengths is not None:
        parts.append(lengths.select("table_name", F.concat(F.lit("length:"), "column_name").alias("check_name"),
                                    F.col("over_limit").alias("violations")))
    return _union_all(parts)


def quality_tags(results: DataFrame) -> DataFrame:
    """Worst result per table -> ``quality:pass`` / ``quality:fail``."""
    return (results.groupBy("table_name")
            .agg(F.count(F.lit(1)).cast("long").alias("checks"),
                 F.count_if(F.col("violations") > 0).cast("long").alias("failed_checks"))
            .withColumn("tag", F.when(F.col("failed_checks") > 0, F.lit("quality:fail"))
                        .otherwise(F.lit("quality:pass"))))
