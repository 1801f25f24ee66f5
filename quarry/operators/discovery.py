"""Keys and foreign keys found in the data, not declared.

Foreign keys (``foreign_keys_found``) are inclusions of one column's values in a
unique column. Every column of every table is unpivoted to (value hash, column) and
grouped by value once: the columns that have a value are one bit set, an OR that each
task combines before the shuffle, so a value in a third of all rows leaves a task as one row.
Equal bit sets are counted together (few, as they are sets of columns), and all overlaps
of columns follow from those counts without looking at a value again. Only
columns of pairs that survive are read a second time, to count rows and values
exactly, by the values themselves.

Keys (``unique_combinations``) are searched level by level over the lattice of column
sets. One pass a level keeps a distinct-count sketch for each candidate of each
table; those whose estimate is well under the rows are pruned, the rest are
confirmed by exact counts. Supersets of a key are skipped, so what is found
is minimal; sets whose parts' distinct counts multiply to fewer than the rows are not tried. In large tables
a candidate that repeats among the rows of one share of a column's values is refuted there; every
key that is found was counted over all rows.

What comes to the driver is a row a column, pair of columns or candidate: it grows
with the schema, not with the data.

Defined results: a null is no value (and keeps a column from being a parent); a
column without values has no parent; in ``unique_combinations`` nulls count as equal and are
reported; tables without rows have no keys; -0.0 and 0.0 are one value, as in SQL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.frames import sql_id, sql_str, union_all
from quarry.operators.quality import all_null_profiles, key_counts
from quarry.sources.scratch import materialize

_WORD = 62  # columns a word of a bit set
SKETCH_LOG2 = 12  # registers of a distinct-count sketch: a relative error of about 1.6 %
_SLACK = 0.07  # more than four such errors
_SHARES = 64
_LARGE = 1_000_000  # rows of a table whose candidates are first looked for repeats in one of the shares


@dataclass(frozen=True)
class ColumnRef:
    number: int
    table: str
    column: str
    family: str

    @property
    def typed(self) -> str:
        """The column as a value that is comparable in its family (SQL)."""
        return f"CAST({sql_id(self.column)} AS {self.family})" if self.family in _CASTS else sql_id(self.column)


# Types whose values are compared with each other, by the type they are cast to.
_FAMILIES = {
    "bigint": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "double": (T.FloatType, T.DoubleType),
    "string": (T.StringType,),
    "timestamp_ntz": (T.TimestampType, T.TimestampNTZType, T.DateType),
}
_CASTS = frozenset(_FAMILIES)


def _family(t: T.DataType) -> str:
    return next((f for f, types in _FAMILIES.items() if isinstance(t, types)), t.simpleString())


def columns_of(tables: dict[str, DataFrame]) -> list[ColumnRef]:
    """All columns of the tables, numbered."""
    found = [(t, f.name, _family(f.dataType)) for t, df in tables.items() for f in df.schema.fields]
    return [ColumnRef(i, *x) for i, x in enumerate(found)]


# ------------------------------------------------------------------ inclusions
def _unpivoted(tables: dict[str, DataFrame], columns: list[ColumnRef], value: str) -> DataFrame:
    """One row a cell with a value: what ``value`` says of it (SQL, with {typed} and {family}), and the column's number."""
    parts = []
    for t, df in tables.items():
        own = [c for c in columns if c.table == t]
        if own:
            cells = ", ".join(
                f"IF({sql_id(c.column)} IS NULL, NULL, struct({value.format(typed=c.typed, family=sql_str(c.family))}, {c.number} AS col))"
                for c in own)
            parts.append(df.selectExpr(f"explode(array({cells})) AS cell").where("cell IS NOT NULL").select("cell.*"))
    return union_all(parts)


def column_sets(tables: dict[str, DataFrame], columns: list[ColumnRef]) -> DataFrame:
    """``cols, n``: for each set of columns (sorted numbers), the values that are in just these columns."""
    words = max(c.number for c in columns) // _WORD + 1
    cells = _unpivoted(tables, columns, "xxhash64({family}, {typed}) AS value")
    bit = f"shiftleft(1L, CAST(col % {_WORD} AS INT))"
    sets = cells.groupBy("value").agg(*[F.expr(f"bit_or(IF(col div {_WORD} = {w}, {bit}, 0L))").alias(f"w{w}") for w in range(words)])
    counted = sets.groupBy(*[f"w{w}" for w in range(words)]).agg(F.count(F.lit(1)).alias("n"))
    members = [f"filter(transform(sequence(0, {_WORD - 1}), i -> IF(shiftright(w{w}, i) & 1L = 1L, i + {w * _WORD}, -1)), i -> i >= 0)"
               for w in range(words)]
    return counted.selectExpr(f"concat({', '.join(members)}) AS cols", "n")


def overlaps(sets: DataFrame) -> DataFrame:
    """``a, b, n``: how many values each two columns share (with itself: how many it has)."""
    return (sets.select("n", "cols", F.explode("cols").alias("a")).select("n", "a", F.explode("cols").alias("b"))
            .groupBy("a", "b").agg(F.sum("n").alias("n")))


def _same_name(child: str, parent: str) -> bool:
    """Equal names, a table's short prefix (``o_``, ``l_``) left out."""
    bare = [re.sub(r"^[a-z]{1,2}_", "", x.lower()) for x in (child, parent)]
    return bare[0] == bare[1]


def inclusion_candidates(tables: dict[str, DataFrame], columns: list[ColumnRef], least_percent: int) -> list[tuple[ColumnRef, ColumnRef]]:
    """(child, parent) columns: the parent is unique and not null, and has at least so many percent of
    the child's values. Judged by hashes."""
    rows = {(r["table_name"], r["column_name"]): (r["row_count"], r["null_count"]) for r in all_null_profiles(tables).collect()}
    # only columns of a family with a parent are unpivoted: one without nulls whose sketch may be that of unique values
    whole = {t: [c.column for c in columns if c.table == t and rows.get((t, c.column), (0, 0))[0] and not rows[t, c.column][1]] for t in tables}
    sketches = union_all([_sketched(tables[t], t, [(c,) for c in names]) for t, names in whole.items() if names])
    likely = {(r["table_name"], whole[r["table_name"]][r["combo"]]): r["estimate"] for r in (sketches.collect() if sketches is not None else ())}
    families = {c.family for c in columns if likely.get((c.table, c.column), -1) >= rows.get((c.table, c.column), (0, 0))[0] * (1 - 2 * _SLACK)}
    kept = [c for c in columns if c.family in families]
    if not kept:
        return []
    by_number = {c.number: c for c in columns}
    shared = {(r["a"], r["b"]): r["n"] for r in overlaps(column_sets(tables, kept)).collect()}
    out = []
    for (a, b), n in shared.items():
        child, parent = by_number[a], by_number[b]
        total, nulls = rows[parent.table, parent.column]
        if a != b and not nulls and shared[b, b] == total and 100 * n >= least_percent * shared[a, a]:
            out.append((child, parent))
    return sorted(out, key=lambda p: (p[0].number, p[1].number))


_FOUND = ("child_table string, child_column string, parent_table string, parent_column string, child_values long, "
          "matched_values long, parent_values long, matching_rows long, orphan_rows long, null_rows long, name_match boolean")


def foreign_keys_found(tables: dict[str, DataFrame], least_percent: int = 90) -> DataFrame:
    """One row for each column and unique column that has at least ``least_percent`` of its distinct
    values: exact counts of values and rows with and without a match."""
    spark = next(iter(tables.values())).sparkSession
    columns = columns_of(tables)
    pairs = inclusion_candidates(tables, columns, least_percent)
    if not pairs:
        return spark.createDataFrame([], _FOUND)
    used = {c.number for pair in pairs for c in pair}
    # exact: the values themselves, each column's rows of a value counted before the shuffle
    cells = _unpivoted(tables, [c for c in columns if c.number in used], "{family} AS family, CAST({typed} AS STRING) AS value")
    counts = materialize(cells.groupBy("family", "value", "col").agg(F.count(F.lit(1)).alias("n")), "discovery", measure_bytes=False).frame
    holders = counts.groupBy("family", "value").agg(F.collect_list(F.struct("col", "n")).alias("holders"))
    parents: dict[int, list[int]] = {}
    for child, parent in pairs:
        parents.setdefault(child.number, []).append(parent.number)
    asked = "map(" + ", ".join(f"{a}, array({', '.join(map(str, bs))})" for a, bs in parents.items()) + ")"
    each = (holders.selectExpr("transform(holders, h -> h.col) AS cols", "explode(holders) AS h")
            .selectExpr("cols", "h.col AS child", "h.n AS n", f"explode(element_at({asked}, h.col)) AS parent"))
    hit = F.expr("array_contains(cols, parent)")
    matched = each.groupBy("child", "parent").agg(
        F.count_if(hit).alias("matched_values"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("matching_rows"),
        F.sum(F.when(hit, 0).otherwise(F.col("n"))).alias("orphan_rows"))
    per_column = counts.groupBy("col").agg(F.count(F.lit(1)).alias("vals"), F.max("n").alias("most"), F.sum("n").alias("with_value"))
    names = spark.createDataFrame([(a.number, b.number, a.table, a.column, b.table, b.column, _same_name(a.column, b.column)) for a, b in pairs],
                                  "child int, parent int, child_table string, child_column string, parent_table string, parent_column string, "
                                  "name_match boolean")
    nulls = all_null_profiles({t: tables[t] for t in {a.table for a, _ in pairs}}).select(
        F.col("table_name").alias("child_table"), F.col("column_name").alias("child_column"), F.col("null_count").alias("null_rows"))
    return (matched.join(names, ["child", "parent"])
            .join(per_column.select(F.col("col").alias("child"), F.col("vals").alias("child_values")), "child")
            .join(per_column.select(F.col("col").alias("parent"), F.col("vals").alias("parent_values"), "most"), "parent")
            .join(nulls, ["child_table", "child_column"])
            .where(F.col("most") == 1).where(100 * F.col("matched_values") >= least_percent * F.col("child_values"))
            .select(*[f.split()[0] for f in _FOUND.split(", ")]))


# ------------------------------------------------------------------------ keys
def _sketched(df: DataFrame, table: str, combos: list[tuple[str, ...]]) -> DataFrame:
    """``table_name, combo, estimate``: a distinct-count estimate of each set of columns, all in one pass."""
    at = {c: i for i, c in enumerate(df.columns)}
    hashed = df.selectExpr(*[f"xxhash64({sql_id(c)}) AS h{i}" for c, i in at.items()])
    aggs = [F.expr(f"hll_sketch_estimate(hll_sketch_agg({_combined([at[c] for c in combo])}, {SKETCH_LOG2}))").alias(f"e{i}")
            for i, combo in enumerate(combos)]
    cells = ", ".join(f"struct({i} AS combo, e{i} AS estimate)" for i in range(len(combos)))
    return hashed.agg(*aggs).selectExpr(f"{sql_str(table)} AS table_name", f"inline(array({cells}))")


def _combined(numbers: list[int]) -> str:
    return f"h{numbers[0]}" if len(numbers) == 1 else f"xxhash64({', '.join(f'h{i}' for i in numbers)})"


def _key_part(field: T.StructField) -> Column:
    """What stands for a column in an exact count: the value, or 128 bits of a string's MD5."""
    c = F.col(sql_id(field.name))
    return F.unhex(F.md5(c.cast("binary"))) if isinstance(field.dataType, T.StringType) else c


def _confirmed(tables: dict[str, DataFrame], combos: list[tuple[str, tuple[str, ...]]], rows: dict[str, int],
               by: dict | None = None) -> list[tuple[int, int, int]]:
    """(number of the candidate, repeated groups, rows with a null part), counted exactly; with ``by`` (a column of each
    candidate) among the rows of one of ``_SHARES`` shares of this column's values, which has its groups whole."""
    parts = []
    for i, (t, combo) in enumerate(combos):
        fields = {f.name: f for f in tables[t].schema.fields}
        keys = [_key_part(fields[c]).alias(f"k{j}") for j, c in enumerate(combo)]
        none = " OR ".join(f"k{j} IS NULL" for j in range(len(combo)))
        of = tables[t] if by is None else tables[t].where(f"pmod(xxhash64({sql_id(by[t, combo])}), {_SHARES}) = 0")
        parts.append(key_counts(of.select(*keys), rows[t] if by is None else rows[t] // _SHARES)
                     .selectExpr(f"{i} AS combo", "n", f"({none}) AS none"))
    got = (union_all(parts).groupBy("combo")
           .agg(F.count_if(F.col("n") > 1).alias("repeated"), F.coalesce(F.sum(F.when(F.col("none"), F.col("n"))), F.lit(0)).alias("null_rows")))
    return [(r["combo"], r["repeated"], r["null_rows"]) for r in got.collect()]


def unique_combinations(tables: dict[str, DataFrame], max_size: int = 2, batch: int = 24) -> DataFrame:
    """``table_name, key_columns, size, row_count, null_rows``: the minimal sets of at most
    ``max_size`` columns whose values are never repeated. Exact counts run ``batch`` candidates a job."""
    spark = next(iter(tables.values())).sparkSession
    rows = {r["table_name"]: r["row_count"] for r in all_null_profiles(tables).select("table_name", "row_count").distinct().collect()}
    keys: dict[str, list[frozenset]] = {t: [] for t in tables}
    distinct: dict[tuple[str, str], float] = {}
    found = []
    for level in range(1, max_size + 1):
        todo: dict[str, list[tuple[str, ...]]] = {}
        for t, df in tables.items():
            for combo in combinations(df.columns, level) if rows[t] else ():
                if any(k <= set(combo) for k in keys[t]):
                    continue
                most = 1.0
                for c in combo if level > 1 else ():
                    most *= distinct[t, c] * (1 + _SLACK)
                if level == 1 or most >= rows[t]:
                    todo.setdefault(t, []).append(combo)
        if not todo:
            break
        estimates = union_all([_sketched(tables[t], t, combos) for t, combos in todo.items()]).collect()
        likely = []
        for r in estimates:
            t, combo = r["table_name"], todo[r["table_name"]][r["combo"]]
            if level == 1:
                distinct[t, combo[0]] = max(1.0, r["estimate"])
            if r["estimate"] >= rows[t] * (1 - _SLACK):
                likely.append((t, combo))
        # a group repeated in one share of the rows is repeated in the table: no key. What this leaves is counted whole.
        large = [x for x in likely if rows[x[0]] >= _LARGE]
        if large:
            by = {x: max(x[1], key=lambda c: distinct[x[0], c]) for x in large}
            refuted = {large[i] for i, repeated, _ in _confirmed(tables, large, rows, by) if repeated}
            likely = [x for x in likely if x not in refuted]
        likely.sort(key=lambda x: (list(tables).index(x[0]), [tables[x[0]].columns.index(c) for c in x[1]]))
        for start in range(0, len(likely), batch):
            part = likely[start:start + batch]
            for i, repeated, null_rows in _confirmed(tables, part, rows):
                if not repeated:
                    t, combo = part[i]
                    keys[t].append(frozenset(combo))
                    found.append((t, ",".join(combo), level, rows[t], null_rows))
    return spark.createDataFrame(found, "table_name string, key_columns string, size int, row_count long, null_rows long")
