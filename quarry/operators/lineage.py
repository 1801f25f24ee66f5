"""Lineage: process entities and edges, FK lineage, layered ETL stages, cascades.

Edges are a DataFrame ``src_qn, process_qn, dst_qn`` (one process per
ingested table); a process with several inputs and outputs is walked as hops
through the process node (``process_hops``), never as input x output pairs. Both ends of an edge must resolve to catalog entities (inner joins);
unresolved ones are returned separately by an anti-join instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.frames import semi_join
from quarry.operators import entities as E
from quarry.operators.graph import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, _materialize, broadcastable

EDGE_COLUMNS = ["src_qn", "process_qn", "dst_qn"]


def resolve_by_name(entities: DataFrame, names: DataFrame, name_col: str, type_name: str = "table",
                    layer: str | None = "source") -> DataFrame:
    """First ACTIVE entity of ``type_name`` whose name equals ``name_col``
    (smallest qualified name wins, so the choice is repeatable)."""
    cands = entities.where((F.col("type_name") == type_name) & (F.col("status") == E.ACTIVE))
    if layer is not None:
        cands = cands.where(F.col("attributes")["layer"] == layer)
    first = cands.groupBy("name").agg(F.min("qualified_name").alias("resolved_qn"))
    return names.join(first, names[name_col] == first["name"], "left").drop("name")


def etl_process_edges(results: DataFrame, entities: DataFrame, prefix: str = "etl.tpch_to_raw_"):
    """One process per successfully ingested table: source table -> raw table.

    ``results`` has ``table_name`` and ``status``; the raw table entity is the
    raw-layer table entity with the same name. Returns ``(edges, rejects)``.
    """
    ok = results.where(F.col("status") == "ok").select("table_name")
    src = resolve_by_name(entities, ok, "table_name", layer="source").withColumnRenamed("resolved_qn", "src_qn")
    both = resolve_by_name(entities, src, "table_name", layer="raw").withColumnRenamed("resolved_qn", "dst_qn")
    with_proc = both.withColumn("process_qn", F.concat(F.lit(prefix), F.col("table_name")))
    good = F.col("src_qn").isNotNull() & F.col("dst_qn").isNotNull()
    return (with_proc.where(good).select("table_name", *EDGE_COLUMNS),
            with_proc.where(~good).select("table_name", "src_qn", "dst_qn"))


def process_entities(edges: DataFrame) -> DataFrame:
    """A ``process`` entity per process, with its inputs/outputs as arrays."""
    procs = edges.groupBy("process_qn").agg(F.array_sort(F.collect_set("src_qn")).alias("inputs"),
                                            F.array_sort(F.collect_set("dst_qn")).alias("outputs"))
    return E.make_entities(procs, "process", F.col("process_qn"), F.element_at(F.split("process_qn", r"\."), -1),
                           description=F.concat(F.lit("process "), F.col("process_qn")),
                           attributes=F.create_map(F.lit("inputs"), F.array_join("inputs", ","),
                                                   F.lit("outputs"), F.array_join("outputs", ",")))


def process_hops(processes: DataFrame) -> DataFrame:
    """``src, dst`` hops of ``process_qn, inputs[], outputs[]``: input -> process
    and process -> output.

    A process links every input to every output; going through the process
    node expresses that with inputs + outputs rows instead of inputs x
    outputs pairs. A table-to-table step is two hops.
    """
    ins = processes.select(F.explode("inputs").alias("src"), F.col("process_qn").alias("dst"))
    outs = processes.select(F.col("process_qn").alias("src"), F.explode("outputs").alias("dst"))
    return ins.unionByName(outs)


def fk_edges(fk_columns: DataFrame, entities: DataFrame, db_prefix: str = "source.tpch.") -> DataFrame:
    """Lineage between FK-related tables: referencing table -> referenced table,
    one edge per distinct pair, kept only when both table entities exist."""
    pairs = fk_columns.select("table_name", "foreign_table_name").distinct()
    tables = entities.where((F.col("type_name") == "table") & (F.col("status") == E.ACTIVE)).select("qualified_name")
    edges = pairs.select(F.concat(F.lit(db_prefix), "table_name").alias("src_qn"),
                         F.concat(F.lit("fk."), "table_name", F.lit("_"), "foreign_table_name").alias("process_qn"),
                         F.concat(F.lit(db_prefix), "foreign_table_name").alias("dst_qn"))
    return (semi_join(semi_join(edges, tables.withColumnRenamed("qualified_name", "src_qn"), "src_qn"),
                      tables.withColumnRenamed("qualified_name", "dst_qn"), "dst_qn")
            .select(*EDGE_COLUMNS))


def cascade_soft_delete(levels, root_filter, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                        broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, written: dict | None = None) -> DataFrame:
    """Soft-delete a root selection and everything under it, level by level.

    Each level is written with its rows' ``_status`` (ACTIVE or DELETED) and read back; the
    counts and the next level's keys come from what was written. ``written`` gets the tables by name.

    ``levels`` is a list of ``(table_name, df, key_col, parent_col)``; level 0
    is filtered by ``root_filter`` and each later level is the semi-join of its
    ``parent_col`` with the previous level's deleted keys. Deleted keys are
    de-duplicated and written per level (the next level's join input); the
    written keys are broadcast only when their measured rows and bytes are
    within the bounds, else the level is a shuffle join.
    Returns ``level, table_name, deleted_rows, remaining_rows``.
    """
    out = []
    prev = None
    for i, (name, df, key, parent) in enumerate(levels):
        if i == 0:
            marked = df.withColumn("_hit", F.coalesce(root_filter, F.lit(False)))
        else:
            keys = F.broadcast(prev.frame) if broadcastable(prev, broadcast_rows, broadcast_bytes) else prev.frame
            marked = (df.join(keys.withColumnRenamed("_k", parent).withColumn("_m", F.lit(True)), parent, "left")
                      .withColumn("_hit", F.coalesce("_m", F.lit(False))))
        marked = marked.select(*df.columns, F.when(F.col("_hit"), E.DELETED).otherwise(E.ACTIVE).alias("_status"))
        kept = _materialize(marked, "cascade", measure_bytes=False).frame
        if written is not None:
            written[name] = kept
        gone = F.col("_status") == E.DELETED
        out.append(kept.agg(F.count_if(gone).cast("long").alias("deleted_rows"),
                            F.count_if(~gone).cast("long").alias("remaining_rows"))
                   .select(F.lit(i).alias("level"), F.lit(name).alias("table_name"),
                           "deleted_rows", "remaining_rows"))
        if key is not None and i + 1 < len(levels):
            prev = _materialize(kept.where(gone).select(F.col(key).alias("_k")).distinct())
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result
