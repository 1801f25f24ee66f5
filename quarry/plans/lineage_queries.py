"""Registered queries: lineage, graph walks, classification, scans, upserts,
cascades, raw-layer validation and the layered raw -> processed -> analytics ETL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.frames import semi_join, union_all
from quarry.functions.names import DEFAULT_RUN_TS
from quarry.functions.patterns import CONTENT_TAG_PREFIX, NAME_RULES, SENSITIVE_PATTERNS
from quarry.operators import classify as C
from quarry.operators import entities as E
from quarry.operators import metadata as M
from quarry.operators import quality as Q
from quarry.operators.ancestry import ancestry
from quarry.operators.graph import hierarchy, walk, walk_many
from quarry.operators.ingest import batch_summary, ingest_tables, raw_table_name, with_audit_columns
from quarry.operators.lineage import (cascade_soft_delete, etl_process_edges, fk_edges, process_entities,
                                     process_hops)
from quarry.plans.catalog_queries import _COLS, _IN, _orphans_sql
from quarry.plans.declared import DRIVER_CONSTRAINTS, FOREIGN_KEYS
from quarry.plans.entity_queries import DB, build_catalog, catalog_sql
from quarry.session import fresh_dir
from quarry.sources.tables import ALL_TABLES, STAR_TABLES, read_table, read_tables
from quarry.sources.versioned import SNAPSHOT_COL, VersionedTable

INGEST_SET = STAR_TABLES + ["events"]
RUN_TS = dt.datetime(2024, 1, 1)
WALK_CUSTOMER = 10
CASCADE_REGION = "EUROPE"
SEARCH_TAG = "PII:email"
TEXT_COLUMNS = {"documents": "text", "pages": "html", "conversations": "text"}
TAGGED_ROWS = {"documents": ["text"], "pages": ["html"]}
KINDS = {"documents": "document", "pages": "page", "conversations": "turn"}


# ------------------------------------------------------------------ lineage
def _ingest(spark, sf_dir, purpose):
    warehouse = fresh_dir(spark, purpose)
    sources = {t: read_table(spark, sf_dir, t) for t in INGEST_SET}
    results = ingest_tables(spark, sources, warehouse, DEFAULT_RUN_TS, committed_at=RUN_TS)
    return warehouse, results


def lineage_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, register the raw tables with their written counts, link source -> process -> raw."""
    warehouse, results = _ingest(spark, sf_dir, "lineage_processes")
    counts = batch_summary(spark, results, warehouse).where(F.col("table_name") != "__total__")
    raw_meta = M.meta_tables(spark, {t: None for t in INGEST_SET})
    raw_tables = E.table_entities(raw_meta, DB, layer="raw",
                                  row_counts=counts.select("table_name", F.col("records_extracted").alias("row_count")))
    catalog = build_catalog(spark, sf_dir).unionByName(raw_tables)
    edges, _rejects = etl_process_edges(results, catalog)
    recs = raw_tables.select(F.col("qualified_name").alias("dst_qn"),
                             F.col("attributes")["record_count"].cast("long").alias("records_extracted"))
    procs = process_entities(edges).select(F.col("qualified_name").alias("process_qn"),
                                           F.col("key").alias("process_key"))
    return (edges.join(recs, "dst_qn").join(procs, "process_qn")
            .select("process_qn", "process_key", "src_qn", "dst_qn", "records_extracted"))


def _fk_edges(spark, sf_dir):
    tc, kcu, ccu = M.constraint_relations(spark, DRIVER_CONSTRAINTS)
    return fk_edges(M.foreign_key_columns(tc, kcu, ccu), build_catalog(spark, sf_dir, assets=False))


def lineage_fk_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between tables with a foreign key, with the child rows that refer to a parent row and those that
    do not; an edge that no row bears out is left out."""
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    checked = Q.all_reference_checks(tables, DRIVER_CONSTRAINTS).join(M.table_row_counts(tables), "table_name")
    process = F.concat(F.lit("fk."), "table_name", F.lit("_"), "ref_table").alias("process_qn")
    rows = checked.groupBy(process).agg(
        F.sum(F.col("row_count") - F.col("violating_rows") - F.col("null_key_rows")).alias("matching_rows"),
        F.sum("violating_rows").alias("orphan_rows"))
    return _fk_edges(spark, sf_dir).join(rows, "process_qn").where(F.col("matching_rows") > 0)


def row_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level edges: order -> customer (one per order), order -> part and
    order -> supplier (one each per line)."""
    orders = read_table(spark, sf_dir, "orders")
    lines = read_table(spark, sf_dir, "lineitem")
    o = F.concat(F.lit("order:"), F.col("o_orderkey").cast("string"))
    lo = F.concat(F.lit("order:"), F.col("l_orderkey").cast("string"))
    return (orders.select(o.alias("src"), F.concat(F.lit("customer:"), F.col("o_custkey").cast("string")).alias("dst"))
            .unionByName(lines.select(lo.alias("src"),
                                      F.concat(F.lit("part:"), F.col("l_partkey").cast("string")).alias("dst")))
            .unionByName(lines.select(lo.alias("src"),
                                      F.concat(F.lit("supplier:"), F.col("l_suppkey").cast("string")).alias("dst"))))


def lineage_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-level FK lineage walked three ways plus a row-level walk from one
    customer, all in one breadth-first loop."""
    fk = _fk_edges(spark, sf_dir).select(F.lit("fk").alias("graph"), F.col("src_qn").alias("src"),
                                         F.col("dst_qn").alias("dst"))
    rows = row_edges(spark, sf_dir).select(F.lit("rows").alias("graph"), "src", "dst")
    starts = spark.createDataFrame([
        ("fk_out_lineitem", "fk", "source.tpch.lineitem", "OUT", 3),
        ("fk_in_region", "fk", "source.tpch.region", "IN", 3),
        ("fk_both_customer", "fk", "source.tpch.customer", "BOTH", 2),
        ("rows_both_customer", "rows", f"customer:{WALK_CUSTOMER}", "BOTH", 3),
    ], "walk string, graph string, node string, direction string, max_depth int")
    return walk_many(fk.unionByName(rows), starts).select("walk", "node", F.col("depth").cast("int").alias("depth"))


def parent_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region <- nation <- customer <- orders as ``node, parent, kind``."""
    t = read_tables(spark, sf_dir, ["region", "nation", "customer", "orders"])

    def ref(kind, c):
        return F.concat(F.lit(kind + ":"), F.col(c).cast("string"))
    return (t["region"].select(ref("region", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"),
                               F.lit("region").alias("kind"))
            .unionByName(t["nation"].select(ref("nation", "n_nationkey").alias("node"),
                                            ref("region", "n_regionkey").alias("parent"), F.lit("nation").alias("kind")))
            .unionByName(t["customer"].select(ref("customer", "c_custkey").alias("node"),
                                              ref("nation", "c_nationkey").alias("parent"),
                                              F.lit("customer").alias("kind")))
            .unionByName(t["orders"].select(ref("order", "o_orderkey").alias("node"),
                                            ref("customer", "o_custkey").alias("parent"), F.lit("order").alias("kind"))))


def hierarchy_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hierarchy(parent_pointers(spark, sf_dir))
    return (h.groupBy("root", F.col("kind").alias("node_type"), F.col("depth").cast("int").alias("depth"))
            .agg(F.count(F.lit(1)).cast("long").alias("node_count")))


def turn_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains as ``node, parent, kind``: each turn of a conversation points to the turn before
    it, each event to its user's event before it (by time, then id)."""
    t = read_tables(spark, sf_dir, ["conversations", "events"])
    turn = F.concat_ws(":", F.lit("turn"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    turns = t["conversations"].select("conv_id", "turn").distinct()
    event = F.concat(F.lit("event:"), F.col("event_id").cast("string"))
    by_conversation = Window.partitionBy("conv_id").orderBy("turn")
    by_user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return (turns.select(turn.alias("node"), F.lag(turn).over(by_conversation).alias("parent"), F.lit("turn").alias("kind"))
            .unionByName(t["events"].select(event.alias("node"), F.lag(event).over(by_user).alias("parent"), F.lit("event").alias("kind"))))


def hierarchy_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root, depth and status of every node of the region tree and of the chains of turns
    and events, in rounds that double their reach."""
    nodes = parent_pointers(spark, sf_dir).unionByName(turn_pointers(spark, sf_dir))
    kinds = nodes.select("node", "kind")
    return ancestry(nodes).join(kinds, "node").select("node", "kind", "root", F.col("depth").cast("int").alias("depth"), "status")


LAYERS_ANALYTICS = "analytics.tpch.customer_summary"

# The layered ETL's process wiring (input, process, output).
LAYERS_EDGES = [
    ("source.tpch.orders", "etl.orders_to_raw", "raw.tpch.raw_orders"),
    ("raw.tpch.raw_orders", "etl.validate_orders", "processed.tpch.processed_orders"),
    ("processed.tpch.processed_orders", "etl.customer_aggregation", LAYERS_ANALYTICS),
    ("source.tpch.customer", "etl.customer_aggregation", LAYERS_ANALYTICS),
]


def _run_layers(spark: SparkSession, sf_dir: str, jobs: list | None = None) -> dict[str, VersionedTable]:
    """orders -> raw -> processed (validated) -> analytics (customer summary),
    each stage a versioned table; returns them by qualified name. ``jobs`` gets
    (qualified name, the frame that was written) of each stage."""
    jobs = [] if jobs is None else jobs
    warehouse = fresh_dir(spark, "layered_etl")
    raw = VersionedTable(spark, warehouse, "raw_orders")
    audited = with_audit_columns(read_table(spark, sf_dir, "orders"), DEFAULT_RUN_TS)
    raw.create(audited, committed_at=RUN_TS)
    jobs.append(("raw.tpch.raw_orders", audited))
    processed = VersionedTable(spark, warehouse, "processed_orders")
    clean = (raw.read().where((F.col("o_totalprice") > 0) & F.col("o_orderstatus").isin("F", "O", "P"))
             .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    processed.create(clean, committed_at=RUN_TS)
    jobs.append(("processed.tpch.processed_orders", clean))
    # aggregate before the join: one row per customer meets the customer table
    per_cust = processed.read().groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("long").alias("order_count"),
        F.round(F.sum("o_totalprice"), 2).alias("total_spent"),
        F.max("o_orderdate").alias("last_order_date"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    summary = customer.join(per_cust, customer["c_custkey"] == per_cust["o_custkey"]).drop("o_custkey")
    analytics = VersionedTable(spark, warehouse, "customer_summary")
    analytics.create(summary, committed_at=RUN_TS)
    jobs.append((LAYERS_ANALYTICS, summary))
    return {"raw.tpch.raw_orders": raw, "processed.tpch.processed_orders": processed, LAYERS_ANALYTICS: analytics}


def layered_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_layers(spark, sf_dir)[LAYERS_ANALYTICS].read().drop(SNAPSHOT_COL)


def layered_etl_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the layered ETL, register its tables with their written row counts,
    wire the processes (inputs[] / outputs[]), then walk upstream from the
    analytics table: ``node, depth, record_count``."""
    stages = _run_layers(spark, sf_dir)
    written = None
    for qn, table in stages.items():
        part = table.log().select(F.lit(qn).alias("qualified_name"), F.col("added_rows").alias("record_count"))
        written = part if written is None else written.unionByName(part)
    sources = M.table_row_counts(read_tables(spark, sf_dir, ["orders", "customer"])).select(
        F.concat(F.lit(f"source.{DB}."), "table_name").alias("qualified_name"),
        F.col("row_count").alias("record_count"))
    counts = written.unionByName(sources)
    tables = E.make_entities(counts, "table", F.col("qualified_name"),
                             F.element_at(F.split("qualified_name", r"\."), -1),
                             attributes=F.create_map(F.lit("record_count"), F.col("record_count").cast("string")))
    wiring = spark.createDataFrame(LAYERS_EDGES, "src_qn string, process_qn string, dst_qn string")
    hops = process_hops(process_entities(wiring).select(
        F.col("qualified_name").alias("process_qn"),
        F.split(F.col("attributes")["inputs"], ",").alias("inputs"),
        F.split(F.col("attributes")["outputs"], ",").alias("outputs")))
    known = tables.select("qualified_name")
    # guard: an input hop needs a registered input table, an output hop a registered output table
    guarded = (semi_join(hops, known.withColumnRenamed("qualified_name", "src"), "src")
               .unionByName(semi_join(hops, known.withColumnRenamed("qualified_name", "dst"), "dst")))
    start = spark.createDataFrame([(LAYERS_ANALYTICS,)], "node string")
    walked = walk(guarded, start, "IN", hops.count() + 1)  # no path is longer than the hops
    tables_reached = semi_join(walked, known.withColumnRenamed("qualified_name", "node"), "node")
    return (tables_reached.join(counts.withColumnRenamed("qualified_name", "node"), "node", "left")
            .select("node", (F.col("depth") / 2).cast("int").alias("depth"), "record_count"))


# ------------------------------------------------------------ classification
def classify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    return C.classify(M.meta_columns(spark, tables), tables)


def entity_tags(spark: SparkSession, sf_dir: str, only_tag: str | None = None) -> DataFrame:
    """Tags on column entities (name and content rules) and on document entities
    (content). With ``only_tag`` just the rules that can yield that tag run."""
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    rules = [(t, rx) for t, rx in NAME_RULES if only_tag in (None, t)]
    patterns = {p: rx for p, rx in SENSITIVE_PATTERNS.items() if only_tag in (None, CONTENT_TAG_PREFIX + p)}
    parts = []
    if rules:
        parts.append(C.name_tags(M.meta_columns(spark, tables), rules))
    if patterns:
        # documents.text and pages.html are tagged by the per-row passes below (one regex pass over the texts)
        parts.append(C.content_tags({t: df.drop(*TAGGED_ROWS.get(t, [])) for t, df in tables.items()},
                                    patterns))
    cols = [p.select(F.concat(F.lit(f"source.{DB}."), "table_name", F.lit("."), "column_name").alias("entity_qn"),
                     "tag") for p in parts]
    if patterns:
        cols.append(C.row_tags(tables["documents"],
                               F.concat(F.lit(f"asset.{DB}.document."), F.col("doc_id").cast("string")), "text",
                               patterns, column_qn=f"source.{DB}.documents.text"))
        cols.append(C.row_tags(tables["pages"], F.concat(F.lit(f"asset.{DB}.page."), F.col("page_id").cast("string")), "html",
                               patterns, column_qn=f"source.{DB}.pages.html"))
    if not cols:
        return spark.createDataFrame([], "entity_qn string, tag string")
    out = cols[0]
    for c in cols[1:]:
        out = out.unionByName(c)
    return out.distinct()


def tag_search(spark: SparkSession, sf_dir: str, tag: str = SEARCH_TAG) -> DataFrame:
    tagged = entity_tags(spark, sf_dir, only_tag=tag).where(F.col("tag") == tag).select(
        F.col("entity_qn").alias("qualified_name"))
    return semi_join(build_catalog(spark, sf_dir), tagged, "qualified_name").select(
        "type_name", "qualified_name", "name")


def sensitive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every string column of every table against all patterns, whole values."""
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    return C.sensitive_scan({t: (df, C.string_columns(df)) for t, df in tables.items()})


def content_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, pages (their whole html) and conversation turns that hold a sensitive pattern: a tag a row and pattern."""
    tables = read_tables(spark, sf_dir, list(TEXT_COLUMNS))
    names = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}
    tagged = [C.row_tags(tables[t], F.concat_ws(".", F.lit(f"asset.{DB}.{KINDS[t]}"), *[F.col(k).cast("string") for k in names[t]]), c)
              for t, c in TEXT_COLUMNS.items()]
    return union_all(tagged).groupBy("entity_qn", "tag").agg(F.count(F.lit(1)).alias("rows"))


# ----------------------------------------------------------- upsert / delete
def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user (greatest ``ts``, then ``event_id``)."""
    events = read_table(spark, sf_dir, "events")
    return E.latest_per_key(events.select("user_id", "ts", "event_id", "event_type", "value", "props"),
                            key="user_id", order=["ts", "event_id"])


def cascade_delete(spark: SparkSession, sf_dir: str, region: str = CASCADE_REGION) -> DataFrame:
    t = read_tables(spark, sf_dir, ["region", "nation", "customer", "orders", "lineitem"])
    levels = [("region", t["region"], "r_regionkey", None),
              ("nation", t["nation"], "n_nationkey", "n_regionkey"),
              ("customer", t["customer"], "c_custkey", "c_nationkey"),
              ("orders", t["orders"], "o_orderkey", "o_custkey"),
              ("lineitem", t["lineitem"], None, "l_orderkey")]
    return cascade_soft_delete(levels, F.col("r_name") == region)


def validate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected raw tables vs the ones the ingest actually wrote."""
    warehouse, results = _ingest(spark, sf_dir, "validate_raw")
    written = batch_summary(spark, results, warehouse).where(F.col("table_name") != "__total__")
    found = (results.where((F.col("status") == "ok") & F.col("raw_table").startswith("raw_"))
             .select("table_name").join(written, "table_name"))
    expected = spark.createDataFrame([(t, raw_table_name(t)) for t in ALL_TABLES], "table_name string, raw_table string")
    per = (expected.join(found.select("table_name", "records_extracted"), "table_name", "left")
           .select("table_name", "raw_table", F.col("records_extracted").isNotNull().alias("is_found"),
                   F.coalesce("records_extracted", F.lit(0).cast("long")).alias("records_extracted")))
    summary = per.agg(
        F.lit("__summary__").alias("table_name"),
        F.concat(F.lit("expected="), F.count(F.lit(1)).cast("string"),
                 F.lit(";found="), F.count_if("is_found").cast("string"),
                 F.lit(";missing="), F.count_if(~F.col("is_found")).cast("string")).alias("raw_table"),
        (F.count_if(~F.col("is_found")) == 0).alias("is_found"),
        F.sum("records_extracted").cast("long").alias("records_extracted"))
    return per.unionByName(summary)


QUERIES = {
    "lineage_processes": lineage_processes,
    "lineage_fk_edges": lineage_fk_edges,
    "lineage_walk": lineage_walk,
    "hierarchy_walk": hierarchy_walk,
    "hierarchy_roots": hierarchy_roots,
    "layered_etl": layered_etl,
    "layered_etl_lineage": layered_etl_lineage,
    "classify_columns": classify_columns,
    "tag_search": tag_search,
    "sensitive_scan": sensitive_scan,
    "content_tags": content_tags,
    "upsert_events": upsert_events,
    "cascade_delete": cascade_delete,
    "validate_raw": validate_raw,
}

# --------------------------------------------------------------------- oracles
# The string columns of the driver tables (content classification scans these).
STRING_COLUMNS = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"], "pages": ["url", "html"], "benchmark": ["text"],
    "conversations": ["role", "text"],
}


def _counts(names):
    return " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in names)


def _fk_edges_sql() -> str:
    pairs = sorted({(fk.table, fk.ref_table) for fk in FOREIGN_KEYS})
    vals = ", ".join(f"('{a}', '{b}')" for a, b in pairs)
    return f"""(SELECT 'source.tpch.' || a AS src_qn, 'fk.' || a || '_' || b AS process_qn, 'source.tpch.' || b AS dst_qn
  FROM (VALUES {vals}) v(a, b)
  WHERE a IN (SELECT table_name FROM information_schema.tables WHERE table_name IN ({_IN}))
    AND b IN (SELECT table_name FROM information_schema.tables WHERE table_name IN ({_IN})))"""


def _walk_sql(name, edges, start, direction, depth) -> str:
    if direction == "OUT":
        adj = f"SELECT src AS frm, dst AS too FROM {edges}"
    elif direction == "IN":
        adj = f"SELECT dst AS frm, src AS too FROM {edges}"
    else:
        adj = f"SELECT src AS frm, dst AS too FROM {edges} UNION ALL SELECT dst, src FROM {edges}"
    return f"""(WITH RECURSIVE adj AS ({adj}),
  w(node, depth) AS (SELECT '{start}', 0 UNION
                     SELECT adj.too, w.depth + 1 FROM w JOIN adj ON adj.frm = w.node WHERE w.depth < {depth})
  SELECT '{name}' AS walk, node, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY node)"""


_FK_E = f"(SELECT src_qn AS src, dst_qn AS dst FROM {_fk_edges_sql()})"
_ROW_E = """(SELECT 'order:' || o_orderkey AS src, 'customer:' || o_custkey AS dst FROM orders
  UNION ALL SELECT 'order:' || l_orderkey, 'part:' || l_partkey FROM lineitem
  UNION ALL SELECT 'order:' || l_orderkey, 'supplier:' || l_suppkey FROM lineitem)"""


def _name_tags_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT table_name, column_name, '{tag}' AS tag, 'name' AS basis FROM {_COLS} "
        f"WHERE regexp_matches(column_name, '{rx}')" for tag, rx in NAME_RULES)


def _content_tags_sql() -> str:
    parts = []
    for t, cols in STRING_COLUMNS.items():
        for c in cols:
            for p, rx in SENSITIVE_PATTERNS.items():
                parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'PII:{p}' AS tag, 'content' AS basis "
                             f"FROM {t} HAVING count(*) FILTER (WHERE regexp_matches({c}, '{rx}')) > 0")
    return " UNION ALL ".join(parts)


def _scan_sql() -> str:
    parts = []
    for t, c in ((t, c) for t, columns in STRING_COLUMNS.items() for c in columns):
        for p, rx in SENSITIVE_PATTERNS.items():
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows_scanned, '{p}' AS pattern, "
                f"count(*) FILTER (WHERE regexp_matches({c}, '{rx}')) AS rows_with_match, "
                f"CAST(coalesce(sum(len(regexp_extract_all({c}, '{rx}'))), 0) AS BIGINT) AS match_count FROM {t}")
    return " UNION ALL ".join(parts)


def _row_tags_sql() -> str:
    keys = {"documents": "doc_id::VARCHAR", "pages": "page_id::VARCHAR", "conversations": "conv_id || '.' || turn"}
    parts = [f"SELECT 'asset.tpch.{KINDS[t]}.' || {keys[t]} AS entity_qn, '{CONTENT_TAG_PREFIX}{p}' AS tag FROM {t} WHERE regexp_matches({c}, '{rx}')"
             for t, c in TEXT_COLUMNS.items() for p, rx in SENSITIVE_PATTERNS.items()]
    return f"SELECT entity_qn, tag, count(*) AS rows FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"


def _cascade_sql(region) -> str:
    return f"""
WITH r AS (SELECT r_regionkey AS k FROM region WHERE r_name = '{region}'),
n AS (SELECT n_nationkey AS k FROM nation WHERE n_regionkey IN (SELECT k FROM r)),
c AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey IN (SELECT k FROM n)),
o AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT k FROM c))
SELECT 0 AS level, 'region' AS table_name, count(*) FILTER (WHERE r_name = '{region}') AS deleted_rows,
       count(*) FILTER (WHERE NOT (r_name = '{region}')) AS remaining_rows FROM region
UNION ALL SELECT 1, 'nation', count(*) FILTER (WHERE n_regionkey IN (SELECT k FROM r)),
       count(*) FILTER (WHERE n_regionkey NOT IN (SELECT k FROM r)) FROM nation
UNION ALL SELECT 2, 'customer', count(*) FILTER (WHERE c_nationkey IN (SELECT k FROM n)),
       count(*) FILTER (WHERE c_nationkey NOT IN (SELECT k FROM n)) FROM customer
UNION ALL SELECT 3, 'orders', count(*) FILTER (WHERE o_custkey IN (SELECT k FROM c)),
       count(*) FILTER (WHERE o_custkey NOT IN (SELECT k FROM c)) FROM orders
UNION ALL SELECT 4, 'lineitem', count(*) FILTER (WHERE l_orderkey IN (SELECT k FROM o)),
       count(*) FILTER (WHERE l_orderkey NOT IN (SELECT k FROM o)) FROM lineitem"""


ORACLE = {
    "lineage_processes": f"""
        SELECT 'etl.tpch_to_raw_' || t AS process_qn, sha256('etl.tpch_to_raw_' || t) AS process_key,
               'source.tpch.' || t AS src_qn, 'raw.tpch.' || t AS dst_qn,
               CAST(n AS BIGINT) AS records_extracted
        FROM ({_counts(INGEST_SET)})""",
    "lineage_fk_edges": f"""
        SELECT e.*, matching_rows, orphan_rows FROM {_fk_edges_sql()} e
        JOIN (SELECT 'fk.' || table_name || '_' || ref_table AS process_qn,
                     CAST(sum(n - violating_rows - null_key_rows) AS BIGINT) AS matching_rows, CAST(sum(violating_rows) AS BIGINT) AS orphan_rows
              FROM ({_orphans_sql(False)}) o JOIN ({_counts(ALL_TABLES)}) c ON c.t = o.table_name GROUP BY 1) r ON r.process_qn = e.process_qn
        WHERE matching_rows > 0""",
    "lineage_walk": " UNION ALL ".join([
        "SELECT * FROM " + _walk_sql("fk_out_lineitem", _FK_E, "source.tpch.lineitem", "OUT", 3),
        "SELECT * FROM " + _walk_sql("fk_in_region", _FK_E, "source.tpch.region", "IN", 3),
        "SELECT * FROM " + _walk_sql("fk_both_customer", _FK_E, "source.tpch.customer", "BOTH", 2),
        "SELECT * FROM " + _walk_sql("rows_both_customer", _ROW_E, f"customer:{WALK_CUSTOMER}", "BOTH", 3),
    ]),
    "hierarchy_walk": """
        WITH RECURSIVE p AS (
          SELECT 'region:' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent, 'region' AS kind FROM region
          UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey, 'nation' FROM nation
          UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey, 'customer' FROM customer
          UNION ALL SELECT 'order:' || o_orderkey, 'customer:' || o_custkey, 'order' FROM orders),
        h(node, kind, root, depth) AS (
          SELECT node, kind, node, 0 FROM p WHERE parent IS NULL
          UNION ALL SELECT p.node, p.kind, h.root, h.depth + 1 FROM p JOIN h ON p.parent = h.node)
        SELECT root, kind AS node_type, CAST(depth AS INTEGER) AS depth, count(*) AS node_count
        FROM h GROUP BY ALL""",
    "hierarchy_roots": """
        WITH RECURSIVE p AS (
          SELECT 'region:' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent, 'region' AS kind FROM region
          UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey, 'nation' FROM nation
          UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey, 'customer' FROM customer
          UNION ALL SELECT 'order:' || o_orderkey, 'customer:' || o_custkey, 'order' FROM orders),
        h(node, kind, root, depth) AS (
          SELECT node, kind, node, 0 FROM p WHERE parent IS NULL
          UNION ALL SELECT p.node, p.kind, h.root, h.depth + 1 FROM p JOIN h ON p.parent = h.node),
        t AS (SELECT DISTINCT 'turn:' || conv_id || ':' || turn AS node, conv_id AS chain, turn AS a, 0 AS b FROM conversations),
        e AS (SELECT 'event:' || event_id AS node, user_id AS chain, ts AS a, event_id AS b FROM events),
        c AS (SELECT node, 'turn' AS kind, first(node) OVER w AS root, row_number() OVER w - 1 AS depth FROM t
              WINDOW w AS (PARTITION BY chain ORDER BY a NULLS FIRST, b)
              UNION ALL
              SELECT node, 'event', first(node) OVER w, row_number() OVER w - 1 FROM e
              WINDOW w AS (PARTITION BY chain ORDER BY a NULLS FIRST, b))
        SELECT node, kind, root, CAST(depth AS INTEGER) AS depth, 'tree' AS status FROM h
        UNION ALL SELECT node, kind, root, CAST(depth AS INTEGER), 'tree' FROM c""",
    "layered_etl": """
        SELECT c.c_custkey, c.c_name, c.c_mktsegment, count(*) AS order_count,
               round(sum(o.o_totalprice), 2) AS total_spent, max(o.o_orderdate) AS last_order_date
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
        WHERE o.o_totalprice > 0 AND o.o_orderstatus IN ('F', 'O', 'P')
        GROUP BY c.c_custkey, c.c_name, c.c_mktsegment""",
    "layered_etl_lineage": f"""
        WITH RECURSIVE e(src, dst) AS (VALUES {", ".join(f"('{a}', '{c}')" for a, _b, c in LAYERS_EDGES)}),
        w(node, depth) AS (SELECT '{LAYERS_ANALYTICS}', 0 UNION
                           SELECT e.src, w.depth + 1 FROM w JOIN e ON e.dst = w.node WHERE w.depth < 3),
        valid AS (SELECT * FROM orders WHERE o_totalprice > 0 AND o_orderstatus IN ('F', 'O', 'P')),
        c(node, record_count) AS (
          SELECT 'source.tpch.orders', count(*) FROM orders UNION ALL
          SELECT 'source.tpch.customer', count(*) FROM customer UNION ALL
          SELECT 'raw.tpch.raw_orders', count(*) FROM orders UNION ALL
          SELECT 'processed.tpch.processed_orders', count(*) FROM valid UNION ALL
          SELECT '{LAYERS_ANALYTICS}', count(*) FROM customer
            WHERE c_custkey IN (SELECT o_custkey FROM valid))
        SELECT w.node, CAST(min(w.depth) AS INTEGER) AS depth, c.record_count
        FROM w LEFT JOIN c ON c.node = w.node GROUP BY w.node, c.record_count""",
    "classify_columns": _name_tags_sql() + " UNION ALL " + _content_tags_sql(),
    "tag_search": f"""
        WITH cat AS {catalog_sql()},
        ct AS ({_content_tags_sql()}),
        q AS (SELECT 'source.tpch.' || table_name || '.' || column_name AS qn FROM ct WHERE tag = '{SEARCH_TAG}'
              UNION SELECT 'asset.tpch.document.' || doc_id FROM documents
              WHERE regexp_matches(text, '{SENSITIVE_PATTERNS[SEARCH_TAG.split(":")[1]]}')
              UNION SELECT 'asset.tpch.page.' || page_id FROM pages
              WHERE regexp_matches(html, '{SENSITIVE_PATTERNS[SEARCH_TAG.split(":")[1]]}'))
        SELECT type_name, qualified_name, name FROM cat WHERE qualified_name IN (SELECT qn FROM q)""",
    "sensitive_scan": _scan_sql(),
    "content_tags": _row_tags_sql(),
    "upsert_events": """
        SELECT user_id, ts, event_id, event_type, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "cascade_delete": _cascade_sql(CASCADE_REGION),
    "validate_raw": f"""
        WITH e AS (SELECT * FROM (VALUES {", ".join(f"('{t}')" for t in ALL_TABLES)}) v(t)),
        f AS ({_counts(INGEST_SET)}),
        per AS (SELECT e.t AS table_name, 'raw_' || e.t AS raw_table, f.n IS NOT NULL AS is_found,
                       CAST(coalesce(f.n, 0) AS BIGINT) AS records_extracted FROM e LEFT JOIN f ON f.t = e.t)
        SELECT * FROM per
        UNION ALL
        SELECT '__summary__', 'expected=' || count(*) || ';found=' || count(*) FILTER (WHERE is_found)
               || ';missing=' || count(*) FILTER (WHERE NOT is_found),
               count(*) FILTER (WHERE NOT is_found) = 0, CAST(sum(records_extracted) AS BIGINT) FROM per""",
}
