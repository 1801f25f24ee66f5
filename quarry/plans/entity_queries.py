"""Registered queries: the entity catalog (build, upsert, replace, search, reports)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.frames import semi_join
from quarry.functions.names import DEFAULT_RUN_TS
from quarry.operators import entities as E
from quarry.operators import metadata as M
from quarry.operators import quality as Q
from quarry.operators.documents import field, nested_columns, table_documents, through_json
from quarry.operators.ingest import with_audit_columns
from quarry.operators.pages import columns_of_table, first_tables, numbered_pages
from quarry.plans.catalog_queries import _COLS, _FK_VALUES, _IN, _counts_sql, _nulls_sql
from quarry.plans.declared import DRIVER_CONSTRAINTS
from quarry.session import fresh_dir
from quarry.sources.scratch import materialize
from quarry.sources.tables import ALL_TABLES, STAR_TABLES, read_tables

DB = "tpch"
OLD_DB = "tpch_old"
REGISTERED = STAR_TABLES + ["documents", "pages"]  # allow-list for the partial catalog


def build_catalog(spark: SparkSession, sf_dir: str, table_allow: list[str] | None = None,
                  assets: bool = True, written: bool = False) -> DataFrame:
    """db + table + column entities from the schemas, asset entities from rows
    (``assets=False`` keeps only the schema-level entities).

    ``written=True`` writes the catalog once into the work folder and returns
    the written table: for operations that read the catalog several times
    (upsert, replace, orphans), which would otherwise re-scan the sources,
    page HTML included, once per reference.
    """
    if written:
        return materialize(build_catalog(spark, sf_dir, table_allow, assets), "catalog", measure_bytes=False).frame
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    mt = M.meta_tables(spark, tables, allow=table_allow)
    mc = M.meta_columns(spark, tables)
    parts = [E.database_entities(spark, DB), E.table_entities(mt, DB), E.column_entities(mc, DB)]
    if assets:
        parts += [E.document_entities(tables["documents"], DB), E.page_entities(tables["pages"], DB)]
    return E.union_entities(parts)


def raw_layer_entities(spark: SparkSession, sf_dir: str, names: list[str], version: int, db: str = DB) -> DataFrame:
    """Table + column entities for the raw-layer copies (source columns + audit columns)."""
    tables = read_tables(spark, sf_dir, names)
    raw = {t: with_audit_columns(df, DEFAULT_RUN_TS) for t, df in tables.items()}
    mt = M.meta_tables(spark, raw)
    mc = M.meta_columns(spark, raw)
    return E.union_entities([E.table_entities(mt, db, layer="raw", version=version),
                             E.column_entities(mc, db, layer="raw", version=version)])


def entity_build(spark, sf_dir):
    return E.flat(build_catalog(spark, sf_dir))


def entity_json_roundtrip(spark, sf_dir):
    return E.flat(E.from_json_documents(E.to_json_documents(build_catalog(spark, sf_dir))))


def _sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


GET_KEYS = [_sha("source.tpch.lineitem"), _sha("source.tpch.lineitem.l_orderkey"), _sha("asset.tpch.document.0")]


def entity_get(spark, sf_dir):
    """Point reads on the catalog as it is kept: stored clustered by key."""
    stored = E.store_by_key(build_catalog(spark, sf_dir), fresh_dir(spark, "catalog_by_key"))
    return E.flat(E.get(stored, GET_KEYS))


def entity_search(spark, sf_dir):
    return E.flat(E.search(build_catalog(spark, sf_dir), "order"))


TEXT_QUERY = "license"


def document_search(spark, sf_dir):
    """Documents whose text mentions the query, as catalog entities (all of them)."""
    docs = read_tables(spark, sf_dir, ["documents"])["documents"]
    qn = F.concat(F.lit(f"asset.{DB}.document."), F.col("doc_id").cast("string"))
    return (E.search_texts(build_catalog(spark, sf_dir), docs, qn, "text", TEXT_QUERY)
            .select("type_name", "qualified_name", "name", "description"))


def entity_documents(spark, sf_dir):
    """Every table with its columns as one nested document (raw copies name a column's type ``type``,
    sources ``dataType``), through JSON and back, its columns taken out again."""
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    columns, profiles = M.meta_columns(spark, tables), Q.all_null_profiles(tables)
    raw = columns.where(F.col("table_name").isin(STAR_TABLES))
    documents = (table_documents(columns, profiles, "source")
                 .unionByName(table_documents(raw, profiles, "raw", type_field="type")))
    back = through_json(documents)
    rows = back.select("qualified_name", field("document", ["$.rows"], "long").alias("row_count"))
    return nested_columns(back).join(rows, "qualified_name")


PAGE_SIZE = 50


def document_search_pages(spark, sf_dir):
    """All pages of ``document_search``: each row with its page, the total, and the key that the next page begins after."""
    found = document_search(spark, sf_dir).select("qualified_name", "name", "description")
    return numbered_pages(found, "qualified_name", PAGE_SIZE).select("page", "total", "qualified_name", "name", "next_key")


def table_columns(spark, sf_dir, table: str = "lineitem"):
    """One table's columns in ordinal order, looked up by parameter, with what the data says of them."""
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    columns = columns_of_table(spark, M.meta_columns(spark, tables), table)
    return (columns.join(Q.null_profile(tables[table], table), ["table_name", "column_name"])
            .select("position", "table_name", "column_name", "data_type", "row_count", "null_count").orderBy("position"))


def first_tables_by_name(spark, sf_dir, n: int = 5):
    """The first ``n`` tables by name, with their rows."""
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    return first_tables(M.meta_tables(spark, tables).select("table_name"), n).join(M.table_row_counts(tables), "table_name")


def entity_type_counts(spark, sf_dir):
    return E.type_counts(build_catalog(spark, sf_dir))


def discover_tables(spark, sf_dir):
    """The catalog's tables with what the data says of them: rows, columns, and columns without any value."""
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    profile = (Q.all_null_profiles(tables).groupBy(F.col("table_name").alias("name"))
               .agg(F.max("row_count").alias("row_count"), F.count(F.lit(1)).alias("n_columns"),
                    F.count_if(F.col("null_count") == F.col("row_count")).alias("empty_columns")))
    return (E.search(build_catalog(spark, sf_dir, assets=False), "*", type_name="table")
            .select("name", "key", "status", "qualified_name").join(profile, "name"))


def table_schema(spark, sf_dir):
    return E.table_schemas(build_catalog(spark, sf_dir))


def entity_orphans(spark, sf_dir):
    return (E.orphans(build_catalog(spark, sf_dir, table_allow=REGISTERED, written=True))
            .select("type_name", "qualified_name", "parent_qn"))


def catalog_coverage(spark, sf_dir):
    """Expected tables vs registered table entities (allow-listed catalog)."""
    catalog = build_catalog(spark, sf_dir, table_allow=REGISTERED)
    tables = read_tables(spark, sf_dir, ALL_TABLES)
    expected = (M.meta_columns(spark, tables).groupBy("table_name")
                .agg(F.count(F.lit(1)).cast("long").alias("expected_columns")))
    reg_tables = catalog.where((F.col("type_name") == "table") & (F.col("status") == E.ACTIVE)).select(
        F.col("name").alias("table_name"), F.col("qualified_name").alias("table_qn"))
    reg_cols = (semi_join(catalog.where(F.col("type_name") == "column"),
                          reg_tables.select(F.col("table_qn").alias("parent_qn")), "parent_qn")
        .groupBy(F.col("parent_qn").alias("table_qn")).agg(F.count(F.lit(1)).cast("long").alias("registered_columns")))
    per = (expected.join(reg_tables, "table_name", "left").join(reg_cols, "table_qn", "left")
           .select("table_name", F.col("table_qn").isNotNull().alias("is_registered"),
                   F.coalesce("registered_columns", F.lit(0).cast("long")).alias("registered_columns"),
                   "expected_columns"))
    per = per.withColumn("coverage", F.col("registered_columns") / F.col("expected_columns"))
    total = per.agg(F.lit("__all__").alias("table_name"), F.min("is_registered").alias("is_registered"),
                    F.sum("registered_columns").cast("long").alias("registered_columns"),
                    F.sum("expected_columns").cast("long").alias("expected_columns"),
                    (F.count_if("is_registered") / F.count(F.lit(1))).alias("coverage"))
    return per.unionByName(total).withColumn("coverage", F.round("coverage", 4))


def _label_changes(catalog: DataFrame, labels: DataFrame) -> DataFrame:
    """Document updates from labels (v2) and a second, later change for toxic ones (v3)."""
    lab = labels.select(E.entity_key(F.concat(F.lit(f"asset.{DB}.document."), F.col("doc_id").cast("string")))
                        .alias("key"), "quality", "toxic")
    docs = catalog.where(F.col("type_name") == "document")
    v2 = docs.join(lab, "key").withColumns({
        "attributes": F.map_concat("attributes", F.create_map(
            F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"), F.col("toxic").cast("string"))),
        "version": F.lit(2).cast("long")})
    v3 = v2.where(F.col("toxic") == 1).withColumns({
        "description": F.lit("quarantined: toxic"), "version": F.lit(3).cast("long")})
    return v2.unionByName(v3).drop("quality", "toxic")


def entity_upsert(spark, sf_dir):
    catalog = build_catalog(spark, sf_dir, written=True)
    labels = read_tables(spark, sf_dir, ["labels"])["labels"]
    updated = E.upsert(catalog, _label_changes(catalog, labels))
    raw_tables = (raw_layer_entities(spark, sf_dir, STAR_TABLES + ["events"], version=1)
                  .where(F.col("type_name") == "table"))
    again = E.table_entities(M.meta_tables(spark, read_tables(spark, sf_dir, ["lineitem"])), DB, version=9)
    return E.flat(E.create_or_get(updated, raw_tables.unionByName(again)))


def replaced_catalog(spark, sf_dir) -> DataFrame:
    """The raw copies of an earlier run (under another database name) are replaced by this
    run's; the source tables of the same names stay."""
    earlier = raw_layer_entities(spark, sf_dir, STAR_TABLES, version=1, db=OLD_DB)
    catalog = materialize(build_catalog(spark, sf_dir).unionByName(earlier), "catalog", measure_bytes=False).frame
    incoming = raw_layer_entities(spark, sf_dir, STAR_TABLES, version=2)
    return E.replace_by_name(catalog, incoming, version=2)


def entity_replace(spark, sf_dir):
    return E.flat(replaced_catalog(spark, sf_dir))


def entity_active_counts(spark, sf_dir):
    return E.active_counts(replaced_catalog(spark, sf_dir))


def catalog_cleanup(spark, sf_dir):
    """Columns, then tables, then databases, then the rest; a final row
    re-counts ACTIVE entities on the cleaned catalog (expected 0)."""
    cleaned, report = E.cleanup(build_catalog(spark, sf_dir))
    check = cleaned.agg(F.count_if(F.col("status") == E.ACTIVE).cast("long").alias("remaining_active")).select(
        F.lit(99).alias("step"), F.lit("verify").alias("scope"), F.lit(0).cast("long").alias("deleted"),
        "remaining_active")
    return report.unionByName(check).withColumn("step", F.col("step").cast("int"))


REPORT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True)
                              for n in ["guid", "type_name", "name", "description"]])


def discovery_report(spark, sf_dir):
    """Report rows written as JSON lines and CSV with header; the JSON copy is read back.

    The catalog is computed once: the CSV copy is written from the JSON copy.
    """
    rows = E.report_rows(build_catalog(spark, sf_dir))
    out = fresh_dir(spark, "discovery_report")
    rows.write.mode("overwrite").json(f"{out}/json")
    written = spark.read.schema(REPORT_SCHEMA).json(f"{out}/json")
    written.write.mode("overwrite").option("header", True).csv(f"{out}/csv")
    return written


def discovery_stats(spark, sf_dir, k: int = 5):
    """Entity totals per type, declared relationships, and the k widest tables."""
    catalog = build_catalog(spark, sf_dir)
    per_type = E.type_counts(catalog).select(
        F.concat(F.lit("entities:"), "type_name").alias("metric"), F.lit(0).alias("rank"),
        F.col("entity_count").alias("value"), F.lit("").alias("detail"))
    tc, kcu, ccu = M.constraint_relations(spark, DRIVER_CONSTRAINTS)
    rel = (M.foreign_key_columns(tc, kcu, ccu).select("table_name", "foreign_table_name").distinct()
           .agg(F.count(F.lit(1)).cast("long").alias("value"))
           .select(F.lit("relationships").alias("metric"), F.lit(0).alias("rank"), "value", F.lit("").alias("detail")))
    widest = E.table_schemas(catalog).orderBy(F.col("n_columns").desc(), F.col("table_name")).limit(k)
    from pyspark.sql import Window
    top = widest.select(F.lit("most_columns").alias("metric"),
                        F.row_number().over(Window.orderBy(F.col("n_columns").desc(), F.col("table_name")))
                        .alias("rank"),
                        F.col("n_columns").alias("value"), F.col("table_name").alias("detail"))
    return per_type.unionByName(rel).unionByName(top).withColumn("rank", F.col("rank").cast("int"))


QUERIES = {
    "entity_build": entity_build,
    "entity_json_roundtrip": entity_json_roundtrip,
    "entity_documents": entity_documents,
    "entity_get": entity_get,
    "entity_search": entity_search,
    "document_search": document_search,
    "document_search_pages": document_search_pages,
    "table_columns": table_columns,
    "first_tables": first_tables_by_name,
    "entity_type_counts": entity_type_counts,
    "discover_tables": discover_tables,
    "table_schema": table_schema,
    "entity_orphans": entity_orphans,
    "catalog_coverage": catalog_coverage,
    "entity_upsert": entity_upsert,
    "entity_replace": entity_replace,
    "entity_active_counts": entity_active_counts,
    "catalog_cleanup": catalog_cleanup,
    "discovery_report": discovery_report,
    "discovery_stats": discovery_stats,
}

# --------------------------------------------------------------------- oracles
_HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)"


def _tables_in(names) -> str:
    return ", ".join(f"'{t}'" for t in names)


def catalog_sql(table_allow=None) -> str:
    """The catalog as DuckDB SQL (columns as in ``entities.flat``)."""
    allow = f"AND table_name IN ({_tables_in(table_allow)})" if table_allow else ""
    return f"""(
  SELECT sha256('source.tpch') AS key, 'db' AS type_name, 'source.tpch' AS qualified_name, 'tpch' AS name,
         CAST(NULL AS VARCHAR) AS parent_qn, 'quarry' AS owner, 'Database tpch (source layer)' AS description,
         CAST(NULL AS VARCHAR) AS data_type, CAST(0 AS INTEGER) AS position, 'ACTIVE' AS status,
         'layer=source' AS attributes, CAST(1 AS BIGINT) AS version
  UNION ALL
  SELECT sha256('source.tpch.' || table_name), 'table', 'source.tpch.' || table_name, table_name, 'source.tpch',
         'quarry', 'source table ' || table_name, NULL, 0, 'ACTIVE',
         'layer=source;source_table=' || table_name, 1
  FROM (SELECT DISTINCT table_name FROM information_schema.tables WHERE table_name IN ({_IN}) {allow})
  UNION ALL
  SELECT sha256('source.tpch.' || table_name || '.' || column_name), 'column',
         'source.tpch.' || table_name || '.' || column_name, column_name, 'source.tpch.' || table_name,
         'quarry', data_type || ' column of ' || table_name, data_type, position, 'ACTIVE',
         'nullable=' || CAST(is_nullable = 'YES' AS VARCHAR), 1
  FROM {_COLS}
  UNION ALL
  SELECT sha256('asset.tpch.source.' || source), 'source', 'asset.tpch.source.' || source, source,
         'source.tpch.documents', 'quarry', 'document source ' || source, NULL, 0, 'ACTIVE', '', 1
  FROM (SELECT DISTINCT source FROM documents)
  UNION ALL
  SELECT sha256('asset.tpch.document.' || doc_id), 'document', 'asset.tpch.document.' || doc_id,
         CAST(doc_id AS VARCHAR), 'asset.tpch.source.' || source, 'quarry',
         lang || ' document, ' || n_chars || ' chars', NULL, 0, 'ACTIVE',
         'lang=' || lang || ';n_chars=' || n_chars, 1
  FROM documents
  UNION ALL
  SELECT sha256('asset.tpch.host.' || host), 'host', 'asset.tpch.host.' || host, host, 'source.tpch.pages',
         'quarry', 'web host ' || host, NULL, 0, 'ACTIVE', '', 1
  FROM (SELECT DISTINCT {_HOST} AS host FROM pages)
  UNION ALL
  SELECT sha256('asset.tpch.page.' || page_id), 'page', 'asset.tpch.page.' || page_id, CAST(page_id AS VARCHAR),
         'asset.tpch.host.' || {_HOST}, 'quarry', 'web page, ' || length(html) || ' chars', NULL, 0, 'ACTIVE',
         'url=' || url, 1
  FROM pages)"""


_STAR = _tables_in(STAR_TABLES)
# Audit columns as Spark declares them: the timestamp cast is nullable, the string literals are not.
_RAW_COLS = f"""(SELECT table_name, column_name, data_type, position, 'true' AS nullable FROM {_COLS}
  WHERE table_name IN ({{names}})
  UNION ALL SELECT t, c, ty, CAST(p + n AS INTEGER), nl FROM
   (SELECT table_name AS t, count(*) AS n FROM {_COLS} WHERE table_name IN ({{names}}) GROUP BY 1) x,
   (VALUES ('_extracted_at', 'timestamp_ntz', 1, 'true'), ('_source_system', 'string', 2, 'false'),
           ('_layer', 'string', 3, 'false')) v(c, ty, p, nl))"""


def raw_layer_sql(names, version: int, with_columns: bool = True, db: str = DB) -> str:
    return _raw_layer_sql(names, version, with_columns).replace("raw.tpch", f"raw.{db}")


def _raw_layer_sql(names, version: int, with_columns: bool) -> str:
    cols = _RAW_COLS.format(names=_tables_in(names))
    tables = f"""
  SELECT sha256('raw.tpch.' || t) AS key, 'table' AS type_name, 'raw.tpch.' || t AS qualified_name, t AS name,
         'raw.tpch' AS parent_qn, 'quarry' AS owner, 'raw table ' || t AS description,
         CAST(NULL AS VARCHAR) AS data_type, CAST(0 AS INTEGER) AS position, 'ACTIVE' AS status,
         'layer=raw;source_table=' || t AS attributes, CAST({version} AS BIGINT) AS version
  FROM (VALUES {", ".join(f"('{n}')" for n in names)}) v(t)"""
    if not with_columns:
        return f"({tables})"
    return f"""({tables}
  UNION ALL
  SELECT sha256('raw.tpch.' || table_name || '.' || column_name), 'column',
         'raw.tpch.' || table_name || '.' || column_name, column_name, 'raw.tpch.' || table_name, 'quarry',
         data_type || ' column of ' || table_name, data_type, position, 'ACTIVE', 'nullable=' || nullable, {version}
  FROM {cols})"""


_REPLACED = f"""
WITH base AS MATERIALIZED (SELECT * FROM {catalog_sql()} UNION ALL SELECT * FROM {raw_layer_sql(STAR_TABLES, 1, db=OLD_DB)}),
inc AS MATERIALIZED {raw_layer_sql(STAR_TABLES, 2)},
doomed AS MATERIALIZED (SELECT DISTINCT b.qualified_name FROM base b
           JOIN inc i ON i.type_name = 'table' AND i.name = b.name AND split_part(i.attributes, ';', 1) = split_part(b.attributes, ';', 1)
           LEFT JOIN inc j ON j.key = b.key
           WHERE b.type_name = 'table' AND b.status = 'ACTIVE' AND j.key IS NULL),
marked AS (
  SELECT b.key, type_name, b.qualified_name, name, parent_qn, owner, description, data_type, position,
         CASE WHEN d.qualified_name IS NOT NULL OR p.qualified_name IS NOT NULL THEN 'DELETED' ELSE status END AS status,
         attributes,
         CASE WHEN d.qualified_name IS NOT NULL OR p.qualified_name IS NOT NULL THEN CAST(2 AS BIGINT) ELSE version END AS version
  FROM base b LEFT JOIN doomed d ON d.qualified_name = b.qualified_name LEFT JOIN doomed p ON p.qualified_name = b.parent_qn),
replaced AS (SELECT m.* FROM marked m LEFT JOIN (SELECT key FROM inc) i ON i.key = m.key WHERE i.key IS NULL UNION ALL SELECT * FROM inc)
"""

_UPSERT = f"""
WITH base AS {catalog_sql()},
lab AS (SELECT sha256('asset.tpch.document.' || doc_id) AS key, quality, toxic FROM labels),
upd AS (
  SELECT b.key, b.type_name, b.qualified_name, b.name, b.parent_qn, b.owner,
         CASE WHEN l.toxic = 1 THEN 'quarantined: toxic' ELSE b.description END AS description,
         b.data_type, b.position, b.status,
         b.attributes || ';quality=' || l.quality || ';toxic=' || l.toxic AS attributes,
         CAST(CASE WHEN l.toxic = 1 THEN 3 ELSE 2 END AS BIGINT) AS version
  FROM base b JOIN lab l ON b.key = l.key WHERE b.type_name = 'document'),
merged AS (SELECT * FROM base WHERE key NOT IN (SELECT key FROM upd) UNION ALL SELECT * FROM upd),
raw AS {raw_layer_sql(STAR_TABLES + ["events"], 1, with_columns=False)}
SELECT * FROM merged UNION ALL SELECT * FROM raw WHERE key NOT IN (SELECT key FROM merged)
"""

_LINEITEM_KEYS = ", ".join(f"'{k}'" for k in GET_KEYS)

_TABLE_SCHEMAS = f"""
SELECT t.qualified_name AS table_qn, t.name AS table_name, count(*) AS n_columns,
       string_agg(c.name || ':' || c.data_type, ',' ORDER BY c.position, c.name, c.data_type) AS columns
FROM cat t JOIN cat c ON c.parent_qn = t.qualified_name
WHERE t.type_name = 'table' AND t.status = 'ACTIVE' AND c.type_name = 'column' AND c.status = 'ACTIVE'
GROUP BY 1, 2"""

ORACLE = {
    "entity_build": f"SELECT * FROM {catalog_sql()}",
    "entity_json_roundtrip": f"SELECT * FROM {catalog_sql()}",
    "entity_documents": f"""
        SELECT l.layer || '.' || c.table_name AS qualified_name, position, c.column_name, data_type, null_count AS nulls, row_count
        FROM {_COLS} c JOIN ({_nulls_sql()}) n ON n.table_name = c.table_name AND n.column_name = c.column_name
        JOIN (VALUES ('source'), ('raw')) l(layer) ON l.layer = 'source' OR c.table_name IN ({_STAR})""",
    "entity_get": f"SELECT * FROM {catalog_sql()} WHERE key IN ({_LINEITEM_KEYS})",
    "entity_search": f"""
        SELECT * FROM {catalog_sql()} WHERE status = 'ACTIVE' AND (
          contains(lower(name), 'order') OR contains(lower(qualified_name), 'order')
          OR contains(lower(coalesce(description, '')), 'order'))
        ORDER BY qualified_name""",
    "document_search": f"""
        SELECT type_name, qualified_name, name, description FROM {catalog_sql()}
        WHERE status = 'ACTIVE' AND qualified_name IN (
          SELECT 'asset.tpch.document.' || doc_id FROM documents WHERE contains(lower(text), '{TEXT_QUERY}'))
        ORDER BY qualified_name""",
    "document_search_pages": f"""
        WITH h AS (SELECT qualified_name, name, row_number() OVER (ORDER BY qualified_name) AS r, count(*) OVER () AS total FROM {catalog_sql()}
                   WHERE status = 'ACTIVE' AND qualified_name IN (
                     SELECT 'asset.tpch.document.' || doc_id FROM documents WHERE contains(lower(text), '{TEXT_QUERY}'))),
             p AS (SELECT *, (r - 1) // {PAGE_SIZE} + 1 AS page FROM h)
        SELECT page, total, qualified_name, name,
               CASE WHEN page * {PAGE_SIZE} < total THEN max(qualified_name) OVER (PARTITION BY page) END AS next_key FROM p""",
    "table_columns": f"""
        SELECT position, c.table_name, c.column_name, c.data_type, row_count, null_count FROM {_COLS} c
        JOIN ({_nulls_sql()}) n ON n.table_name = c.table_name AND n.column_name = c.column_name WHERE c.table_name = 'lineitem'""",
    "first_tables": f"""
        SELECT t.table_name, row_count FROM (SELECT DISTINCT table_name FROM information_schema.tables WHERE table_name IN ({_IN})
                                              ORDER BY table_name LIMIT 5) t JOIN ({_counts_sql()}) c ON c.table_name = t.table_name""",
    "entity_type_counts": f"""
        SELECT coalesce(type_name, 'unknown') AS type_name, count(*) AS entity_count, min(key) AS first_key
        FROM {catalog_sql()} WHERE status = 'ACTIVE' GROUP BY 1""",
    "discover_tables": f"""
        SELECT name, key, status, qualified_name, row_count, n_columns, empty_columns FROM {catalog_sql()} c
        JOIN (SELECT table_name, max(row_count) AS row_count, count(*) AS n_columns,
                     count(*) FILTER (WHERE null_count = row_count) AS empty_columns FROM ({_nulls_sql()}) GROUP BY 1) n ON n.table_name = c.name
        WHERE status = 'ACTIVE' AND type_name = 'table'""",
    "table_schema": f"WITH cat AS {catalog_sql()} {_TABLE_SCHEMAS}",
    "entity_orphans": f"""
        WITH cat AS MATERIALIZED {catalog_sql(REGISTERED)}
        SELECT c.type_name, c.qualified_name, c.parent_qn FROM cat c
        LEFT JOIN (SELECT DISTINCT qualified_name FROM cat) p ON p.qualified_name = c.parent_qn
        WHERE c.parent_qn IS NOT NULL AND p.qualified_name IS NULL""",
    "catalog_coverage": f"""
        WITH cat AS {catalog_sql(REGISTERED)},
        exp AS (SELECT table_name, count(*) AS expected_columns FROM {_COLS} GROUP BY 1),
        reg AS (SELECT name AS table_name, qualified_name AS table_qn FROM cat
                WHERE type_name = 'table' AND status = 'ACTIVE'),
        rc AS (SELECT parent_qn AS table_qn, count(*) AS registered_columns FROM cat
               WHERE type_name = 'column' AND parent_qn IN (SELECT table_qn FROM reg) GROUP BY 1),
        per AS (SELECT e.table_name, r.table_qn IS NOT NULL AS is_registered,
                       CAST(coalesce(rc.registered_columns, 0) AS BIGINT) AS registered_columns,
                       CAST(e.expected_columns AS BIGINT) AS expected_columns
                FROM exp e LEFT JOIN reg r ON r.table_name = e.table_name LEFT JOIN rc ON rc.table_qn = r.table_qn)
        SELECT *, round(registered_columns / expected_columns, 4) AS coverage FROM per
        UNION ALL
        SELECT '__all__', bool_and(is_registered), CAST(sum(registered_columns) AS BIGINT),
               CAST(sum(expected_columns) AS BIGINT),
               round(count(*) FILTER (WHERE is_registered) / count(*), 4) FROM per""",
    "entity_upsert": _UPSERT,
    "entity_replace": _REPLACED + "SELECT * FROM replaced",
    "entity_active_counts": _REPLACED + """
        SELECT count(*) FILTER (WHERE status = 'ACTIVE' AND type_name = 'db') AS active_dbs,
               count(*) FILTER (WHERE status = 'ACTIVE' AND type_name = 'table') AS active_tables,
               count(*) FILTER (WHERE status = 'ACTIVE' AND type_name = 'column') AS active_columns,
               count(*) FILTER (WHERE status = 'ACTIVE' AND type_name IN ('document', 'page', 'source', 'host'))
                 AS active_assets,
               count(*) FILTER (WHERE status <> 'ACTIVE') AS deleted,
               count(*) AS total
        FROM replaced""",
    "catalog_cleanup": f"""
        WITH cat AS {catalog_sql()},
        s AS (SELECT CASE type_name WHEN 'column' THEN 1 WHEN 'table' THEN 2 WHEN 'db' THEN 3 ELSE 4 END AS step,
                     CASE WHEN type_name IN ('column', 'table', 'db') THEN type_name ELSE 'rest' END AS scope,
                     count(*) AS deleted
              FROM cat WHERE status = 'ACTIVE' GROUP BY ALL)
        SELECT CAST(step AS INTEGER) AS step, scope, deleted,
               CAST(sum(deleted) OVER () - sum(deleted) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING
                    AND CURRENT ROW) AS BIGINT) AS remaining_active FROM s
        UNION ALL SELECT 99, 'verify', CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
    "discovery_report": f"""
        SELECT key AS guid, coalesce(type_name, 'unknown') AS type_name, coalesce(name, 'N/A') AS name,
               coalesce(description, 'N/A') AS description FROM {catalog_sql()}""",
    "discovery_stats": f"""
        WITH cat AS {catalog_sql()},
        ts AS ({_TABLE_SCHEMAS})
        SELECT 'entities:' || coalesce(type_name, 'unknown') AS metric, CAST(0 AS INTEGER) AS rank,
               count(*) AS value, '' AS detail
        FROM cat WHERE status = 'ACTIVE' GROUP BY 1
        UNION ALL
        SELECT 'relationships', 0, count(*), '' FROM (SELECT DISTINCT t, p FROM ({_FK_VALUES}) v(n, t, c, o, p, pc))
        UNION ALL
        SELECT 'most_columns', CAST(row_number() OVER (ORDER BY n_columns DESC, table_name) AS INTEGER),
               n_columns, table_name
        FROM (SELECT * FROM ts ORDER BY n_columns DESC, table_name LIMIT 5)""",
}
