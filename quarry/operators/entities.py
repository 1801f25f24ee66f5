"""The metadata catalog as a DataFrame of entities.

An entity is a row ``key, type_name, qualified_name, name, parent_qn, owner,
description, data_type, position, status, attributes, version``. ``key`` is the
SHA-256 of the qualified name, so a re-run produces the same ids, references
inside one batch need no placeholder ids, and an upsert is an equi-join.
Entities come from schemas (db / table / column) and from data rows (one
asset per document or page, under its source or host), so every operator here
runs at data size. Deletes are soft: ``status`` becomes ``DELETED``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.frames import anti_join, semi_join, union_all
from pyspark.sql import types as T

from quarry.functions.names import entity_key, qualified_name
from quarry.sources.scratch import materialize

ACTIVE = "ACTIVE"
DELETED = "DELETED"
DEFAULT_OWNER = "quarry"

ENTITY_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("type_name", T.StringType(), True),
    T.StructField("qualified_name", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("parent_qn", T.StringType(), True),
    T.StructField("owner", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("data_type", T.StringType(), True),
    T.StructField("position", T.IntegerType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("version", T.LongType(), False),
])
ENTITY_COLUMNS = [f.name for f in ENTITY_SCHEMA.fields]


def _empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def make_entities(df: DataFrame, type_name, qn: Column, name: Column, parent_qn=None, description=None,
                  data_type=None, position=None, attributes=None, owner=DEFAULT_OWNER, version=1,
                  status=ACTIVE) -> DataFrame:
    """Project any DataFrame into the entity shape (one entity per row)."""
    def c(v, typ):
        if v is None:
            return F.lit(None).cast(typ)
        return (v if isinstance(v, Column) else F.lit(v)).cast(typ)
    return df.select(
        entity_key(qn).alias("key"),
        c(type_name, "string").alias("type_name"),
        qn.alias("qualified_name"),
        name.cast("string").alias("name"),
        c(parent_qn, "string").alias("parent_qn"),
        c(owner, "string").alias("owner"),
        c(description, "string").alias("description"),
        c(data_type, "string").alias("data_type"),
        c(position, "int").alias("position"),
        c(status, "string").alias("status"),
        (attributes if attributes is not None else _empty_map()).alias("attributes"),
        c(version, "long").alias("version"),
    )


def union_entities(frames: list[DataFrame]) -> DataFrame:
    return union_all(frames)


# ---------------------------------------------------------------- builders
def database_entities(spark: SparkSession, db: str, layer: str = "source") -> DataFrame:
    one = spark.range(1)
    return make_entities(one, "db", qualified_name(layer, db), F.lit(db),
                         description=F.lit(f"Database {db} ({layer} layer)"),
                         attributes=F.create_map(F.lit("layer"), F.lit(layer)))


def table_entities(meta_tables: DataFrame, db: str, layer: str = "source", version: int = 1,
                   row_counts: DataFrame | None = None) -> DataFrame:
    """One entity per row of ``meta_tables`` (``table_name`` [, ``row_count``])."""
    t = meta_tables
    attrs = [F.lit("layer"), F.lit(layer), F.lit("source_table"), F.col("table_name")]
    if row_counts is not None:
        t = t.join(row_counts, "table_name", "left")
        attrs += [F.lit("record_count"), F.col("row_count").cast("string")]
    return make_entities(
        t, "table", qualified_name(layer, db, F.col("table_name")), F.col("table_name"),
        parent_qn=qualified_name(layer, db),
        description=F.concat(F.lit(f"{layer} table "), F.col("table_name")),
        attributes=F.create_map(*attrs), version=version)


def column_entities(meta_columns: DataFrame, db: str, layer: str = "source", version: int = 1) -> DataFrame:
    """One entity per column, referencing its table entity through ``parent_qn``."""
    return make_entities(
        meta_columns, "column",
        qualified_name(layer, db, F.col("table_name"), F.col("column_name")), F.col("column_name"),
        parent_qn=qualified_name(layer, db, F.col("table_name")),
        description=F.concat(F.col("data_type"), F.lit(" column of "), F.col("table_name")),
        data_type=F.col("data_type"), position=F.col("position"),
        attributes=F.create_map(F.lit("nullable"), F.col("is_nullable").cast("string")),
        version=version)


URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


def document_entities(documents: DataFrame, db: str) -> DataFrame:
    """A ``source`` entity per distinct source and a ``document`` entity per row."""
    sources = documents.select("source").distinct()
    src = make_entities(sources, "source", qualified_name("asset", db, F.lit("source"), F.col("source")),
                        F.col("source"), parent_qn=qualified_name("source", db, F.lit("documents")),
                        description=F.concat(F.lit("document source "), F.col("source")))
    docs = make_entities(
        documents, "document", qualified_name("asset", db, F.lit("document"), F.col("doc_id").cast("string")),
        F.col("doc_id"), parent_qn=qualified_name("asset", db, F.lit("source"), F.col("source")),
        description=F.concat(F.col("lang"), F.lit(" document, "), F.col("n_chars").cast("string"), F.lit(" chars")),
        attributes=F.create_map(F.lit("lang"), F.col("lang"), F.lit("n_chars"), F.col("n_chars").cast("string")))
    return src.unionByName(docs)


def page_entities(pages: DataFrame, db: str) -> DataFrame:
    """A ``host`` entity per distinct URL host and a ``page`` entity per row."""
    with_host = pages.select("page_id", "url", F.length("html").alias("html_chars"),
                             F.regexp_extract("url", URL_HOST, 1).alias("host"))
    hosts = with_host.select("host").distinct()
    host = make_entities(hosts, "host", qualified_name("asset", db, F.lit("host"), F.col("host")), F.col("host"),
                         parent_qn=qualified_name("source", db, F.lit("pages")),
                         description=F.concat(F.lit("web host "), F.col("host")))
    page = make_entities(
        with_host, "page", qualified_name("asset", db, F.lit("page"), F.col("page_id").cast("string")),
        F.col("page_id"), parent_qn=qualified_name("asset", db, F.lit("host"), F.col("host")),
        description=F.concat(F.lit("web page, "), F.col("html_chars").cast("string"), F.lit(" chars")),
        attributes=F.create_map(F.lit("url"), F.col("url")))
    return host.unionByName(page)


# ------------------------------------------------------------- operations
def latest_per_key(changes: DataFrame, key: str = "key", order=("version",)) -> DataFrame:
    """Keep one row per key: the row with the greatest ``order`` tuple wins.

    ``max_by`` instead of a ranking window: the hash aggregate combines
    map-side, so a key repeated millions of times never lands whole in one
    task. ``order`` must be a total order within a key.
    """
    payload = [c for c in changes.columns if c != key]
    return (changes.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), F.struct(*[F.col(o) for o in order])).alias("_w"))
            .select(key, *[F.col(f"_w.{c}").alias(c) for c in payload]))


def upsert(target: DataFrame, changes: DataFrame, key: str = "key") -> DataFrame:
    """Create-or-replace by key: latest change per key wins, untouched rows kept."""
    latest = latest_per_key(changes, key)
    kept = anti_join(target, latest, key)
    return kept.unionByName(latest.select(*target.columns))


def create_or_get(target: DataFrame, candidates: DataFrame, key: str = "key") -> DataFrame:
    """Insert only candidates whose key is new; existing rows are returned unchanged."""
    fresh = anti_join(latest_per_key(candidates, key), target, key)
    return target.unionByName(fresh.select(*target.columns))


def layer_of(attributes: Column | None = None) -> Column:
    """An entity's layer (``source``, ``raw``, ...): from its attributes, else the first part of its qualified name."""
    return F.coalesce((F.col("attributes") if attributes is None else attributes)["layer"], F.substring_index("qualified_name", ".", 1))


def replace_by_name(target: DataFrame, incoming: DataFrame, version: int,
                    match_types=("table",)) -> DataFrame:
    """Delete-then-recreate: existing entities with the same (type, name) as an
    incoming top-level entity of the same layer are soft-deleted together with their
    children, then the incoming entities are added. A source table and its raw copy
    share a name, not a layer, so registering one never retires the other."""
    on = ["type_name", "name", "_layer"]
    tops = incoming.where(F.col("type_name").isin(list(match_types))).withColumn("_layer", layer_of()).select(*on).distinct()
    clash = anti_join(semi_join(target.where(F.col("status") == ACTIVE).withColumn("_layer", layer_of()), tops, on),
                      incoming, "key")
    doomed = clash.select("qualified_name")
    children = semi_join(target, doomed.withColumnRenamed("qualified_name", "parent_qn"), "parent_qn")
    doomed_keys = clash.select("key").unionByName(children.select("key")).distinct()
    marked = soft_delete(target, doomed_keys, version)
    return upsert(marked, incoming)


def soft_delete(entities: DataFrame, keys: DataFrame, version: int | None = None) -> DataFrame:
    """``status = DELETED`` for the given keys (semi-join via a left join on distinct keys)."""
    flagged = entities.join(keys.select("key").distinct().withColumn("_del", F.lit(True)), "key", "left")
    hit = F.coalesce(F.col("_del"), F.lit(False))
    out = flagged.withColumn("status", F.when(hit, F.lit(DELETED)).otherwise(F.col("status")))
    if version is not None:
        out = out.withColumn("version", F.when(hit, F.lit(version).cast("long")).otherwise(F.col("version")))
    return out.drop("_del").select(*entities.columns)


def cleanup(entities: DataFrame, order=("column", "table", "db")):
    """Hierarchical cleanup: soft-delete ACTIVE entities type by type (children
    before parents), then everything left.

    Returns ``(cleaned, report)``: the cleaned catalog is written (``status`` DELETED and the
    step that deleted it in ``attributes.deleted_in``) and read back, and the report is counted on
    what was written: one row per step that deleted something, with the entities deleted in it and
    those that were left ACTIVE after it. One aggregate (a conditional count per step, combined
    map-side), unpivoted into rows.
    """
    steps = list(order) + ["rest"]
    name = F.lit(steps[-1])
    for t in reversed(list(order)):
        name = F.when(F.col("type_name") == t, F.lit(t)).otherwise(name)
    hit = F.col("status") == ACTIVE
    marked = entities.withColumns({
        "attributes": F.when(hit, F.map_concat("attributes", F.create_map(F.lit("deleted_in"), name))).otherwise(F.col("attributes")),
        "status": F.when(hit, F.lit(DELETED)).otherwise(F.col("status"))})
    cleaned = materialize(marked, "cleanup", measure_bytes=False).frame
    of = F.col("attributes")["deleted_in"]
    aggs = []
    for i, n in enumerate(steps, start=1):
        aggs += [F.count_if((of == n) & (F.col("status") == DELETED)).alias(f"d{i}"),
                 F.count_if(of.isin(steps[i:]) | (F.col("status") == ACTIVE)).alias(f"r{i}")]
    cells = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("scope"),
                               F.col(f"d{i}").alias("deleted"), F.col(f"r{i}").alias("remaining_active"))
                      for i, n in enumerate(steps, start=1)])
    report = cleaned.agg(*aggs).select(F.inline(cells)).where(F.col("deleted") > 0)
    return cleaned, report


def search(entities: DataFrame, query: str = "*", type_name: str | None = None, limit: int | None = None,
           active_only: bool = True) -> DataFrame:
    """Free-text search (case-insensitive substring of name / qualified name /
    description; ``*`` matches all). Type and status filters apply before the
    limit, and the limit follows a total order on the qualified name."""
    out = entities
    if active_only:
        out = out.where(F.col("status") == ACTIVE)
    if type_name is not None:
        out = out.where(F.col("type_name") == type_name)
    if query != "*":
        q = query.lower()
        out = out.where(F.lower(F.col("name")).contains(q) | F.lower(F.col("qualified_name")).contains(q)
                        | F.lower(F.coalesce(F.col("description"), F.lit(""))).contains(q))
    out = out.orderBy("qualified_name")
    return out.limit(limit) if limit is not None else out


def search_texts(entities: DataFrame, texts: DataFrame, qn: Column, text_col: str, query: str,
                 limit: int | None = None) -> DataFrame:
    """Free-text search over the *content* behind asset entities: rows of
    ``texts`` whose whole ``text_col`` contains ``query`` (case-insensitive)
    select their entity (``qn`` maps a row to its qualified name)."""
    from quarry.sources.tables import spread
    hits = (spread(texts).where(F.lower(F.col(text_col)).contains(query.lower()))
            .select(entity_key(qn).alias("key")))
    out = semi_join(entities.where(F.col("status") == ACTIVE), hits, "key").orderBy("qualified_name")
    return out.limit(limit) if limit is not None else out


def store_by_key(entities: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write the catalog clustered by key and return the stored table.

    Rows are range-partitioned on the key and sorted within each file, so
    every file and row group covers a narrow key range: a point read
    (``get``) on the stored table is a pushed-down ``IN`` filter, and the
    Parquet reader skips every row group whose min/max range misses the keys
    (only the footers of the other files are read).
    """
    spark = entities.sparkSession
    # without an explicit count AQE sizes the range partitions (advisory partition size)
    ranged = entities.repartitionByRange(files, "key") if files else entities.repartitionByRange("key")
    ranged.sortWithinPartitions("key").write.mode("overwrite").parquet(path)
    return spark.read.schema(entities.schema).parquet(path)


def get(entities: DataFrame, keys: list[str]) -> DataFrame:
    """Point read by id (an equality / IN filter on the key); on a table
    stored by ``store_by_key`` the filter reaches the scan and prunes."""
    return entities.where(F.col("key").isin(keys))


def type_counts(entities: DataFrame) -> DataFrame:
    """Per type (``unknown`` when missing): entity count and the smallest key."""
    return (entities.where(F.col("status") == ACTIVE)
            .groupBy(F.coalesce(F.col("type_name"), F.lit("unknown")).alias("type_name"))
            .agg(F.count(F.lit(1)).cast("long").alias("entity_count"), F.min("key").alias("first_key")))


def active_counts(entities: DataFrame) -> DataFrame:
    """ACTIVE dbs / tables / columns / data assets, and all entities, in one pass."""
    active = F.col("status") == ACTIVE
    return entities.agg(
        F.count_if(active & (F.col("type_name") == "db")).cast("long").alias("active_dbs"),
        F.count_if(active & (F.col("type_name") == "table")).cast("long").alias("active_tables"),
        F.count_if(active & (F.col("type_name") == "column")).cast("long").alias("active_columns"),
        F.count_if(active & F.col("type_name").isin("document", "page", "source", "host"))
        .cast("long").alias("active_assets"),
        F.count_if(~active).cast("long").alias("deleted"),
        F.count(F.lit(1)).cast("long").alias("total"))


def orphans(entities: DataFrame) -> DataFrame:
    """Entities whose ``parent_qn`` names no entity (reported, not joined).

    Parents are few and hot (every document sits under a handful of
    sources), so the referenced names are de-duplicated first (partial
    aggregation) and only the missing ones are joined back to the children.
    """
    children = entities.where(F.col("parent_qn").isNotNull())
    parents = entities.select(F.col("qualified_name").alias("parent_qn"))
    missing = anti_join(children.select("parent_qn").distinct(), parents, "parent_qn")
    return semi_join(children, missing, "parent_qn")


def to_json_documents(entities: DataFrame) -> DataFrame:
    return entities.select("key", F.to_json(F.struct(*[F.col(c) for c in ENTITY_COLUMNS])).alias("doc"))


def from_json_documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.from_json("doc", ENTITY_SCHEMA).alias("e")).select("e.*")


def report_rows(entities: DataFrame) -> DataFrame:
    """Report projection: id, type, name, description (``N/A`` when missing)."""
    return entities.select(F.col("key").alias("guid"),
                           F.coalesce(F.col("type_name"), F.lit("unknown")).alias("type_name"),
                           F.coalesce(F.col("name"), F.lit("N/A")).alias("name"),
                           F.coalesce(F.col("description"), F.col("attributes")["description"],
                                      F.lit("N/A")).alias("description"))


def table_schemas(entities: DataFrame) -> DataFrame:
    """Per table entity: its columns as ``name:type`` in position order.

    One join of table and column entities replaces the 1 + N point reads; the
    collected list per table is bounded by the table's width.
    """
    tables = entities.where((F.col("type_name") == "table") & (F.col("status") == ACTIVE))
    cols = entities.where((F.col("type_name") == "column") & (F.col("status") == ACTIVE))
    joined = tables.select(F.col("qualified_name").alias("table_qn"), F.col("name").alias("table_name")).join(
        cols.select(F.col("parent_qn").alias("table_qn"), "position", F.col("name").alias("column_name"),
                    "data_type"), "table_qn")
    return (joined.groupBy("table_qn", "table_name")
            .agg(F.count(F.lit(1)).cast("long").alias("n_columns"),
                 F.array_sort(F.collect_list(F.struct("position", "column_name", "data_type"))).alias("_c"))
            .select("table_qn", "table_name", "n_columns",
                    F.array_join(F.transform("_c", lambda s: F.concat(s["column_name"], F.lit(":"), s["data_type"])),
                                 ",").alias("columns")))


def flat(entities: DataFrame) -> DataFrame:
    """Scalar-only projection (attributes rendered as sorted ``k=v;...``)."""
    return entities.select(
        "key", "type_name", "qualified_name", "name", "parent_qn", "owner", "description", "data_type",
        F.coalesce("position", F.lit(0)).alias("position"), "status",
        F.array_join(F.array_sort(F.transform(F.map_entries("attributes"),
                                              lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
        .alias("attributes"),
        "version")
