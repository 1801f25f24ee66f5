from pyspark.sql import functions as F

from quarry.operators import entities as E
from quarry.operators.analytics import top_k_counts


def _ents(spark, rows):
    df = spark.createDataFrame(rows, "qn string, type_name string, name string, version long, status string")
    return E.make_entities(df, F.col("type_name"), F.col("qn"), F.col("name"), version=F.col("version"),
                           status=F.col("status"))


def test_upsert_latest_change_wins_and_is_idempotent(spark):
    target = _ents(spark, [("db.t1", "table", "t1", 1, "ACTIVE"), ("db.t2", "table", "t2", 1, "ACTIVE")])
    changes = _ents(spark, [("db.t1", "table", "t1-v2", 2, "ACTIVE"), ("db.t1", "table", "t1-v3", 3, "ACTIVE"),
                            ("db.t3", "table", "t3", 1, "ACTIVE")])
    once = E.upsert(target, changes)
    got = {r["qualified_name"]: (r["name"], r["version"]) for r in once.collect()}
    assert got == {"db.t1": ("t1-v3", 3), "db.t2": ("t2", 1), "db.t3": ("t3", 1)}
    twice = E.upsert(once, changes)
    assert sorted(map(tuple, twice.drop("attributes").collect())) == sorted(map(tuple, once.drop("attributes").collect()))


def test_create_or_get_keeps_existing(spark):
    target = _ents(spark, [("db.t1", "table", "t1", 1, "ACTIVE")])
    cands = _ents(spark, [("db.t1", "table", "other", 5, "ACTIVE"), ("db.t2", "table", "t2", 1, "ACTIVE")])
    got = {r["qualified_name"]: r["name"] for r in E.create_or_get(target, cands).collect()}
    assert got == {"db.t1": "t1", "db.t2": "t2"}


def test_soft_delete_and_unknown_type(spark):
    ents = _ents(spark, [("db.t1", "table", "t1", 1, "ACTIVE"), ("db.x", None, "x", 1, "ACTIVE"),
                         ("db.gone", "table", "gone", 1, "DELETED")])
    counts = {r["type_name"]: r["entity_count"] for r in E.type_counts(ents).collect()}
    assert counts == {"table": 1, "unknown": 1}
    deleted = E.soft_delete(ents, ents.where(F.col("name") == "t1").select("key"), version=2)
    assert E.active_counts(deleted).first()["deleted"] == 2


def test_replace_by_name_soft_deletes_children_within_the_layer(spark):
    target = E.union_entities([
        _ents(spark, [("raw.old.t1", "table", "t1", 1, "ACTIVE"), ("source.db.t1", "table", "t1", 1, "ACTIVE")]),
        E.make_entities(spark.range(1), "column", F.lit("raw.old.t1.c"), F.lit("c"), parent_qn=F.lit("raw.old.t1")),
        E.make_entities(spark.range(1), "column", F.lit("source.db.t1.c"), F.lit("c"), parent_qn=F.lit("source.db.t1")),
    ])
    incoming = _ents(spark, [("raw.db.t1", "table", "t1", 2, "ACTIVE")])
    got = {r["qualified_name"]: r["status"] for r in E.replace_by_name(target, incoming, 2).collect()}
    assert got == {"raw.old.t1": "DELETED", "raw.old.t1.c": "DELETED", "raw.db.t1": "ACTIVE",
                   "source.db.t1": "ACTIVE", "source.db.t1.c": "ACTIVE"}  # the raw copy does not retire its source


def test_json_roundtrip_identity(spark):
    ents = E.make_entities(spark.range(3), "column", F.concat(F.lit("q."), F.col("id").cast("string")),
                           F.col("id"), position=F.col("id"), attributes=F.create_map(F.lit("k"), F.lit("v")))
    back = E.from_json_documents(E.to_json_documents(ents))
    assert sorted(map(str, back.collect())) == sorted(map(str, ents.collect()))


def test_search_filters_before_limit(spark):
    rows = [(f"db.col{i}", "column", f"col{i}", 1, "ACTIVE") for i in range(20)]
    rows += [("db.zz_table", "table", "zz_table", 1, "ACTIVE")]
    ents = _ents(spark, rows)
    got = E.search(ents, "*", type_name="table", limit=10).collect()
    assert [r["name"] for r in got] == ["zz_table"]  # the type filter is not cut by the limit


def test_topk_tie_break(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("c",)] * 3 + [("b",)] * 3 + [("d",)] * 3, "k string")
    got = [(r["k"], r["n"]) for r in top_k_counts(df, "k", 2, "n").collect()]
    assert got == [("a", 5), ("b", 3)]


def test_latest_per_key_plan_has_no_window(spark):
    df = spark.range(100).selectExpr("id % 3 AS key", "id AS version", "id AS v")
    plan = E.latest_per_key(df, "key")._jdf.queryExecution().executedPlan().toString()
    # map-side partial aggregate before the exchange: a hot key leaves each task as one row
    assert "Window" not in plan and "partial_max_by" in plan


def test_cleanup_children_first_report(spark):
    ents = _ents(spark, [("c1", "column", "a", 1, "ACTIVE"), ("c2", "column", "b", 1, "ACTIVE"),
                         ("t", "table", "t", 1, "ACTIVE"), ("d", "document", "x", 1, "ACTIVE"),
                         ("gone", "column", "z", 1, "DELETED")])
    cleaned, report = E.cleanup(ents)
    got = sorted(tuple(r) for r in report.select("step", "scope", "deleted", "remaining_active").collect())
    # no db entity: that step deletes nothing and is not reported
    assert got == [(1, "column", 2, 2), (2, "table", 1, 1), (4, "rest", 1, 0)]
    assert cleaned.where(F.col("status") == "ACTIVE").count() == 0


def test_search_texts_reads_whole_texts_and_limits_after_filtering(spark):
    ents = _ents(spark, [(f"doc.{i}", "document", str(i), 1, "ACTIVE") for i in range(4)]
                 + [("doc.9", "document", "9", 1, "DELETED")])
    long_tail = "filler " * 20000 + "Needle here"
    texts = spark.createDataFrame([(0, "no match"), (1, long_tail), (2, "NEEDLE first"), (3, "needle"),
                                   (9, "needle but deleted")], "doc_id long, text string")
    qn = F.concat(F.lit("doc."), F.col("doc_id").cast("string"))
    got = [r["qualified_name"] for r in E.search_texts(ents, texts, qn, "text", "needle").collect()]
    assert got == ["doc.1", "doc.2", "doc.3"]  # a match 140k characters in counts; deleted entities do not
    top = [r["qualified_name"] for r in E.search_texts(ents, texts, qn, "text", "needle", limit=2).collect()]
    assert top == ["doc.1", "doc.2"]


def test_stored_catalog_point_read_pushes_the_key_filter(spark):
    from quarry.session import fresh_dir
    ents = _ents(spark, [(f"t.{i}", "table", str(i), 1, "ACTIVE") for i in range(50)])
    stored = E.store_by_key(ents, fresh_dir(spark, "by_key"), files=4)
    wanted = [r["key"] for r in ents.where(F.col("qualified_name").isin("t.3", "t.41")).collect()]
    got = E.get(stored, wanted)
    assert sorted(r["qualified_name"] for r in got.collect()) == ["t.3", "t.41"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(key" in plan or "PushedFilters: [IsNotNull(key), In(key" in plan
