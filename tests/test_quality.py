from quarry.operators import quality as Q
from quarry.operators.metadata import Constraints, ForeignKey


def test_fk_orphans_null_exempt(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    children = spark.createDataFrame([(10, 1), (11, 9), (12, None), (13, 9)], "cid int, pid int")
    fk = ForeignKey("fk_c_p", "children", ("pid",), "parents", ("id",))
    r = Q.orphan_references(children, parents, fk).first()
    assert (r["violating_keys"], r["violating_rows"], r["null_key_rows"]) == (1, 2, 1)


def test_composite_fk_pairs_by_ordinal(spark):
    parent = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    # (2, 1) is (1, 2) swapped: must be an orphan when columns are paired by ordinal
    child = spark.createDataFrame([(1, 2), (2, 1), (3, 4)], "x int, y int")
    fk = ForeignKey("fk", "child", ("x", "y"), "parent", ("a", "b"))
    r = Q.orphan_references(child, parent, fk).first()
    assert r["violating_keys"] == 1 and r["violating_rows"] == 1


def test_unreferenced_parents(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    children = spark.createDataFrame([(1,), (1,), (3,)], "pid int")
    fk = ForeignKey("fk", "children", ("pid",), "parents", ("id",))
    assert Q.unreferenced_parents(children, parents, fk, "lonely").first()["violating_keys"] == 1


def test_length_check(spark):
    df = spark.createDataFrame([("abcd",), ("abcde",), ("abcdef",), (None,)], "code string")
    r = Q.length_profile(df, "long_strings", {"code": 5}).first()
    assert (r["max_length"], r["declared_length"], r["over_limit"]) == (6, 5, 1)


def test_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1), (None, 3)], "a int, b int")
    r = Q.duplicate_keys(df, "t", ("a", "b"), "pk_t").first()
    assert (r["duplicate_groups"], r["duplicate_rows"], r["null_key_rows"]) == (2, 5, 1)


def test_null_profile_every_column(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a int, b string")
    got = {r["column_name"]: (r["row_count"], r["null_count"]) for r in Q.null_profile(df, "t").collect()}
    assert got == {"a": (3, 2), "b": (3, 2)}


def test_quality_tags_worst_result(spark):
    good = spark.createDataFrame([(1, "ab")], "id int, code string")
    bad = spark.createDataFrame([(1, "abcdef"), (1, "x")], "id int, code string")
    cons = Constraints(primary_keys={"good": ("id",), "bad": ("id",)}, lengths={"bad": {"code": 3}})
    tags = {r["table_name"]: r["tag"] for r in Q.quality_tags(Q.check_results({"good": good, "bad": bad}, cons)).collect()}
    assert tags == {"good": "quality:pass", "bad": "quality:fail"}


def test_key_check_plan_aggregates_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k")
    plan = Q.duplicate_keys(df, "t", ("k",), "pk")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan  # partial aggregate runs before the exchange


def test_empty_tables_still_report_every_check(spark):
    empty = spark.createDataFrame([], "k int, p int")
    parent = spark.createDataFrame([(1,)], "k int")
    cons = Constraints(primary_keys={"e": ("k",), "p": ("k",)},
                       foreign_keys=[ForeignKey("fk_e_p", "e", ("p",), "p", ("k",))])
    dups = {r["table_name"]: r["duplicate_groups"] for r in Q.all_duplicate_keys({"e": empty, "p": parent}, cons).collect()}
    assert dups == {"e": 0, "p": 0}
    refs = Q.all_reference_checks({"e": empty, "p": parent}, cons).collect()
    assert [(r["constraint_name"], r["violating_rows"], r["null_key_rows"]) for r in refs] == [("fk_e_p", 0, 0)]


def test_keys_are_counted_in_tasks_that_grow_with_the_table(spark, monkeypatch):
    from quarry.operators import quality as Q
    monkeypatch.setattr(Q, "ROWS_PER_TASK", 100)
    rows = [(i % 700 if i % 3 else None, "hot" if i < 900 else str(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a long, b string")
    counted = Q.key_counts(df, len(rows))
    assert counted.rdd.getNumPartitions() == 21
    got = {(r["a"], r["b"]): r["n"] for r in counted.collect()}
    assert got == {k: rows.count(k) for k in set(rows)}
    assert {tuple(r) for r in Q.duplicate_keys(df, "t", ("b",), "pk").collect()} == {("pk", "t", "b", 1, 900, 0)}
