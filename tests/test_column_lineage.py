"""Column lineage read from plans: values only, through every kind of operator."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.column_lineage import column_edges, trace


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lineage"))
    spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "id int, name string, price double").write.parquet(f"{root}/a")
    spark.createDataFrame([(1, [1, 2]), (2, [3])], "id int, items array<int>").write.parquet(f"{root}/b")
    return spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/b"), {f"{root}/a": "src.a", f"{root}/b": "src.b"}


def edges_of(df, names):
    out = {}
    for s, d, how in column_edges(df, "t", names):
        if not d.endswith(".*"):
            out.setdefault(d[2:], set()).add(s)
    return out


def test_projection_rename_and_literal(tables):
    a, _, names = tables
    df = a.select(F.col("id").alias("key"), (F.col("price") * 2).alias("double_price"), F.lit(1).alias("one"))
    assert edges_of(df, names) == {"key": {"src.a.id"}, "double_price": {"src.a.price"}}  # name is not used, one takes nothing
    assert {how for _, d, how in column_edges(df, "t", names) if d == "t.key"} == {"id"}


def test_a_renamed_source_column_shows(tables):
    a, _, names = tables
    df = a.withColumnRenamed("price", "cost").select("cost")
    assert edges_of(df, names) == {"cost": {"src.a.price"}}


def test_join_and_filter_columns_are_no_value_lineage(tables):
    a, b, names = tables
    df = a.join(b, a["id"] == b["id"]).where(F.col("price") > 0).select("name", F.size("items").alias("n"))
    assert edges_of(df, names) == {"name": {"src.a.name"}, "n": {"src.b.items"}}


def test_aggregate_window_and_generate(tables):
    a, b, names = tables
    agg = a.groupBy("name").agg(F.sum("price").alias("total"), F.count(F.lit(1)).alias("n"))
    assert edges_of(agg, names) == {"name": {"src.a.name"}, "total": {"src.a.price"}, "n": {"src.a.*"}}
    win = a.select("id", F.sum("price").over(Window.partitionBy("name").orderBy("id")).alias("running"))
    assert edges_of(win, names)["running"] == {"src.a.price", "src.a.name", "src.a.id"}
    gen = b.select("id", F.explode("items").alias("item"))
    assert edges_of(gen, names) == {"id": {"src.b.id"}, "item": {"src.b.items"}}


def test_union_and_self_join(tables):
    a, b, names = tables
    both = a.select(F.col("id").alias("k")).union(b.select(F.element_at("items", 1)))
    assert edges_of(both, names) == {"k": {"src.a.id", "src.b.items"}}
    x, y = a.alias("x"), a.alias("y")
    joined = x.join(y, F.col("x.id") == F.col("y.id")).select(F.col("x.name").alias("n"), F.col("y.price").alias("p"))
    assert edges_of(joined, names) == {"n": {"src.a.name"}, "p": {"src.a.price"}}


def test_subqueries_of_sql_text(spark, tables):
    a, b, names = tables
    df = spark.sql("WITH c AS (SELECT id, upper(name) AS big FROM {a}) SELECT c.big, s.top FROM c JOIN (SELECT id, max(price) AS top FROM {a} GROUP BY id) s"
                   " ON c.id = s.id", a=a)
    assert edges_of(df, names) == {"big": {"src.a.name"}, "top": {"src.a.price"}}


def test_python_maps_take_every_column(tables):
    a, _, names = tables
    df = a.select("id", "name").mapInPandas(lambda it: it, "id int, name string")
    assert edges_of(df, names) == {"id": {"src.a.id", "src.a.name"}, "name": {"src.a.id", "src.a.name"}}


def test_trace_goes_through_all_jobs_and_ends_on_cycles(spark):
    edges = [("src.a.x", "raw.a.x", "x"), ("raw.a.x", "out.t.y", "x + 1"), ("out.t.y", "raw.a.x", "y"), ("src.a.z", "out.t.w", "z")]
    got = {(r["target_column"], r["source_column"], r["depth"], r["is_source"]) for r in trace(spark, edges, "out.t").collect()}
    assert got == {("out.t.y", "raw.a.x", 1, False), ("out.t.y", "src.a.x", 2, True), ("out.t.w", "src.a.z", 1, True)}
