"""Semi/anti-join helpers: join semantics, and the plan stays an equi-join
above a union (no per-branch nested-loop existence checks)."""

from pyspark.sql import functions as F

from quarry.functions.frames import anti_join, semi_join


def _left(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k int, v string")


def test_semi_join_keeps_matches_once(spark):
    right = spark.createDataFrame([(2,), (2,), (None,), (9,)], "k int")
    got = sorted(r["v"] for r in semi_join(_left(spark), right, "k").collect())
    assert got == ["b", "d"]  # duplicates on the right do not duplicate left rows; nulls never match


def test_anti_join_keeps_null_keys(spark):
    right = spark.createDataFrame([(2,), (None,)], "k int")
    got = sorted(r["v"] for r in anti_join(_left(spark), right, "k").collect())
    assert got == ["a", "c"]
    assert anti_join(_left(spark), right, "k").columns == ["k", "v"]


def test_no_nested_loop_over_a_union_with_a_constant_branch(spark):
    consts = spark.range(3).select(F.lit("x").alias("k"), F.col("id").alias("v"))
    rows = spark.range(5).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    right = spark.range(4).select(F.col("id").cast("string").alias("k"))
    for f in (semi_join, anti_join):
        plan = f(consts.unionByName(rows), right, "k")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan
    assert semi_join(consts.unionByName(rows), right, "k").count() == 4
    assert anti_join(consts.unionByName(rows), right, "k").count() == 4


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

keys = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=5)), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keys, right=keys)
def test_semi_anti_match_brute_force(spark, left, right):
    lf = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, i int")
    rf = spark.createDataFrame([(k,) for k in right], "k int")
    present = {k for k in right if k is not None}
    semi = sorted(r["i"] for r in semi_join(lf, rf, "k").collect())
    anti = sorted(r["i"] for r in anti_join(lf, rf, "k").collect())
    assert semi == [i for i, k in enumerate(left) if k is not None and k in present]
    assert anti == [i for i, k in enumerate(left) if k is None or k not in present]
