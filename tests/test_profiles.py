"""Mergeable profiles: exact counts, bounded estimates, merges equal to a scan from scratch."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import profiles as P
from quarry.operators import quality as Q
from quarry.operators.metadata import Constraints


def frame(spark, rows=20_000):
    rng = random.Random(1)
    data = [(i % 4 + 1, i, rng.randrange(5000), rng.gauss(0, 10) if rng.random() < 0.9 else None,
             rng.choice(["a", "bb", "ccc", None]), None) for i in range(rows)]
    return spark.createDataFrame(data, "v int, id long, many int, x double, s string, none string").withColumn(
        "at", F.timestamp_seconds(F.col("id")).cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def store(spark):
    df = frame(spark).cache()
    return df, P.profile_rows(df, "t", "v").cache()


def rows_of(profiles):
    return {tuple(r[k] for k in r.__fields__ if k in ("version", "column_name")): r.asDict() for r in profiles.collect()}


def test_merge_equals_one_profile_of_all_rows(store):
    df, kept = store
    merged = {r["column_name"]: r for r in P.merge(kept).collect()}
    whole = {r["column_name"]: r for r in P.profile_rows(df.drop("v"), "t").collect()}
    assert set(merged) == set(whole) == {"id", "many", "x", "s", "none", "at"}
    for c, w in whole.items():
        assert [merged[c][k] for k in ("row_count", "null_count", "low", "high")] == [w[k] for k in ("row_count", "null_count", "low", "high")], c
    a = {r["column_name"]: (r["distinct_values"], r["set_values"]) for r in P.estimates(P.merge(kept)).collect()}
    b = {r["column_name"]: (r["distinct_values"], r["set_values"]) for r in P.estimates(P.profile_rows(df.drop("v"), "t")).collect()}
    for c in a:  # the same registers and the same set, whichever way it was built
        assert a[c][0] == pytest.approx(b[c][0], rel=0.03) and a[c][1] == pytest.approx(b[c][1], rel=0.05)


def test_every_version_is_the_merge_up_to_it(store):
    df, kept = store
    got = rows_of(P.as_of(kept))
    for v in range(1, 5):
        upto = df.where(F.col("v") <= v).drop("v")
        want = {(r["column_name"],): r for r in P.profile_rows(upto, "t", store_sketches=False).collect()}
        for (c,), w in want.items():
            g = got[(v, c)]
            assert (g["row_count"], g["null_count"], g["low"], g["high"]) == (w["row_count"], w["null_count"], w["low"], w["high"])


def test_estimates_are_within_their_bounds(store):
    df, kept = store
    got = {r["column_name"]: r for r in P.estimates(P.merge(kept)).collect()}
    for c in ("id", "many", "s", "x"):
        exact = df.select(c).where(F.col(c).isNotNull()).distinct().count()
        assert got[c]["distinct_values"] == pytest.approx(exact, rel=0.07), c  # four standard errors
        assert got[c]["set_values"] == pytest.approx(exact, rel=0.07), c
    assert got["s"]["distinct_values"] == 3 and got["none"]["distinct_values"] == 0
    values = sorted(r[0] for r in df.where("x IS NOT NULL").select("x").collect())
    for q in (25, 50, 75):
        rank = sum(v <= got["x"][f"q{q}"] for v in values) / len(values)
        assert abs(rank - q / 100) < 0.03, q
    assert got["none"]["low"] is None and got["none"]["q50"] is None


def test_shared_values_of_two_columns(spark):
    a = spark.range(0, 6000).select(F.col("id").alias("k"))
    b = spark.range(4000, 9000).select(F.col("id").alias("k"))
    profiles = P.merge(P.store_of({"a": a, "b": b}))
    assert P.shared_values(profiles, ("a", "k"), ("b", "k")).first()["shared"] == pytest.approx(2000, rel=0.15)


def test_a_table_is_read_once(spark, tmp_path):
    frame(spark, 100).write.parquet(f"{tmp_path}/t")
    df = P.profile_rows(spark.read.parquet(f"{tmp_path}/t"), "t", "v")
    assert len(re.findall("FileScan parquet", df._jdf.queryExecution().executedPlan().toString())) == 1


def test_rules_are_judged_on_the_profiles(store):
    _, kept = store
    got = {(r["version"], r["column_name"]): (r["violations"], r["holds"]) for r in
           P.not_null_results(P.as_of(kept), {"t": ("id", "x", "none"), "other": ("id",)}).collect()}
    assert got[(1, "id")] == (0, True) and not got[(4, "x")][1] and got[(4, "none")] == (20_000, False)
    assert {c for _, c in got} == {"id", "x", "none"}


def test_empty_table(spark):
    assert P.profile_rows(spark.createDataFrame([], "a int, b string"), "t", None).collect() == []


def test_not_null_rules_take_part_in_the_quality_tags(spark):
    tables = {"t": spark.createDataFrame([(1, None), (2, "x")], "id long, name string")}
    cons = Constraints(primary_keys={"t": ("id",)}, not_null={"t": ("name",)})
    got = {r["check_name"]: r["violations"] for r in Q.check_results(tables, cons).collect()}
    assert got["not_null:name"] == 1 and got["unique:pk_t"] == 0
    assert Q.quality_tags(Q.check_results(tables, cons)).first()["tag"] == "quality:fail"
