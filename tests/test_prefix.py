"""Positions, running totals and version totals against sorting in one place."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators.prefix import running_totals, with_positions
from quarry.operators.versions import version_totals

ROWS = "g string, k int, v long, uid string, part string"


def rows_of(seed, n=3000):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "hot", "a", "b", None, f"g{i % 50}"]), i, rng.choice([None, rng.randrange(-50, 50)]), "u", "p")
            for i in rng.sample(range(10 * n), n)]


def slow_totals(rows):
    groups, out = {}, {}
    for g, k, v, *_ in sorted(rows, key=lambda r: r[1]):
        seen = groups.setdefault(g, [0, 0])
        seen[0] += 1
        seen[1] += v or 0
        out[k] = (seen[0], seen[1])
    return out, {g: s[0] for g, s in groups.items()}


@pytest.mark.parametrize("seed", range(2))
def test_running_totals_and_positions(spark, seed):
    rows = rows_of(seed)
    want, sizes = slow_totals(rows)
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    got = running_totals(df, ["g"], ["k"], {"n": F.lit(1).cast("long"), "total": F.col("v")})
    assert {r["k"]: (r["n"], r["total"]) for r in got.collect()} == want
    placed = with_positions(df, ["g"], ["k"]).collect()
    assert {r["k"]: r["position"] + 1 for r in placed} == {k: n for k, (n, _) in want.items()}
    assert all(r["group_size"] == sizes[r["g"]] for r in placed)


def test_without_a_group(spark):
    rows = rows_of(3)
    got = with_positions(spark.createDataFrame(rows, ROWS), [], ["k"]).collect()
    assert [r["k"] for r in sorted(got, key=lambda r: r["position"])] == sorted(r[1] for r in rows)


def test_ties_get_positions_of_their_own_and_no_rows_give_none(spark):
    same = spark.createDataFrame([("a", 1, 1, "u", "p")] * 500, ROWS)
    assert sorted(r["position"] for r in with_positions(same, ["g"], ["k"]).collect()) == list(range(500))
    assert with_positions(same.where("k > 1"), ["g"], ["k"]).collect() == []
    assert running_totals(same.where("k > 1"), [], ["k"], {"n": F.lit(1)}).collect() == []


def test_no_task_gets_all_rows(spark):
    df = running_totals(spark.createDataFrame(rows_of(5), ROWS), [], ["k"], {"n": F.lit(1).cast("long")})
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    # the one exchange to a single task takes one row a partition: their counts
    for at, line in enumerate(plan):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[__part" in plan[at + 1], plan[at:at + 2]


def test_version_totals(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.randrange(1, 6), rng.choice([None, *range(30)]), rng.choice([None, 1.5, 2.0])) for _ in range(400)]
    spark.createDataFrame(rows, "ver int, who int, x double").write.parquet(f"{tmp_path}/t")
    got = {r["version"]: r for r in version_totals(spark.read.parquet(f"{tmp_path}/t"), "ver", {"x": F.col("x")}, {"who": F.col("who")}).collect()}
    for v in range(1, 6):
        upto, new = [r for r in rows if r[0] <= v], [r for r in rows if r[0] == v]
        assert (got[v]["n_rows"], got[v]["new_n_rows"]) == (len(upto), len(new))
        assert got[v]["who"] == len({w for _, w, _ in upto if w is not None})
        assert got[v]["x"] == pytest.approx(sum(x or 0 for *_, x in upto)) and got[v]["new_x"] == pytest.approx(sum(x or 0 for *_, x in new))


def test_version_totals_scan_the_table_once(spark, tmp_path):
    from quarry.operators import versions
    df = spark.createDataFrame([(1, 2)], "ver int, x int")
    df.write.parquet(f"{tmp_path}/t")
    seen, kept = [], versions.materialize
    try:
        versions.materialize = lambda frame, *a, **k: seen.append(frame) or kept(frame, *a, **k)
        out = version_totals(spark.read.parquet(f"{tmp_path}/t"), "ver", {"s": F.col("x")}, {"d": F.col("x")})
    finally:
        versions.materialize = kept
    assert len(re.findall("FileScan parquet", seen[0]._jdf.queryExecution().executedPlan().toString())) == 1
    assert f"{tmp_path}/t" not in out._jdf.queryExecution().executedPlan().toString()
