"""Changes between two stored states against a comparison row by row."""

import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from quarry.operators.changes import LEAF, _leaf_of, changed_leaves, changes, levels_of, store_state

TABLE = "id long, a string, b double"


def slow(before, after):
    out = []
    keys = {r[0] for r in before + after}
    for k in keys:
        one, two = [r for r in before if r[0] == k], [r for r in after if r[0] == k]
        for r in list(one):
            if r in two:
                one.remove(r)
                two.remove(r)
        if len(one) == len(two) == 1:
            out.append(("update", k, tuple(c for i, c in enumerate(["id", "a", "b"]) if one[0][i] != two[0][i]), 1))
            continue
        for kind, left in (("delete", one), ("insert", two)):
            for r in {x for x in left}:
                out.append((kind, k, (), left.count(r)))
    return sorted(out, key=repr)


def states(spark, tmp_path, before, after, per_leaf=25):
    a = store_state(spark.createDataFrame(before, TABLE), f"{tmp_path}/a", "id", rows_per_leaf=per_leaf)
    return a, store_state(spark.createDataFrame(after, TABLE), f"{tmp_path}/b", "id", a.cuts)


def found(a, b):
    return sorted([(r["change"], r["id"], tuple(r["columns"]), r["copies"]) for r in changes(a, b).collect()], key=repr)


def rows_of(n=1000, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["x", "y", None]), rng.choice([None, 1.0, float(i)])) for i in range(n)]


def test_changes_equal_brute_force(spark, tmp_path):
    rng = random.Random(2)
    before = rows_of()
    after = [r if rng.random() < 0.9 else (r[0], "changed", r[2]) for r in before if rng.random() < 0.95]
    after += [(5000 + i, "new", 0.5) for i in range(20)] + [(None, "null key", 1.0), (7, None, None), (7, None, None), (8, "x", 8.0)]
    before = before + [(None, "null key", 2.0), (9, "rep", 1.0), (9, "rep", 1.0)]
    a, b = states(spark, tmp_path, before, after)
    assert len(a.cuts) > 16 and levels_of(a.cuts) == 2
    assert found(a, b) == slow(before, after)


def test_only_leaves_that_differ_are_read(spark, tmp_path):
    before = rows_of()
    after = [(i, "z", b) if 100 <= i < 110 else (i, a, b) for i, a, b in before]
    a, b = states(spark, tmp_path, before, after)
    leaves = [r["node"] for r in changed_leaves(a, b).collect()]
    read = a.rows().where(F.col(LEAF).isin(leaves))
    assert 10 <= read.count() <= 75 and len(found(a, b)) == 10  # of 1,000 rows
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_leaf" in plan.split("PartitionFilters: [")[1][:80]


def test_equal_states_have_no_changes(spark, tmp_path):
    rows = rows_of(200)
    a, b = states(spark, tmp_path, rows, list(reversed(rows)))
    assert changed_leaves(a, b).collect() == [] and found(a, b) == []


@pytest.mark.parametrize("before, after", [([], [(1, "a", 1.0)]), ([(1, "a", 1.0)], []), ([], [])])
def test_empty_states(spark, tmp_path, before, after):
    a, b = states(spark, tmp_path, before, after)
    assert found(a, b) == slow(before, after)


def test_states_cut_in_different_ways_are_refused(spark, tmp_path):
    a, _ = states(spark, tmp_path, rows_of(200), rows_of(200))
    c = store_state(spark.createDataFrame(rows_of(50), TABLE), f"{tmp_path}/c", "id", rows_per_leaf=10)
    with pytest.raises(ValueError):
        changed_leaves(a, c)


def test_a_column_that_one_state_lacks_is_null_there(spark, tmp_path):
    a = store_state(spark.createDataFrame([(1, "a"), (2, "b")], "id long, a string"), f"{tmp_path}/a", "id", ())
    b = store_state(spark.createDataFrame([(1, "a", 1.0), (2, "b", None)], TABLE), f"{tmp_path}/b", "id", ())
    assert found(a, b) == [("update", 1, ("b",), 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 100, 4095])
def test_a_leaf_is_found_by_binary_search(spark, n):
    cuts = tuple(sorted(random.Random(n).sample(range(10_000), n)))
    keys = [None, -1, 10_001, *(c + d for c in cuts for d in (-1, 0, 1))]
    leaf = _leaf_of(F.col("id"), cuts)
    got = spark.createDataFrame([(k,) for k in keys], "id long").select("id", leaf.alias("leaf")).collect()
    assert [r["leaf"] for r in got] == [0 if k is None else bisect_left(cuts, k) for k in keys]
    assert "filter" not in str(leaf)  # compares a key with few cuts, not with all
