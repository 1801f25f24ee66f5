"""Roots, depths and cycles by pointer jumping, against a walk node by node."""

import random

import pytest

from quarry.operators.ancestry import ancestry
from quarry.operators.graph import hierarchy

FOREST = "node string, parent string"


def slow(rows):
    """(root, depth, status) of each node, by following its pointers."""
    parent = {}
    for n, p in rows:
        if n is not None:
            known = [x for x in (parent.get(n, p), p) if x is not None]
            parent[n] = min(known) if known else None
    out = {}
    for n in parent:
        seen, at = [], n
        while at in parent and at not in seen:
            seen.append(at)
            if parent[at] is None or parent[at] not in parent:
                break
            at = parent[at]
        last = seen[-1]
        if parent[last] is None:
            out[n] = (last, len(seen) - 1, "tree")
        elif parent[last] not in parent:
            out[n] = (last, len(seen) - 1, "missing_parent")
        else:
            cycle = seen[seen.index(at):]
            out[n] = (min(cycle), None, "cycle" if n in cycle else "below_cycle")
    return out


def found(df, rounds=None):
    return {r["node"]: (r["root"], r["depth"], r["status"]) for r in ancestry(df, rounds).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_ancestry_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    n = 60
    rows = [(f"n{i:02}", rng.choice([None, f"n{rng.randrange(n + 3):02}", f"n{max(0, i - 1):02}"])) for i in range(n)]
    rows += [(None, "n01"), rows[5], (rows[6][0], "n00")]
    assert found(spark.createDataFrame(rows, FOREST)) == slow(rows)


def test_deep_chain_in_few_rounds(spark):
    rows = [(f"{i:04}", f"{i - 1:04}" if i else None) for i in range(1001)]
    random.Random(1).shuffle(rows)
    rounds = []
    got = found(spark.createDataFrame(rows, FOREST), rounds)
    assert all(got[f"{i:04}"] == ("0000", i, "tree") for i in range(1001)) and len(rounds) <= 11


def test_cycles_of_all_lengths_with_long_tails(spark):
    rows = [("a", "a"), ("b0", "b1"), ("b1", "b2"), ("b2", "b0"), ("root", None), ("leaf", "root"), ("lost", "nowhere"), ("under", "lost")]
    rows += [(f"t{i:02}", f"t{i - 1:02}" if i else "b1") for i in range(40)]
    assert found(spark.createDataFrame(rows, FOREST)) == slow(rows)
    assert found(spark.createDataFrame(rows, FOREST))["t39"] == ("b0", None, "below_cycle")


def test_no_nodes(spark):
    assert found(spark.createDataFrame([], FOREST)) == {}


def test_equal_to_the_level_by_level_walk(spark):
    rng = random.Random(4)
    rows = [(f"n{i}", f"n{rng.randrange(i)}" if i > 3 else None, "k") for i in range(200)]
    df = spark.createDataFrame(rows, FOREST + ", kind string")
    walked = {(r["node"], r["root"], r["depth"]) for r in hierarchy(df).collect()}
    assert {(n, root, depth) for n, (root, depth, _) in found(df).items()} == walked
