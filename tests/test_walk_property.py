"""Walks against a brute-force breadth-first search on random small graphs
(cycles, self-loops and duplicate edges included)."""

from collections import deque

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators.graph import walk

NODES = [f"n{i}" for i in range(7)]
edge_lists = st.lists(st.tuples(st.sampled_from(NODES), st.sampled_from(NODES)), min_size=0, max_size=14)


def brute_force(edges, start, direction, max_depth):
    nbrs = {n: set() for n in NODES}
    for a, b in edges:
        if direction in ("OUT", "BOTH"):
            nbrs[a].add(b)
        if direction in ("IN", "BOTH"):
            nbrs[b].add(a)
    depth, queue = {start: 0}, deque([start])
    while queue:
        n = queue.popleft()
        if depth[n] == max_depth:
            continue
        for m in nbrs[n]:
            if m not in depth:
                depth[m] = depth[n] + 1
                queue.append(m)
    return depth


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=edge_lists, start=st.sampled_from(NODES), direction=st.sampled_from(["IN", "OUT", "BOTH"]),
       max_depth=st.integers(min_value=0, max_value=4))
def test_walk_matches_brute_force(spark, edges, start, direction, max_depth):
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r["node"]: r["depth"] for r in
           walk(df, spark.createDataFrame([(start,)], "node string"), direction, max_depth).collect()}
    assert got == brute_force(edges, start, direction, max_depth)


rows = st.lists(st.tuples(st.integers(min_value=0, max_value=3), st.integers(min_value=0, max_value=4)),
                max_size=15)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=rows)
def test_latest_per_key_matches_brute_force(spark, changes):
    from quarry.operators.entities import latest_per_key
    data = [(k, v, i, f"p{i}") for i, (k, v) in enumerate(changes)]  # (version, seq) is a total order per key
    df = spark.createDataFrame(data, "k int, version int, seq int, payload string")
    got = {r["k"]: r["payload"] for r in latest_per_key(df, "k", order=("version", "seq")).collect()}
    want = {}
    for k, v, i, p in data:
        if k not in want or (v, i) > want[k][0]:
            want[k] = ((v, i), p)
    assert got == {k: p for k, (_, p) in want.items()}


parents = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=7)), min_size=1, max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parent_of=parents)
def test_hierarchy_matches_brute_force(spark, parent_of):
    from quarry.operators.graph import hierarchy
    n = len(parent_of)
    pointers = [(f"v{i}", None if p is None else f"v{p % n}") for i, p in enumerate(parent_of)]
    nodes = spark.createDataFrame([(a, b, "k") for a, b in pointers], "node string, parent string, kind string")
    got = {r["node"]: (r["root"], r["depth"]) for r in hierarchy(nodes).collect()}
    want = {}
    for a, _ in pointers:  # follow the pointers up; nodes on a cycle never reach a root
        seen, cur, d = set(), a, 0
        while cur is not None and cur not in seen:
            seen.add(cur)
            par = dict(pointers)[cur]
            if par is None:
                want[a] = (cur, d)
                break
            cur, d = par, d + 1
    assert got == want


level_parents = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=5)), max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(top_flags=st.lists(st.booleans(), min_size=1, max_size=4), mid=level_parents, low=level_parents)
def test_cascade_matches_brute_force(spark, top_flags, mid, low):
    from pyspark.sql import functions as F
    from quarry.operators.lineage import cascade_soft_delete
    top = spark.createDataFrame([(i, "drop" if f else "keep") for i, f in enumerate(top_flags)], "k int, name string")
    mid_df = spark.createDataFrame([(i, p) for i, p in enumerate(mid)], "k int, p int")
    low_df = spark.createDataFrame([(i, p) for i, p in enumerate(low)], "k int, p int")
    levels = [("top", top, "k", None), ("mid", mid_df, "k", "p"), ("low", low_df, None, "p")]
    got = {r["table_name"]: (r["deleted_rows"], r["remaining_rows"])
           for r in cascade_soft_delete(levels, F.col("name") == "drop").collect()}
    dead_top = {i for i, f in enumerate(top_flags) if f}
    dead_mid = {i for i, p in enumerate(mid) if p in dead_top}
    dead_low = [i for i, p in enumerate(low) if p in dead_mid]
    assert got == {"top": (len(dead_top), len(top_flags) - len(dead_top)),
                   "mid": (len(dead_mid), len(mid) - len(dead_mid)),
                   "low": (len(dead_low), len(low) - len(dead_low))}
