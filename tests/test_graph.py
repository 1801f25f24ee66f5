from quarry.operators.graph import hierarchy, walk
from quarry.operators.lineage import cascade_soft_delete
from pyspark.sql import functions as F


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def _start(spark, node):
    return spark.createDataFrame([(node,)], "node string")


def test_walk_terminates_on_cycles(spark):
    edges = _edges(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("d", "d")])
    got = {r["node"]: r["depth"] for r in walk(edges, _start(spark, "a"), "OUT", 10).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_walk_directions_and_min_depth(spark):
    edges = _edges(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("x", "a")])
    out = {r["node"]: r["depth"] for r in walk(edges, _start(spark, "a"), "OUT", 3).collect()}
    assert out == {"a": 0, "b": 1, "c": 1}
    inn = {r["node"]: r["depth"] for r in walk(edges, _start(spark, "c"), "IN", 3).collect()}
    assert inn == {"c": 0, "a": 1, "b": 1, "x": 2}
    both = {r["node"]: r["depth"] for r in walk(edges, _start(spark, "b"), "BOTH", 1).collect()}
    assert both == {"b": 0, "a": 1, "c": 1}


def test_walk_depth_monotone(spark):
    edges = _edges(spark, [(str(i), str(i + 1)) for i in range(6)])
    prev = set()
    for d in range(4):
        cur = {r["node"] for r in walk(edges, _start(spark, "0"), "OUT", d).collect()}
        assert prev <= cur
        prev = cur
    assert prev == {"0", "1", "2", "3"}


def test_walk_without_broadcast(spark):
    edges = _edges(spark, [("a", "b"), ("b", "c")])
    got = {r["node"]: r["depth"] for r in walk(edges, _start(spark, "a"), "OUT", 3, broadcast_rows=0).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_staff_hierarchy_self_reference(spark):
    # manager pointers 2, -, 2, 2, 2, 5, 5, 2, 5 for employees 1..9
    managers = [2, None, 2, 2, 2, 5, 5, 2, 5]
    nodes = spark.createDataFrame([(str(i + 1), None if m is None else str(m), "employee")
                                   for i, m in enumerate(managers)], "node string, parent string, kind string")
    got = {r["node"]: (r["root"], r["depth"]) for r in hierarchy(nodes).collect()}
    assert got["2"] == ("2", 0)
    assert got["5"] == ("2", 1) and got["6"] == ("2", 2) and got["9"] == ("2", 2)
    assert len(got) == 9


def test_hierarchy_skips_cycles(spark):
    nodes = spark.createDataFrame([("r", None, "k"), ("a", "r", "k"), ("x", "y", "k"), ("y", "x", "k")],
                                  "node string, parent string, kind string")
    assert {r["node"] for r in hierarchy(nodes).collect()} == {"r", "a"}


def test_cascade_soft_delete(spark):
    top = spark.createDataFrame([(1, "keep"), (2, "drop")], "t_id int, name string")
    mid = spark.createDataFrame([(10, 1), (20, 2), (21, 2)], "m_id int, t_id int")
    low = spark.createDataFrame([(100, 10), (200, 20), (201, 21), (202, 21)], "l_id int, m_id int")
    levels = [("top", top, "t_id", None), ("mid", mid, "m_id", "t_id"), ("low", low, None, "m_id")]
    got = {r["table_name"]: (r["deleted_rows"], r["remaining_rows"])
           for r in cascade_soft_delete(levels, F.col("name") == "drop").collect()}
    assert got == {"top": (1, 1), "mid": (2, 1), "low": (3, 1)}


def test_process_hops_link_inputs_to_outputs_without_pairs(spark):
    from quarry.operators.lineage import process_hops
    procs = spark.createDataFrame([("p", ["a", "b"], ["x", "y", "z"])],
                                  "process_qn string, inputs array<string>, outputs array<string>")
    hops = process_hops(procs)
    assert hops.count() == 5  # inputs + outputs, not 2 x 3 pairs
    got = {r["node"]: r["depth"] for r in walk(hops, _start(spark, "y"), "IN", 2).collect()}
    assert got == {"y": 0, "p": 1, "a": 2, "b": 2}
