"""Uniqueness and reference checks against brute force on random small
tables with composite keys and null key parts."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import quality as Q
from quarry.operators.metadata import ForeignKey

part = st.one_of(st.none(), st.integers(min_value=0, max_value=2))
pairs = st.lists(st.tuples(part, part), max_size=14)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=pairs)
def test_duplicate_keys_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    r = Q.duplicate_keys(df, "t", ("a", "b"), "pk").first()
    keyed = Counter(k for k in rows if None not in k)
    assert r["duplicate_groups"] == sum(1 for n in keyed.values() if n > 1)
    assert r["duplicate_rows"] == sum(n for n in keyed.values() if n > 1)
    assert r["null_key_rows"] == sum(1 for k in rows if None in k)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(child=pairs, parent=pairs)
def test_orphan_references_match_brute_force(spark, child, parent):
    c = spark.createDataFrame(child, "x int, y int")
    p = spark.createDataFrame(parent, "k1 int, k2 int")
    r = Q.orphan_references(c, p, ForeignKey("fk", "c", ("x", "y"), "p", ("k1", "k2"))).first()
    known = {k for k in parent if None not in k}
    orphans = Counter(k for k in child if None not in k and k not in known)
    assert r["violating_keys"] == len(orphans)
    assert r["violating_rows"] == sum(orphans.values())
    assert r["null_key_rows"] == sum(1 for k in child if None in k)
