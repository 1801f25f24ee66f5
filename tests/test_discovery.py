"""Keys and foreign keys found in the data, against brute force on small tables."""

import random
from itertools import combinations

import pytest

from quarry.operators import discovery as D
from quarry.plans.declared import FOREIGN_KEYS, PRIMARY_KEYS
from quarry.plans.discovery_queries import foreign_keys_found, keys_found

from conftest import SF_SMALL


def tables_of(spark, seed):
    rng = random.Random(seed)
    parent = [(i, f"name {i % 9}", i / 2) for i in range(40)]
    hot = [(rng.choice([3, 3, 3, rng.randrange(40), rng.randrange(44)]) if rng.random() < 0.9 else None,
            rng.choice(["a", "b", None]), rng.randrange(5)) for _ in range(400)]
    codes = [(c, i) for i, c in enumerate(["a", "b", "c"])]
    return {"parent": spark.createDataFrame(parent, "id int, name string, half double"),
            "child": spark.createDataFrame(hot, "parent_id long, code string, n smallint"),
            "code": spark.createDataFrame(codes, "code string, place int"),
            "empty": spark.createDataFrame([], "id long, name string"),
            "nulls": spark.createDataFrame([(None, "x"), (None, "y")], "id long, code string")}


FAMILY = {"int": "i", "bigint": "i", "smallint": "i", "double": "f", "string": "s"}


def slow_foreign_keys(tables, percent):
    cols = {}
    for t, df in tables.items():
        rows = df.collect()
        for c, kind in df.dtypes:
            cols[t, c] = FAMILY[kind], [r[c] for r in rows]
    out = set()
    for a, (fam, values) in cols.items():
        child = {v for v in values if v is not None}
        for b, (other, parents) in cols.items():
            if a == b or fam != other or not child or None in parents or len(set(parents)) != len(parents):
                continue
            matched = child & set(parents)
            if matched and 100 * len(matched) >= percent * len(child):
                rows = sum(v in matched for v in values)
                nulls = values.count(None)
                out.add((*a, *b, len(child), len(matched), len(set(parents)), rows, len(values) - nulls - rows, nulls))
    return out


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_foreign_keys_equal_brute_force(spark, percent):
    tables = tables_of(spark, percent)
    found = {tuple(r)[:10] for r in D.foreign_keys_found(tables, percent).collect()}
    assert found == slow_foreign_keys(tables, percent)
    if percent == 80:
        edge = next(r for r in found if r[:4] == ("child", "parent_id", "parent", "id"))
        assert edge[8] > 0 and edge[9] > 0  # orphan rows and null rows


def test_declared_foreign_keys_are_found(spark):
    found = {tuple(r)[:4] for r in foreign_keys_found(spark, SF_SMALL).where("declared").collect()}
    assert found == {(fk.table, fk.columns[0], fk.ref_table, fk.ref_columns[0]) for fk in FOREIGN_KEYS}


def test_no_pair_survives(spark):
    assert D.foreign_keys_found({"a": spark.createDataFrame([(1,), (1,)], "x int")}).collect() == []


def test_more_columns_than_one_word_of_bits(spark):
    wide = spark.createDataFrame([tuple(range(130)), tuple(range(1, 131))], ", ".join(f"c{i} int" for i in range(130)))
    sets = {tuple(r["cols"]): r["n"] for r in D.column_sets({"w": wide}, D.columns_of({"w": wide})).collect()}
    want = {}
    for v in range(131):
        key = tuple(sorted({c for c in (v, v - 1) if 0 <= c < 130}))
        want[key] = want.get(key, 0) + 1
    assert sets == want


def slow_keys(df, max_size):
    rows, found = [tuple(r) for r in df.collect()], []
    for size in range(1, max_size + 1):
        for combo in combinations(range(len(df.columns)), size):
            if rows and not any(set(k) <= set(combo) for k in found):
                cells = [tuple(r[i] for i in combo) for r in rows]
                if len(set(cells)) == len(cells):
                    found.append(combo)
    return {(",".join(df.columns[i] for i in k), sum(any(r[i] is None for i in k) for r in rows)) for k in found}


@pytest.mark.parametrize("seed", range(3))
def test_keys_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    grid = [(i // 8, i % 8, rng.randrange(3), f"t{i % 32}", rng.choice([None, i])) for i in range(64)]
    rng.shuffle(grid)
    tables = {"grid": spark.createDataFrame(grid, "a int, b int, c int, d string, e long"),
              "some": spark.createDataFrame([(rng.randrange(6), rng.randrange(6), rng.randrange(6)) for _ in range(12)], "x int, y int, z int"),
              "one": spark.createDataFrame([(None, "a")], "p int, q string"),
              "none": spark.createDataFrame([], "p int, q string")}
    found = D.unique_combinations(tables, 3, batch=5).collect()
    for t, df in tables.items():
        assert {(r["key_columns"], r["null_rows"]) for r in found if r["table_name"] == t} == slow_keys(df, 3), t


def test_declared_keys_are_found_where_they_hold(spark):
    found = {(r["table_name"], r["key_columns"]) for r in keys_found(spark, SF_SMALL).collect()}
    for t, key in PRIMARY_KEYS.items():
        rows = spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(*key)
        assert ((t, ",".join(key)) in found) == (rows.count() == rows.distinct().count()), t


def test_candidates_are_refuted_in_one_share_and_confirmed_on_all_rows(spark, monkeypatch):
    rows = [(i, i // 2 * 2 + (i % 1000 != 1), i % 7, f"s{i}") for i in range(3000)]
    rows[2999] = (2999, 2999, 1, "s17")  # one repeat, likely in another share
    tables = {"t": spark.createDataFrame(rows, "a long, b long, c long, d string")}
    want = {tuple(r) for r in D.unique_combinations(tables).collect()}
    calls = []
    confirmed = D._confirmed
    monkeypatch.setattr(D, "_confirmed", lambda t, combos, rows, by=None: calls.append((len(combos), by is None)) or confirmed(t, combos, rows, by))
    monkeypatch.setattr(D, "_LARGE", 1)
    assert {tuple(r) for r in D.unique_combinations(tables).collect()} == want
    assert any(not whole for _, whole in calls) and ("t", "a", 1, 3000, 0) in want and "d" not in {r[1] for r in want}


def test_only_columns_of_a_family_with_a_unique_column_are_unpivoted(spark, monkeypatch):
    tables = {"p": spark.createDataFrame([(i, float(i % 3)) for i in range(50)], "k long, x double"),
              "c": spark.createDataFrame([(i % 50, float(i % 3), "s") for i in range(200)], "f long, y double, z string")}
    seen = []
    sets = D.column_sets
    monkeypatch.setattr(D, "column_sets", lambda t, columns: seen.append({c.column for c in columns}) or sets(t, columns))
    found = {tuple(r)[:4] for r in D.foreign_keys_found(tables).collect()}
    assert found == {("c", "f", "p", "k")} and seen == [{"k", "f"}]
