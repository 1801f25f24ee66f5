"""Pages by key: put together, they are the whole result."""

import random

import pytest

from quarry.operators.pages import columns_of_table, first_tables, next_key, numbered_pages, page_after


def rows_of(spark, n):
    keys = [f"k{i:03}" for i in range(n)]
    random.Random(1).shuffle(keys)
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)] + [(None, -1)], "k string, v int").repartition(5), sorted(keys)


@pytest.mark.parametrize("n, size", [(23, 5), (20, 5), (3, 5), (0, 5)])
def test_pages_put_together_are_the_result(spark, n, size):
    df, keys = rows_of(spark, n)
    got, after = [], None
    for _ in range(n // size + 2):
        page = page_after(df, "k", after, size)
        got += [r["k"] for r in page.collect()]
        after = next_key(page, "k", size)
        if after is None:
            break
    assert got == keys
    numbered = sorted(tuple(r) for r in numbered_pages(df, "k", size).select("k", "page", "total", "next_key").collect())
    assert [r[0] for r in numbered] == keys
    for i, (_, page, total, key) in enumerate(numbered):
        assert (page, total) == (i // size + 1, n)
        assert key == (keys[page * size - 1] if page * size < n else None)


def test_the_key_filter_is_pushed_down(spark, tmp_path):
    df, _ = rows_of(spark, 50)
    df.write.parquet(f"{tmp_path}/t")
    plan = page_after(spark.read.parquet(f"{tmp_path}/t"), "k", "k010", 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,k010)" in plan and "TakeOrderedAndProject" in plan


def test_parameters_are_values_not_text(spark):
    columns = spark.createDataFrame([("t", "b", 2), ("t", "a", 1), ("u' OR '1'='1", "c", 1)], "table_name string, column_name string, position int")
    assert [r["column_name"] for r in columns_of_table(spark, columns, "t").collect()] == ["a", "b"]
    assert [r["column_name"] for r in columns_of_table(spark, columns, "u' OR '1'='1").collect()] == ["c"]
    assert columns_of_table(spark, columns, "none").collect() == []
    assert [r["table_name"] for r in first_tables(columns.select("table_name").distinct(), 1).collect()] == ["t"]
