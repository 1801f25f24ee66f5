"""Semantic types against counting shapes in plain Python."""

import random
import re

import pytest

from quarry.operators import semantic as S


def slow(values):
    """(n, level, patterns, covered, type, of_type) of a column."""
    values = [v for v in values if v is not None]
    levels = []
    for level in range(len(S.LEVELS)):
        shapes = []
        for v in values:
            shape = "*" if len(v) > S.LONGEST else v
            for steps in S.LEVELS[:level + 1] if shape != "*" else []:
                for pattern, by in steps:
                    shape = re.sub(pattern, by, shape)
            shapes.append(shape)
        counts = sorted(((-shapes.count(x), x) for x in set(shapes)))[:S.TOP]
        levels.append((shapes, [x for _, x in counts], -sum(n for n, _ in counts)))
    good = [i for i, x in enumerate(levels) if 100 * x[2] >= S.SHARE_PERCENT * len(values)]
    level = good[0] if good else len(levels) - 1
    types = [next((name for name, rx in S.TYPES if re.search(rx, shape)), S.OTHER) for shape in levels[1][0]]
    order = [n for n, _ in S.TYPES] + [S.OTHER]
    best = max(set(types), key=lambda t: (types.count(t), -order.index(t)))
    return len(values), level, " | ".join(levels[level][1]), levels[level][2], best, types.count(best)


def columns():
    rng = random.Random(1)
    n = 120
    return {"mail": [f"user{i}.x@mail-{i % 7}.example.org" for i in range(n)],
            "ip": [f"{rng.randrange(256)}.{i}.0.{rng.randrange(99)}" for i in range(n)],
            "mixed": [rng.choice([None, "", "plain", "Ünïcode wörds here", "a1", "12.5", "x" * 65, "!?"]) for _ in range(n)],
            "even": [rng.choice(["aa", "11"]) for _ in range(n)],
            "code": [f"Part#{i:05}" for i in range(n)],
            "url": [f"https://h{i % 5}.org/p/{i}?q={'z' * (i % 4)}" for i in range(n)],
            "none": [None] * n}


def test_types_equal_brute_force(spark):
    cols = columns()
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} string" for c in cols))
    got = {r["column_name"]: tuple(r)[2:] for r in S.semantic_types({"t": df}).collect()}
    assert got == {c: slow(v) for c, v in cols.items() if c != "none"}
    assert {c: got[c][4] for c in ("mail", "ip", "code", "url")} == {"mail": "email", "ip": "ipv4", "code": "code", "url": "url"}


def test_no_string_column(spark):
    with pytest.raises(ValueError):
        S.semantic_types({"t": spark.range(3)})
    assert S.semantic_types({"t": spark.createDataFrame([], "a string")}).collect() == []
