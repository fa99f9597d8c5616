import math

import numpy as np
import pytest
from pyspark.sql import types as T

from tapekeeper.llm import inner_search

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("id", T.StringType()), T.StructField("score", T.StringType())])
ASKS = "id % 10 = 0"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in rows], ROWS)


def slow(rows, k, asks=lambda i: i is not None and i % 10 == 0):
    sound = []
    for i, v in rows:
        if v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(1024 * float(np.float32(x))) for x in v]
        if sum(x * x for x in w) < 1 << 62:
            sound.append((i, w))
    best = {}
    for i, v in sound:
        if asks(i):
            best[i] = max(best.get(i, v), v)
    out = []
    for q, v in best.items():
        scored = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for i, w in sound if i != q and len(w) == len(v)]
        out += [(q, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=lambda r: r[:2])


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=lambda r: r[:2])


def clusters(n, size, seed, spread=0.05, scale=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, size))
    return [(i, (scale * (middles[rng.integers(12)] + spread * rng.normal(size=size))).round(3)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = clusters(400, 6, seed) + [(1000 + i, v) for i, v in clusters(100, 6, seed + 9, 2.0, 0.2)]
    assert found(inner_search.search(table(spark, rows), ASKS, 5)) == slow(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2]), (1, None), (2, []), (3, [None, 1]), (4, [nan, 1]), (5, [inf, 1]), (6, [1e30, 1]), (7, [0, 0]), (8, [-1, -2]),
            (None, [1, 2]), (None, [1, 2]), (9, [1, 2]), (9, [1, 2]), (10, [3, 4]), (10, [3, 5]), (11, [1, 2, 3]), (20, [1, 1, 1]),
            (30, None), (40, [0, 0]), (50, [1e6, -1e6]), (12, [1e6, 1e6])]
    assert found(inner_search.search(table(spark, rows), ASKS, 3)) == slow(rows, 3)
    assert found(inner_search.search(table(spark, rows), ASKS, 100)) == slow(rows, 100)


def test_scores_beyond_53_bits_are_exact(spark):
    rows = [(i, [1e6 + i, 9e5 - i, 77777.5 + i]) for i in range(25)]
    assert max(abs(r[3]) for r in slow(rows, 4)) > 1 << 53
    assert found(inner_search.search(table(spark, rows), ASKS, 4)) == slow(rows, 4)


def test_no_rows_and_no_queries(spark):
    assert found(inner_search.search(table(spark, []), ASKS)) == []
    assert found(inner_search.search(table(spark, [(1, [1.0]), (2, [2.0])]), ASKS)) == []
    assert found(inner_search.search(table(spark, [(10, [1.0])]), ASKS)) == []


def test_hot_cells_are_dealt_to_bounded_tasks(spark, monkeypatch):
    """A third of the rows are one vector; groups and slices are small, so its cell takes several of each."""
    monkeypatch.setattr(inner_search, "GROUP", 7)
    monkeypatch.setattr(inner_search, "SLICE", 40)
    rows = [(i, v) if i % 3 else (i, np.array([0.5, 0.25, -1, 2])) for i, v in clusters(360, 4, 3)]
    assert found(inner_search.search(table(spark, rows), ASKS, 6)) == slow(rows, 6)


def test_only_needed_rows_travel(spark, monkeypatch):
    """In clearly separated clusters a group is sent a part of the rows only."""
    monkeypatch.setattr(inner_search, "GROUP", 5)
    sent = []
    deal = inner_search._dealt

    def counting(rows, cells, groups, slices):
        left, right = deal(rows, cells, groups, slices)
        sent.append((left.count(), groups[2]))
        return left, right

    monkeypatch.setattr(inner_search, "_dealt", counting)
    rows = [(i, v / np.linalg.norm(v)) for i, v in clusters(600, 5, 4, 0.01)]
    assert found(inner_search.search(table(spark, rows), ASKS, 3)) == slow(rows, 3)
    (travelled, groups), = sent
    assert groups > 5 and travelled < 0.4 * groups * len(rows)


def test_many_rows_with_a_querys_id(spark):
    rows = [(10, [1.0 + i, 2.0]) for i in range(30)] + [(i, [float(i), 1.0]) for i in range(11, 20)]
    assert found(inner_search.search(table(spark, rows), ASKS, 4)) == slow(rows, 4)
