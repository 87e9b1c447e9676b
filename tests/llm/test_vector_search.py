import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm.vector_search import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    usable = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % every == 0:
            asked[i] = v
    out = []
    for i, q in asked.items():
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in usable if j != i
        )[:k]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def answer(spark, rows, **more):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as ring", "2 as vec", "3 as score")
    return sorted(map(tuple, top_k(table, F.col("vec_id") % 20 == 0, **more).collect()))


def vectors(n, dim, spread, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [
        (i, (centres[i % 12] + spread * rng.normal(size=dim)).astype(np.float32).tolist(), 0) for i in range(n)
    ]


@pytest.mark.parametrize("dim,spread", [(3, 0.05), (24, 0.6)])
def test_against_all_pairs(spark, monkeypatch, dim, spread):
    monkeypatch.setattr("daybook.llm.vector_search.FIRST_WAVE", 100)
    monkeypatch.setattr("daybook.llm.vector_search.TILE_VECTORS", 64)
    monkeypatch.setattr("daybook.llm.vector_search.TILE_QUERIES", 8)
    rows = vectors(1200, dim, spread)
    assert answer(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = vectors(50, 4, 0.3)
    rows += [(60, None, 0), (61, [1.0, None, 2.0, 3.0], 0), (80, [float("nan")] * 4, 0), (81, [float("inf")] * 4, 0)]
    rows += [(100, [1.0, 2.0], 0), (None, [9.0] * 4, 0), (120, [], 0)]
    rows += [(200 + i, [1.0, 0.0, 0.0, 0.0], 0) for i in range(70)]  # ties
    assert answer(spark, rows) == brute(rows)


def test_rows_that_repeat_and_large_values(spark):
    rows = [(0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (1, [1e6, -1e6], 0), (1, [1e6, -1e6], 0), (20, [1e6, 1e6], 0)]
    assert answer(spark, rows, k=3) == brute(rows, k=3)


def test_few_and_none(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(20, [1.0], 0)]) == []
    assert answer(spark, [(20, None, 0)]) == []
