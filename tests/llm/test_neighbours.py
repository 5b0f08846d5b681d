import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=10):
    usable = {}
    for vec_id, v, *_ in rows:
        if vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[vec_id, tuple(v)] = (vec_id, np.array(v, np.float32).astype(float))
    out = []
    for _, (q, x) in usable.items():
        if q % 100 == 0:
            near = sorted((float(neighbours.distance(x[None], y[None])[0]), c) for c, y in usable.values() if c != q and len(y) == len(x))
            out += [(q, i + 1, c, d) for i, (d, c) in enumerate(near[:k])]
    return sorted(out)


def run(spark, rows):
    found = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())


def test_equals_brute_force(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(8, 24))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 8] + draw.normal(size=24) * 0.05], 0) for i in range(900)]
    assert run(spark, rows) == brute(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 6)], 0) for i in range(0, 900, 3)]
    assert run(spark, rows) == brute(rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (100, [0.0, 0.0], 0), (200, None, 0), (300, [nan, 1.0], 0), (400, [inf, 1.0], 0), (500, [None, 1.0], 0),
            (600, [], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0, 1.0], 0), (None, [1.0, 0.0], 0), (0, [1.0, 0.0], 0),
            (700, [1e30, 1.0], 0), (4, [1e-30, 0.0], 0)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0] or []) == []
    assert run(spark, [(100, [1.0], 0)]) == []


def test_quantisation_bounds_hold():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(200, 48)) * draw.lognormal(size=(200, 1), sigma=4)
    codes, scale, error = neighbours.quantised(x)
    assert codes.dtype == np.int8
    assert np.allclose(np.linalg.norm(x - codes * scale[:, None], axis=1), error)
    wide = draw.integers(-127, 128, (3, 2500)).astype(np.int8)
    assert (neighbours._product(wide, wide) == wide.astype(np.int64) @ wide.astype(np.int64).T).all()
