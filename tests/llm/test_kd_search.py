"""Exact top-k against all inner products."""

import math
import pickle

import numpy as np
import pytest

from plugsites.llm import kd_search
from plugsites.llm.kd_search import KDTree, exact_top_k, quantised

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute_force(rows, k, step, scale=64):
    usable = sorted(
        {
            (key, tuple(math.floor(scale * float(x)) for x in vector))
            for key, vector in rows
            if key is not None
            and vector is not None
            and all(x is not None and math.isfinite(x) for x in vector)
        }
    )
    out = []
    for own, query in usable:
        if own % step == 0:
            scored = [
                (-sum(a * b for a, b in zip(query, other)), key)
                for key, other in usable
                if key != own and len(other) == len(query)
            ]
            out += [(own, n, key, -s) for n, (s, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def run(spark, rows, k, step, **sizes):
    table = spark.createDataFrame([(key, v, 1) for key, v in rows], SCHEMA)
    vectors = quantised(table, 64)
    found = exact_top_k(vectors, vectors.where(f"vec_id % {step} = 0"), k, **sizes)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "leaf_rows": 4}])
def test_awkward_vectors(spark, sizes):
    draw = np.random.default_rng(4)
    rows = [(k, [float(x) for x in draw.normal(size=6).astype("f4")]) for k in range(150)]
    rows += [(200 + k, [0.5, -0.25, 0.125, 1.0, 0.0, 0.0]) for k in range(60)]  # ties
    rows += [(300, None), (301, [1.0, None] * 3), (302, [float("nan")] * 6), (None, [1.0] * 6)]
    rows += [(303, [float("inf")] * 6), (310, [1.0, 2.0]), (320, [3.0, 4.0]), (340, []), (305, [])]
    rows += [(0, rows[0][1]), (-20, [-1.0] * 6), (360, [3e5] * 6), (380, [-3e5] * 6)]
    assert run(spark, rows, 5, 20, **sizes) == brute_force(rows, 5, 20)


def test_fewer_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0])]
    assert run(spark, rows, 20, 20) == [(0, 1, 1, 64 * 64 * 4)]
    assert run(spark, [(1, [1.0])], 20, 20) == []
    assert run(spark, [], 20, 20) == []


def test_boxes_bound_their_points():
    draw = np.random.default_rng(5)
    points = draw.integers(-60, 60, (700, 8)).astype(float)
    tree = KDTree(points, 16)
    queries = draw.integers(-60, 60, (9, 8)).astype(float)
    bounds = tree.box_bounds(queries)
    for node, (first, last) in enumerate(tree.bounds):
        best = (points[tree.order[first:last]] @ queries.T).max(axis=0)
        assert (best <= bounds[:, node]).all()
    assert sorted(tree.order) == list(range(700))


def test_rounds_and_copies(spark, monkeypatch):
    monkeypatch.setattr(kd_search, "BOX_VALUES", 60)
    monkeypatch.setattr(kd_search, "QUERIES_PER_TASK", 2)
    monkeypatch.setattr(kd_search, "SAMPLE_ROWS", 50)
    draw = np.random.default_rng(8)
    rows = [(k, [float(x) for x in draw.normal(size=5)]) for k in range(200)]
    assert run(spark, rows, 4, 20, shard_rows=16, leaf_rows=4) == brute_force(rows, 4, 20)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, vector array<long>")


def test_every_vector_is_in_one_tree_of_bounded_size(spark):
    draw = np.random.default_rng(9)
    rows = [(k, [int(x) for x in draw.integers(-90, 90, 4)]) for k in range(600)]
    rows += [(1000 + k, [7, 7, 7, 7]) for k in range(500)]  # copies that no cut can part
    rows += [(2000 + k, [k, 1]) for k in range(30)]
    trees = kd_search.build_trees(vectors_of(spark, rows), shard_rows=50).collect()
    stored = [pickle.loads(row.tree) for row in trees]
    found = sorted((int(i), v.tolist()) for ids, points, *_ in stored for i, v in zip(ids, points))
    assert found == sorted(rows)
    assert max(len(ids) for ids, *_ in stored) < 4 * 50 and len(trees) < 80


def test_only_shards_whose_boxes_reach_the_kth_are_visited(spark):
    """Groups far apart: a query's own group has its best, and no other shard is asked."""
    draw = np.random.default_rng(10)
    rows = []
    for group in range(8):
        centre = np.array([1000 if group >> bit & 1 else -1000 for bit in range(3)])
        rows += [(100 * group + k, (centre + draw.integers(-9, 9, 3)).tolist()) for k in range(100)]
    vectors = vectors_of(spark, rows)
    trees = kd_search.build_trees(vectors, shard_rows=120)
    (boxes,) = kd_search._box_rounds(trees)
    asked = vectors.where("vec_id % 50 = 0").selectExpr(
        "vec_id", "vector", "2900000L AS kth", "CAST(NULL AS struct<region:bigint,part:int>) AS home"
    )
    visits = kd_search._visits(asked, boxes, False).groupBy("vec_id").count().collect()
    assert len(boxes) >= 8 and len(visits) == 16 and max(row["count"] for row in visits) <= 2


def test_null_vectors_take_no_part(spark):
    vectors = vectors_of(spark, [(0, [1, 2]), (1, None), (2, [3, 4]), (None, [5, 6])])
    found = exact_top_k(vectors, vectors.where("vec_id = 0 OR vec_id = 1"), 3).collect()
    assert [tuple(row) for row in found] == [(0, 1, 2, 11)]
