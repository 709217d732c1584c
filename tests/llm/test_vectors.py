from __future__ import annotations

import math

import numpy as np
import pytest

from tests.conftest import SMALL
from tripmart.llm import neighbours
from tripmart.llm.tables import read

SCHEMA = "vec_id long, embedding array<float>, shard string, id int"


def brute(rows, every, k):
    """Nearest rows of each query by plain loops; rows are (id, vector)."""
    out = []
    queries = {}
    for i, v in rows:
        if i % every == 0 and (i not in queries or v < queries[i]):
            queries[i] = v
    for q, v in queries.items():
        scored = []
        for i, w in rows:
            if i != q and len(w) == len(v):
                a, b = np.array(v, np.float64), np.array(w, np.float64)
                scored.append((-float((a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum()))), i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_exact_with_factor_one(spark):
    df = read(spark, SMALL, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    out = sorted(map(tuple, neighbours.nearest_of(df, 10, 5).collect()))
    expected = brute(rows, 10, 5)
    assert [x[:3] for x in out] == [x[:3] for x in expected]
    assert [x[3] for x in out] == pytest.approx([x[3] for x in expected], abs=1e-12)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [1.0, 1.0]), (5, [1.0, 1.0]),
        (6, [1.0, 2.0, 3.0]), (8, [3.0, 2.0, 1.0]), (10, [-1.0, 0.5]), (10, [-2.0, 0.5]),
    ]
    bad = [(11, None), (12, [0.0, 0.0]), (13, [nan, 1.0]), (14, [inf, 1.0]), (15, [None, 1.0]), (None, [1.0, 1.0]), (16, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], SCHEMA)
    out = sorted(map(tuple, neighbours.nearest_of(df, 2, 3).collect()))
    expected = brute(rows, 2, 3)
    assert [x[:3] for x in out] == [x[:3] for x in expected]
    assert neighbours.nearest_of(df.limit(0), 2, 3).count() == 0
    with pytest.raises(ValueError):
        neighbours.search(df, df, factor=0.5)


def test_many_ties_and_relaxed_search():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 16)).astype(np.float32)
    vectors[500:1500] = vectors[0]
    ids = rng.permutation(3000)
    tree = neighbours.VantageTree(ids, vectors)
    again = neighbours.VantageTree.from_bytes(tree.to_bytes(), 16)
    queries, names = vectors[::100].astype(np.float64), ids[::100]
    exact, score = again.search(names, queries, 5, 1.0)
    for q, name, found in zip(queries, names, exact):
        cosine = neighbours.cosines(q, vectors.astype(np.float64))
        cosine[ids == name] = -9
        assert (ids[np.lexsort((ids, -cosine))[:5]] == found).all()
    relaxed, _ = tree.search(names, queries, 5, 1.5)
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(exact, relaxed)]) >= 0.9


def test_tiny_and_huge_vectors(spark):
    rows = [(0, [1e-200, 2e-200]), (1, [1e-200, 1e-200]), (2, [1e200, 3e200]), (3, [5e-324, 0.0]), (4, [-1e308, 1e308]), (5, [1.0, 2.0]), (6, [1e-200, 1e200])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA.replace("float", "double"))
    out = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in neighbours.nearest_of(df, 50, 6).collect()}
    from fractions import Fraction

    def cosine(a, b):
        a, b = [Fraction(x) for x in a], [Fraction(x) for x in b]
        a, b = ([x / max(abs(y) for y in v) for x in v] for v in (a, b))
        return float(sum(x * y for x, y in zip(a, b))) / math.sqrt(float(sum(x * x for x in a) * sum(x * x for x in b)))

    expected = sorted(((-cosine(rows[0][1], v), i) for i, v in rows[1:]))
    assert [out[0, k][0] for k in range(1, 7)] == [i for _, i in expected]
    assert [out[0, k][1] for k in range(1, 7)] == pytest.approx([-s for s, _ in expected], abs=1e-15)
