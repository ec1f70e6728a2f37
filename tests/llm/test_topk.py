import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwise.llm import topk


def brute(rows, k):
    clean = [(n, i, [int(np.floor(1024.0 * float(x))) for x in v]) for n, (i, v) in enumerate(rows)
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, q in clean:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, x)), j, m) for m, j, x in clean if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=10, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, row_id long, score string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=k, **options).collect())


def rounded(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


@pytest.mark.parametrize("options", [{}, {"candidate_rows": 64, "query_rows": 2, "pivots": 3}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(31)
    centres = rng.normal(size=(6, 12))
    rows = [(i, rounded(centres[i % 6] + 0.1 * rng.normal(size=12))) for i in range(900)]
    rows += [(1000 + i, rounded(centres[0])) for i in range(60)] + [(100, rounded(centres[1])), (100, rounded(centres[1]))]
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2100, [float("inf")] * 12), (None, rounded(centres[2])),
             (2200, rounded([0.0] * 12)), (2300, rounded([1.5, -2.0])), (2400, [])]
    assert run(spark, rows, **options) == brute(rows, 10)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (100, [0.5, -1.0]), (3, [0.25, 0.25])]
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e5, -2e5, 1e5]), (1, [2.5e5, 1e5, 3e5]), (2, [2.5e5, 1e5, 3.0001e5]), (3, [-1e5, 0.0, 7.0])]
    rows = [(i, rounded(v)) for i, v in rows]
    assert run(spark, rows) == brute(rows, 10)


def test_bounds_hold_and_eliminate():
    rng = np.random.default_rng(32)
    x = (1024 * rng.normal(size=(500, 8))).astype(np.int64)
    pivots = topk.choose_pivots(x, 64)
    assert len(pivots) == 64 and len(np.unique(pivots, axis=0)) == 64
    far = topk.distances(x, pivots)
    bound = np.abs(far[:, None, :] - far[None, :, :]).max(axis=2)
    assert (bound <= topk.distances(x, x) + 1e-3).all()


def test_scores_beyond_64_bits_are_refused(spark):
    rows = spark.createDataFrame([(0, [4e9, 4e9]), (1, [4e9, 4e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large for scores"):
        topk.top_k(rows, F.col("vec_id") == 0).collect()
    fine = spark.createDataFrame([(0, [1e6, 1e6]), (1, [1e6, -1e6]), (2, [1e6, 1e6])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in topk.top_k(fine, F.col("vec_id") == 0).collect()] == [(2, 2 * (1024 * 10 ** 6) ** 2), (1, 0)]
