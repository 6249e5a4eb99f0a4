import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedworks.llm import balltree

SCHEMA = "vec_id long, embedding array<float>, label int"
HELD = lambda s: max(-2**63, min(2**63 - 1, s))


def brute(rows, is_query, k=5):
    good = {(i, tuple(math.floor(float(np.float32(x)) * 256) for x in e)) for i, e in rows
            if i is not None and e and all(x is not None and np.isfinite(np.float32(x)) for x in e)}
    out = []
    for i, q in good:
        if is_query(i):
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
            out += [(i, r + 1, j, HELD(-x)) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


def got(df, step=50, **args):
    return sorted(tuple(r) for r in balltree.top_k(df, F.col("vec_id") % step == 0, **args).collect())


def test_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("shard_rows,query_rows", [(4096, 512), (130, 20)])
def test_ties_and_odd_rows(spark, shard_rows, query_rows):
    rng = np.random.default_rng(shard_rows)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(700)]  # many equal vectors and scores
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(90)]
    rows += [(2000, None), (2005, []), (2010, [None, 1.0, 1.0, 1.0]), (2015, [float("nan")] * 4), (2020, [float("inf")] * 4),
             (None, [1.0] * 4), (2025, [1.0, 2.0]), (2030, [3.0, -1.0]), (5, [1.0] * 4), (5, [1.0] * 4), (2035, [7.0]),
             (2040, [2e5, 3e5, -1e5]), (2045, [1e5, 1e5, 1e30]), (2050, [3e20, 1.0, -1e30])]
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], SCHEMA)
    assert got(df, 5, shard_rows=shard_rows, query_rows=query_rows) == brute(rows, lambda i: i % 5 == 0)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_columns_that_clash_are_not_read(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(0, 200)]
    df = spark.createDataFrame([(a, b, 1, "x", 2.0) for a, b in rows], "vec_id long, embedding array<float>, rank int, query_id string, score double")
    assert got(df) == brute(rows, lambda i: i % 50 == 0)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    x = np.floor(rng.standard_normal((2000, 8)) * 50 + rng.integers(-3, 4, (2000, 1)) * 200)
    tree = balltree.BallTree(np.arange(2000), x)
    q = np.floor(rng.standard_normal((20, 8)) * 100)
    for n, (lo, hi) in enumerate(tree.spans):
        best = (q @ tree.points[lo:hi].T).max(1)
        assert (tree.bounds(q, np.sqrt((q * q).sum(1)), np.full(20, n)) >= best).all()
    ids, scores = balltree.search(tree, np.full(20, -1), q, np.full(20, -np.inf), 5, False)
    want = np.sort(q @ x.T, 1)[:, ::-1][:, :5]
    assert (scores == want).all()
