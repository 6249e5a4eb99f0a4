import numpy as np
import pytest

from feedworks.llm import embed_dedup

from test_simhash import brute_components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    good = []
    for k, (i, e) in enumerate(rows):
        if e is not None and len(e) and all(x is not None and np.isfinite(np.float32(x)) for x in e) and any(e):
            good.append((k, np.array(e, np.float32).astype(float)))
    near = []
    for a, (k, x) in enumerate(good):
        for m, y in good[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                near.append((m, k))
    comp = brute_components(range(len(rows)), near)
    links = np.bincount(np.array(near, int).ravel(), minlength=len(rows)) if near else np.zeros(len(rows), int)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[comp[k]] = min(least.get(comp[k], i), i)
    return sorted(((i, int(links[k]), least.get(comp[k]), i is not None and i == least.get(comp[k]))
                   for k, (i, _) in enumerate(rows)), key=str)


def got(df, **args):
    return sorted((tuple(r) for r in embed_dedup.near_vectors(df, **args).collect()), key=str)


def test_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == brute(rows)


@pytest.mark.parametrize("chunk", [4, 512])
def test_groups_of_copies_and_odd_rows(spark, chunk):
    rng = np.random.default_rng(chunk)
    rows, i = [], 100
    for _ in range(6):
        c = rng.standard_normal(16)
        for _ in range(40):
            rows.append((i, [float(np.float32(v)) for v in c + rng.standard_normal(16) * 0.12]))
            i += 1
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [None] + [1.0] * 15), (5, [float("nan")] * 16), (6, [float("inf")] * 16),
             (7, [1.0] * 8), (8, [2.0] * 8), (9, [1.0] * 16), (9, [1.0] * 16), (None, [1.0] * 16), (None, [3.0] * 4), (10, [-1.0] * 16),
             (11, [1e30] * 16), (12, [1e-30] * 16)]
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], SCHEMA)
    assert got(df, chunk=chunk) == brute([(a, b) for a, b in rows])
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_columns_that_clash_are_not_read(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)]
    df = spark.createDataFrame([(a, b, 1, "x", True) for a, b in rows],
                               "vec_id long, embedding array<float>, n_links int, component_id string, kept boolean")
    assert got(df) == brute(rows)


def test_doubles_are_not_rounded(spark):
    x = [[1.0, 0.0], [1.0, 1e-9], [1.0, 2e-9], [0.0, 1.0]]
    x += [[1.0, 0.3286841051788632], [1.0, 0.3286841]]  # a cosine just under 0.95 with the first, and one just over
    rows = list(enumerate(x))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    size = [np.sqrt(np.dot(v, v)) for v in x]
    want = {i: sum(i != j and np.dot(v, w) / (size[i] * size[j]) >= 0.95 for j, w in rows) for i, v in rows}
    assert {r[0]: r[1] for r in embed_dedup.near_vectors(df).collect()} == want


@pytest.mark.parametrize("dim", [3, 40, 200])
@pytest.mark.parametrize("threshold", [0.5, 0.95, 1.0])
def test_sketches_of_near_vectors_are_near(dim, threshold):
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((3000, dim))
    y = x * rng.uniform(0.1, 9, (3000, 1)) + rng.standard_normal((3000, dim)) * rng.uniform(0, 1, (3000, 1)) * (threshold < 1)
    near = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)) >= threshold
    a, b = (embed_dedup.sketches(embed_dedup.scaled(list(v)), 5).astype(int) for v in (x, y))
    assert near.sum() > 500 and (((a - b) ** 2).sum(1)[near] <= embed_dedup.reach(threshold)).all()


def test_keys_do_not_depend_on_the_batch():
    x = embed_dedup.scaled(list(np.random.default_rng(2).standard_normal((500, 64))))
    keys = embed_dedup.signatures(x, 8, 25, 5)
    assert all((embed_dedup.signatures(x[i:i + n], 8, 25, 5) == keys[i:i + n]).all() for i in range(0, 480, 37) for n in (1, 3, 20))
