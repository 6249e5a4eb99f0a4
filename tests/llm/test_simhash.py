import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedworks.llm import simhash
from feedworks.llm.graph import components, local_roots

SF001 = "/root/testdata/sf0.001"


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, near):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in near:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def test_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fp = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    near = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3]
    want = brute_components(list(fp), near)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fp[i]:016x}", want[i]) for i in fp}


def test_odd_rows(spark):
    long = "word " * 40000 + "end"
    data = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "One two", "x"), (5, "one\vTWO", "x"),
            (5, "one\vTWO", "x"), (None, "one two", "x"), (None, "lonely text here now", "x"),
            (8, long, "x"), (9, long, "x"), (10, "É é e", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id)
                 for r in simhash.near_duplicates(docs).collect())
    by = {}
    for i, f, c in got:
        by.setdefault(i, []).append((f, c))
    assert by[1] == by[2] == by[3] == [("0" * 16, 1)]
    assert by[4] == [(f"{brute_fingerprint('one two'):016x}", 4)] and by[5] == by[4] * 2
    assert sorted(by[-1], key=str) == sorted([by[4][0], (f"{brute_fingerprint('lonely text here now'):016x}", None)], key=str)
    assert by[8][0][1] == by[9][0][1] == 8
    assert by[10][0][0] == f"{brute_fingerprint('É é e'):016x}"
    empty = spark.createDataFrame([], docs.schema)
    assert simhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("parts,distance,chunk", [(3, 3, 1024), (4, 3, 16), (2, 3, 8), (3, 5, 64)])
def test_links_connect_what_is_near(spark, parts, distance, chunk):
    rng = np.random.default_rng(parts)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set()
    for b in base:  # groups of many near copies share most partition values
        for _ in range(12):
            f = int(b)
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                f ^= 1 << int(bit)
            fps.add(f)
    fps = sorted(fps)
    rows = [(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "fp long, id long")
    links = simhash.link_fingerprints(simhash.stored(df, "t"), distance, parts, chunk)
    got = {r.node: r.component for r in components(links).collect()}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= distance]
    want = brute_components(range(len(fps)), near)
    assert {i: got.get(i, i) for i in range(len(fps))} == want


def test_thresholds_sum_and_avoid_hot_values():
    v = [np.array([5, 9]), np.array([1, 2]), np.array([7, 7])]
    hot = [(np.array([5]), np.array([10**6])), (np.zeros(0, np.int64), np.zeros(0, np.int64)),
           (np.zeros(0, np.int64), np.zeros(0, np.int64))]
    t = simhash.allot(v, [21, 21, 22], hot, 1000, 3)
    assert (t.sum(1) == 3 - 3 + 1).all() and t[0, 0] == -1 and t[1, 0] >= 0


def test_bits_that_vary_together_share_a_partition():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (500, 64)).astype(float)
    x[:, 40] = x[:, 3]
    groups = simhash.correlated_parts(x.T @ x, 500, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any(3 in g and 40 in g for g in groups)


def test_components_of_a_path_a_hub_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(9, 9), (None, 3), (8, 7)]
    got = {r.node: r.component for r in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 700)}, 7: 7, 8: 7}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert local_roots(np.array([0, 3]), np.array([1, 1]), 4).tolist() == [0, 0, 2, 0]
