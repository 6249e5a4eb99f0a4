"""Distributed connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of the nodes 0..n-1 over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _state(edges: DataFrame) -> tuple:
    # bit_xor of row hashes: no overflow under ANSI, order does not matter
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                  F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(r)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected links ``a``, ``b`` (longs).

    Returns (``node``, ``component``) for every node that has a link to another one;
    ``component`` is the smallest node of its component.  Links of a node to itself
    and null ends are ignored.  Both sides of every join are read from written tables,
    so that adaptive execution can split the partition of a hub node; minima are
    pre-aggregated before they are shuffled.
    """
    e = (edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stored(e, "cc-edges")
    before = _state(e)
    # tables of a round have at most two rows an edge: tasks by their number, not by the cluster's setting
    tasks = max(8, -(-before[0] // 200_000))
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                     .select("u", F.least("u", "m").alias("m")).coalesce(tasks), "cc-min")
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = stored(large.coalesce(tasks), "cc-large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "cc-min")
        small = (large.join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small.coalesce(tasks), "cc-small")
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
