"""Exact top-k by inner product: ball-tree branch and bound per shard of the candidates.

A node's inner products with a query are at most q . centre + |q| * radius.  First every
shard looks into the leaf with the highest bound; the k-th best score of all shards
together is then shared, and each shard searches on with it, nodes in the order of
their bounds, dropping those that can't reach the current k-th score.

The queries go to the trees: a task builds the tree of its shard once and streams the blocks
of queries through it.  Where there are fewer shards than shuffles have partitions, a shard
has several lanes, each with its own copy of the tree and its own part of the blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ship, stored
from .vectors import blob, finite, matrix

LONG = 2**63 - 1
KINDS = (np.int16, np.int32, np.float64)


def narrow(a: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of ``KINDS`` that holds them all, which the first byte names."""
    top = np.abs(a).max(initial=0.0)
    kind = next(i for i, t in enumerate(KINDS) if t is np.float64 or top <= np.iinfo(t).max)
    return bytes([kind]) + blob(a.astype(KINDS[kind]))


def wide(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, KINDS[data[0]], offset=1).reshape(-1, dim).astype(np.float64)


class BallTree:
    """Points in the order of the leaves; nodes by breadth, children of node i at kids[i]."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = 64):
        order, todo, at = np.arange(len(ids)), [(0, len(ids))], 0
        spans, kids = [], []
        while at < len(todo):
            lo, hi = todo[at]
            at += 1
            spans.append((lo, hi))
            own = order[lo:hi]
            p = points[own]
            if hi - lo <= leaf:
                kids.append(-1)
                continue
            a = p[np.argmax(((p - p.mean(0)) ** 2).sum(1))]
            b = p[np.argmax(((p - a) ** 2).sum(1))]
            order[lo:hi] = own[np.argsort(p @ (b - a), kind="stable")]  # equal points split by count
            kids.append(len(todo))
            todo += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
        self.spans, self.kids = np.array(spans), np.array(kids)
        self.ids, self.points = ids[order], points[order]
        self.centres = np.stack([self.points[lo:hi].mean(0) for lo, hi in spans])
        self.radii = np.array([np.sqrt(((self.points[lo:hi] - c) ** 2).sum(1).max())
                               for (lo, hi), c in zip(spans, self.centres)])
        self.lengths = np.sqrt((self.centres ** 2).sum(1))

    def bounds(self, q: np.ndarray, size: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Upper bounds of row i of ``q`` in node[i], with room for rounding."""
        c = np.einsum("ij,ij->i", q, self.centres[node])
        spread = size * (self.lengths[node] + self.radii[node])
        return c + size * self.radii[node] + 1e-9 * spread + 1e-9


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integers held as doubles; Python integers where doubles would round."""
    top = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * q.shape[1]
    if top < 2.0 ** 53:
        return q @ x.T
    whole = [[int(v) for v in row] for row in x]
    return np.array([[sum(int(a) * b for a, b in zip(row, y)) for y in whole] for row in q], object).reshape(len(q), len(x))


def best_rows(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the k best scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def search(tree: BallTree, qid: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, greedy: bool):
    """Best k (ids, scores) of each query in the tree that are not below ``floor``; empty
    places have score minus infinity.  ``greedy``: only the leaf with the highest bound."""
    n, none = len(q), np.iinfo(np.int64).max
    ids, scores = np.full((n, k), none), np.full((n, k), -np.inf)
    floor, size = floor.copy(), np.sqrt((q * q).sum(1))
    exact = np.abs(q).max(initial=0.0) * np.abs(tree.points).max(initial=0.0) * q.shape[1] < 2.0 ** 53
    if not exact:
        scores = scores.astype(object)
    # all nodes that may matter, by query
    row, node = np.arange(n), np.zeros(n, np.int64)
    leaf_row, leaf_node, leaf_bound = [], [], []
    while len(row):
        bound = tree.bounds(q[row], size[row], node)
        open_ = bound >= floor[row]
        row, node, bound = row[open_], node[open_], bound[open_]
        leaf = tree.kids[node] < 0
        leaf_row.append(row[leaf])
        leaf_node.append(node[leaf])
        leaf_bound.append(bound[leaf])
        kids = tree.kids[node[~leaf]]
        row, node = np.repeat(row[~leaf], 2), np.stack([kids, kids + 1], 1).ravel()
    row, node, bound = map(np.concatenate, (leaf_row, leaf_node, leaf_bound))
    order = np.lexsort((-bound, row))
    row, node, bound = row[order], node[order], bound[order]
    first = np.searchsorted(row, np.arange(n + 1))
    step = 0
    live = np.flatnonzero(first[1:] > first[:-1])
    while len(live):
        at = first[live] + step
        reach = bound[at] >= floor[live]  # in the order of bounds: where one falls short, so do all after it
        live, at = live[reach], at[reach]
        for leaf in np.unique(node[at]):
            who = live[node[at] == leaf]
            lo, hi = tree.spans[leaf]
            s = products(q[who], tree.points[lo:hi])
            if not exact:
                s = s.astype(object)
            cand = np.broadcast_to(tree.ids[lo:hi], s.shape)
            s = np.where(cand == qid[who][:, None], -np.inf, s)
            ids[who], scores[who] = best_rows(np.hstack([ids[who], cand]), np.hstack([scores[who], s]), k)
            floor[who] = np.maximum(floor[who], scores[who, k - 1].astype(float) * (1 if exact else 1 - 1e-9) - (0 if exact else 1))
        if greedy:
            break
        step += 1
        live = live[first[live] + step < first[live + 1]]
    return ids, scores


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vec_col: str = "embedding", shard_rows: int = 4096, query_rows: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score (op4's contract): for each row with ``is_query`` the k other
    rows with the highest inner products of floor(scale * component).

    Ties go to the smaller id; fewer than k candidates give fewer rows.  Null or empty
    vectors, those with a null or non-finite component, and rows with a null id take no
    part; vectors meet only vectors of their own length; a row repeated whole counts once.
    Scores beyond the range of long are held at its ends.  An empty table gives no rows;
    other columns are read only by ``is_query``.
    """
    spark = ship(vectors.sparkSession)
    ok = F.col(id_col).isNotNull() & finite(vec_col)
    rows = vectors.where(ok).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("q")).dropDuplicates(["id", "v"])
    rows = stored(rows, "top-rows")
    n, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // query_rows))
    place = F.xxhash64("id", F.size("v"))

    def whole(column) -> np.ndarray:
        return np.floor(matrix(column) * scale)

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        return pd.DataFrame({"dim": [key[0]], "part": [key[1]], "ids": [blob(pdf["id"].to_numpy(np.int64))],
                             "points": [narrow(whole(pdf["v"]))]})

    keyed = rows.select("*", F.size("v").alias("dim"))

    def blobs(part: DataFrame, number: int, name: str, column: str) -> DataFrame:
        return stored(part.select("dim", F.pmod(place, F.lit(number)).alias("part"), "id", "v").groupBy("dim", "part")
                      .applyInPandas(gather, "dim int, part long, ids binary, points binary"), name).withColumnRenamed("part", column)

    trees, queries = blobs(keyed, shards, "top-trees", "shard"), blobs(keyed.where("q"), blocks, "top-queries", "block")
    lanes = min(blocks, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def meet(asked_blocks: DataFrame) -> DataFrame:
        # the stated query set against all shards, block by block; a tree comes before its blocks
        own = trees.select("dim", "shard", numbers(lanes).alias("lane"), F.lit(-1).cast("long").alias("block"), "ids", "points",
                           F.lit(None).cast("binary").alias("floors"))
        each = asked_blocks.select("dim", numbers(shards).alias("shard"), (F.col("block") % lanes).alias("lane"), "block", "ids",
                                   "points", "floors")
        return (own.unionByName(each).repartition("dim", "shard", "lane")
                .sortWithinPartitions("dim", "shard", "lane", "block"))

    def run(with_floor: bool):
        def searched(batches):
            tree, built = None, None
            for batch in batches:
                for r in batch.itertuples():
                    ids, points = np.frombuffer(r.ids, np.int64), wide(r.points, r.dim)
                    if r.block < 0:
                        tree, built = BallTree(ids, points), (r.dim, r.shard)
                        continue
                    if built != (r.dim, r.shard):
                        continue  # no vector of this length in the shard
                    floor = np.frombuffer(r.floors) if with_floor else np.full(len(ids), -np.inf)
                    near, scores = search(tree, ids, points, floor, k, not with_floor)
                    i, j = np.nonzero(scores != -np.inf)
                    # where an id stands for several vectors, its queries stay apart by their place
                    yield pd.DataFrame({"dim": r.dim, "block": r.block, "place": i, "query_id": ids[i], "vec_id": near[i, j],
                                        "score": [max(-LONG - 1, min(LONG, int(s))) for s in scores[i, j]]})
        return searched

    schema = "dim int, block long, place int, query_id long, vec_id long, score long"
    best = W.partitionBy("dim", "block", "place").orderBy(F.desc("score"), "vec_id")
    seen = stored(meet(queries.withColumn("floors", F.lit(None).cast("binary"))).mapInPandas(run(False), schema), "top-first")
    kth = (seen.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("dim", "block", "place", "score"))

    def floors(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in left.itertuples():
            floor = np.full(len(r.ids) // 8, -np.inf)
            floor[right["place"].to_numpy()] = right["score"].to_numpy()
            out.append((r.dim, r.block, r.ids, r.points, blob(floor - np.abs(floor) * 1e-15)))
        return pd.DataFrame(out, columns=["dim", "block", "ids", "points", "floors"])

    shared = stored(queries.groupBy("dim", "block").cogroup(kth.groupBy("dim", "block"))
                    .applyInPandas(floors, "dim int, block long, ids binary, points binary, floors binary"), "top-floors")
    found = meet(shared).mapInPandas(run(True), schema)
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
