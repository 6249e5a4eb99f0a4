"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines,
distributed connected components.

Equal vectors are one class.  Two vectors at an angle share one sign with probability
1 - angle / pi; enough tables are taken that a pair right at the threshold meets in
none of them with probability ``miss`` at most.

Short sketches meet in the tables first: whole numbers near 127 times the first coordinates of
the unit vector in a random orthonormal base.  Distances of sketches can't be much above those
of the vectors, so who has no sketch near enough in any table has no link.  Only the others'
vectors are sent to the tables.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buckets import hot_buckets, pair_tiles, runs, whole_runs
from .common import ship, stored
from .graph import components
from .simhash import _spanning
from .vectors import blob, finite, matrix

#: Coordinates of a sketch, one byte each.
SKETCH = 32
KEYS = ["dim", "tab", "sig", "block"]


def table_shape(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """Signs per key and number of tables: about 64 vectors a bucket if they lay evenly."""
    bits = max(8, min(24, math.ceil(math.log2(max(n, 1) / 64 + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-meet)))


def scaled(column) -> np.ndarray:
    """Vectors as doubles, each times a power of two (exact) so that its squares don't overflow."""
    x = matrix(column)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def signatures(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Keys of the rows of ``x`` (from ``scaled``) in all tables (int32).  Planes and vectors are
    rounded to whole numbers whose sums are exact, so a vector's keys don't depend on its batch."""
    dim = x.shape[1]
    planes = np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))
    planes = np.clip(np.rint(np.ldexp(planes, 12)), -2**15, 2**15)
    whole = np.rint(np.ldexp(x, 37 - math.ceil(math.log2(dim))))
    signs = (whole @ planes > 0).reshape(len(x), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(2).astype(np.int32)


def sketches(x: np.ndarray, seed: int) -> np.ndarray:
    dim = x.shape[1]
    base = np.linalg.qr(np.random.default_rng([seed, dim, 1]).standard_normal((dim, min(dim, SKETCH))))[0]
    return np.rint(127 * (x / np.sqrt((x * x).sum(1, keepdims=True))) @ base).astype(np.int8)


def reach(threshold: float) -> float:
    """Largest squared distance of sketches of vectors with a cosine of ``threshold`` or more:
    both ends of each coordinate may be off by a half."""
    return (127 * math.sqrt(max(0.0, 2 - 2 * threshold)) + math.sqrt(SKETCH) + 0.01) ** 2


def link_classes(classes: DataFrame, threshold: float = 0.95, miss: float = 1e-6, chunk: int = 512,
                 seed: int = 5) -> DataFrame:
    """From (``node`` long, ``vec`` array, ``copies`` long): rows (a, b, n).  With b null, n
    is a part of the number of vectors linked to class a, itself left out; else (a, b)
    is a link of two classes.  Each pair is counted in the first table where it meets."""
    bits, tables = table_shape(classes.count(), threshold, miss)
    kind = np.float32 if classes.schema["vec"].dataType.elementType == T.FloatType() else np.float64

    def keys(batches):
        for batch in batches:
            if not len(batch):
                continue
            dims = batch["vec"].map(len).to_numpy()
            for d in np.unique(dims):
                part = batch[dims == d]
                x = scaled(part["vec"])
                yield d, part, x, signatures(x, bits, tables, seed)

    def buckets(batches):
        for d, _, _, sig in keys(batches):
            yield pd.DataFrame({"dim": d, "tab": np.repeat(np.arange(tables), len(sig)), "sig": sig.T.ravel()})

    sizes = (classes.mapInPandas(buckets, "dim int, tab int, sig int").groupBy("dim", "tab", "sig")
             .agg(F.count(F.lit(1)).alias("n")))
    hot = {(r["dim"], r["tab"], r["sig"]): -(-r["n"] // chunk) for r in hot_buckets(sizes, chunk)}
    held = ship(classes.sparkSession).sparkContext.broadcast(hot)  # hot_buckets bounds it

    def entries(batches, rest):
        """Entries of the tables.  role: 1 index, 2 probe, 3 both; a hot bucket of k pieces
        becomes k x k blocks.  ``rest``: the further columns of rows ``row``."""
        for d, part, x, sig in keys(batches):
            node, more = part["node"].to_numpy(), rest(part, x)
            cut = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            for t in range(tables):
                k = np.array([held.value.get((d, t, s), 1) for s in sig[:, t].tolist()])
                row, block, role = [np.flatnonzero(k == 1)], [np.zeros((k == 1).sum(), np.int64)], [np.full((k == 1).sum(), 3)]
                for i in np.flatnonzero(k > 1):
                    own, others = int(cut[i] % np.uint64(k[i])), np.arange(k[i])
                    mixed = others != own
                    row.append(np.full(2 * k[i] - 1, i))
                    block.append(np.concatenate([own * k[i] + others[mixed], others[mixed] * k[i] + own, [own * k[i] + own]]))
                    role.append(np.repeat([1, 2, 3], [k[i] - 1, k[i] - 1, 1]))
                row = np.concatenate(row)
                yield pd.DataFrame({"dim": d, "tab": t, "sig": sig[row, t], "block": np.concatenate(block), "node": node[row],
                                    "role": np.concatenate(role), **{c: v[row] for c, v in more.items()}})

    def each(rows) -> np.ndarray:
        return np.array([blob(r) for r in rows], object)

    def short(batches):
        return entries(batches, lambda part, x: {"sketch": each(sketches(x, seed))})

    def whole(batches):
        return entries(batches, lambda part, x: {"copies": part["copies"].to_numpy(), "vec": each(matrix(part["vec"]).astype(kind))})

    def tiles(batches):
        """Of the entries of one length: dimension, rows, and the pairs that meet, in tiles."""
        for batch in whole_runs(batches, KEYS):
            for d, part in batch.groupby("dim", sort=False):
                bounds, role = runs([part[c].to_numpy() for c in KEYS]), part["role"].to_numpy()
                yield d, part, pair_tiles(bounds, np.flatnonzero(role & 2), np.flatnonzero(role & 1), 1 << 16)

    def meet(batches):
        most = reach(threshold)
        for d, part, pairs in tiles(batches):
            node = part["node"].to_numpy()
            y = np.frombuffer(b"".join(part["sketch"]), np.int8).reshape(len(part), -1).astype(np.float32)  # sums stay exact
            near = np.zeros(len(part), bool)
            for i, j in pairs:
                once = node[i] > node[j]
                i, j = i[once], j[once]
                apart = y[i] - y[j]
                close = np.einsum("ij,ij->i", apart, apart) <= most
                near[i[close]] = near[j[close]] = True
            yield pd.DataFrame({"node": np.unique(node[near])})

    def verify(batches):
        for d, part, pairs in tiles(batches):
            tab, node, copies = (part[c].to_numpy() for c in ("tab", "node", "copies"))
            x = scaled(np.frombuffer(b"".join(part["vec"]), kind).reshape(len(part), d))
            size = np.sqrt(np.einsum("ij,ij->i", x, x))
            links, found = np.zeros(len(part), np.int64), []
            for i, j in pairs:
                once = node[i] > node[j]
                i, j = i[once], j[once]
                near = np.einsum("ij,ij->i", x[i], x[j]) / (size[i] * size[j]) >= threshold
                i, j = i[near], j[near]
                if not len(i):
                    continue
                some, at = np.unique(np.concatenate([i, j]), return_inverse=True)
                sig = signatures(x[some], bits, tables, seed)
                first = np.argmax(sig[at[:len(i)]] == sig[at[len(i):]], axis=1) == tab[i]
                i, j = i[first], j[first]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                found.append((i, j))
                if sum(len(f[0]) for f in found) > 1 << 18:
                    found = [_spanning(found, node)]
            if found:
                a, b = _spanning(found, node)
                yield pd.DataFrame({"a": node[a], "b": node[b], "n": 0})
            some = np.flatnonzero(links)
            if len(some):
                yield pd.DataFrame({"a": node[some], "b": pd.array([None] * len(some), "Int64"), "n": links[some]})

    def tabled(rows: DataFrame, fill, more: str) -> DataFrame:
        return (rows.mapInPandas(fill, f"dim int, tab int, sig int, block long, node long, role int, {more}")
                .repartition(*KEYS).sortWithinPartitions(*KEYS))

    met = stored(tabled(classes.select("node", "vec"), short, "sketch binary").mapInPandas(meet, "node long").distinct(), "vec-met")
    return (tabled(classes.join(met, "node", "left_semi"), whole, "copies long, vec binary")
            .mapInPandas(verify, "a long, b long, n long"))


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                 miss: float = 1e-6, chunk: int = 512) -> DataFrame:
    """vec_id, n_links, component_id, kept (op6's contract) of each row.

    Null, empty and zero vectors, and those with a null or non-finite component, link with
    nothing; vectors of different lengths don't link.  Every row is a vector of its own,
    so repeated rows link with each other.  Rows with a null id link like others; their
    component is the smallest id that they reach, or null, and they are not kept.  An empty
    table gives no rows; other columns are not read.
    """
    ship(vectors.sparkSession)
    single = vectors.schema[vec_col].dataType.elementType == T.FloatType()
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    nonzero = F.exists("vec", lambda v: v != 0)
    rows = stored(rows.withColumn("vec", F.when(finite("vec") & F.coalesce(nonzero, F.lit(False)), F.col("vec")))
                  .withColumn("h", F.when(F.col("vec").isNotNull(), F.xxhash64("vec"))), "vec-rows")
    classes = rows.where("vec IS NOT NULL").groupBy("h", "vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vec-classes")
    found = stored(link_classes(classes.select("node", "vec", "copies"), threshold, miss, chunk), "vec-links")
    comp = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    table = (classes.join(counts, "node", "left").join(comp, "node", "left")
             .select("h", "vec", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component")))
    table = stored(table, "vec-table")
    low = stored(table.groupBy("component").agg(F.min("least").alias("component_id")), "vec-low")
    named = stored(table.join(low, "component").select("h", "vec", "n_links", "component_id"), "vec-named")
    # a class once on the right, maybe a third of all rows on the left: a plain join that can be split
    linked = rows.where("vec IS NOT NULL").join(named, ["h", "vec"]).select("id", "n_links", "component_id")
    alone = rows.where("vec IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
