"""SimHash near-duplicates by the generalised pigeonhole principle.

64-bit fingerprints of word shingles are cut into partitions of correlated bits.  Each
fingerprint allots the distance over the partitions so that the thresholds sum to
(distance - partitions + 1); dynamic programming picks the allotment with the fewest
estimated candidates.  Probes within a partition's threshold meet the index entries of
all fingerprints, and full distances are verified (Qin et al., GPH).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buckets import hot_buckets, pair_tiles, runs, whole_runs
from .common import ship, stored
from .graph import components, local_roots


def simhash(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a text: a bit is set if over half of the shingles'
    XXH64 (seed 42) have it.  No words, or a null text: zero."""
    if not isinstance(text, str):
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII space and case only
    if not words:
        return 0
    ones, n = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, 1 << 16):  # a piece of a very long text at a time
        h = np.fromiter((digest(join(words[i:i + shingle]), 42) for i in range(at, min(n, at + (1 << 16)))),
                        np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in range(64) if 2 * ones[i] > n)


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(s: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in s], np.uint64).view(np.int64))

    return of(text)


def correlated_parts(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Cut the bits into groups of even size, each grown from the bit that is left with the
    strongest tie, adding the bit most correlated with the group.  together: how
    often two bits are both set among n fingerprints."""
    p = np.diag(together) / max(n, 1)
    dev = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(dev, dev))
    np.fill_diagonal(tie, 0.0)
    left, groups = list(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda i: (tie[i, left].max(initial=0.0), -i))] if left else []
        left.remove(group[0])
        while len(group) < size:
            group.append(best := max(left, key=lambda i: (tie[i, group].sum(), -i)))
            left.remove(best)
        groups.append(sorted(group))
    return groups


def part_values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of unsigned fingerprints, gathered into a number."""
    out = np.zeros(len(fp), np.int64)
    for k, bit in enumerate(bits):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def flips(bits: int, most: int) -> list[np.ndarray]:
    """Masks with 0, 1, ..., most of the bits set, by their number."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(bits), k)], np.int64)
            for k in range(most + 1)]


def allot(values: list[np.ndarray], widths: list[int], hot: list[tuple[np.ndarray, np.ndarray]],
          n: int, distance: int) -> np.ndarray:
    """Thresholds (rows x partitions) from -1 up that sum to distance - partitions + 1, with
    the least estimated cost.  A threshold costs one for each signature probed and one
    for each candidate: an even share of n for each signature, plus the known sizes of
    the hot values at distance 0 and 1."""
    parts, most = len(values), distance + 1
    cost = np.zeros((parts, most + 1, len(values[0])))
    for i, (v, w) in enumerate(zip(values, widths)):
        hv, hn = hot[i]

        def known(x):
            if not len(hv):
                return np.zeros(len(x))
            at = np.minimum(np.searchsorted(hv, x), len(hv) - 1)
            return np.where(hv[at] == x, hn[at], 0.0)

        total = np.zeros(len(v))
        for t, masks in enumerate(flips(w, min(distance, 2))):
            total += len(masks) * (1.0 + n / 2.0 ** w)
            if t < 2:
                for m in masks:
                    total += known(v ^ m)
            cost[i, t + 1] = total
        for t in range(3, distance + 1):
            cost[i, t + 1] = cost[i, t] * w
    best = np.full((most + 1, len(values[0])), np.inf)
    best[0], pick = 0.0, []
    for i in range(parts):  # units = threshold + 1; the units of all partitions sum to distance + 1
        new, chosen = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for units in range(most + 1):
            for own in range(units + 1):
                c = best[units - own] + cost[i, own]
                better = c < new[units]
                new[units][better], chosen[units][better] = c[better], own
        best = new
        pick.append(chosen)
    out, units, rows = np.zeros((len(values[0]), parts), np.int64), np.full(len(values[0]), most), np.arange(len(values[0]))
    for i in reversed(range(parts)):
        own = pick[i][units, rows].astype(np.int64)
        out[:, i], units = own - 1, units - own
    return out


def link_fingerprints(classes: DataFrame, distance: int = 3, parts: int = 3, chunk: int = 1024) -> DataFrame:
    """Links (a, b) between ids of ``classes`` (``fp`` long, distinct; ``id`` long) whose
    fingerprints are connected through pairs at ``distance`` bits or fewer: enough
    links to connect what is connected, not every pair."""

    def bits_together(batches):
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            fp = batch["fp"].to_numpy().view(np.uint64)
            x = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
            total, n = total + x.T @ x, n + len(fp)
        if n:
            i, j = np.nonzero(total)
            yield pd.DataFrame({"i": [*i, 64], "j": [*j, 64], "c": [*total[i, j], n]})

    seen = classes.mapInPandas(bits_together, "i int, j int, c double").groupBy("i", "j").agg(F.sum("c").alias("c")).collect()
    together, n = np.zeros((64, 64)), 0
    for r in seen:  # 4097 sums at most
        if r["i"] == 64:
            n = int(r["c"])
        else:
            together[r["i"], r["j"]] = r["c"]
    groups = correlated_parts(together, n, parts)
    widths = [len(g) for g in groups]

    def values(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy().view(np.uint64)
            for i, g in enumerate(groups):
                yield pd.DataFrame({"part": i, "value": part_values(fp, g)})

    sizes = classes.mapInPandas(values, "part int, value long").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    large = hot_buckets(sizes, max(8, chunk // 16))
    hot = []
    for i in range(parts):
        own = sorted((r["value"], r["n"]) for r in large if r["part"] == i)
        hot.append((np.array([v for v, _ in own], np.int64), np.array([c for _, c in own], np.int64)))

    def pieces(i, v):
        hv, hn = hot[i]
        if not len(hv):
            return np.ones(len(v), np.int64)
        at = np.minimum(np.searchsorted(hv, v), len(hv) - 1)
        return np.where(hv[at] == v, -(-hn[at] // chunk), 1)

    def entries(batches):
        """An index entry for each partition; probes as far as the thresholds reach.  role:
        1 entry, 2 probe, 3 both.  A hot bucket of k pieces becomes k x k blocks."""
        for batch in batches:
            fps, ids = batch["fp"].to_numpy(), batch["id"].to_numpy()
            fp = fps.view(np.uint64)
            vals = [part_values(fp, g) for g in groups]
            reach = allot(vals, widths, hot, n, distance)
            own = (fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            for i in range(parts):
                todo = [(np.arange(len(fp)), vals[i], np.where(reach[:, i] >= 0, 3, 1))]
                for t, masks in enumerate(flips(widths[i], max(0, int(reach[:, i].max(initial=-1))))):
                    if t:
                        rows = np.flatnonzero(reach[:, i] >= t)
                        todo += [(rows, vals[i][rows] ^ m, np.full(len(rows), 2)) for m in masks]
                rows, v, role = (np.concatenate(x) for x in zip(*todo))
                k = pieces(i, v)
                plain = k == 1
                yield pd.DataFrame({"part": i, "value": v[plain], "block": 0, "fp": fps[rows[plain]],
                                    "id": ids[rows[plain]], "role": role[plain]})
                for pieces_ in np.unique(k[~plain]):
                    at = np.flatnonzero(k == pieces_)
                    piece = (own[rows[at]] % np.uint64(pieces_)).astype(np.int64)
                    for other in range(pieces_):
                        for bit, block in ((1, piece * pieces_ + other), (2, other * pieces_ + piece)):
                            has = (role[at] & bit) > 0
                            yield pd.DataFrame({"part": i, "value": v[at][has], "block": block[has],
                                                "fp": fps[rows[at][has]], "id": ids[rows[at][has]], "role": bit})

    def verify(batches):
        for batch in whole_runs(batches, ["part", "value", "block"]):
            bounds = runs([batch[c].to_numpy() for c in ("part", "value", "block")])
            role, fp, ids = batch["role"].to_numpy(), batch["fp"].to_numpy().view(np.uint64), batch["id"].to_numpy()
            probes, index = np.flatnonzero(role & 2), np.flatnonzero(role & 1)
            found = []
            for i, j in pair_tiles(bounds, probes, index):
                near = (np.bitwise_count(fp[i] ^ fp[j]) <= distance) & (ids[i] != ids[j])
                if near.any():
                    found.append((i[near], j[near]))
                if sum(len(x) for x, _ in found) > 1 << 20:
                    found = [_spanning(found, ids)]
            if found:
                a, b = _spanning(found, ids)
                yield pd.DataFrame({"a": ids[a], "b": ids[b]})

    spread = (classes.mapInPandas(entries, "part int, value long, block long, fp long, id long, role int")
              .repartition("part", "value", "block").sortWithinPartitions("part", "value", "block"))
    return spread.mapInPandas(verify, "a long, b long")


def _spanning(found, ids) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links between rows that connect the same ids."""
    a, b = (np.concatenate(x) for x in zip(*found))
    nodes, where, back = np.unique(ids[np.concatenate([a, b])], return_index=True, return_inverse=True)
    root = local_roots(back[:len(a)], back[len(a):], len(nodes))
    row = np.concatenate([a, b])[where]
    keep = root != np.arange(len(nodes))
    return row[keep], row[root[keep]]


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int, parts: int,
             chunk: int) -> tuple[DataFrame, DataFrame]:
    """(``id``, ``fp``) of all rows, and of each fingerprint ``fp``, ``least`` (its smallest id),
    ``component`` (the fingerprint that names its group) and ``component_id``."""
    ship(docs.sparkSession)
    fps = stored(docs.select(F.col(id_col).cast("long").alias("id"),
                             fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    classes = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    # a fingerprint is the node's name: rows without an id connect others as well
    links = stored(link_fingerprints(classes.select("fp", F.col("fp").alias("id")), distance, parts, chunk), "simhash-links")
    comp = components(links)
    member = stored(classes.join(comp, classes["fp"] == comp["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-members")
    low = stored(member.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-low")
    return fps, stored(member.join(low, "component"), "simhash-table")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3, parts: int = 3, chunk: int = 1024) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over fingerprints at ``distance`` bits
    or fewer.

    Null and empty texts have fingerprint zero and link like any other.  Rows with a
    null id get a fingerprint and the component of it, which is null where no row of
    it has an id.  Repeated rows appear as often as they do in ``docs``; an empty table
    gives no rows; other columns are not read.
    """
    fps, table = _classes(docs, id_col, text_col, shingle, distance, parts, chunk)
    # each class once on the right; copies of one text may be a third of the left: both are plain scans
    return (fps.join(table.select("fp", "component_id"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3,
             parts: int = 3, chunk: int = 1024) -> DataFrame:
    """The rows of ``docs``, all their columns, that stay when each group of near-duplicates
    keeps one: that of the smallest id (rows without an id stay only where no row of the
    group has one), of several rows of that id one with the smallest fingerprint."""
    _, table = _classes(docs, id_col, text_col, shingle, distance, parts, chunk)
    own = table.where("least <=> component_id").groupBy("component_id", "component").agg(F.min("fp").alias("__fp"))
    own = stored(own.select("__fp", F.col("component_id").alias("__keep")), "simhash-kept")
    rows = docs.select(F.struct("*").alias("__row"), F.col(id_col).cast("long").alias("__id"),
                       fingerprint(F.col(text_col), shingle).alias("__own"))
    # merge: the same plan whatever the size of the list; copies differ in their id, so no key is hot
    kept = rows.join(own.hint("merge"), (rows["__own"] == own["__fp"]) & rows["__id"].eqNullSafe(own["__keep"]), "left_semi")
    return kept.dropDuplicates(["__own", "__id"]).select("__row.*")
