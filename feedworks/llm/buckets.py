"""Meeting rows in keyed buckets: hot buckets are split into blocks, and every bucket is
streamed through its task, so that none has to fit one task's memory whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_buckets(sizes: DataFrame, chunk: int, limit: int = 4096) -> list:
    """Of a table (key columns..., ``n``) the ``limit`` largest buckets with over ``chunk``
    rows.  A bucket that is not among them holds less than 1/limit of all rows."""
    return sizes.where(F.col("n") > chunk).orderBy(F.desc("n"), *[c for c in sizes.columns if c != "n"]) \
        .limit(limit).collect()


def runs(keys: list[np.ndarray]) -> np.ndarray:
    """Bounds of the runs of equal keys in sorted key columns: 0, ..., number of rows."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n - 1, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]])


def whole_runs(batches, key_names: list[str]) -> Iterator:
    """Pandas batches of sorted rows, recut so that no run of equal keys is parted."""
    import pandas as pd

    held = []
    for batch in batches:
        if not len(batch):
            continue
        keys = [batch[k].to_numpy() for k in key_names]
        cut = int(runs(keys)[-2])
        if held and cut == 0 and all(k[0] == held[-1][n].iloc[-1] for k, n in zip(keys, key_names)):
            held.append(batch)
            continue
        if held:
            if all(k[0] == held[-1][n].iloc[-1] for k, n in zip(keys, key_names)):
                yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
            else:
                yield pd.concat(held, ignore_index=True)
                if cut:
                    yield batch.iloc[:cut].reset_index(drop=True)
        elif cut:
            yield batch.iloc[:cut].reset_index(drop=True)
        held = [batch.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def pair_tiles(bounds: np.ndarray, left: np.ndarray, right: np.ndarray, most: int = 1 << 20):
    """Row pairs (i, j), i in ``left`` and j in ``right`` rows of the same run, in tiles of
    about ``most`` pairs.  left, right: ascending row numbers."""
    la, lb = np.searchsorted(left, bounds[:-1]), np.searchsorted(left, bounds[1:])
    ra, rb = np.searchsorted(right, bounds[:-1]), np.searchsorted(right, bounds[1:])
    nl, nr = lb - la, rb - ra
    busy = np.flatnonzero((nl > 0) & (nr > 0))
    size = nl[busy] * nr[busy]
    small = busy[size <= most]
    total = np.cumsum(nl[small] * nr[small])
    at = 0
    while at < len(small):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        part = small[at:stop]
        n = nl[part] * nr[part]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(nr[part], n)
        yield (left[np.repeat(la[part], n) + within // width], right[np.repeat(ra[part], n) + within % width])
        at = stop
    for r in busy[size > most]:
        rows, cols = left[la[r]:lb[r]], right[ra[r]:rb[r]]
        step = max(1, most // len(cols)) if len(cols) <= most else 1
        for i in range(0, len(rows), step):
            for j in range(0, len(cols), most):
                a, b = rows[i:i + step], cols[j:j + most]
                yield np.repeat(a, len(b)), np.tile(b, len(a))
