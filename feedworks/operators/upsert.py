"""Keep-first loading (K2-K5, Q1, Q10).

``INSERT .. ON CONFLICT (pk) DO NOTHING`` means: of all rows carrying a key, the
first one wins, and a key already in the target is never overwritten.

"First" is made deterministic by an explicit order (an ingest-order column), or by
all remaining columns when none is given.  The winner per key is found with
``min(struct(order..., payload...))`` in a grouped aggregate: partial aggregation
runs before the shuffle, so a key that holds a third of the input reaches the
reducer as one row per map task, not as one giant sorted window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def keep_first(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per key: the smallest by ``order`` (ascending, nulls first), ties broken
    by the remaining columns.  Column order of ``df`` is preserved."""
    keys = _as_list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    order = [c for c in _as_list(order or []) if c in others]
    packed = order + [c for c in others if c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*packed)).alias("_first"))
    return best.select(*[F.col(k) for k in keys], *[F.col(f"_first.{c}").alias(c) for c in others]) \
        .select(*df.columns)


def new_rows(new: DataFrame, existing: DataFrame, keys, order=None) -> DataFrame:
    """K2: the rows of ``new`` a keep-first load would insert into ``existing``."""
    keys = _as_list(keys)
    return without(keep_first(new, keys, order), existing, keys)


def without(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The ``rows`` whose keys ``existing`` does not hold.  Only the keys of ``existing`` are read;
    where it is bucketed by them (:func:`write_index`) they don't move either."""
    return rows.join(existing.select(*keys), keys, "left_anti")


def keep_first_append(new: DataFrame, existing: DataFrame, keys, order=None) -> DataFrame:
    """K2 / K3: the target after the load (existing rows untouched, new keys added)."""
    return existing.unionByName(new_rows(new, existing, keys, order).select(*existing.columns))


def dedup_pairs(edges: DataFrame, cols) -> DataFrame:
    """K4 / Q10: unique pair rule on an edge list (hash aggregate, partial before shuffle)."""
    return edges.dropDuplicates(_as_list(cols))


def append_pairs(new_edges: DataFrame, existing: DataFrame, cols) -> DataFrame:
    """K4: edges a unique-pair load would add to ``existing``."""
    cols = _as_list(cols)
    return without(dedup_pairs(new_edges, cols), existing, cols)


def write_index(df: DataFrame, table: str, keys, buckets: int, path: str | None = None, mode: str = "append") -> None:
    """K2 / K4 on a large target: its keys in a catalog table bucketed by them.  A load then asks
    ``without(rows, spark.table(table), keys)``: the new rows are dealt out to the buckets, and
    what earlier loads have written stays where it is."""
    keys = _as_list(keys)
    writer = df.select(*keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
