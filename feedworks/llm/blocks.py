"""Texts packed into blocks: the unit in which operators on whole texts read them again.

A block is one row: the ids of some documents, their lengths in bytes and their UTF-8
bytes, compressed.  The table is written once, so a block keeps its number, and rows
with null or repeated ids are told apart by their place in it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, ship, stored

SCHEMA = "ids array<string>, lens binary, texts binary, size long"


def pack_keys(rows: DataFrame, name: str, block_bytes: int) -> DataFrame:
    """(``block`` long, ``ids``, ``lens``, ``texts``, ``size``) of all rows (``key`` string,
    ``text``), blocks of about ``block_bytes`` or one longer text.  Null texts are empty.
    The table is cut into buckets by block: joining a block's answers to it moves no text."""
    ship(rows.sparkSession)

    def packed(batches):
        keys, raw, size = [], [], 0
        for batch in batches:
            for key, t in zip(batch["key"], batch["text"]):
                data = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
                if raw and size + len(data) > block_bytes:
                    yield row(keys, raw)
                    keys, raw, size = [], [], 0
                keys.append(key if isinstance(key, str) else None)
                raw.append(data)
                size += len(data)
        if raw:
            yield row(keys, raw)

    def row(keys, raw):
        lens = np.array([len(r) for r in raw], np.int64)
        return pd.DataFrame({"ids": [keys], "lens": [lens.tobytes()], "size": [int(lens.sum())],
                             "texts": [zstandard.ZstdCompressor(level=3).compress(b"".join(raw))]})

    out = rows.select("key", "text").mapInPandas(packed, SCHEMA).select(F.monotonically_increasing_id().alias("block"), "*")
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return bucketed(out, name, "block", volume)


def pack(docs: DataFrame, name: str, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """Blocks of all rows of ``docs``, the ids as text."""
    named = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text"))
    return pack_keys(named, name, block_bytes)


def unpack(lens: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a block end to end, and their offsets."""
    size = np.frombuffer(lens, np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = zstandard.ZstdDecompressor().decompress(texts, max_output_size=max(1, int(offsets[-1])))
    return np.frombuffer(data, np.uint8), offsets


def slices(offsets: np.ndarray, limit: int = 1 << 20):
    """Ranges of consecutive texts of about ``limit`` bytes; a longer text is one of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, stop
        at = stop


# Blocks and shards: a block asks each shard, a range of hashed keys, for what all blocks know of
# its own distinct keys, and gets the answers in the order in which it asked.
def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def spread(data: bytes, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def by_shard(shard: np.ndarray):
    """(shard, slice) of the runs of ascending shard numbers."""
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else [0]
    for lo, hi in zip(bounds, bounds[1:]):
        yield int(shard[lo]), slice(int(lo), int(hi))


def gathered(answers: DataFrame, column: str, name: str) -> DataFrame:
    """(``block``, ``column``): a block's answers (``shard``, ``counts``), one for each shard."""
    return stored(answers.groupBy("block").agg(F.collect_list(F.struct("shard", "counts")).alias(column)), name)
