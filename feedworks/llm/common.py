"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from feedworks.session import shared_path

WORD = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POW = np.ones(1, np.uint64)


_SHIPPED: set[str] = set()
#: Bytes of one Arrow batch to a Python worker: ten thousand long texts at once are too much.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Make the session ready for this package's Python workers: batches of ``BATCH_BYTES`` at
    most (one longer row is a batch of its own), and the package itself, sent once per
    application as ``--py-files`` does."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if sc.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="feedworks-py-"), "feedworks_py.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in sorted(os.walk(top)):
                for name in sorted(n for n in names if n.endswith(".py")):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.join(os.path.basename(top), os.path.relpath(file, top)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and
    a lost executor costs no recomputation of what came before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of text in one bucket: a scan by buckets can't be split.
BUCKET_BYTES = 64 << 20


def bucketed(df: DataFrame, name: str, by: str, volume: int = 0) -> DataFrame:
    """Like ``stored``, cut by a key into buckets: joins on the key need not move these rows.  As
    many as shuffles have partitions, or more where ``volume``, the bytes of text in them, asks
    for it.  The catalog is told of the table only until it is read; the files stay in the
    shared folder like all others."""
    spark = df.sparkSession
    table = f"feedworks_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // BUCKET_BYTES))
    df.write.bucketBy(n, by).option("path", shared_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising step of a 64-bit hash, element by element."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_bounds(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than 0x20 and 0x09 to 0x0D."""
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~_SPACE[b]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span that depends on its bytes alone: a polynomial
    over random values of the bytes, modulo 2**64, then mixed.  Spans must not overlap."""
    global _POW
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    longest = int(lens.max())
    if len(_POW) < longest:
        _POW = np.cumprod(np.full(longest, _ODD, np.uint64))
    power = _POW
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    within = np.arange(total) - np.repeat(first, lens)
    value = _BYTE[b[within + np.repeat(starts, lens)]] * power[within]
    h = np.add.reduceat(value, first)
    if longest > 1 << 20:
        _POW = _POW[: 1 << 20].copy()
    return mix64(h)


def pack_texts(texts) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, a newline after each, and the offsets of the texts."""
    raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    return np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8), offsets


def text_slices(texts, limit: int = 1 << 20):
    """Index ranges of consecutive texts of about ``limit`` characters each (a longer
    text is a range of its own)."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if isinstance(t, str) else 0
        if i > at and size + n > limit:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)
