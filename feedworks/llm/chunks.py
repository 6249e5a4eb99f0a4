"""Substring dedup by content-defined chunks.

A gear hash rolls over the last 16 bytes; where its upper bits are zero a chunk ends, so
an insertion moves the borders next to it and no others.  Chunks with equal digests
are one chunk.  The first document that holds it keeps it, others lose it where enough of
them follow each other, or where a short text is an exact copy.  Digests meet in shards,
ranges of them; each block of texts sends its distinct ones with their number, and learns
which occur again and who was first.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .blocks import by_shard, gathered, shard_of, spread, squeeze
from .common import stored

#: Values of the gear hash by byte; any fixed ones will do.
_GEAR = np.random.default_rng(271828).integers(0, 1 << 16, 256, dtype=np.uint16)
WINDOW = 16
#: Stands for a null id: after all others.
LAST = np.iinfo(np.int64).max


def gear(b: np.ndarray) -> np.ndarray:
    """At each byte the hash of the 16 bytes up to it: h = 2 h + gear[byte], modulo 2**16."""
    h, span = _GEAR[b], 1
    while span < WINDOW:
        h[span:] += h[:-span] << np.uint16(span) if len(h) > span else 0
        span *= 2
    return h


def cuts(b: np.ndarray, least: int, bits: int, most: int) -> list[int]:
    """Ends of the chunks of one text: after a byte where the upper ``bits`` of the hash are
    zero, chunks having from ``least`` (16 or more) to ``most`` bytes; the last may have fewer."""
    if least < WINDOW:
        raise ValueError("chunks must be as long as the hash's window")
    n, out, at = len(b), [], 0
    ends = (np.flatnonzero(gear(b.copy()) >> np.uint16(16 - bits) == 0) + 1).tolist() if n else []
    while at < n:
        k = bisect_left(ends, at + least)
        at = min(ends[k] if k < len(ends) else n, at + most, n)
        out.append(at)
    return out


def _doc_chunks(b: np.ndarray, offsets: np.ndarray, least: int, bits: int, most: int):
    """Per text: its offset, the ends of its chunks and their digests."""
    view = memoryview(b)
    for k in range(len(offsets) - 1):
        lo, hi = int(offsets[k]), int(offsets[k + 1])
        ends = cuts(b[lo:hi], least, bits, most)
        yield lo, ends, [hashlib.blake2b(view[lo + i:lo + j], digest_size=16).digest() for i, j in zip([0, *ends], ends)]


def _whole(text: bytes) -> bytes:
    """Digest of a whole text, never that of a chunk."""
    return hashlib.blake2b(text, digest_size=16, person=b"text").digest()


def _group_starts(rows: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted rows of two columns."""
    if not len(rows):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))


def dedup_chunks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 16, bits: int = 4,
                 most: int = 512, min_run: int = 180, min_words: int | None = None, whole_texts: bool = False,
                 with_kept: bool = False, block_bytes: int = 8 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """Per row: doc_id, n_bytes, n_chunks, n_shared, n_removed, n_spans, kept_sha256; with
    ``with_kept`` also the remaining bytes and the removed spans.

    A run of chunks that each occur again, in this text or another, counts if it has
    ``min_run`` bytes or more, or ``min_words`` words or more (cut ones too); n_shared is the
    number of bytes in such runs.  Of these a chunk is removed if a document with a smaller id
    holds it, or an earlier place of this one.  With ``whole_texts``, a text of under
    ``min_run`` bytes that occurs again whole is shared, and removed if a document with a
    smaller id is equal to it.  n_removed counts the bytes removed, n_spans the maximal runs of them.

    An id stands for one document: a row repeated whole repeats no text, and rows with a
    null id come after all others and take themselves for one document.  Null texts are
    empty; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    packed = blocks.pack(docs, "cdc-blocks", id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    total = packed.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def asked(r) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct digests of a block in the order (shard, digest), their number and least id."""
        b, offsets = blocks.unpack(r.lens, r.texts)
        every, ids = [], []
        for i, (lo, ends, digests) in zip(r.ids, _doc_chunks(b, offsets, least, bits, most)):
            if whole_texts and 0 < (ends[-1] if ends else 0) < min_run:
                digests = [*digests, _whole(b[lo:lo + ends[-1]].tobytes())]
            every += digests
            ids.append((LAST if i is None else int(i), len(digests)))
        halves = np.frombuffer(b"".join(every), np.uint64).reshape(-1, 2)
        owner = np.repeat(np.array([i for i, _ in ids], np.int64), [n for _, n in ids])
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        at = _group_starts(halves[order])
        if not len(at):
            return halves, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = np.diff(np.concatenate([at, [len(order)]]))
        keys = halves[order][at]
        return keys, n, np.minimum.reduceat(owner[order], at), shard_of(keys[:, 0], shards)

    def ask(batches):
        for batch in batches:
            for r in batch.itertuples():
                keys, n, first, shard = asked(r)
                rows = [(r.block, s, keys[at].tobytes(), squeeze(n[at].astype(np.int32)), squeeze(first[at])) for s, at in by_shard(shard)]
                yield pd.DataFrame(rows, columns=["block", "shard", "digests", "n", "first"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        """For each digest asked: 0 if it occurs once, else 1; then the first ids of the latter."""
        keys = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in pdf["digests"]]
        both = np.concatenate(keys)
        order = np.lexsort((both[:, 1], both[:, 0]))
        at = _group_starts(both[order])
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(at)), np.diff(np.concatenate([at, [len(order)]])))
        total = np.bincount(group, np.concatenate([spread(x, np.int32) for x in pdf["n"]]))
        first = np.minimum.reduceat(np.concatenate([spread(x) for x in pdf["first"]])[order], at)
        out = []
        for own in np.split(group, np.cumsum([len(k) for k in keys])[:-1]):
            again = total[own] >= 2
            out.append(squeeze(np.concatenate([again.astype(np.int64), first[own][again]])))
        return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "counts": out})

    answers = stored(packed.select("block", "ids", "lens", "texts")
                     .mapInPandas(ask, "block long, shard long, digests binary, n binary, first binary")
                     .groupBy("shard").applyInPandas(meet, "block long, shard long, counts binary"), "cdc-answers")
    todo = gathered(answers, "again", "cdc-again")

    def repeated(r) -> dict[bytes, int | None]:
        """First ids by digest of the block's chunks that occur again."""
        keys, _, _, shard = asked(r)
        given = {p["shard"]: spread(p["counts"]) for p in r.again} if r.again is not None else {}
        out: dict[bytes, int | None] = {}
        for s, at in by_shard(shard):
            n = at.stop - at.start
            again = given[s][:n] > 0
            firsts = given[s][n:].tolist()
            out.update(zip(map(bytes, np.ascontiguousarray(keys[at][again]).view("V16").ravel()),
                           [None if f == LAST else f for f in firsts]))
        return out

    def removed(batches):
        for batch in batches:
            for r in batch.itertuples():
                b, offsets = blocks.unpack(r.lens, r.texts)
                first = repeated(r)
                out = []
                for i, (lo, ends, digests) in zip(r.ids, _doc_chunks(b, offsets, least, bits, most)):
                    i = None if i is None else int(i)
                    n, shared, gone, k, met = (ends[-1] if ends else 0), 0, [], 0, set()
                    while k < len(ends):
                        j = k
                        while j < len(ends) and digests[j] in first:
                            j += 1
                        begin, stop = ends[k - 1] if k else 0, ends[j - 1] if j else 0
                        counts = j > k and (stop - begin >= min_run or min_words is not None and
                                            len(b[lo + begin:lo + stop].tobytes().split()) >= min_words)
                        if counts:
                            shared += stop - begin
                        for m in range(k, max(j, k + 1)):
                            if counts and (first[digests[m]] != i or digests[m] in met):
                                if gone and gone[-1][1] == (ends[m - 1] if m else 0):
                                    gone[-1][1] = ends[m]
                                else:
                                    gone.append([ends[m - 1] if m else 0, ends[m]])
                            met.add(digests[m])
                        k = max(j, k + 1)
                    if whole_texts and 0 < n < min_run and (key := _whole(b[lo:lo + n].tobytes())) in first:
                        shared, gone = n, gone if first[key] == i else [[0, n]]
                    at, kept = 0, []
                    for p, q in gone:
                        kept.append(b[lo + at:lo + p].tobytes())
                        at = q
                    kept = b"".join([*kept, b[lo + at:lo + n].tobytes()])
                    row = (None if i is None else str(i), n, len(ends), shared, n - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
                    out.append((*row, kept, gone) if with_kept else row)
                yield pd.DataFrame(out, columns=["id", "n_bytes", "n_chunks", "n_shared", "n_removed", "n_spans", "kept_sha256",
                                                 *(["kept", "spans"] if with_kept else [])])

    schema = "id string, n_bytes long, n_chunks long, n_shared long, n_removed long, n_spans long, kept_sha256 string" + \
        ", kept binary, spans array<array<long>>" * with_kept
    return (packed.join(todo, "block", "left").select("ids", "lens", "texts", "again").mapInPandas(removed, schema)
            .select(F.col("id").cast("long").alias(id_col), "n_bytes", "n_chunks", "n_shared", "n_removed", "n_spans", "kept_sha256",
                    *(["kept", "spans"] if with_kept else [])))


#: Of the registered query: a passage of over 50 words counts when its cut has lost both edges,
#: a line of 13 words doesn't.
PASSAGES = {"min_words": 16, "whole_texts": True}
