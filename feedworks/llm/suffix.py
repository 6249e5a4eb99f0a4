"""Removal of repeated byte strings with per-shard suffix arrays.

Every window of ``length`` bytes is filed under its anchor, the least of the hashes of its
byte grams, so equal windows meet under one anchor.  Consecutive windows with one
anchor make a segment.  Anchors that occur once are done with.  Of the others each
distinct segment goes once, with the number of its occurrences, to the shard of its
anchor; there a suffix array is refined by prefix doubling (Larsson and Sadakane), and
suffixes that share ``length`` bytes are one string.  An anchor with more segments than an
array should hold is filed again, its windows by the bytes that neighbouring ones have in
common.  Shards are cut by content, so no string lies in two of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import _BYTE, _ODD, _SPACE, mix64, span_hashes, stored

_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
GRAM = 96
#: Words of a gram that a window of words is filed by.
WORD_GRAM = 12
#: Text of one suffix array, about; each byte of it takes some 100 bytes while the array is built.
PIECE_BYTES = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, ..., base ** (n - 1) modulo 2**64; up to 4 million are kept."""
    known = _POWERS.get(base, np.ones(0, np.uint64))
    if len(known) < n:
        known = np.full(max(n, 1 << 20), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= 1 << 22:
            _POWERS[base] = known
    return known[:n]


def gram_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` values (bytes as random numbers, or hashes of words) from each place
    on; places with fewer left out."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_ODD, len(values)), out=total[1:])
    return mix64((total[size:] - total[:n]) * _powers(_INVERSE, n))


def span_digests(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of values, from ``first`` to before ``end``."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix64(values) * _powers(_ODD, len(values)), out=total[1:])
    size = (end - first).astype(np.uint64)
    return mix64((total[end] - total[first]) * _powers(_INVERSE, len(values) + 1)[first] + mix64(size)).view(np.int64)


def segments(values: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window's start, last window's start, anchor's start) of the segments of all texts.

    The anchor of a window is its gram with the least upper hash half, of several the
    last one: values of the window alone decide."""
    hashes = gram_hashes(values, gram)
    grams = length - gram + 1
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64))
    span = 1
    while 2 * span <= grams:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if grams > span:
        low = np.minimum(low[:len(low) - (grams - span)], low[grams - span:])
    at = (np.uint64(0xFFFFFFFF) - (low[:n] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    whole = np.zeros(n + 1, np.int8)  # windows inside one text
    size = np.diff(offsets)
    long = size >= length
    np.add.at(whole, offsets[:-1][long], 1)
    np.add.at(whole, offsets[1:][long] - length + 1, -1)
    inside = np.cumsum(whole[:n]) > 0
    start = np.flatnonzero(inside)
    if not len(start):
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    anchor = at[start]
    # the windows of two texts are never next to each other: a text's last places start none
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(start)]]) - 1
    return hashes[anchor[first]], start[first], start[last], anchor[first]


def _digest(data) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def block_segments(lens: bytes, texts: bytes, length: int, gram: int, only=None):
    """Bytes and offsets of a block, and per segment anchor, digest, first and last start; with
    ``only`` of the segments with these anchors alone."""
    b, offsets = blocks.unpack(lens, texts)
    out = []
    for lo, hi in blocks.slices(offsets, 1 << 17):
        at, end = int(offsets[lo]), int(offsets[hi])
        h, first, last, _ = segments(_BYTE[b[at:end]], offsets[lo:hi + 1] - at, length, gram)
        out.append((h.view(np.int64), first + at, last + at))
    h, first, last = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    if only is not None:
        some = np.isin(h, np.asarray(only, np.int64))
        h, first, last = h[some], first[some], last[some]
    view = memoryview(b)
    d = np.array([_digest(view[i:j + length]) for i, j in zip(first.tolist(), last.tolist())], np.int64)
    return b, offsets, h, d, first, last


def _refined(t: np.ndarray, depth: int, left: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Suffixes in the order of their first ``depth`` bytes (or word numbers) exactly, the rank of
    each by position, and the places and ranks of those that are tied.

    With ``left``, the number of values from each position to the end of its own text, only
    suffixes with ``depth`` values left are ranked to that depth: they never ask for a shorter one."""
    n = len(t)
    h = min(8, depth) if t.dtype == np.uint8 else 1
    key = t
    if t.dtype == np.uint8:
        padded = np.concatenate([t, np.zeros(16, np.uint8)])
        key = np.empty(n, np.uint64)
        for k in range(min(8, n)):
            part = key[k::8]
            part[:] = padded[k:k + 8 * len(part)].view(">u8")
        key >>= np.uint64(8 * (8 - h))
    order = np.argsort(key)
    k = key[order]
    head = np.concatenate([[True], k[1:] != k[:-1]])
    place = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    rank[order] = place
    # only the places of suffixes that are tied are gone through again
    todo = np.flatnonzero(~(head & np.append(head[1:], True)))
    group = place[todo]
    while h < depth and len(todo):
        step = min(h, depth - h)
        pos = order[todo]
        if left is None:
            after = np.where(pos + step < n, rank[np.minimum(pos + step, n - 1)] + 1, 0)
        else:
            whole = left[pos] >= h + step
            todo, group, pos = todo[whole], group[whole], pos[whole]
            if not len(todo):
                break
            after = rank[pos + step]
        # the groups are in order already, which a merging sort makes use of
        sub = np.argsort((group << 32) | after, kind="stable")
        pos, after = pos[sub], after[sub]
        order[todo] = pos
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        group = np.maximum.accumulate(np.where(fresh, todo, 0))
        rank[pos] = group
        tied = ~(fresh & np.append(fresh[1:], True))
        todo, group = todo[tied], group[tied]
        h += step
    return order, rank, todo, group


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` bytes (or word numbers)."""
    order, _, todo, group = _refined(t, depth)
    # what is still equal goes by position, so that the order is the same in every run
    pos = order[todo]
    order[todo] = pos[np.argsort((group << 32) | pos, kind="stable")]
    return order


def common_prefixes(t: np.ndarray, order: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Length, ``most`` at most, that each suffix shares with the one before it in ``order``.

    Kasai's scan: going on by one byte loses one byte of the common prefix at most.  It
    runs over all pieces of the text that begin at ``starts`` side by side.  ``order`` holds
    for a limited depth only, so it may put two suffixes one way round and what follows
    their first bytes the other; the scan then begins anew."""
    n = len(t)
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = np.arange(n), -1
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    at, end = starts.copy(), np.concatenate([starts[1:], [n]])
    h = np.zeros(len(starts), np.int64)
    while len(at):
        j = before[at]
        far = np.maximum(at, j) + h
        more = (j >= 0) & (far < n) & (h < most)
        more[more] = t[(at + h)[more]] == t[(j + h)[more]]
        done = ~more
        shared[at[done]] = h[done]
        goes_on = (j >= 0) & (rank[j + 1] >= 0) & (rank[j + 1] < rank[np.minimum(at + 1, n)])
        h = np.where(more, h + 1, np.where(goes_on, np.maximum(h - 1, 0), 0))
        at = at + done
        live = at < end
        if not live.all():
            at, end, h = at[live], end[live], h[live]
    return shared


def repeated_windows(contents: list, weights: np.ndarray, length: int) -> list[np.ndarray]:
    """Per content a mask of its windows that occur twice or more, content i being there
    weights[i] times."""
    sizes = np.array([len(c) for c in contents])
    if isinstance(contents[0], bytes):
        text = np.frombuffer(b"\xff".join(contents) + b"\xff", np.uint8)  # no byte of UTF-8
    else:  # numbers of words, and one that none of them has
        end = np.array([max((int(c.max(initial=0)) for c in contents)) + 1], np.int64)
        text = np.concatenate([x for c in contents for x in (c, end)])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(text))
    _, rank, _, _ = _refined(text, length, left)
    window = np.flatnonzero(left >= length)
    rank = rank[window]  # equal ranks: the same ``length`` values
    total = np.bincount(rank, np.repeat(weights, sizes + 1)[window])
    often = np.zeros(len(text), bool)
    often[window] = total[rank] >= 2
    return [often[s:s + n - length + 1] for s, n in zip(starts, sizes)]


def _runs(mask: np.ndarray) -> np.ndarray:
    """Bounds of the runs of True: start, end, start, end, ..."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))


def repeated_segments(packed: DataFrame, length: int, gram: int, variants: int) -> tuple[DataFrame, DataFrame]:
    """(``block``, ``h``, ``d``) of all segments, and (``h``, ``d``, ``spans``) of those with
    repeated windows, spans being the bounds of their runs (binary of longs).  Null spans: all
    windows are, as the segment occurs again as it is and is the only kind with its anchor."""

    def listed(batches):
        for batch in batches:
            for r in batch.itertuples():
                _, _, h, d, _, _ = block_segments(r.lens, r.texts, length, gram)
                both, n = np.unique(np.stack([h, d]), axis=1, return_counts=True) if len(h) else (np.zeros((2, 0)), [])
                yield pd.DataFrame({"block": r.block, "h": both[0], "d": both[1], "n": n})

    seen = stored(packed.select("block", "lens", "texts").mapInPandas(listed, "block long, h long, d long, n long"), "sa-seen")
    kinds = stored(seen.groupBy("h", "d").agg(F.sum("n").alias("n"), F.min("block").alias("block")), "sa-kinds")
    anchors = stored(kinds.groupBy("h").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("variants"))
                     .where("all >= 2").select("h", "variants"), "sa-anchors")
    whole = kinds.join(anchors.where("variants = 1"), "h").select("h", "d", F.lit(None).cast("binary").alias("spans"))
    wanted = kinds.join(anchors.where("variants > 1"), "h").groupBy("block").agg(
        F.collect_list(F.struct("h", "d", "n", "variants")).alias("wanted"))  # no more than the block's own

    def cut(batches):
        for batch in batches:
            for r in batch.itertuples():
                b, _, h, d, first, last = block_segments(r.lens, r.texts, length, gram, [w["h"] for w in r.wanted])
                where = dict(zip(zip(h.tolist(), d.tolist()), zip(first.tolist(), last.tolist())))
                rows = [(w["h"], w["d"], w["n"], w["variants"], b[i:j + length].tobytes())
                        for w in r.wanted for i, j in [where[w["h"], w["d"]]]]
                for k in range(0, len(rows), 4096):
                    yield pd.DataFrame(rows[k:k + 4096], columns=["h", "d", "n", "variants", "content"])

    found = stored(packed.join(stored(wanted, "sa-wanted"), "block").select("lens", "texts", "wanted")
                   .mapInPandas(cut, "h long, d long, n long, variants long, content binary"), "sa-contents")

    repeated = _repeated(found, "sa", _bytes_of, length, gram, variants)
    return seen.select("block", "h", "d"), repeated.unionByName(whole)


def _bytes_of(contents) -> tuple:
    """All values of some contents, where each content begins (and the last ends), the bytes of a
    run of values, and their digests."""
    raw = b"".join(contents)
    values = _BYTE[np.frombuffer(raw, np.uint8)]
    return (values, np.concatenate([[0], np.cumsum([len(c) for c in contents])]), lambda i, j: raw[i:j],
            lambda first, end: np.array([_digest(raw[i:j]) for i, j in zip(first.tolist(), end.tolist())], np.int64))


def _widths(span: int) -> list[int]:
    """Windows of a slot at each filing, of up to ``span`` with one anchor; in the end each is alone."""
    return [4 ** k for k in range(8, 0, -1) if 4 * 4 ** k <= span] + [1]


SLOTS = "h long, d long, n long, at long, windows long, h2 long, d2 long, content binary"


def _slots(values_of, length: int, gram: int, width: int):
    """Cuts segments into slots of up to ``width`` windows by the windows' places before their
    anchor, and files each slot (``h2``) by all that its windows have in common.

    Equal windows have the anchor at the same place, so they lie in slots of one key.  A
    segment has no more slots than its windows by ``width``, and one."""

    def cut(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo:lo + 256]
                values, begin, take, digests = values_of(list(part["content"]))
                _, first, last, anchor = segments(values, begin, length, gram)  # one of each content
                most, least = (anchor - first) // width, (anchor - last) // width
                many = most - least + 1
                i = np.repeat(np.arange(len(part)), many)
                slot = most[i] - (np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many))
                a = np.maximum(first[i], anchor[i] - slot * width - width + 1)
                z = np.minimum(last[i], anchor[i] - slot * width)
                core = gram_hashes(values, length - width + 1)[anchor[i] - slot * width]
                h = part["h"].to_numpy()[i]
                h2 = mix64(core + mix64(h.view(np.uint64) + mix64((slot * 4096 + width).astype(np.uint64))))
                yield pd.DataFrame({"h": h, "d": part["d"].to_numpy()[i], "n": part["n"].to_numpy()[i], "at": a - first[i], "windows": z - a + 1,
                                    "h2": h2.view(np.int64), "d2": digests(a, z + length),
                                    "content": [take(x, y) for x, y in zip(a.tolist(), (z + length).tolist())]})

    return cut


def _repeated(found: DataFrame, name: str, values_of, length: int, gram: int, variants: int) -> DataFrame:
    """(``h``, ``d``, ``spans``) of the segments ``found`` (``h``, ``d``, ``n``, ``variants``,
    ``content``) with repeated windows.  Anchors with over ``variants`` segments are filed by
    slots, and those slots again by narrower ones, until an array can hold what shares a key; a
    slot of one window has one kind a key."""

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "d"], kind="stable")
        contents = list(pdf["content"])
        if values_of is not _bytes_of:
            values, begin, _, _ = values_of(contents)
            contents = np.split(np.unique(values, return_inverse=True)[1], begin[1:-1])
        masks = repeated_windows(contents, pdf["n"].to_numpy(), length)
        spans = [_runs(m).tobytes() for m in masks]
        return pd.DataFrame({"h": pdf["h"].to_numpy(), "d": pdf["d"].to_numpy(), "spans": spans})[[len(s) > 0 for s in spans]]

    small, known, levels = [], [], []
    for width in [*_widths(length - gram + 1), 0]:
        hot = found.where(F.col("variants") > variants)
        if not width or hot.isEmpty():
            small.append(found)
            break
        small.append(found.where(F.col("variants") <= variants))
        slots = hot.mapInPandas(_slots(values_of, length, gram, width), SLOTS)
        slots = stored(slots.withColumn("row", F.monotonically_increasing_id()), f"{name}-slots")
        kinds = stored(slots.groupBy("h2", "d2").agg(F.sum("n").alias("n"), F.min("row").alias("row")), f"{name}-slot-kinds")
        keys = stored(kinds.groupBy("h2").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("variants"))
                      .where("all >= 2").select("h2", "variants"), f"{name}-slot-keys")
        one = kinds.join(keys.where("variants = 1"), "h2")
        known.append(one.select(F.col("h2").alias("h"), F.col("d2").alias("d"), F.lit(None).cast("binary").alias("spans")))
        levels.append(slots.select("h", "d", "at", "windows", "h2", "d2"))
        wanted = kinds.join(keys.where("variants > 1"), "h2").select("row", "n", "variants")
        found = stored(slots.drop("n").join(wanted, "row").select(F.col("h2").alias("h"), F.col("d2").alias("d"), "n", "variants", "content"), f"{name}-slot-contents")
    usual = small[0].select("h", "d", "n", "content")
    for other in small[1:]:
        usual = usual.unionByName(other.select("h", "d", "n", "content"))
    # equal windows share h, and so their piece
    shards = max(1, -(-(usual.agg(F.sum(F.length("content"))).first()[0] or 0) // PIECE_BYTES))
    out = stored(usual.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).groupBy("shard")
                 .applyInPandas(shard, "h long, d long, spans binary"), f"{name}-usual")
    below = out
    for slots, whole in zip(levels[::-1], known[::-1]):
        answers = below.unionByName(whole).select(F.col("h").alias("h2"), F.col("d").alias("d2"), "spans")
        below = stored(slots.join(answers, ["h2", "d2"]).groupBy("h", "d")  # one segment: no more rows than it has slots
                       .agg(F.sort_array(F.collect_list(F.struct("at", "windows", "spans"))).alias("slots"))
                       .mapInPandas(_joined, "h long, d long, spans binary"), f"{name}-hot").unionByName(out)
    return below


def _joined(batches):
    """Spans of segments from those of their slots, which lie end to end."""
    for batch in batches:
        spans = []
        for slots in batch["slots"]:
            mask = np.zeros(slots[-1]["at"] + slots[-1]["windows"], bool)
            for x in slots:
                bounds = [0, x["windows"]] if x["spans"] is None else np.frombuffer(x["spans"], np.int64).tolist()
                for lo, hi in zip(bounds[::2], bounds[1::2]):
                    mask[x["at"] + lo:x["at"] + hi] = True
            spans.append(_runs(mask).tobytes())
        yield pd.DataFrame({"h": batch["h"], "d": batch["d"], "spans": spans})


# ---------------------------------------------------------------- passages of words
def word_bounds(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, which lie end to end."""
    inside = ~_SPACE[b]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    border = offsets[(offsets > 0) & (offsets < len(b))]
    first[border] = inside[border]
    last[border - 1] = inside[border - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_segments(b: np.ndarray, offsets: np.ndarray, words: int, gram: int):
    """(anchor hash, digest, first word of the first window, first word of the last one), words
    being numbered through the block."""
    out, before = [], 0
    for lo, hi in blocks.slices(offsets, 1 << 19):
        at, end = int(offsets[lo]), int(offsets[hi])
        part, own = b[at:end], offsets[lo:hi + 1] - at
        starts, ends = word_bounds(part, own)
        values = span_hashes(part, starts, ends)
        h, first, last, _ = segments(values, np.searchsorted(starts, own), words, gram)
        d = span_digests(values, first, last + words)
        out.append((h.view(np.int64), d, first + before, last + before))
        before += len(starts)
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def _words_of(contents) -> tuple:
    """As ``_bytes_of``, of words: their hashes, and where each content's begin."""
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in contents])])
    raw = b"".join(contents)
    b = np.frombuffer(raw, np.uint8)
    starts, ends = word_bounds(b, offsets)
    values = span_hashes(b, starts, ends)
    return (values, np.searchsorted(starts, offsets), lambda i, j: raw[starts[i]:ends[j - 1]],
            lambda first, end: span_digests(values, first, end))


def repeated_passages(packed: DataFrame, words: int, gram: int, variants: int) -> DataFrame:
    """(``block``, ``firsts``, ``lasts``, ``passages``): arrays of the first and last windows of the
    segments with repeated windows of ``words`` words, and their spans as above, by the same anchors and suffix arrays as strings of bytes, over the
    numbers of the words.  White space between words is not compared."""

    def listed(batches):
        for batch in batches:
            for r in batch.itertuples():
                h, d, first, last = word_segments(*blocks.unpack(r.lens, r.texts), words, gram)
                yield pd.DataFrame({"block": r.block, "h": h, "d": d, "first": first.astype(np.int32), "last": last.astype(np.int32)})

    seen = stored(packed.select("block", "lens", "texts").mapInPandas(listed, "block long, h long, d long, first int, last int"), "sw-seen")
    kinds = stored(seen.groupBy("h", "d").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("block", "first", "last")]), "sw-kinds")
    anchors = stored(kinds.groupBy("h").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("variants"))
                     .where("all >= 2").select("h", "variants"), "sw-anchors")
    whole = kinds.join(anchors.where("variants = 1"), "h").select("h", "d", F.lit(None).cast("binary").alias("spans"))
    wanted = kinds.join(anchors.where("variants > 1"), "h").groupBy("block").agg(
        F.collect_list(F.struct("h", "d", "n", "variants", "first", "last")).alias("wanted"))

    def cut(batches):
        for batch in batches:
            for r in batch.itertuples():
                b, offsets = blocks.unpack(r.lens, r.texts)
                starts, ends = word_bounds(b, offsets)
                rows = [(w["h"], w["d"], w["n"], w["variants"], b[starts[w["first"]]:ends[w["last"] + words - 1]].tobytes()) for w in r.wanted]
                for k in range(0, len(rows), 4096):
                    yield pd.DataFrame(rows[k:k + 4096], columns=["h", "d", "n", "variants", "content"])

    found = stored(packed.join(stored(wanted, "sw-wanted"), "block").select("lens", "texts", "wanted")
                   .mapInPandas(cut, "h long, d long, n long, variants long, content binary"), "sw-contents")

    repeated = _repeated(found, "sw", _words_of, words, gram, variants).unionByName(whole)
    own = seen.join(repeated, ["h", "d"]).groupBy("block").agg(F.collect_list(F.struct("first", "last", "spans")).alias("p"))
    return stored(own.select("block", F.col("p.first").alias("firsts"), F.col("p.last").alias("lasts"), F.col("p.spans").alias("passages")), "sw-todo")


def covered(b: np.ndarray, offsets: np.ndarray, firsts, lasts, passages, words: int) -> np.ndarray:
    """Bytes of each text under repeated passages, from the begin of a first word to the end of
    a last one."""
    if not len(passages):
        return np.zeros(len(offsets) - 1, np.int64)
    starts, ends = word_bounds(b, offsets)
    runs = [np.array([0, z - a + 1]).tobytes() if p is None else p for a, z, p in zip(firsts.tolist(), lasts.tolist(), passages)]
    bounds = np.frombuffer(b"".join(runs), np.int64).reshape(-1, 2) + np.repeat(firsts, [len(p) // 16 for p in runs])[:, None]
    step = np.bincount(starts[bounds[:, 0]], minlength=len(b) + 1)
    step -= np.bincount(ends[bounds[:, 1] + words - 2], minlength=len(b) + 1)
    under = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    return under[offsets[1:]] - under[offsets[:-1]]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = GRAM,
                   variants: int = 2048, words: int = 51, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (op7's contract) and n_shared of each row;
    with ``with_kept`` also the remaining bytes and the removed spans (array of start, end).

    ``n_shared``: bytes under runs of ``words`` words (white space between them aside) that also
    begin anywhere else; such passages may be shorter than ``length`` and are told, not
    removed.  Words are told apart by 64-bit hashes.

    Null texts count as empty; texts shorter than ``length`` lose nothing; null and
    repeated ids keep a row for each row, and repeated rows repeat each other; an empty
    table gives no rows; other columns are not read.
    """
    if length < 2 or words < 2:
        raise ValueError("length and words must be 2 or more")
    gram = min(gram, length)
    packed = blocks.pack(docs, "sa-blocks", id_col=id_col, text_col=text_col)
    passages = repeated_passages(packed, words, min(WORD_GRAM, words), variants)
    seen, repeated = repeated_segments(packed, length, gram, variants)
    todo = stored(seen.join(repeated, ["h", "d"]).groupBy("block")
                  .agg(F.collect_list(F.struct("h", "d", "spans")).alias("repeats")), "sa-todo")

    def removed(batches):
        for batch in batches:
            for r in batch.itertuples():
                repeats = r.repeats if r.repeats is not None else []
                b, offsets, h, d, first, last = block_segments(r.lens, r.texts, length, gram, [x["h"] for x in repeats])
                spans = {(x["h"], x["d"]): x["spans"] if x["spans"] is None else np.frombuffer(x["spans"], np.int64).tolist() for x in repeats}
                ends = set(offsets.tolist())  # a run that ends with its text does not go on in the next
                gone: list[list[int]] = []  # maximal removed runs; windows come in the order of their starts
                for key, at, to in zip(zip(h.tolist(), d.tolist()), first.tolist(), last.tolist()):
                    runs = spans.get(key, ())
                    runs = iter((0, to - at + 1) if runs is None else runs)
                    for lo, hi in zip(runs, runs):
                        start, end = at + lo, at + hi - 1 + length
                        if gone and start <= gone[-1][1] and start not in ends:
                            gone[-1][1] = max(end, gone[-1][1])
                        else:
                            gone.append([start, end])
                out, view, k = [], memoryview(b), 0
                shared = covered(b, offsets, *((r.firsts, r.lasts, r.passages) if r.passages is not None else ((), (), ())), words).tolist()
                for i, lo, hi, under in zip(r.ids, offsets[:-1].tolist(), offsets[1:].tolist(), shared):
                    kept, at, own = [], lo, []  # views: the bytes are copied once
                    while k < len(gone) and gone[k][0] < hi:
                        kept.append(view[at:gone[k][0]])
                        own.append([gone[k][0] - lo, gone[k][1] - lo])
                        at, k = gone[k][1], k + 1
                    kept = b"".join([*kept, view[at:hi]])
                    row = (i, hi - lo, hi - lo - len(kept), len(own), hashlib.sha256(kept).hexdigest(), under)
                    out.append((*row, kept, own) if with_kept else row)
                yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared",
                                                 *(["kept", "spans"] if with_kept else [])])

    schema = "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long" + \
        ", kept binary, spans array<array<long>>" * with_kept
    return (packed.join(todo, "block", "left").join(passages, "block", "left").select("ids", "lens", "texts", "repeats", "firsts", "lasts", "passages")
            .mapInPandas(removed, schema)
            .select(F.col("id").cast("long").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared",
                    *(["kept", "spans"] if with_kept else [])))
