"""SentencePiece encoding and decoding with a table of distinct chunks.

A chunk is a marked word: a run of white space markers and what follows up to the next
one.  Where no piece of the model holds a marker behind another character, no merge can
cross the border of two chunks, so a text's ids are those of its chunks end to end.  Each
block of texts lists its distinct chunks; each chunk goes to the shard of its hash and
is segmented there once, whatever the number of texts and blocks that hold it; a block
gets the ids back in the order in which it asked, and joins them by position.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import OrderedDict
from itertools import accumulate

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import stored

MARKER = "▁"
_CHUNK = re.compile(" +[^ ]*")
_BORDER = re.compile("[^ ] ")
#: Characters of a long text that are cut into chunks at once.
PART = 1 << 20


def check_model(model: bytes) -> None:
    """Raise unless the model's pieces stay within marked words: no marker behind another
    character, a marker put in front of each text, and no other change of the text."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if MARKER in piece.lstrip(MARKER):
            raise ValueError(f"piece {i} crosses a white space marker: chunks can't be segmented alone")
    probe = " \tﬁ Ａ  x\r\n "
    if sp.normalize(probe) != MARKER + probe.replace(" ", MARKER):
        raise ValueError("the model changes its texts: chunks can't be cut from them as they are")


def chunks_of(text: str):
    """Lists of the chunks of a text, each without its first marker; long texts in parts."""
    text = text.replace(MARKER, " ")
    at, n = 0, len(text)
    while n - at > PART:
        border = _BORDER.search(text, at + PART)
        if border is None:
            break
        yield _cut(text[at:border.start() + 1])
        at = border.end()
    if n:
        yield _cut(text[at:])


def _cut(text: str) -> list[str]:
    if "  " in text or text[:1] in ("", " ") or text[-1:] == " ":
        return [c[1:] for c in _CHUNK.findall(" " + text)]
    return text.split(" ")


class Pieces:
    """Segmentation of single chunks."""

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.lone = [self.sp.piece_to_id(MARKER)]
        # a model without such an id has -1 there, and the library then adds none
        self.first, self.last = [np.array([i] * (i >= 0), "<u4").tobytes() for i in (self.sp.bos_id(), self.sp.eos_id())]

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk."""
        out = self.sp.encode(chunks, num_threads=1)
        return [ids if c else self.lone for c, ids in zip(chunks, out)]

    def spell(self, ids: list[list[int]]) -> list[str]:
        """Decoded texts of the ids of single chunks, each without its first space: at the
        begin of a text the decoder drops it, elsewhere it stays."""
        return self.sp.decode(ids, num_threads=1) if ids else []


_LOADED: OrderedDict[str, Pieces] = OrderedDict()


def pieces(model: bytes) -> Pieces:
    """The segmenter of a model's content; a worker process keeps the last two."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
        while len(_LOADED) > 2:
            _LOADED.popitem(last=False)
    return _LOADED[key]


def _texts(r):
    """(id, text) of a block's rows."""
    data, offsets = blocks.unpack(r.lens, r.texts)
    view = memoryview(data)
    for i, (lo, hi) in zip(r.ids, zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        yield i, str(view[lo:hi], "utf-8", "surrogatepass")


def _asked(r, shards: int) -> tuple[list[str], np.ndarray]:
    """The distinct chunks of a block by (shard, chunk), and their shards."""
    seen: set[str] = set()
    for _, text in _texts(r):
        for part in chunks_of(text):
            seen.update(part)
    chunks = sorted(seen)
    shard = np.array([zlib.crc32(c.encode("utf-8", "surrogatepass")) for c in chunks], np.uint64) * np.uint64(shards) >> np.uint64(32)
    order = np.argsort(shard, kind="stable")
    return [chunks[i] for i in order.tolist()], shard[order].astype(np.int64)


def _joined(parts: list[bytes]) -> tuple[bytes, bytes]:
    return blocks.squeeze(np.array([len(p) for p in parts], np.uint32)), blocks.squeeze(np.frombuffer(b"".join(parts), np.uint8))


def _parted(lens: bytes, data: bytes) -> list[bytes]:
    size, raw = blocks.spread(lens, np.uint32).tolist(), blocks.spread(data, np.uint8).tobytes()
    ends = list(accumulate(size, initial=0))
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def encode_pieces(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
                  block_bytes: int = 16 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """Per row of ``docs``: ``id_col``, n_tokens (begin and end counted), ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded text), as the
    library encodes and decodes whole texts without sampling; with ``with_ids`` also
    ``ids`` (array of int) and ``decoded`` (string).

    Null and empty texts have the begin and end ids alone; null and repeated ids keep a
    row for each row; an empty table gives no rows; other columns are not read.  A text
    without spaces is one chunk, however long.  The model file is read once and sent to
    the workers; a model whose pieces cross white space markers is an error.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = f.read()
    check_model(model)
    content = spark.sparkContext.broadcast(model)
    packed = blocks.pack(docs, "sp-blocks", id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    total = packed.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def ask(batches):
        for batch in batches:
            for r in batch.itertuples():
                chunks, shard = _asked(r, shards)
                rows = [(r.block, s, *_joined([c.encode("utf-8", "surrogatepass") for c in chunks[at]]))
                        for s, at in blocks.by_shard(shard)]
                yield pd.DataFrame(rows, columns=["block", "shard", "lens", "chunks"])

    def segment(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pieces(content.value)
        asked = [_parted(a, b) for a, b in zip(pdf["lens"], pdf["chunks"])]
        at: dict[bytes, int] = {}
        where = [np.array([at.setdefault(c, len(at)) for c in part], np.int64) for part in asked]
        chunks = [c.decode("utf-8", "surrogatepass") for c in at]
        ids = own.segment(chunks)
        # null where decoding gives the chunk back, as it mostly does
        decoded = [None if d == c else d.encode("utf-8", "surrogatepass") for c, d in zip(chunks, own.spell(ids))]
        flat = np.fromiter((i for x in ids for i in x), np.uint32)
        ends = np.cumsum([0, *map(len, ids)])
        rows = []
        for block, shard, w in zip(pdf["block"], pdf["shard"], where):
            size = ends[w + 1] - ends[w]
            first = np.cumsum(size) - size
            own_ids = flat[np.arange(int(size.sum())) - np.repeat(first, size) + np.repeat(ends[w], size)]
            odd = [(k, decoded[i]) for k, i in enumerate(w.tolist()) if decoded[i] is not None]
            rows.append((block, shard, blocks.squeeze(size.astype(np.uint32)), blocks.squeeze(own_ids),
                         [k for k, _ in odd], [d for _, d in odd]))
        return pd.DataFrame(rows, columns=["block", "shard", "lens", "ids", "odd", "decoded"])

    answers = stored(packed.select("block", "ids", "lens", "texts")
                     .mapInPandas(ask, "block long, shard long, lens binary, chunks binary")
                     .groupBy("shard").applyInPandas(segment, "block long, shard long, lens binary, ids binary, odd array<long>, "
                                                              "decoded array<binary>"), "sp-answers")
    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "lens", "ids", "odd", "decoded")).alias("answers"))

    def join(batches):
        own = pieces(content.value)
        for batch in batches:
            for r in batch.itertuples():
                chunks, _ = _asked(r, shards)
                answers = sorted(r.answers, key=lambda a: a["shard"]) if r.answers is not None else []
                ids, spelled, at = {}, {}, 0
                for a in answers:
                    size = blocks.spread(a["lens"], np.uint32).astype(np.int64) * 4
                    raw, ends = blocks.spread(a["ids"], np.uint8).tobytes(), [0, *np.cumsum(size).tolist()]
                    part = chunks[at:at + len(size)]
                    ids.update(zip(part, (raw[x:y] for x, y in zip(ends, ends[1:]))))
                    spelled.update((part[k], bytes(d).decode("utf-8", "surrogatepass")) for k, d in zip(a["odd"], a["decoded"]))
                    at += len(size)
                out = []
                for i, text in _texts(r):
                    parts = [own.first]
                    digest, begun = hashlib.sha256(), False
                    kept = []
                    for part in chunks_of(text):
                        parts.append(b"".join(map(ids.__getitem__, part)))
                        if spelled:
                            part = [spelled.get(c, c) for c in part]
                        words = " ".join(part)
                        digest.update((" " + words if begun else words).encode("utf-8", "surrogatepass"))
                        begun = True
                        if with_ids:
                            kept.append(words)
                    parts.append(own.last)
                    joined = b"".join(parts)
                    row = (i, len(joined) // 4, hashlib.sha256(joined).hexdigest(), digest.hexdigest())
                    out.append((*row, np.frombuffer(joined, "<u4").astype(np.int32), " ".join(kept)) if with_ids else row)
                yield pd.DataFrame(out, columns=["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids])

    schema = "id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    # grouped as the blocks are bucketed: the answers move once, the texts never
    return (packed.join(gathered, "block", "left").select("block", "ids", "lens", "texts", "answers")
            .mapInPandas(join, schema).withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", id_col))
