"""Byte-level BPE: exact merges in linear time by backtracking over longest matches.

The bytes of a piece are read as Latin-1 characters, so that an Aho-Corasick automaton
over the vocabulary tells how far the longest token from a position can reach.  Encoding takes the
longest token that may follow the token before it; where none may, it goes back.
Whether two tokens may stand side by side, which is whether merging their joined
bytes would give just these two, is worked out once for each pair and remembered.
"""

from __future__ import annotations

import base64
import hashlib
from collections import OrderedDict
from itertools import islice

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Pieces and token pairs remembered by one worker (each twice at most, see _Remembered).
PIECES, PAIRS = 250_000, 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with one ``base64 rank`` pair a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder of one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.token = {i: t for t, i in ranks.items()}
        self.parents: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs = _Remembered(self._fit_together, PAIRS)
        self.ids: dict[str, int] = {}
        self.spelled = _Remembered(
            lambda piece: " ".join(map(str, self.encode_piece(piece.encode("utf-8", "surrogatepass")))), PIECES)
        self.written = {str(i): t for i, t in self.token.items()}
        self.automaton = ahocorasick.Automaton()
        # In order of rank: what merges into a token has lower ranks and is known already.
        for i, t in sorted(self.token.items()):
            parts = self._merge(t, below=i)
            if len(t) == 1:
                self.parents[i] = (i, i)
            elif len(parts) == 2:
                self.parents[i] = (parts[0], parts[1])
                self.merged[parts[0], parts[1]] = i
            else:
                continue  # no sequence of merges makes this token
            self.ids[t.decode("latin-1")] = i
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.widest = max(map(len, self.ids), default=1)

    def _merge(self, data: bytes, below: int) -> list[int]:
        """Plain merging with the ranks under ``below``; used on vocabulary entries only."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _fit_together(self, key: int) -> bool:
        """Whether merging the bytes of two tokens (left << 20 | right) gives these two again.

        Undoes the merges of both sides from the last one back.  Before each step a
        merge across the border that comes earlier than the merges already undone
        would have been taken first, and so the two can't stand together.
        """
        a, b, undone = key >> 20, key & 0xFFFFF, 1 << 30
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < undone:
                return False
            a_whole, b_whole = self.parents[a][0] == a, self.parents[b][0] == b
            if a_whole and b_whole:
                return True
            if b_whole or (not a_whole and a > b):
                undone, a = a, self.parents[a][1]
            else:  # on equal ranks the left merge comes first, so the right one is undone first
                undone, b = b + 1, self.parents[b][0]

    def encode_piece(self, data: bytes) -> list[int]:
        """Token ids of one piece.  A position from which the rest can't be spelled is
        marked and never tried again, so each position is left at most once."""
        s, n = data.decode("latin-1"), len(data)
        whole = self.ids.get(s)
        if whole is not None:
            return [whole]
        ids, longest, pairs, widest = self.ids, self.automaton.longest_prefix, self.pairs, self.widest
        out: list[int] = []
        path: list[tuple[int, int]] = []  # (start, size) of the tokens in out
        dead: set[int] = set()
        at, size, last = 0, longest(s[:widest]) if n else 0, -1
        while at < n:
            while size:
                i = ids.get(s[at:at + size])
                if i is not None and at + size not in dead:
                    if last < 0 or pairs[last << 20 | i]:
                        break
                size -= 1
            if size:
                out.append(i)
                path.append((at, size))
                at, last = at + size, i
                size = longest(s[at:at + widest])
            else:
                if not path:
                    raise ValueError("the vocabulary can't spell these bytes")
                dead.add(at)
                at, size = path.pop()
                out.pop()
                last, size = out[-1] if out else -1, size - 1
        return out

    def encode(self, text: str) -> list[int]:
        return [i for p in self.split.findall(text) for i in self.encode_piece(p.encode("utf-8", "surrogatepass"))]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in decimal joined by one space, and SHA-256 of
        the bytes decoded from them.  A long text is worked off in parts, and what a piece
        encodes to is remembered."""
        n, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
        spelled, written = self.spelled.__getitem__, self.written.__getitem__
        pieces = (m[0] for m in self.split.finditer(text)) if len(text) > 1 << 20 else self.split.findall(text)
        for part in iter(lambda it=iter(pieces): list(islice(it, 1 << 16)), []):
            ids = " ".join(map(spelled, part))
            ids_hash.update(f" {ids}".encode() if n else ids.encode())
            each = ids.split(" ")
            bytes_hash.update(b"".join(map(written, each)))
            n += len(each)
        return n, ids_hash.hexdigest(), bytes_hash.hexdigest()


class _Remembered(dict):
    """Values worked out by ``make`` when they are first asked for.

    Holds ``most`` of them; then they become the older generation, from which those that are
    asked for again come back, and the generation before is forgotten.  Long texts are
    not kept.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if isinstance(key, int) or len(key) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


_CODECS: OrderedDict[str, Codec] = OrderedDict()


def codec(ranks_file: bytes, pattern: str) -> Codec:
    """The codec of a vocabulary file's content; a worker process keeps the last two."""
    key = hashlib.sha256(ranks_file + b"\0" + pattern.encode()).hexdigest()
    if key not in _CODECS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        _CODECS[key] = Codec(ranks, pattern)
        while len(_CODECS) > 2:
            _CODECS.popitem(last=False)
    return _CODECS[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row of ``docs``: ``id_col``, n_tokens, ids_sha256, decoded_sha256, and with
    ``with_ids`` the ids themselves (array of int).

    A null text counts as empty (no tokens, the digests of no bytes); null and repeated
    ids keep a row for each row; other columns are not read.  Special tokens are
    ordinary text.  The vocabulary file is read once and sent to the workers.
    """
    spark = ship(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    def run(batches):
        own = codec(content.value, pattern)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            got = [own.digest(t) for t in texts]
            out = pd.DataFrame(got, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "id", batch["id"].astype("Int64"))
            if with_ids:
                out["ids"] = [own.encode(t) for t in texts]
            yield out
        own.spelled.forget()  # the worker lives on, maybe with other work

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInPandas(run, schema).withColumnRenamed("id", id_col))


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, *, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` (binary): the bytes of its ids; null ids give null."""
    spark = ship(encoded.sparkSession)
    with open(ranks_path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf("binary")
    def decoded(s: pd.Series) -> pd.Series:
        own = codec(content.value, pattern)
        return pd.Series([None if ids is None else own.decode([int(i) for i in ids]) for ids in s])

    return encoded.withColumn("decoded", decoded(F.col(ids_col)))
