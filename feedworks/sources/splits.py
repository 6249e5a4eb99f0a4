"""Records of many lines in the splits of a file, each read once from its begin to its end.

A line comes with a code: bit 0 tells whether it leaves a quote open where none was before it,
bit 1 the same where one was.  It shares a number, ``place``, with what holds for the whole
split, since each further column takes longer to reach Python than a line takes there.
What a task holds is a batch of lines and, of the record that is not closed yet, up to
``most`` lines (of a longer one the first line and how many).  Before it is known how a
split begins, both cases are kept, each with ``room`` bytes of text only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CLOSES, TURNS, KEEPS, OPENS = 0, 1, 2, 3
#: How a split begins (``begin``): with a record, within a record or with the header of its file.
RECORD, WITHIN, HEADER = 0, 1, 2
#: Text travels as bytes: it need not be valid UTF-8.
BORDERS = ("file string, block long, f0 int, f1 int, closes0 boolean, closes1 boolean, head binary, head_n long, "
           "tail0 binary, tail0_n long, tail0_pos long, tail1 binary, tail1_n long, tail1_pos long")
FOUND = "split int, pos long, n long, text binary"


class Open:
    """The lines so far of a record, or of a piece of one, that begins with line ``pos`` of its split."""

    def __init__(self, most: int, pos: int = 0, room: float = np.inf):
        self.most, self.pos, self.room, self.n, self.size, self.lines = most, pos, room, 0, 0, []

    def add(self, lines: pa.Array) -> None:
        self.n, self.size = self.n + len(lines), self.size + lines.nbytes
        if self.n <= self.most and self.size <= self.room:
            self.lines += lines.to_pylist()
        else:
            self.lines = self.lines[:1] or lines[:1].to_pylist()

    @property
    def text(self) -> bytes | None:
        """Null if there was no room for it."""
        return b"\n".join(self.lines) if self.n > self.most or self.size <= self.room else None

    def row(self, split: int) -> tuple:
        return split, self.pos, self.n, self.text


def open_after(codes: np.ndarray, state: int) -> np.ndarray:
    """For each line whether a quote is open behind it, where ``state`` tells it before the first."""
    turns, at = np.cumsum(codes == TURNS), np.arange(len(codes))
    fixed = np.maximum.accumulate(np.where((codes == CLOSES) | (codes == OPENS), at, -1))
    since = np.where(fixed < 0, state, (codes[fixed] == OPENS) - turns[fixed])
    return (since + turns) & 1


def runs(numbers: np.ndarray, names: pa.Array | None = None):
    """Begin and end of the rows that follow each other with the same values."""
    new = numbers[1:] != numbers[:-1]
    if names is not None:
        new |= pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)
    at = [0, *(np.flatnonzero(new) + 1).tolist(), len(numbers)]
    return [(a, b) for a, b in zip(at, at[1:]) if b > a]


class Split:
    """What is found in a split whatever stands before it: for both cases the state of quotes at its end, whether
    a record ends in it and the lines behind the last that does; and the lines up to the end of a record
    that is open at its begin."""

    def __init__(self, key: tuple, most: int, room: float):
        self.key, self.most, self.room, self.n, self.head = key, most, room, 0, Open(most, 0, room)
        self.state, self.closes, self.tails = [0, 1], [False, False], [Open(most, 0, room), Open(most, 0, room)]

    def add(self, codes: np.ndarray, lines: pa.Array) -> None:
        for k in (0, 1):
            after = open_after(codes, self.state[k])
            ends = np.flatnonzero(after == 0)
            if k and not self.closes[1]:
                self.head.add(lines[:ends[0] + 1] if len(ends) else lines)
            if len(ends):
                self.closes[k], self.tails[k] = True, Open(self.most, self.n + int(ends[-1]) + 1, self.room)
            self.tails[k].add(lines[ends[-1] + 1:] if len(ends) else lines)
            self.state[k] = int(after[-1])
        self.n += len(codes)

    def row(self) -> tuple:
        return (*self.key, *self.state, *self.closes, self.head.text, self.head.n,
                *[x for t in self.tails for x in (t.text, t.n, t.pos)])


def borders(most: int, room: float):
    """For ``mapInArrow`` over (``value``, ``place``: block and code, ``file``): a row for each split."""
    def run(batches):
        split = None
        for batch in batches:
            value, place, file = batch.columns
            value, codes, block, done = value.cast(pa.binary()), place.to_numpy() & 3, place.to_numpy() >> 2, []
            for a, b in runs(block, file):
                key = (file[a].as_py(), int(block[a]))
                if split is None or key != split.key:
                    done += [split] if split else []
                    split = Split(key, most, room)
                split.add(codes[a:b], value[a:b])
            yield _batch([s.row() for s in done], _BORDERS)
        yield _batch([split.row()] if split else [], _BORDERS)
    return run


_BORDERS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("f0", pa.int32()), ("f1", pa.int32()),
                      ("closes0", pa.bool_()), ("closes1", pa.bool_()), ("head", pa.binary()), ("head_n", pa.int64()),
                      *[(f"tail{k}{c}", t) for k in (0, 1) for c, t in (("", pa.binary()), ("_n", pa.int64()), ("_pos", pa.int64()))]])
_FOUND = pa.schema([("split", pa.int32()), ("pos", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [*zip(*rows)] or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def read(most: int, pieces: bool = False):
    """For ``mapInArrow`` over (``value``, ``place``: split, begin and code): the records that begin and end in one
    split, without headers; of one with over ``most`` lines the first line.  With ``pieces`` the lines of each
    split before the first and behind the last of them."""
    def run(batches):
        at = None
        for batch in batches:
            value, place = batch.columns
            if place.null_count:
                raise ValueError("the files or their splits have changed while they were read")
            value, codes, split = value.cast(pa.binary()), place.to_numpy() & 3, place.to_numpy() >> 4
            for a, b in runs(split):
                if split[a] != at:
                    if pieces and at is not None and held.n:
                        yield _batch([held.row(at)], _FOUND)
                    at, first = int(split[a]), place[a].as_py() >> 2 & 3
                    state, n, held, piece = int(first == WITHIN), 0, Open(most), first != RECORD
                after = open_after(codes[a:b], state)
                ends = np.flatnonzero(after == 0)
                lines, state = value[a:b], int(after[-1])
                if len(ends):
                    held.add(lines[:ends[0] + 1])
                    if piece == pieces:
                        yield _batch([held.row(at)], _FOUND)
                    if len(ends) > 1 and not pieces:
                        yield _joined(at, n, lines, ends, most)
                    held, piece = Open(most, n + int(ends[-1]) + 1), False
                    held.add(lines[ends[-1] + 1:])
                else:
                    held.add(lines)
                n += b - a
        if pieces and at is not None and held.n:
            yield _batch([held.row(at)], _FOUND)
    return run


def _joined(split: int, n: int, lines: pa.Array, ends: np.ndarray, most: int) -> pa.RecordBatch:
    """The records between the first and the last of ``ends``, for ``lines`` from line ``n`` of the split."""
    borders, count = ends + 1, np.diff(ends)
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(borders, pa.int32()), lines), b"\n")
    if count.max() > most:
        text = pc.if_else(pa.array(count > most), lines.take(pa.array(borders[:-1])), text)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(count), split), pa.int32()), pa.array(n + borders[:-1], pa.int64()),
                                       pa.array(count, pa.int64()), text], schema=_FOUND)
