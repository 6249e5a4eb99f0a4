"""Spelling variants by a frequency-vector trie.

A word's vector holds how often each group of letters occurs in it.  An inserted letter adds
one to one group, a deleted one takes one from one group, a replaced one does both or
neither: near words differ by a surplus and a deficit of one each at most.  Words
are arranged in a trie by successive counts.  Its top, down to nodes of at most
``region_words`` words, is broadcast; each word is searched through it and sent to the
regions that its budget reaches.  A region arranges its own words in a trie of the
same kind, searches it depth first for all words it got, and verifies leaf words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

LEAST_LENGTH, LEAST_N, RATIO, ODDS = 7, 2, 10, 31
# One group for each of these strings, and one for all other letters.
GROUPS = ["e", "a", "i", "n", "r", "s", "t", "o", "l", "u", "d", "c", "m", "p", "g", "h", "b", "v", "y", "fk", "jqwxz", "éèêë", "íìîï", "óòôöáàâä"]
LEVELS = len(GROUPS) + 1
#: Counts from here on are one: cutting both of two counts never takes them farther apart.
MOST = 60
_GROUP_OF = np.full(256, len(GROUPS), np.int64)
for _i, _letters in enumerate(GROUPS):
    _GROUP_OF[list(_letters.encode("latin-1"))] = _i
#: Longer words are compared one by one.
WIDE = 64


# ---------------------------------------------------------------- words
def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", odds: int = ODDS) -> DataFrame:
    """(``word``, ``n``) of all words of at least 7 code points after the planned deletions.  All
    letters of words are Latin-1, so texts are read as bytes of that encoding."""
    ship(docs.sparkSession)
    run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LENGTH)

    def counted(batches):
        total: dict[bytes, int] = {}
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                if not isinstance(text, str):
                    continue
                begin = zlib.crc32(f"{key if isinstance(key, str) else ''}:".encode())
                for word, n in Counter(run.findall(text.encode("latin-1", "replace").lower())).items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begin)
                    if h % odds == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < LEAST_LENGTH:
                            continue
                    total[word] = total.get(word, 0) + n
                if len(total) > 300_000:
                    yield frame(total)
                    total.clear()
        yield frame(total)

    def frame(total):
        return pd.DataFrame({"word": pd.Series([w.decode("latin-1") for w in total], dtype=object), "n": np.fromiter(total.values(), np.int64, len(total))})

    return (docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text"))
            .mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def vector_column():
    """A word's vector in Spark: a character for each count."""
    counts, rest = [], F.length("word")
    for letters in GROUPS:
        n = F.length("word") - F.length(F.translate("word", letters, ""))
        counts, rest = [*counts, n], rest - n
    return F.concat(*[F.char(F.lit(48) + F.least(n, F.lit(MOST))) for n in (*counts, rest)])


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of words, their bytes side by side (those of long words cut), and lengths."""
    raw = [w.encode("latin-1") for w in words]
    lens = np.array([len(r) for r in raw], np.int64)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    owner = np.repeat(np.arange(len(raw)), lens)
    vectors = np.bincount(owner * LEVELS + _GROUP_OF[flat], minlength=len(raw) * LEVELS).reshape(-1, LEVELS)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    rows = np.zeros((len(raw), min(int(lens.max(initial=0)), WIDE) + 1), np.uint8)
    fits = within < WIDE
    rows[owner[fits], within[fits]] = flat[fits]
    return np.minimum(vectors, MOST).astype(np.int64), rows, lens


# ---------------------------------------------------------------- tries
def search(levels: list[tuple[np.ndarray, np.ndarray]], vectors: np.ndarray, most: int = 1 << 17):
    """(row, leaf, exact) arrays of the leaves within the budget of each row's vector.

    A level maps node * 64 + count, ascending, to a node of the next level or to a leaf (-1 -
    leaf).  The search goes depth first, for many rows at once: what is open at one
    level is split into parts of ``most`` entries, and the last part goes down first."""
    n = len(vectors)
    none = np.zeros(n, bool)
    stack = [(0, np.arange(n), np.zeros(n, np.int64), none, none)]
    while stack:
        level, row, node, more, less = stack.pop()
        if len(row) > most:
            half = len(row) // 2
            stack += [(level, row[:half], node[:half], more[:half], less[:half]), (level, row[half:], node[half:], more[half:], less[half:])]
            continue
        keys, target = levels[level]
        count = vectors[row, level]
        found = []
        for step, able in ((0, None), (1, ~more), (-1, ~less & (count > 0))):
            at = np.arange(len(row)) if able is None else np.flatnonzero(able)
            key = node[at] * 64 + count[at] + step
            place = np.searchsorted(keys, key)
            place[place == len(keys)] = 0
            hit = keys[place] == key
            at, to = at[hit], target[place[hit]]
            found.append((row[at], to, more[at] | (step > 0), less[at] | (step < 0)))
        row, to, more, less = (np.concatenate(x) for x in zip(*found))
        leaf = to < 0
        if leaf.any():
            yield row[leaf], -1 - to[leaf], ~(more[leaf] | less[leaf])
            row, to, more, less = row[~leaf], to[~leaf], more[~leaf], less[~leaf]
        if len(row):
            stack.append((level + 1, row, to, more, less))


def arrange(vectors: np.ndarray, leaf_words: int = 8):
    """(levels, first, last) of the trie of sorted vectors; leaf i holds rows first[i] to last[i] - 1."""
    owner, at = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
    levels, firsts, lasts, leaves = [], [], [], 0
    while len(at):
        key = owner * 64 + vectors[at, len(levels)]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([begin, [len(key)]]))
        done = (size <= leaf_words) | (len(levels) == LEVELS - 1)
        target = np.where(done, -1 - (leaves + np.cumsum(done) - 1), np.cumsum(~done) - 1)
        levels.append((key[begin], target))
        firsts.append(at[begin[done]])
        lasts.append(at[begin[done]] + size[done])
        leaves += int(done.sum())
        goes_on = np.repeat(~done, size)
        owner, at = np.repeat(target, size)[goes_on], at[goes_on]
    return levels, np.concatenate(firsts), np.concatenate(lasts)


class Top:
    """The top of the trie of all words, cut where at most ``region_words`` words are left.  Leaf i
    is ``pieces[i]`` regions from ``first[i]`` on: several small sibling nodes may share one, and a
    whole vector of more words is several."""

    def __init__(self, region_words: int):
        self.region_words, self.levels, self.first, self.pieces, self.regions = region_words, [], [], [], 0
        self.open = {"": 0}

    def grow(self, counts: dict[str, int]) -> None:
        """One level further, by the number of words with each vector prefix below an open node."""
        keys, target, below, last = [], [], {}, (None, 0)
        for prefix in sorted(counts, key=lambda p: (self.open[p[:-1]], p[-1])):
            n, node = counts[prefix], self.open[prefix[:-1]]
            keys.append(node * 64 + ord(prefix[-1]) - 48)
            if n > self.region_words and len(self.levels) < LEVELS - 1:
                target.append(len(below))
                below[prefix], last = len(below), (None, 0)
                continue
            pieces = -(-n // self.region_words)
            if pieces > 1 or last[0] != node or last[1] + n > self.region_words:
                self.first.append(self.regions)
                self.regions += pieces
                last = (node if pieces == 1 else None, 0)
            else:
                self.first.append(self.regions - 1)
            last = (last[0], last[1] + n)
            self.pieces.append(pieces)
            target.append(-len(self.pieces))
        self.levels.append((np.array(keys, np.int64), np.array(target, np.int64)))
        self.open = below

    def regions_of(self, words: list[str]):
        """(row, region, own): the regions that each word has to be sent to; the own one holds it.
        Of the others only later ones, as two words need to meet once."""
        vectors, _, _ = letters_of(words)
        first, pieces = np.array(self.first), np.array(self.pieces)
        row, leaf, exact = (np.concatenate(x) for x in zip(*search(self.levels, vectors)))
        own = np.zeros(len(words), np.int64)
        home = leaf[exact]
        own[row[exact]] = first[home] + np.array([zlib.crc32(words[i].encode()) for i in row[exact]], np.int64) % pieces[home]
        times = pieces[leaf]
        region = np.repeat(first[leaf], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        row = np.repeat(row, times)
        pair = np.unique((row * max(self.regions, 1) + region)[region >= own[row]])
        row, region = np.divmod(pair, max(self.regions, 1))
        return row, region, region == own[row]


def top_of(words: DataFrame, region_words: int) -> Top:
    """The top for a table (``word``, ``vector``): a count of prefixes for each of its levels."""
    top = Top(region_words)
    while top.open:
        n = len(top.levels)
        rows = words if not n else words.join(
            words.sparkSession.createDataFrame([(p,) for p in top.open], "open string"), F.substring("vector", 1, n) == F.col("open"), "left_semi")
        counts = rows.groupBy(F.substring("vector", 1, n + 1).alias("prefix")).count().collect()  # some for each region_words words
        if not counts:
            break
        top.grow({r["prefix"]: r["count"] for r in counts})
    return top


# ---------------------------------------------------------------- near words
def one_apart(words: list[str], rows: np.ndarray, lens: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words differ by one inserted, deleted or replaced code point."""
    a, b = np.where(lens[a] <= lens[b], a, b), np.where(lens[a] <= lens[b], b, a)
    gap = lens[b] - lens[a]
    x, y = rows[a], rows[b]
    differs = x != y
    near = (gap == 0) & (differs.sum(axis=1) == 1)
    one = np.flatnonzero(gap == 1)
    if len(one):
        begun = np.maximum.accumulate(differs[one], axis=1)[:, :-1]
        near[one] = ~(begun & (x[one, :-1] != y[one, 1:])).any(axis=1)
    for i in np.flatnonzero((lens[b] > WIDE) & (gap <= 1)):
        s, t = words[a[i]], words[b[i]]
        at = next((k for k, (u, v) in enumerate(zip(s, t)) if u != v), len(s))
        near[i] = s != t and (s[at + 1:] if gap[i] == 0 else s[at:]) == t[at + 1:]
    return near


def near_in(words: list[str], n: np.ndarray, member: np.ndarray, most: int = 1 << 17):
    """(row, number of near rows, best near row) of the rows with near rows; pairs of two rows
    that are no members are not looked at.  Best: largest n, then first in code point order."""
    vectors, rows, lens = letters_of(words)
    own = np.flatnonzero(member)
    own = own[np.lexsort(vectors[own].T[::-1])]
    levels, first, last = arrange(vectors[own])
    near: list[tuple[np.ndarray, np.ndarray]] = []
    for row, leaf, _ in search(levels, vectors) if levels else ():
        size = last[leaf] - first[leaf]
        ends = np.cumsum(size)
        at = 0
        while at < len(row):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            times = size[at:stop]
            a = np.repeat(row[at:stop], times)
            b = own[np.repeat(first[leaf[at:stop]], times) + np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)]
            keep = (np.abs(lens[a] - lens[b]) <= 1) & (~member[a] | (a < b))
            a, b = a[keep], b[keep]
            hit = one_apart(words, rows, lens, a, b)
            near.append((a[hit], b[hit]))
            at = stop
    if not near:
        return (np.zeros(0, np.int64),) * 3
    a, b = (np.concatenate(x) for x in zip(*near))
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    begin = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    return a[begin], np.diff(np.concatenate([begin, [len(a)]])), b[begin]


def near_words(words: DataFrame, region_words: int = 4096) -> DataFrame:
    """(``word``, ``n``, ``n_near``, ``best_n``, ``best``) of all rows of (``word``, ``n``); the
    words must be distinct, Latin-1 letters."""
    spark = ship(words.sparkSession)
    words = stored(words.withColumn("vector", vector_column()), "spelling-words")
    top = spark.sparkContext.broadcast(top_of(words, region_words))  # a few bytes for each region_words words

    def sent(batches):
        for batch in batches:
            if len(batch) and top.value.regions:
                row, region, own = top.value.regions_of(batch["word"].tolist())
                names = np.array(batch["word"], object)[row]
                yield pd.DataFrame({"region": region, "word": pd.Series(names, dtype=object), "n": batch["n"].to_numpy()[row], "member": own})

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        names, n = pdf["word"].tolist(), pdf["n"].to_numpy()
        row, count, best = near_in(names, n, pdf["member"].to_numpy())
        names = np.array(names, object)
        return pd.DataFrame({"word": pd.Series(names[row], dtype=object), "n_near": count, "best_n": n[best],
                             "best": pd.Series(names[best], dtype=object)})

    found = (words.select("word", "n").mapInPandas(sent, "region long, word string, n long, member boolean")
             .groupBy("region").applyInPandas(met, "word string, n_near long, best_n long, best string"))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<o:bigint,best:string>").alias("best"))
    both = none.unionByName(found.select("word", F.lit(None).cast("long").alias("n"), "n_near",
                                         F.struct((-F.col("best_n")).alias("o"), "best").alias("best")))
    return (both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
            .select("word", "n", "n_near", (-F.col("best.o")).alias("best_n"), F.col("best.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``): where the links (``word``, ``form``) end that begin at a word.  A form has
    ``RATIO`` times the count of its word, so there are under 20 links in a row; each round
    doubles the links followed."""
    cur = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(cur.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")),
                      "spelling-roots")
        cur = step.select("word", "root")
        if not step.where("went").limit(1).count():
            return cur


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", region_words: int = 4096) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word (op13's contract).

    Null and empty texts have no words; a null id counts as an empty one in the hash that
    plans deletions; repeated rows count as often as they appear; an empty table gives no
    rows; other columns are not read.  Texts and words may have any length.
    """
    counts = word_counts(docs, id_col, text_col).where(F.col("n") >= LEAST_N)
    near = near_words(counts, region_words)
    has = F.col("best_n") >= RATIO * F.col("n")
    near = stored(near.select("word", F.when(has, F.col("best")).alias("form"), "n", "n_near", F.when(has, F.col("best_n")).alias("form_n")),
                  "spelling-near")
    ends = roots(near.where("form IS NOT NULL"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
