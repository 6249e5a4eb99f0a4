"""Katz backoff language model over words.

Good-Turing counts c* = d(c) c for small counts; what they give up goes to the words not
seen after a context, in proportion to their probabilities after the context without its
first word, and so on down to single words, with backoff weights that make every
context's distribution sum to one exactly.  One unknown word stands for all words that
are not in the training texts.  The context of a text's first words ends at its start.

Counts meet in tables that are cut by key range (shards) and by block of texts: a block
asks each shard for the counts of its own n-grams and gets them in the order asked.
Only distinct n-grams with their block's counts are moved, never single tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .blocks import by_shard, gathered, shard_of, spread, squeeze
from .common import mix64, span_hashes, stored, word_bounds
from .quality import held_out

END, START = np.uint64(0x5EED0000000000E5), np.uint64(0x5EED000000000057)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Good-Turing below this count; counts from it on lose LEAST, so that no context is left without mass.
TOP, LEAST = 6, 1e-3


def discounted(counts_of_counts: list[int]) -> np.ndarray:
    """c* for c = 0, ..., TOP - 1 from n_1, ..., n_TOP by Katz's formula; where the numbers of
    counts don't allow it (gaps, or a value not in (0, c)), c - D with D = n_1 / (n_1 + 2 n_2)."""
    n = [0, *counts_of_counts]
    flat = min(max(n[1] / (n[1] + 2 * n[2]), 0.05), 0.95) if n[1] and n[2] else 0.5
    out = np.zeros(TOP)
    tail = TOP * n[TOP] / n[1] if n[1] else 1.0
    for r in range(1, TOP):
        value = -1.0
        if n[r] and n[r + 1] and tail < 1:
            value = ((r + 1) * n[r + 1] / n[r] - r * tail) / (1 - tail)
        out[r] = value if 0 < value < r else r - flat
    return out


def stars(counts: np.ndarray, small: np.ndarray) -> np.ndarray:
    return np.where(counts < TOP, small[np.minimum(counts, TOP - 1)], counts - LEAST)


def token_arrays(lens: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts of a block, END after each text, and for each text
    the place of its first token (and at last the number of all)."""
    b, offsets = blocks.unpack(lens, texts)
    out, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for lo, hi in blocks.slices(offsets):
        at, end = int(offsets[lo]), int(offsets[hi])
        part = np.full(end - at + hi - lo, 32, np.uint8)  # a space after each text
        own = offsets[lo:hi + 1] - at
        part[np.arange(end - at) + np.repeat(np.arange(hi - lo), np.diff(own))] = _LOWER[b[at:end]]
        starts, ends = word_bounds(part)
        text = np.searchsorted(own[1:] + np.arange(1, hi - lo + 1), starts, "right")
        n = np.bincount(text, minlength=hi - lo)
        tokens = np.full(len(starts) + hi - lo, END)
        tokens[np.arange(len(starts)) + text] = span_hashes(part, starts, ends)
        out.append(tokens)
        counts[lo:hi] = n + 1
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


def pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(context * np.uint64(0x9E3779B97F4A7C15) + word)


@dataclass
class Unigrams:
    """What all blocks must know of the words: number of tokens, words, ends, and c*."""

    tokens: int
    words: int
    ends: int
    small: np.ndarray
    unknown: float

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, stars(counts, self.small) / max(self.tokens, 1), self.unknown)


class _Block:
    """The tokens of a block and, level by level, their n-grams: ``known`` and ``answered`` take
    what the shards say of a level, ``grams`` goes on to the next one."""

    def __init__(self, lens: bytes, texts: bytes, trained: bytes):
        self.tokens, self.starts = token_arrays(lens, texts)
        self.train = np.repeat(np.frombuffer(trained, bool), np.diff(self.starts))
        self.words, self.word = np.unique(self.tokens, return_inverse=True)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.word, self.train, len(self.words)).astype(np.int64)

    def known(self, counts: np.ndarray) -> None:
        self.count = counts[self.word]
        self.words = self.word = None  # not needed any more

    def grams(self, level: int, model: Unigrams, shards: int) -> None:
        """Distinct grams of ``level`` words whose context and whose end (all but the first word) have
        been seen, in the order (shard, context, gram).  A context with more than a quarter of
        a shard's share of the tokens is parted by its words.  ``count`` is that of the end."""
        context_count = np.roll(self.count, 1)
        if level == 2:
            context, under = np.roll(self.tokens, 1), None
            context[self.starts[:-1]], context_count[self.starts[:-1]] = START, model.ends
        else:
            context, under = np.roll(pair_keys(self.context, self.tokens), 1), self.context_count
            context_count[self.starts[:-1]] = 0  # there the context ends at the start: a lower level has it
        self.open = np.flatnonzero((self.count > 0) & (context_count > 0))
        key = pair_keys(context[self.open], self.tokens[self.open])
        keys, at, gram = np.unique(key, return_index=True, return_inverse=True)
        del key
        at = self.open[at]
        parts = 1 + context_count[at] * 4 * shards // max(model.tokens, 1)
        salt = (mix64(self.tokens[at]) % parts.astype(np.uint64))
        shard = shard_of(mix64(context[at] + salt), shards)
        order = np.lexsort((keys, context[at], shard))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.context, self.context_count, self.gram, self.shard = context, context_count, rank[gram], shard[order]
        at = at[order]
        self.gram_context, self.gram_word, self.gram_known = context[at], self.tokens[at], self.count[at]
        self.gram_under = None if under is None else under[at]
        self.gram_count = np.bincount(self.gram, self.train[self.open], len(order)).astype(np.int64)

    def answered(self, counts: np.ndarray) -> None:
        """``count`` becomes that of the grams; where they are not open it is 0."""
        self.count = np.zeros(len(self.tokens), np.int64)
        if len(self.open):
            self.count[self.open] = counts[self.gram]
        self.gram = self.shard = self.gram_context = self.gram_word = self.gram_known = self.gram_under = self.gram_count = None


def _answer(parts, dtype=np.int32) -> np.ndarray:
    """A block's answers from all shards, in the order in which it asked."""
    got = sorted((p["shard"], p["counts"]) for p in parts) if parts is not None else []
    return np.concatenate([spread(c, dtype) for _, c in got]).astype(np.int64) if got else np.zeros(0, np.int64)


def _of_counts(totals: np.ndarray) -> list[int]:
    return np.bincount(totals[totals <= TOP], minlength=TOP + 1)[1:].tolist()


N_COLUMNS = [f"n{r}" for r in range(1, TOP + 1)]


def score_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 10,
                order: int = 2, block_bytes: int = 8 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (op2's contract).

    Learns n-grams of up to ``order`` words (2 or more) from the rows whose crc32(id) is not
    divisible by ``folds``; each further word is one more pass and one more table.  Null and empty
    texts have the end token alone; null ids are training rows; repeated rows are counted
    and returned as often as they appear; an empty table gives no rows; other columns
    are not read.  Words are told apart by 64-bit hashes.  Where no row is left to learn from,
    every token has probability one in ``score``'s model of a single unknown word.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    flag = held_out(id_col, folds)
    named = docs.select(F.concat_ws(":", flag.cast("int").cast("string"), F.col(id_col).cast("string")).alias("key"),
                        F.col(text_col).alias("text"))
    packed = blocks.pack_keys(named, "katz-blocks", block_bytes)
    total = packed.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def trained(keys) -> bytes:
        return np.array([k[0] == "0" for k in keys], bool).tobytes()

    def ask_words(batches):
        for batch in batches:
            for r in batch.itertuples():
                own = _Block(r.lens, r.texts, trained(r.ids))
                counts = own.word_counts()
                rows = [(r.block, s, own.words[at].tobytes(), squeeze(counts[at].astype(np.int32)))
                        for s, at in by_shard(shard_of(own.words, shards))]
                yield pd.DataFrame(rows, columns=["block", "shard", "words", "counts"])

    def count_words(pdf: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(x, np.uint64) for x in pdf["words"]]
        _, where = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(where, np.concatenate([spread(c, np.int32) for c in pdf["counts"]])).astype(np.int64)
        cut = np.cumsum([len(w) for w in words])[:-1]
        out = pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"],
                            "counts": [squeeze(x.astype(np.int32)) for x in np.split(totals[where], cut)]})
        n = _of_counts(totals)
        end = totals[where[np.concatenate(words) == END][:1]]
        out[N_COLUMNS] = 0
        out.loc[out.index[0], N_COLUMNS] = n
        out["tokens"], out["words"], out["ends"] = 0, 0, 0
        out.loc[out.index[0], ["tokens", "words", "ends"]] = [int(totals.sum()), int((totals > 0).sum()), int(end.sum())]
        return out

    n_schema = ", ".join(f"{c} long" for c in N_COLUMNS)
    answers = stored(packed.select("block", "ids", "lens", "texts")
                     .mapInPandas(ask_words, "block long, shard long, words binary, counts binary")
                     .groupBy("shard").applyInPandas(count_words, f"block long, shard long, counts binary, {n_schema}, "
                                                                  "tokens long, words long, ends long"), "katz-words")
    sums = answers.agg(*[F.sum(c).alias(c) for c in (*N_COLUMNS, "tokens", "words", "ends")]).first()
    n_tokens, n_words = sums["tokens"] or 0, sums["words"] or 0
    small = discounted([sums[c] or 0 for c in N_COLUMNS])
    lost = sum((sums[f"n{r}"] or 0) * (r - small[r]) for r in range(1, TOP))
    rest = n_words - sum(sums[f"n{r}"] or 0 for r in range(1, TOP))
    model = Unigrams(n_tokens, n_words, sums["ends"] or 0, small, (lost + LEAST * rest) / n_tokens if n_tokens else 1.0)
    asked = packed.join(gathered(answers, "counted", "katz-counted"), "block")

    def walked(r, level: int) -> _Block:
        """A block that knows the counts of all levels before ``level``."""
        own = _Block(r.lens, r.texts, trained(r.ids))
        own.known(_answer(r.counted))
        for k in range(2, level):
            own.grams(k, model, shards)
            own.answered(_answer(getattr(r, f"grams{k}")))
        return own

    def ask_grams(level: int):
        def ask(batches):
            for batch in batches:
                for r in batch.itertuples():
                    own = walked(r, level)
                    own.grams(level, model, shards)
                    rows = []
                    for s, at in by_shard(own.shard):
                        context = own.gram_context[at]
                        first = np.concatenate([[0], np.flatnonzero(context[1:] != context[:-1]) + 1])
                        runs = np.diff(np.concatenate([first, [len(context)]]))
                        under = None if own.gram_under is None else squeeze(own.gram_under[at][first].astype(np.int32))
                        rows.append((r.block, s, context[first].tobytes(), squeeze(runs.astype(np.int32)), under, own.gram_word[at].tobytes(),
                                     squeeze(own.gram_known[at].astype(np.int32)), squeeze(own.gram_count[at].astype(np.int32))))
                    yield pd.DataFrame(rows, columns=["block", "shard", "contexts", "runs", "under", "words", "known", "counts"])
        return ask

    def count_grams(below: np.ndarray | None):
        """Counts of a shard's grams and what the weights of its contexts need; ``below``: c* of the level
        below, None where that is the words."""
        def count(pdf: pd.DataFrame) -> pd.DataFrame:
            words = [np.frombuffer(x, np.uint64) for x in pdf["words"]]
            word = np.concatenate(words)
            runs = [spread(n, np.int32) for n in pdf["runs"]]
            context = np.concatenate([np.repeat(np.frombuffer(c, np.uint64), n) for c, n in zip(pdf["contexts"], runs)])
            _, at, where = np.unique(pair_keys(context, word), return_index=True, return_inverse=True)
            totals = np.bincount(where, np.concatenate([spread(c, np.int32) for c in pdf["counts"]])).astype(np.int64)
            known = np.concatenate([spread(c, np.int32) for c in pdf["known"]])[at].astype(np.int64)
            out = pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"],
                                "counts": [squeeze(x.astype(np.int32)) for x in
                                           np.split(totals[where], np.cumsum([len(w) for w in words])[:-1])]})
            # of each context: how many words by count, and what the level below gives to them
            seen = totals > 0
            if below is None:
                lower = model.probability(known[seen])
            else:
                under = np.concatenate([np.repeat(spread(u, np.int32), n) for u, n in zip(pdf["under"], runs)])[at]
                lower = stars(known[seen], below) / under[seen]
            names, group = np.unique(context[at][seen], return_inverse=True)
            sums = np.zeros((len(names), TOP + 1))
            np.add.at(sums, (group, np.minimum(totals[seen], TOP) - 1), 1)
            sums[:, TOP] = np.bincount(group, np.where(totals[seen] >= TOP, totals[seen], 0), len(names))
            mass = np.bincount(group, lower, len(names))
            out["contexts"], out["sums"], out["mass"] = None, None, None
            out.at[out.index[0], "contexts"] = names.tobytes()
            out.at[out.index[0], "sums"] = squeeze(sums.astype(np.int64))
            out.at[out.index[0], "mass"] = squeeze(mass)
            out[N_COLUMNS] = 0
            out.loc[out.index[0], N_COLUMNS] = _of_counts(totals)
            return out
        return count

    def unroll(small: np.ndarray):
        def rows(batches):
            for batch in batches:
                for r in batch.itertuples():
                    s, names = spread(r.sums).reshape(-1, TOP + 1), np.frombuffer(r.contexts, np.int64)
                    total = s[:, :TOP - 1] @ np.arange(1, TOP) + s[:, TOP]
                    kept = s[:, :TOP - 1] @ small[1:] + s[:, TOP] - LEAST * s[:, TOP - 1]
                    yield pd.DataFrame({"context": names, "total": total, "kept": kept, "mass": spread(r.mass, np.float64)})
        return rows

    smalls: list[np.ndarray] = []
    weights = None
    given = ["block", "ids", "lens", "texts", "counted"]
    for level in range(2, order + 1):
        grams = stored(asked.select(*given)
                       .mapInPandas(ask_grams(level), "block long, shard long, contexts binary, runs binary, under binary, words binary, "
                                                      "known binary, counts binary")
                       .groupBy("shard").applyInPandas(count_grams(smalls[-1] if smalls else None),
                                                       "block long, shard long, counts binary, contexts binary, sums binary, "
                                                       f"mass binary, {n_schema}"), f"katz-grams{level}")
        sums = grams.agg(*[F.sum(c).alias(c) for c in N_COLUMNS]).first()
        smalls.append(discounted([sums[c] or 0 for c in N_COLUMNS]))
        more = (grams.where("contexts IS NOT NULL").select("contexts", "sums", "mass")
                .mapInPandas(unroll(smalls[-1]), "context long, total long, kept double, mass double").groupBy("context")
                .agg(F.sum("total").alias("total"), F.sum("kept").alias("kept"), F.sum("mass").alias("mass"))
                .select("context", F.log10((1 - F.col("kept") / F.col("total")) / (1 - F.col("mass"))).alias("weight")))
        weights = more if weights is None else weights.unionByName(more)
        asked = asked.join(gathered(grams, f"grams{level}", f"katz-gathered{level}"), "block", "left")
        given.append(f"grams{level}")

    def evaluate(batches):
        for batch in batches:
            for r in batch.itertuples():
                own = walked(r, 2)
                first = own.starts[:-1]
                log = np.log10(model.probability(own.count))
                base = np.add.reduceat(np.log10((own.count + 0.1) / (model.tokens + 0.1 * (model.words + 1))), first)
                n_known = np.add.reduceat((own.count > 0).astype(np.int64), first)
                for level, small in enumerate(smalls, 2):
                    own.grams(level, model, shards)
                    own.answered(_answer(getattr(r, f"grams{level}")))
                    with np.errstate(divide="ignore", invalid="ignore"):
                        log = np.where(own.count > 0, np.log10(stars(own.count, small) / own.context_count), log)
                    # tokens that back off from a context that has been seen
                    off = np.flatnonzero((own.count == 0) & (own.context_count > 0))
                    if len(off):
                        text = np.searchsorted(own.starts, off, "right") - 1
                        by = np.lexsort((own.context[off], text))
                        text, context = text[by], own.context[off][by]
                        at = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (context[1:] != context[:-1])]))
                        yield frame(r.block, text[at], context=context[at].view(np.int64), times=np.diff(np.concatenate([at, [len(text)]])))
                yield frame(r.block, np.arange(len(first)), id=pd.Series(list(r.ids), dtype=object), n_tokens=np.diff(own.starts),
                            n_known=n_known, base=base, score=np.add.reduceat(log, first))

    def frame(block, k, **columns):
        kinds = {"id": object, "n_tokens": "Int64", "n_known": "Int64", "base": float, "score": float, "context": "Int64", "times": "Int64"}
        none = {c: pd.Series([None] * len(k), dtype=t) for c, t in kinds.items() if c not in columns}
        return pd.DataFrame({"block": block, "k": k, **{c: columns.get(c, none.get(c)) for c in kinds}})

    done = stored(asked.select(*given)
                  .mapInPandas(evaluate, "block long, k long, id string, n_tokens long, n_known long, base double, score double, "
                                             "context long, times long"), "katz-texts")
    weights = stored(weights, "katz-weights")
    # a frequent context may be in a third of the texts: both sides are plain scans, so its partition can be split
    backed = (done.where("context IS NOT NULL").select("block", "k", "context", "times").join(weights, "context")
              .groupBy("block", "k").agg(F.sum(F.col("times") * F.col("weight")).alias("more")))
    texts = done.where("context IS NULL")
    return texts.join(backed, ["block", "k"], "left").select(
        F.expr("CAST(nullif(substring(id, 3), '') AS bigint)").alias(id_col), (F.substring("id", 1, 1) == "1").alias("held_out"),
        "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
