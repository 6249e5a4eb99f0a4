"""Prefix trie of conversations by range partitions and a splitter skeleton.

A conversation is a path: the 32-byte digests of its turns, end to end, so that paths with
a common beginning stand together in byte order.  Paths are range-partitioned by (path,
conv_id) into shards.  What the last path of a shard and the first of the next one share
is a splitter path; the trie of these is the skeleton, and it is broadcast.  Every
other node has all its members in one shard, which finishes it in one sorted
pass.  Of a skeleton node each shard gives a part: all figures of a node add up over its
shards, as a node is counted by the shard with its first member, and a leaf by
the one with its last.  One grouped sum reduces the parts.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, ship, stored

KEY = 32
#: Bytes that all splitter paths together may have; the number of shards follows from it.
SKELETON_BYTES = 32 << 20
NONE_SHA = hashlib.sha256(b"").hexdigest()
FIGURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
PARTS = ("kind string, key binary, parent binary, parent_conv_id long, conv_id long, depth long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, shard long, ends binary")
NAMES = [c.split(" ")[0] for c in PARTS.split(", ")]


def paths(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``path`` binary, ``words`` array<int>) of (conv_id, turn, role, text) rows:
    digests of the turns in order and the words of each."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    own = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
           .where("conv_id IS NOT NULL")
           .withColumn("pos", F.row_number().over(W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")))
           .select("conv_id", "pos", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("key"),
                   F.regexp_count("text", F.lit(WORD)).alias("words")))
    return own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "key", "words"))).alias("turns"))


def rebuild(own: DataFrame, group: int = 20, spread: int = 4) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % ``group`` in place of its
    own first h, h being crc32(c) % ``spread``."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    heads = own.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, spread - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    none = F.array().cast("array<struct<pos:int,key:string,words:int>>")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    turns = (own.withColumns({"base": base, "h": h}).join(heads, "base", "left")
             .select("conv_id", F.concat(head, rest).alias("turns")))
    return turns.select("conv_id", F.unhex(F.array_join("turns.key", "")).alias("path"), F.col("turns.words").alias("words"))


def shared(a: bytes, b: bytes) -> int:
    """Number of whole keys with which both paths begin."""
    n = min(len(a), len(b)) // KEY
    if a[:n * KEY] == b[:n * KEY]:
        return n
    low, high = 0, n - 1  # the first low keys are equal, the first high + 1 are not
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid * KEY] == b[:mid * KEY]:
            low = mid
        else:
            high = mid - 1
    return low


class _Node:
    """An open node of the path from the root to the row at hand."""

    __slots__ = ("words", "left", "right", "skeleton", "n", "least", "children", "leaves", "saved", "ends", "held", "any")

    def __init__(self, words: int, left: bool, right: bool, top: bool):
        # left, right: whether members lie in an earlier or a later shard too
        self.words, self.left, self.right, self.skeleton = words, left, right, top or left or right
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.any, self.ends, self.held = None, False, [], []


class _Shard:
    """One sorted pass over the paths of a shard; finished rows collect in ``out``."""

    def __init__(self, shard: int, left: bytes | None, right: bytes | None, out: list):
        self.shard, self.left, self.right, self.out = shard, left, right, out
        self.path, self.open = b"", [_Node(0, left is not None, right is not None, True)]

    def key(self, depth: int) -> bytes:
        return hashlib.sha256(self.path[:depth * KEY]).digest()

    def add(self, path: bytes, conv_id: int, words) -> None:
        depth, same = len(path) // KEY, shared(self.path, path)
        while len(self.open) - 1 > same:
            self.close()
        if same < depth:
            self.path = path
            left = shared(path, self.left) if self.left is not None else -1
            right = shared(path, self.right) if self.right is not None else -1
            for d in range(same + 1, depth + 1):
                self.open[-1].any = True
                self.open.append(_Node(int(words[d - 1]), d <= left, d <= right, False))
        self.open[-1].ends.append(conv_id)

    def close(self) -> None:
        depth, node = len(self.open) - 1, self.open.pop()
        if node.ends:
            node.n += len(node.ends)
            node.least = min(node.ends[0], node.least if node.least is not None else node.ends[0])
        # the shard with the last member knows whether any of them goes on
        node.leaves += not node.any and not node.right
        node.saved += node.n * node.words - (0 if node.left else node.words)
        ends = ",".join(map(str, node.ends)).encode()
        figures = (node.least, depth, node.n, node.children, node.leaves, node.saved)
        if self.open:
            above = self.open[-1]
            above.n, above.leaves, above.saved = above.n + node.n, above.leaves + node.leaves, above.saved + node.saved
            above.children += not node.left
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton:
            parent = self.key(depth - 1) if depth else None
            self.out.append(("part", self.key(depth), parent, None, *figures, None, self.shard, ends or None))
        elif self.open[-1].skeleton:
            self.out.append(("under", None, self.key(depth - 1), None, *figures, hashlib.sha256(ends).hexdigest(), None, None))
        else:
            self.open[-1].held.append((*figures, hashlib.sha256(ends).hexdigest()))
        self.out += [("done", None, None, node.least, *h, None, None) for h in node.held]

    def finish(self) -> None:
        while self.open:
            self.close()


def prefix_nodes(convs: DataFrame, shard_rows: int = 4096, skeleton_bytes: int = SKELETON_BYTES) -> DataFrame:
    """The trie of (``conv_id``, ``path``, ``words``) rows, one row a node, as
    :func:`conversation_trie` returns it.  An empty table has no node."""
    spark = ship(convs.sparkSession)
    convs = stored(convs, "trie-paths")
    rows, longest = convs.agg(F.count(F.lit(1)), F.max(F.length("path"))).first()
    n = max(1, min(-(-rows // shard_rows), skeleton_bytes // max(longest or 0, 1)))
    # shards are numbered in the order of their paths
    ranged = stored(convs.repartitionByRange(n, "path", "conv_id").withColumn("shard", F.spark_partition_id().cast("long")), "trie-ranged")
    ends = ranged.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")).orderBy("shard").collect()  # n rows
    cut = [bytes(b["first"])[:shared(bytes(a["last"]), bytes(b["first"])) * KEY] for a, b in zip(ends, ends[1:])]
    splitters = dict(zip((r["shard"] for r in ends), zip([None, *cut], [*cut, None])))
    skeleton = spark.sparkContext.broadcast(splitters)  # at most skeleton_bytes

    def walk(batches):
        out: list = []
        at = None
        for batch in batches:
            for shard, path, conv_id, words in zip(batch["shard"], batch["path"], batch["conv_id"], batch["words"]):
                if at is None or at.shard != shard:
                    if at is not None:
                        at.finish()
                    at = _Shard(int(shard), *skeleton.value[int(shard)], out)
                at.add(path, int(conv_id), words)
            if len(out) > 10_000:
                yield frame(out)
                out.clear()
        if at is not None:
            at.finish()
        yield frame(out)

    def frame(out):
        table = pd.DataFrame(out, columns=NAMES)
        for c in ("parent_conv_id", "conv_id", "depth", *FIGURES, "shard"):
            table[c] = table[c].astype("Int64")
        return table

    parts = stored(ranged.repartition(max(n, 1), "shard").sortWithinPartitions("shard", "path", "conv_id")
                   .mapInPandas(walk, PARTS), "trie-parts")
    part = parts.where("kind = 'part'")

    def ends_of(batches):
        key = digest = None
        for batch in batches:
            got = []
            for k, piece in zip(batch["key"], batch["ends"]):
                if k != key:
                    if key is not None:
                        got.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(piece)
                else:
                    digest.update(b"," + piece)
            yield pd.DataFrame(got, columns=["key", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "ends_sha256"])

    # A digest takes its bytes one after the other: the ends of one node are streamed through one
    # task, a row of joined ids for each shard.
    ends = (part.where("ends IS NOT NULL").select("key", "shard", "ends").repartition("key")
            .sortWithinPartitions("key", "shard").mapInPandas(ends_of, "key binary, ends_sha256 string"))
    nodes = stored(part.groupBy("key", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in FIGURES])
                   .join(ends, "key", "left"), "trie-skeleton")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *FIGURES, "ends_sha256"]
    under = parts.where("kind = 'under'").drop("parent_conv_id").join(above, "parent")
    top = nodes.join(above, "parent", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE_SHA)))
    return parts.where("kind = 'done'").select(columns).unionByName(under.select(columns)).unionByName(top.select(columns))


def conversation_trie(conversations: DataFrame, *, shard_rows: int = 4096) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 (op12's contract).

    Turns go by ``turn`` with nulls first, equal ones by role and text; repeated rows are turns
    of their own.  Null roles and texts are empty; rows with a null conv_id are no
    conversation and take no part; c % 20 of a negative id is not negative.  An empty table
    has no node; other columns are not read.  One conversation must fit a task.
    """
    return prefix_nodes(rebuild(paths(conversations)), shard_rows)
