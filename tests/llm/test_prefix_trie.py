import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from feedworks.llm import prefix_trie

SF001 = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[c] for c in children[p])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def got(df, **args):
    key = lambda r: tuple(x if x is not None else -10**9 for x in r)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, **args).collect()), key=key)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(x if x is not None else -10**9 for x in r))


@pytest.mark.parametrize("shard_rows", [4096, 3])
def test_conversations_match_brute_force(spark, shard_rows):
    df = spark.read.parquet(f"{SF001}/conversations.parquet")
    assert got(df, shard_rows=shard_rows) == ordered(brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]))


@pytest.mark.parametrize("seed,shard_rows", [(1, 1), (2, 5), (3, 1000)])
def test_odd_rows_and_hot_paths(spark, seed, shard_rows):
    """Null columns, ties, repeated rows, missing bases, a conversation that a third of all ids
    hold, chains of equal turns, and one deep conversation."""
    rng = random.Random(seed)
    texts = ["", None, "a", "a b", "same  words\n here", "x\ty\x0bz", "é 🙂"]
    rows = []
    for c in range(-25, 90):
        if c % 20 == 0 and rng.random() < 0.5:
            continue
        if rng.random() < 0.33:
            rows += [(c, t, "user", f"hot {t}") for t in range(3)]
        else:
            rows += [(c, rng.choice([None, 0, 1, 1, 2]), rng.choice(["user", "bot", None]), rng.choice(texts)) for _ in range(rng.randint(1, 5))]
    rows += [(200, t, "user", "again") for t in range(60)] + [(201, t, "user", "again") for t in range(45)]
    rows += [(None, 1, "user", "nobody"), (-3, 2, "user", "a"), (-3, 2, "user", "a"), (10**12, 0, "user", "far " * 50_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, b"z", 1) for r in rows], SCHEMA + ", path binary, depth int")
    assert got(df, shard_rows=shard_rows) == ordered(brute(rows))


def test_no_rows_no_nodes(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)) == []


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]  # its base is absent, and it has no turn past its third
    assert got(spark.createDataFrame(rows, SCHEMA)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_skeleton_stays_within_its_bytes(spark):
    """Splitter paths longer than the bound leave fewer shards, never another result."""
    rows = [(c, t, "user", f"{t if t < 30 else c}") for c in range(1, 40) for t in range(34)]
    df = spark.createDataFrame(rows, SCHEMA)
    convs = prefix_trie.rebuild(prefix_trie.paths(df))
    want = ordered(brute(rows))
    for limit in (1, 34 * 32 * 3, 1 << 20):
        assert ordered(tuple(r) for r in prefix_trie.prefix_nodes(convs, 2, limit).collect()) == want


def test_shared_keys():
    a = bytes(range(32)) * 3
    assert [prefix_trie.shared(a, b) for b in (a, a[:64], a[:64] + b"z" * 32, b"z" * 96, b"")] == [3, 2, 2, 0, 0]
