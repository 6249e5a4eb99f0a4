import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from feedworks.llm import chunks, queries

SF001 = "/root/testdata/sf0.001"


def plain_cuts(b, least, bits, most):
    out, start, h = [], 0, 0
    for i, x in enumerate(b):
        h = (h * 2 + int(chunks._GEAR[x])) % 2**16
        size = i + 1 - start
        if size >= least and h >> (16 - bits) == 0 or size == most or i + 1 == len(b):
            out.append(i + 1)
            start = i + 1
    return out


def brute(rows, least=16, bits=4, most=512, min_run=180):
    docs = []
    for i, t in rows:
        b = (t or "").encode()
        ends = plain_cuts(b, least, bits, most)
        docs.append((i, b, [(p, q, b[p:q]) for p, q in zip([0, *ends], ends)]))
    count, first = Counter(c for _, _, cs in docs for *_, c in cs), {}
    for i, _, cs in docs:
        for *_, c in cs:
            if c not in first or first[c] is None or i is not None and i < first[c]:
                first[c] = i
    out = []
    for i, b, cs in docs:
        state = [count[c] >= 2 for *_, c in cs]
        keep, shared, removed = np.ones(len(b), bool), 0, 0
        k = 0
        while k < len(cs):
            j = k
            while j < len(cs) and state[j]:
                j += 1
            if j > k and cs[j - 1][1] - cs[k][0] >= min_run:
                shared += cs[j - 1][1] - cs[k][0]
                for m in range(k, j):
                    if first[cs[m][2]] != i or any(c[2] == cs[m][2] for c in cs[:m]):
                        keep[cs[m][0]:cs[m][1]] = False
            k = max(j, k + 1)
        kept = bytes(np.frombuffer(b, np.uint8)[keep])
        spans = int((np.diff(np.concatenate([[0], (~keep).astype(int)])) == 1).sum())
        out.append((i, len(b), len(cs), shared, len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **args):
    return sorted((tuple(r) for r in chunks.dedup_chunks(df, **args).collect()), key=str)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(docs) == want and any(r[4] for r in want)


@pytest.mark.parametrize("min_run,most,block_bytes", [(100, 512, 8 << 20), (0, 40, 700)])
def test_shared_passages_and_odd_rows(spark, min_run, most, block_bytes):
    rng = random.Random(min_run)
    prose = lambda n: " ".join("".join(rng.choice("abcdeéü🙂 ") for _ in range(rng.randint(1, 9))) for _ in range(n))
    passages = [prose(90) for _ in range(4)]
    rows = [(i, prose(rng.randint(0, 40)) + rng.choice(passages) + prose(rng.randint(0, 20))) for i in range(40)]
    rows += [(100, passages[0] * 2), (101, "ab" * 900), (102, None), (103, ""), (None, passages[1]), (None, None), (None, "null only " * 50),
             (104, "same row " * 60), (104, "same row " * 60), (105, "x" * 15), (106, "y" * 16), (108, prose(4000))]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, block string")
    assert got(df, min_run=min_run, most=most, block_bytes=block_bytes, shard_bytes=block_bytes) == brute(rows, min_run=min_run, most=most)
    assert got(spark.createDataFrame([], df.schema)) == []


def test_insertion_moves_only_nearby_cuts():
    rng = np.random.default_rng(8)
    b = rng.integers(97, 123, 20000).astype(np.uint8)
    moved = np.concatenate([b[:7000], np.frombuffer(b"inserted", np.uint8), b[7000:]])
    old, new = set(chunks.cuts(b, 16, 4, 512)), {c - 8 if c > 7000 else c for c in chunks.cuts(moved, 16, 4, 512)}
    assert len(old ^ new) < 12 and all(6500 < c < 8000 for c in old ^ new)


def test_passages_of_over_fifty_words_are_caught_and_single_lines_left(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "the", "ti", "es"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line = prose(13)
    rows, planted = [], {}
    for g in range(60):
        passage = prose(51)
        for i in (2 * g, 2 * g + 1):
            rows.append((i, f"{prose(rng.randint(3, 60))} {passage} {prose(rng.randint(3, 60))}"))
            planted[i] = g
    rows += [(1000 + i, f"{line}\n{prose(80)}\n{line}") for i in range(60)]
    out = {r.doc_id: r for r in chunks.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    caught = {planted[i] for i in planted if out[i].n_removed > 0}
    assert len(caught) >= 57 and all(out[2 * g].n_removed == 0 for g in range(60))
    assert all(out[1000 + i].n_shared == 0 for i in range(60))


@pytest.mark.parametrize("letters,least", [(4.5, 198), (3, 190)])
def test_passages_of_51_words_in_two_documents(spark, letters, least):
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(max(1, round(rng.gauss(letters, 1.5)))))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, line = [], prose(13)
    for g in range(200):
        passage = prose(51)
        rows += [(i, f"{prose(rng.randint(3, 60))} {passage} {prose(rng.randint(3, 60))}") for i in (2 * g, 2 * g + 1)]
    rows += [(1000 + i, f"{line}\n{prose(80)}\n{line}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in chunks.dedup_chunks(df, **chunks.PASSAGES).collect()}
    assert sum(out[2 * g + 1].n_removed > 0 for g in range(200)) >= least
    assert all(out[2 * g].n_removed == 0 for g in range(200)) and all(out[1000 + i].n_shared == 0 for i in range(60))


def test_short_exact_copies_go_whole(spark):
    tail = "a very long text that ends with these words and a few others before them, " * 4
    rows = [(0, tail + "Thank you."), (1, "Thank you."), (2, "Thank you."), (3, "Thank you!"), (None, "Thank you."), (4, ""), (5, ""),
            (6, "seven words are quite enough for it"), (6, "seven words are quite enough for it"), (7, "x" * 179), (8, "x" * 179),
            (None, "twice without an id"), (None, "twice without an id")]
    out = chunks.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string"), **chunks.PASSAGES, block_bytes=40).collect()
    gone = sorted((str(r.doc_id), r.n_removed, r.n_spans) for r in out if r.doc_id != 0 and r.n_removed)
    assert gone == [("2", 10, 1), ("8", 179, 1), ("None", 10, 1)]
    assert all(r.kept_sha256 == hashlib.sha256(b"").hexdigest() for r in out if r.doc_id in (2, 8))


def test_query_removes_every_short_copy_of_the_documents(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    first = {}
    for i, b in sorted(docs):
        first.setdefault(b, i)
    short = {i for i, b in docs if 0 < len(b) < 180 and first[b] != i}
    out = {r.doc_id: r for r in queries.op9_chunks(spark, "/root/testdata/sf0.01").collect()}
    assert len(short) == 4 and all(out[i].n_removed == out[i].n_bytes for i in short)
