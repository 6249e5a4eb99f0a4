import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from feedworks.llm import suffix

SF001 = "/root/testdata/sf0.001"


def brute_shared(rows, words):
    """Bytes under runs of so many words that begin twice or more."""
    texts = [[(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in rows]
    run = lambda w, k: tuple(x for _, _, x in w[k:k + words])
    seen = Counter(run(w, k) for w in texts for k in range(len(w) - words + 1))
    out = []
    for w in texts:
        under = set()
        for k in range(len(w) - words + 1):
            if seen[run(w, k)] > 1:
                under.update(range(w[k][0], w[k + words - 1][1]))
        out.append(len(under))
    return out


def brute(rows, length, words=51):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for (i, b), shared in zip(raw, brute_shared(rows, words)):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), shared))
    return sorted(out, key=str)


def got(df, **args):
    return sorted((tuple(r) for r in suffix.remove_repeats(df, **args).collect()), key=str)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 400)
    assert got(docs) == want and any(r[2] for r in want)


@pytest.mark.parametrize("length,gram,variants", [(400, 96, 128), (40, 8, 128), (40, 8, 1), (30, 30, 2)])
def test_shared_passages_and_odd_rows(spark, length, gram, variants):
    rng = random.Random(length + variants)
    word = lambda: "".join(rng.choice("abcdeéü🙂 \n") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(90) for _ in range(4)]
    rows = [(i, prose(rng.randint(0, 40)) + rng.choice(passages)[rng.randint(0, 30):] + prose(rng.randint(0, 20))) for i in range(40)]
    rows += [(100, passages[0] * 2), (101, "ab" * 900), (102, None), (103, ""), (None, passages[1]), (None, None),
             (104, "same row " * 60), (104, "same row " * 60), (105, "x" * (length - 1)), (106, "x" * (length - 1)), (107, "q" * length),
             (108, prose(4000))]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, block string")
    words = max(2, length // 8)
    assert got(df, length=length, gram=gram, variants=variants, words=words) == brute(rows, length, words)
    assert got(spark.createDataFrame([], df.schema)) == []


def test_kept_bytes_and_spans(spark):
    line = "".join(chr(97 + i * 7 % 26) for i in range(500))
    df = spark.createDataFrame([(1, "one " + line), (2, line + " two")], "doc_id long, text string")
    rows = {r.doc_id: (bytes(r.kept), r.spans) for r in suffix.remove_repeats(df, with_kept=True).collect()}
    assert rows == {1: (b"one ", [[4, 504]]), 2: (b" two", [[0, 500]])}


@pytest.mark.parametrize("variants", [2048, 3])
def test_short_passages_of_over_50_words_are_told(spark, variants):
    """51 words of one to three letters, far under 400 bytes, in other surroundings and with other
    white space; 50 words are not told, nor is one that has one word changed."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklm") for _ in range(n))
    prose = lambda n: " ".join(word(rng.randint(5, 9)) for _ in range(n))
    passages = [[word(rng.randint(1, 3)) for _ in range(51)] for _ in range(3)]
    rows = [(i, f"{prose(30)} {' '.join(passages[0])} {prose(30)}") for i in range(8)]
    rows += [(20, f"{prose(9)}\n" + "\n ".join(passages[1])), (21, "\t".join(passages[1]) + f" {prose(9)}")]
    rows += [(30, f"{prose(60)} {' '.join(passages[2][:50])} {prose(60)}"), (31, f"{prose(60)} {' '.join(passages[2][:50])} {prose(60)}")]
    rows += [(32, " ".join([*passages[2][:25], "other", *passages[2][26:]])), (40, prose(400)), (41, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = got(df, variants=variants)
    assert out == brute(rows, 400)
    shared = {r[0]: r[5] for r in out}
    assert all(shared[i] for i in (*range(8), 20, 21)) and not any(shared[i] for i in (30, 31, 32, 40, 41))


def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(2)
    for n, letters in ((1, 2), (9, 1), (300, 2), (500, 4)):
        t = rng.integers(97, 97 + letters, n).astype(np.uint8)
        raw = t.tobytes()
        order = suffix.suffix_array(t, 4 * n)
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        shared = suffix.common_prefixes(t, order, np.array([0, *range(7, n, 50)]), 60)
        for a, b in zip(order, order[1:]):
            k = 0
            while k < 60 and max(a, b) + k < n and raw[a + k] == raw[b + k]:
                k += 1
            assert shared[b] == k


@pytest.mark.parametrize("seed", range(6))
def test_long_repeats_with_an_order_of_limited_depth(seed):
    """Copies much longer than the depth that go on differently: nothing is taken for repeated
    that is not."""
    rng = random.Random(seed)
    line = lambda n: bytes(rng.choice(b"ab") for _ in range(n))
    passage = line(150)
    contents = [line(rng.randint(0, 6)) + passage[rng.randint(0, 30):rng.randint(100, 150)] + line(rng.randint(0, 6)) for _ in range(40)]
    contents += [b"ab" * 60, b"ab" * 61, passage * 2]
    weights = np.array([1] * (len(contents) - 1) + [2])
    length = 20
    seen = Counter()
    for c, w in zip(contents, weights):
        for k in range(len(c) - length + 1):
            seen[c[k:k + length]] += int(w)
    got = suffix.repeated_windows(contents, weights, length)
    assert [m.tolist() for m in got] == [[seen[c[k:k + length]] >= 2 for k in range(len(c) - length + 1)] for c in contents]
    text = np.frombuffer(b"\xff".join(contents) + b"\xff", np.uint8)
    order = suffix.suffix_array(text, length)
    starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in contents])[:-1]])
    shared = suffix.common_prefixes(text, order, starts, length)
    raw = text.tobytes()
    for a, b in zip(order.tolist(), order[1:].tolist()):
        k = 0
        while k < length and max(a, b) + k < len(raw) and raw[a + k] == raw[b + k]:
            k += 1
        assert shared[b] == k


def test_equal_ranks_for_equal_windows_of_any_length():
    """The last doubling ends at the window's length itself, also under eight bytes and next to NULs."""
    rng = random.Random(3)
    for length in (2, 3, 7, 8, 9, 12, 16, 31):
        contents = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(length, 60))) for _ in range(30)] + [b"ab" * 40, b"\0" * 50]
        weights = np.array([1] * 31 + [3])
        seen = Counter()
        for c, w in zip(contents, weights):
            for k in range(len(c) - length + 1):
                seen[c[k:k + length]] += int(w)
        want = [[seen[c[k:k + length]] >= 2 for k in range(len(c) - length + 1)] for c in contents]
        assert [m.tolist() for m in suffix.repeated_windows(contents, weights, length)] == want
        numbers = [np.frombuffer(c, np.uint8).astype(np.int64) for c in contents]
        assert [m.tolist() for m in suffix.repeated_windows(numbers, weights, length)] == want


def test_hot_anchor_makes_a_row_for_a_slot_and_goes_to_arrays(spark, monkeypatch):
    """One passage in many surroundings: its segments are cut into a few slots each, not into a row for
    each window, and what is left of them meets in suffix arrays."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, side = noise(300), noise(120)
    rows = [(i, noise(rng.randint(130, 200)) + passage + noise(rng.randint(130, 200))) for i in range(60)]
    rows += [(100 + i, side[i:] + passage + side[:100 - i]) for i in range(0, 40, 7)] + [(i + 500, t) for i, t in rows[:4]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept, before = {}, suffix.stored

    def keep(rows, name):
        kept.setdefault(name, []).append(out := before(rows, name))
        return out

    monkeypatch.setattr(suffix, "stored", keep)
    assert got(df, variants=8) == brute(rows, 400)
    contents = kept["sa-contents"][0].where("variants > 8")
    segments, windows = contents.count(), contents.selectExpr("sum(length(content) - 399)").first()[0]
    assert segments > 60 and windows > 50 * segments
    assert segments <= kept["sa-slots"][0].count() < windows / 15
    # no more slots than four of each slot before, and one
    for above, slots in zip(kept["sa-slot-contents"], kept["sa-slots"][1:]):
        assert slots.count() <= 5 * above.where("variants > 8").count()
    assert "sa-many" not in kept and "sw-many" not in kept
