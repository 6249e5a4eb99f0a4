import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedworks.llm import katz

SF001 = "/root/testdata/sf0.001"
END, START, UNKNOWN = ("end",), ("start",), ("unknown",)


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), END]


class Model:
    """Katz's definition word by word; contexts are tuples of up to ``order`` - 1 tokens."""

    def __init__(self, texts, order=2):
        self.words, self.after, self.order = Counter(), defaultdict(Counter), order
        for t in texts:
            self.words.update(t)
            for context, w in self.places(t):
                for k in range(1, len(context) + 1):
                    self.after[context[-k:]][w] += 1
        self.n = sum(self.words.values())
        self.star1 = self.star(Counter(self.words.values()))
        self.stars = {k: self.star(Counter(c for x, by in self.after.items() if len(x) == k for c in by.values())) for k in range(1, order)}
        self.rest = 1 - sum(map(self.p1, self.words)) if self.n else 1.0
        self.left = {}

    def places(self, t):
        full = [START, *t]
        return [(tuple(full[max(0, i - self.order + 1):i]), full[i]) for i in range(1, len(full))]

    @staticmethod
    def star(n):
        small = katz.discounted([n[r] for r in range(1, 7)])
        return lambda c: small[c] if c < 6 else c - 1e-3

    def p1(self, w):
        return self.star1(self.words[w]) / self.n if self.words[w] else self.rest

    def p(self, context, w):
        if not context:
            return self.p1(w)
        seen, star = self.after.get(context), self.stars[len(context)]
        if not seen:
            return self.p(context[1:], w)
        total = sum(seen.values())
        if w in seen:
            return star(seen[w]) / total
        if context not in self.left:
            kept = 1 - sum(map(star, seen.values())) / total
            self.left[context] = kept / (1 - sum(self.p(context[1:], x) for x in seen))
        return self.left[context] * self.p(context[1:], w)


def brute(rows, folds=10, order=2):
    held = [i is not None and zlib.crc32(str(i).encode()) % folds == 0 for i, _ in rows]
    texts = [tokens(t) for _, t in rows]
    m = Model([t for t, h in zip(texts, held) if not h], order)
    size = 0.1 * (len(m.words) + 1)
    out = [(i, h, len(t), sum(w in m.words for w in t), m.n, sum(math.log10((m.words[w] + 0.1) / (m.n + size)) for w in t),
            sum(math.log10(m.p(a, w)) for a, w in m.places(t))) for (i, _), t, h in zip(rows, texts, held)]
    return m, sorted(out, key=lambda r: (str(r[0]), r[2], r[6]))


def check(df, rows, **args):
    m, want = brute(rows, order=args.get("order", 2))
    got = sorted((tuple(r) for r in katz.score_texts(df, **args).collect()), key=lambda r: (str(r[0]), r[2], r[6]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)
    return m, got


@pytest.mark.parametrize("order", [2, 3, 4])
def test_documents_match_brute_force(spark, order):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    m, got = check(docs, [(r.doc_id, r.text) for r in docs.collect()], order=order)
    assert sum(r[6] for r in got if r[1]) > sum(r[5] for r in got if r[1])  # held-out texts


@pytest.mark.parametrize("order,block_bytes,shard_bytes", [(2, 1 << 24, 1 << 24), (2, 300, 500), (3, 300, 500)])
def test_odd_rows(spark, order, block_bytes, shard_bytes):
    rows = [(i, f"the cat {i % 3} The\x0bdog\x1fx the the  cat\n") for i in range(60)]
    rows += [(100, None), (101, ""), (None, "null id"), (None, None), (7, "again the cat"), (7, "again the cat"), (103, "long " * 30000 + "É é"),
             (104, "</s>   wide space")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    check(df, rows, order=order, block_bytes=block_bytes, shard_bytes=shard_bytes)
    assert katz.score_texts(spark.createDataFrame([], df.schema), order=order).collect() == []
    only_held = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = katz.score_texts(spark.createDataFrame(only_held, "doc_id long, text string")).collect()
    assert all(r.held_out and r.n_tokens == 3 and r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in got)


def test_every_context_sums_to_one(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    m, _ = brute([(r.doc_id, r.text) for r in docs.collect()], order=3)
    by = sorted(m.after, key=lambda a: -sum(m.after[a].values()))
    some = [*[a for a in by if len(a) == 1][:2], *[a for a in by if len(a) == 2][:2], ("never", "seen"), ()]
    for a in some:
        assert abs(sum(m.p(a, w) for w in [*m.words, UNKNOWN]) - 1) < 1e-9


def test_order_below_two_is_an_error(spark):
    with pytest.raises(ValueError, match="order"):
        katz.score_texts(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), order=1)


def test_discounts():
    d = katz.discounted([1000, 300, 120, 60, 40, 25])
    assert all(0 < d[r] < r for r in range(1, 6))
    for gaps in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 9, 1, 9, 1, 9], [3, 1, 0, 0, 2, 7]):
        assert all(0 < katz.discounted(gaps)[r] < r for r in range(1, 6))
