import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from feedworks.llm import spelling

SF001 = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, odds=31):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % odds == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return out


def apart(s, t):
    """Whether one step leads from s to t, by all steps that there are."""
    if len(s) > len(t):
        s, t = t, s
    if len(s) == len(t):
        return sum(a != b for a, b in zip(s, t)) == 1
    return len(t) - len(s) == 1 and any(t[:i] + t[i + 1:] == s for i in range(len(t)))


def brute(rows):
    n = {w: c for w, c in brute_counts(rows).items() if c >= 2}
    # words one step apart share a text with one place left open
    blanks = {}
    for w in n:
        for i in range(len(w) + 1):
            blanks.setdefault(w[:i] + "\0" + w[i:], set()).add(w)
            if i < len(w):
                blanks.setdefault(w[:i] + "\0" + w[i + 1:], set()).add(w)
    near = {w: set() for w in n}
    for group in blanks.values():
        for w in group:
            near[w] |= {x for x in group if x != w and apart(w, x)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def got(df, **args):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in spelling.spelling_variants(df, **args).collect())


@pytest.mark.parametrize("region_words", [4096, 25])
def test_documents_match_brute_force(spark, region_words):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(docs, region_words=region_words) == want and any(r[4] for r in want)


def test_hot_vectors_chains_ties_and_odd_rows(spark):
    """Anagrams that share one vector (more than a region holds), a hot word, chains of forms, ties
    between forms, letters past ASCII, capitals that stay, words of many letters."""
    rng = random.Random(5)
    rows = []
    base = "eeaainr"
    anagrams = {"".join(rng.sample(base, len(base))) for _ in range(60)}
    for k, w in enumerate(sorted(anagrams)):
        rows += [(1000 + k, f"{w} {w}, {w}x {w}x")]
    rows += [(i, "chainaaa " * 2 + "chainaab " * 30 + "chainabb " * 400 + "chaicabb " * 5000) for i in range(1)]
    rows += [(2, "tiesbbb " * 2 + "tiesbba " * 20 + "tiesbbc " * 20), (3, "Ääöüßéé Ääöüßéé ÄÄöüßéé ÄÄöüßéé ääöüßéé ääöüßéé")]
    long = "long" * 40
    rows += [(4, f"{long} {long} {long}x {long}x {long[:80]}y{long[80:]} {long[:80]}y{long[80:]} {long[:70]}q{long[71:]} {long[:70]}q{long[71:]}")]
    rows += [(5, ("a" * 200 + " ") * 2 + ("a" * 199 + " ") * 2 + ("a" * 198 + " ") * 2), (6, None), (None, "nobodys words nobodys words"), (7, "")]
    rows += [(8, "repeated repeatad"), (8, "repeated repeatad"), (9, "short sharp w÷rdsxx×y w÷rdsxx×y 日本repeatedĀrepeated")]
    rows += [(i, " ".join("hot" + "".join(rng.choice("aeiou") for _ in range(rng.randint(4, 6))) for _ in range(80))) for i in range(20, 40)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, n int, word string")
    want = brute(rows)
    for region_words in (8, 4096):
        assert got(df, region_words=region_words) == want
    forms = {r[0]: (r[1], r[2]) for r in want}
    assert forms["chainaaa"] == ("chainaab", "chaicabb") or "chainaaa" not in forms
    assert got(spark.createDataFrame([], df.schema)) == []


def test_vectors_agree_between_spark_and_numpy(spark):
    words = ["abcdefg", "éèêëíóñÿ×÷", "z" * 90, "jqwxzfk"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    here = spelling.letters_of(words)[0]
    assert [[ord(c) - 48 for c in r[0]] for r in df.select(spelling.vector_column()).collect()] == here.tolist()


def test_search_reaches_what_the_budget_allows():
    rng = np.random.default_rng(3)
    vectors = rng.integers(0, 3, (400, spelling.LEVELS)) * (rng.random(spelling.LEVELS) < 0.3)
    order = np.lexsort(vectors.T[::-1])
    vectors = vectors[order]
    levels, first, last = spelling.arrange(vectors, 3)
    assert sorted(i for a, b in zip(first, last) for i in range(a, b)) == list(range(400))
    reached = [set() for _ in range(400)]
    for row, leaf, _ in spelling.search(levels, vectors, most=50):
        for r, f in zip(row.tolist(), leaf.tolist()):
            reached[r] |= set(range(first[f], last[f]))
    for i in range(400):
        d = vectors - vectors[i]
        near = np.flatnonzero((np.maximum(d, 0).sum(1) <= 1) & (np.maximum(-d, 0).sum(1) <= 1))
        assert set(near.tolist()) <= reached[i]
