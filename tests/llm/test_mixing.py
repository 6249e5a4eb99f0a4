import hashlib
import re
from collections import defaultdict

import duckdb
import pytest

from feedworks.llm import mixing

SF001 = "/root/testdata/sf0.001"


def split(budget, kids):
    """kids: {name: (cap, weight)}; plain water filling, one full child at a time."""
    left = {k: (c, w) for k, (c, w) in kids.items() if w > 0}
    out, budget = {k: 0 for k in kids}, min(budget, sum(c for c, _ in left.values()))
    while left:
        total = sum(w for _, w in left.values())
        full = [k for k, (c, w) in left.items() if c * total <= budget * w]
        if not full:
            for k, (_, w) in left.items():
                out[k] = budget * w // total
            break
        k = min(full, key=lambda k: (left[k][0] / left[k][1], k))
        out[k] = left.pop(k)[0]
        budget -= out[k]
    return out


def brute(rows, weights, share, epochs, seed):
    leaves = defaultdict(list)
    for doc_id, text, lang, source in rows:
        digits = re.search(r"([0-9]{1,9})$", source or "")
        domain = f"domain{int(digits[1]) % 4}" if digits else "(none)"
        leaves[domain, lang or "(none)", source or "(none)"].append((doc_id, len((text or "").encode().split())))
    have = {k: sum(n for _, n in v) for k, v in leaves.items()}

    def cap(prefix):  # what weights of 0 further down shut off can't be spent
        return sum(n * epochs for k, n in have.items() if k[:len(prefix)] == prefix and all(
            weights.get(level, {}).get(name, 1) > 0 for level, name in list(zip(mixing.LEVELS, k))[len(prefix):]))

    def down(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        level = mixing.LEVELS[len(prefix)]
        kids = {k[len(prefix)] for k in have if k[:len(prefix)] == prefix}
        got = split(budget, {c: (cap((*prefix, c)), weights.get(level, {}).get(c, 1)) for c in kids})
        return {k: v for c in kids for k, v in down((*prefix, c), got[c]).items()}

    out = []
    for leaf, tokens in down((), sum(have.values()) * share[0] // share[1]).items():
        whole, rest = divmod(tokens, have[leaf]) if have[leaf] else (0, 0)
        name = lambda i: "" if i is None else str(i)
        place = lambda r: hashlib.md5(":".join([str(seed), str(whole + 1), name(r[0])]).encode()).hexdigest()
        total = defaultdict(int)
        for r in leaves[leaf]:
            total[place(r), name(r[0])] += r[1]
        run, taken = 0, set()
        for k in sorted(total):
            run += total[k]
            if rest and run <= rest:
                taken.add(k)
        out += [(r[0], *leaf, r[1], whole + ((place(r), name(r[0])) in taken)) for r in leaves[leaf]]
    return sorted(out, key=str)


@pytest.mark.parametrize("weights,share,epochs", [(mixing.WEIGHTS, (1, 1), 3), ({}, (1, 2), 1),
                                                  ({"domain": {"domain1": 0}, "source": {"src3": 50}}, (5, 1), 2),
                                                  ({"lang": {"en": 0, "de": 3}, "domain": {"domain2": 0}}, (4, 5), 1)])
def test_matches_brute_force(spark, weights, share, epochs):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    got = mixing.mix(docs, weights=weights, share=share, max_epochs=epochs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, weights, share, epochs, 11)


def test_oracle_and_taken_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = sorted(con.sql(mixing.oracle_sql()).fetchall())
    got = mixing.mix(docs, weights=mixing.WEIGHTS)
    assert sorted(tuple(r) for r in got.collect()) == want
    taken = mixing.take_mix(docs, weights=mixing.WEIGHTS)
    assert taken.columns == docs.columns
    zero = {"lang": {"en": 0, "de": 3}, "domain": {"domain2": 0}}
    want_zero = sorted(con.sql(mixing.oracle_sql(zero, (4, 5), 1)).fetchall())
    assert sorted(tuple(r) for r in mixing.mix(docs, weights=zero, share=(4, 5), max_epochs=1).collect()) == want_zero
    assert sorted(r.doc_id for r in taken.collect()) == sorted(i for i, *_, n in want for _ in range(n))


def test_odd_rows(spark):
    data = [(1, None, "en", "src1", "x", 1), (2, "", None, None, "x", 1), (None, "a b c", "en", "src1", "x", 1),
            (4, "a b", "en", "src1", "x", 1), (4, "a b", "en", "src1", "x", 1), (5, "z " * 20000, "de", "web", "x", 1),
            (6, "one", None, "src2", "x", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, domain string, n_copies int")
    rows = [r[:4] for r in data]
    for share, epochs in (((1, 1), 1), ((3, 1), 3), ((1, 3), 2)):
        got = mixing.mix(docs, share=share, max_epochs=epochs)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, {}, share, epochs, 11)
        taken = mixing.take_mix(docs, share=share, max_epochs=epochs)
        assert taken.columns == docs.columns
        assert taken.count() == sum(r.n_copies for r in got.collect())
    empty = spark.createDataFrame([], docs.schema)
    assert mixing.mix(empty).collect() == [] and mixing.take_mix(empty).collect() == []


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "en", "s1", 10, 1), ("a", "en", "s2", 1000, 9), ("b", "en", "s3", 1000, 9)],
        "domain string, lang string, source string, available long, n_docs long")
    got = {r.source: r.tokens for r in mixing.leaf_budgets(leaves, {}, 1, (1, 1), 800).collect()}
    assert got == {"s1": 10, "s2": 390, "s3": 400}


@pytest.mark.parametrize("weights,want", [
    ({"source": {"s1": 0}}, {"s1": 0, "s2": 100, "s3": 900, "s4": 0}),  # the shortage of a goes to its sibling b
    ({"source": {"s1": 0, "s3": 0}}, {"s1": 0, "s2": 100, "s3": 0, "s4": 900}),  # and that of all of d to e
    ({"lang": {"a": 0}}, {"s1": 0, "s2": 0, "s3": 500, "s4": 500}),
    ({"lang": {"a": 0, "b": 0}}, {"s1": 0, "s2": 0, "s3": 0, "s4": 1000})])
def test_weight_zero_leaves_its_share_to_others(spark, weights, want):
    data = [("d", "a", "s1", 1000, 9), ("d", "a", "s2", 100, 1), ("d", "b", "s3", 1000, 9), ("e", "c", "s4", 1000, 9)]
    if weights == {"source": {"s1": 0}}:
        data[3] = ("d", "b", "s4", 0, 1)
    leaves = spark.createDataFrame(data, "domain string, lang string, source string, available long, n_docs long")
    got = {r.source: r.tokens for r in mixing.leaf_budgets(leaves, weights, 1, (1, 1), 1000).collect()}
    assert got == want
