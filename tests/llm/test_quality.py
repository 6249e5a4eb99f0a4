import re
import zlib

import numpy as np
import pytest

from feedworks.llm import quality

SF01 = "/root/testdata/sf0.01"


def features(text, bits=18):
    doc, f = quality.feature_pairs([text], bits)
    return set(f.tolist())


def test_held_out_accuracy_and_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.score_quality(docs, labels)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in known if rows[i].held_out]
    right = sum(rows[i].predicted == known[i] for i in held)
    assert right >= 0.97 * len(held) and len(held) > 30
    good = [rows[i].score for i in held if known[i] == 1]
    bad = [rows[i].score for i in held if known[i] == 0]
    # order of the scores: a good text above a bad one
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_held_out_labels_are_not_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = ({r.doc_id: r.score for r in quality.score_quality(docs, x).collect()} for x in (labels, turned))
    assert a == b
    renamed = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source")
    assert {r.doc_id: r.score for r in quality.score_quality(renamed, labels).collect()} == a


def test_features_depend_on_the_text_alone():
    texts = ["One two  two three!!", "", None, "é ü ### ### ###", " \n", "one TWO", "x"]
    doc, f = quality.feature_pairs(texts, 18)
    for i, t in enumerate(texts):
        assert set(f[doc == i].tolist()) == features(t)
    assert features("") == features(None) == features(" \t") == set()
    assert features("a  b\nc") == features("a b c") and features("a b") != features("b a")
    assert len(features("word word word word")) < len(features("one two three four"))


def test_hinge_fit_closes_the_duality_gap():
    rng = np.random.default_rng(3)
    n, size = 120, 40
    docs = [np.unique(rng.integers(0, size, 8)).astype(np.int32) for _ in range(n)]
    y = np.where([3 in d or 5 in d for d in docs], 1.0, -1.0)
    y[:6] *= -1
    ratio = rng.standard_normal(size)
    ratio[7] = 0.0
    w, bias = quality.fit_hinge(docs, y, ratio, 1.0, 400, 1)
    x = np.zeros((n, size))
    for i, d in enumerate(docs):
        x[i, d] = ratio[d]
        x[i] /= max(np.sqrt((x[i] ** 2).sum()), 1e-12)
    inner = np.divide(w, ratio, out=np.zeros(size), where=ratio != 0)
    assert w[7] == 0.0
    loss = 0.5 * (inner @ inner + bias ** 2) + np.maximum(0, 1 - y * (x @ inner + bias)).sum()
    for step in (1e-1, 1e-2, 1e-3):  # no move lowers the convex loss, but for the tolerance of the fit
        for _ in range(300):
            d, e = rng.standard_normal(size) * step, rng.standard_normal() * step
            d[7] = 0.0
            moved = 0.5 * ((inner + d) @ (inner + d) + (bias + e) ** 2) + np.maximum(0, 1 - y * (x @ (inner + d) + bias + e)).sum()
            assert moved >= loss * (1 - 5e-4)


def test_odd_rows(spark):
    data = [(i, f"good words here number {'abcdefgh'[i % 8]} and more", "x") for i in range(40)]
    data += [(100 + i, f"BAD!! ### $$$ {'abcdefgh'[i % 8]}!! ###", "x") for i in range(40)]
    data += [(200, None, "x"), (201, "", "x"), (None, "good words here", "x"), (5, data[5][1], "x"), (202, "good words " * 40000, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(40)]
                                   + [(7, 1, 0), (None, 0, 0), (8, None, 0), (109, 1, 0), (109, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(data)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[5]) == 2 and by[5][0] == by[5][1]
    assert by[200][0].score == by[201][0].score and not by[None][0].held_out
    assert all(by[i][0].predicted == 1 for i in range(40)) and all(by[100 + i][0].predicted == 0 for i in range(40))
    assert quality.score_quality(docs.where("false"), labels).collect() == []
    assert quality.keep_quality(docs.where("false"), labels).columns == docs.columns
    bare = quality.score_quality(docs, labels.where("false")).collect()  # nothing to learn from
    assert {r.score for r in bare} == {0.5}
    one = quality.score_quality(docs, labels.where("quality = 1")).collect()
    assert all(r.predicted == 1 for r in one if r.doc_id is not None and r.doc_id < 40)


@pytest.mark.parametrize("bound", [20, 10**6])
def test_the_sample_is_bounded_and_the_same_each_time(spark, bound):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    a, b = (quality.fit(docs, labels, max_rows=bound) for _ in range(2))
    assert np.array_equal(a.features, b.features) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def brute_features(text):
    """Words, word pairs and runs of one to three token shapes, as tuples instead of hashes."""
    def kind(byte):
        return "a" if 97 <= byte <= 122 else "A" if 65 <= byte <= 90 else "0" if 48 <= byte <= 57 else "u" if byte > 127 else byte
    tokens = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    shapes = [(kind(t[0]), kind(t[min(1, len(t) - 1)]), kind(t[-1]), i > 0 and tokens[i - 1] == t) for i, t in enumerate(tokens)]
    out = {("w", t) for t in tokens} | {("ww", *tokens[i:i + 2]) for i in range(len(tokens) - 1)}
    return out | {("s", *shapes[i:i + n]) for n in (1, 2, 3) for i in range(len(shapes) - n + 1)}


def brute_scores(train, texts, bits=18, min_docs=3):
    """Scores by plain dictionaries and a projected gradient on the whole dual problem."""
    seen = {1: {}, -1: {}}
    for text, y in train:
        for f in brute_features(text):
            seen[y][f] = seen[y].get(f, 0) + 1
    sums = {y: sum(seen[y].values()) + 2 ** bits for y in seen}
    ratio = {f: np.log((seen[1].get(f, 0) + 1) / sums[1]) - np.log((seen[-1].get(f, 0) + 1) / sums[-1])
             for f in {*seen[1], *seen[-1]} if seen[1].get(f, 0) + seen[-1].get(f, 0) >= min_docs}
    names = {f: i for i, f in enumerate(ratio)}

    def row(text):
        v = np.zeros(len(names) + 1)
        for f in brute_features(text):
            if f in names:
                v[names[f]] = ratio[f]
        v /= max(np.sqrt((v * v).sum()), 1e-12)
        v[-1] = 1.0
        return v

    x, y = np.array([row(t) for t, _ in train]), np.array([y for _, y in train], float)
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha, step = np.zeros(len(y)), 1 / np.linalg.norm(q, 2)
    for _ in range(20000):
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, 1)
    w = x.T @ (alpha * y)
    return [1 / (1 + np.exp(-4 * (row(t) @ w))) for t in texts]


def test_scores_are_those_of_a_plain_version(spark):
    rng = np.random.default_rng(11)
    good, bad = "the river runs under old stone bridges at dawn".split(), "BUY now!! $$$ click 4free win win ### x9".split()
    data = []
    for i in range(90):
        mixed = [str(rng.choice(good if rng.random() < (0.8 if i % 2 else 0.35) else bad)) for _ in range(int(rng.integers(3, 25)))]
        data.append((i, " ".join(mixed), i % 2))
    data += [(90, "", 0), (91, None, 1), (92, "é ü \n the river", 1), (93, "never seen words", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, quality int")
    out = {r.doc_id: r for r in quality.score_quality(docs.drop("quality"), docs.select("doc_id", "quality"), epochs=3000).collect()}
    learnt = [(t, 1 if y else -1) for i, t, y in data if zlib.crc32(str(i).encode()) % 5]
    want = brute_scores(learnt, [t for _, t, _ in data])
    for (i, _, _), score in zip(data, want):
        assert out[i].score == pytest.approx(score, abs=0.02)
        assert out[i].predicted == int(out[i].score >= 0.3)
    assert len({round(s, 2) for s in want}) > 20


def test_the_features_of_the_sample_are_bounded(spark):
    long = " ".join(f"w{i}" for i in range(5000))
    data = [(i, f"good words {i % 7} here" if i % 2 else f"BAD!! ### {i % 7} $$$") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(1000, 1), (1001, 0)], "doc_id long, quality int")
    few = spark.createDataFrame(data, "doc_id long, text string")
    more = few.union(spark.createDataFrame([(1000, long), (1001, "again and again")] + [(1001, "again and again")] * 3000, "doc_id long, text string"))
    # the long text and the repeated id lie in slices that don't fit; all other slices are learnt from
    free, bound = quality.fit(more, labels), quality.fit(more, labels, max_bytes=60_000)
    assert len(bound.features) and len(bound.features) < len(free.features)
    rows = {r.doc_id: r.predicted for r in quality.score_quality(few, labels, max_bytes=60_000).collect()}
    assert all(rows[i] == i % 2 for i, _ in data)
    nothing = quality.fit(few, labels, max_bytes=0)
    assert len(nothing.features) == 0 and nothing.bias == 0.0
