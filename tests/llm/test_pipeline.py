import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_mixing import brute as mixed
from test_secrets import brute as secrets_in
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from feedworks.llm import bpe, quality

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001).cache()
        out.append((name, docs))
    return dict(out)


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "secrets", "mixing", "bpe"]
    for name in ("quality", "simhash", "secrets", "mixing"):
        assert stages[name].columns == stages["documents"].columns


def test_quality_keeps_what_the_classifier_predicts(spark, stages):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    want = {r.doc_id for r in quality.score_quality(stages["documents"], labels).where("predicted = 1").collect()}
    assert set(rows(stages["quality"])) == want
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(known[i] for i in known if i not in want) == 0  # clean documents stay


def test_simhash_keeps_the_smallest_id_of_each_group(stages):
    before = rows(stages["quality"])
    fp = {i: brute_fingerprint(r.text) for i, r in before.items()}
    near = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3]
    assert rows(stages["simhash"]) == {i: before[i] for i in set(brute_components(list(fp), near).values())}


def test_secrets_leave_and_clean_texts_stay(stages):
    before, after = rows(stages["simhash"]), rows(stages["secrets"])
    assert before.keys() == after.keys()
    for i, r in before.items():
        found = secrets_in(r.text)[:3]
        assert secrets_in(after[i].text)[:3] == (0, 0, 0) and (after[i] == r or any(found))
        if any(found):
            assert "[SECRET]" in after[i].text and after[i].n_chars == len(after[i].text)


def test_mix_and_tokens(stages):
    before, mix = rows(stages["secrets"]), corpus_pipeline.MIX
    want = {r[0]: r[-1] for r in mixed([(i, r.text, r.lang, r.source) for i, r in before.items()], mix["weights"], mix["share"],
                                       mix["max_epochs"], 11)}
    after = rows(stages["mixing"])
    assert after == {i: before[i] for i, n in want.items() if n} and 0 < len(after) < len(before)
    copies = Counter(r.doc_id for r in stages["mixing"].collect())
    assert copies == {i: n for i, n in want.items() if n} and max(copies.values()) == 2  # the weights take effect
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    ids = {i: enc.encode_ordinary(r.text) for i, r in after.items()}
    assert Counter(r.doc_id for r in stages["bpe"].collect()) == copies
    assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for i, r in rows(stages["bpe"]).items()} == {
        i: (len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(after[i].text.encode()).hexdigest())
        for i, x in ids.items()}


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF001).collect())) == sorted(map(tuple, stages["bpe"].collect()))


def test_stages_on_odd_rows(spark, tmp_path):
    data = [(1, None, "en", None, None, "x"), (2, "", None, "src1", 0, "x"), (None, "token=abcdefghijklmnop", "en", "src2", 22, "x"),
            (4, "some text with a few words", "en", "src2", 26, "x"), (4, "some text with a few words", "en", "src2", 26, "x"),
            (4, "quite another text under one id", "en", "src2", 31, "x"), (7, "long words " * 20000, "de", "web", 1, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, __row string")
    labels = spark.createDataFrame([(4, 1, 0), (7, 1, 0), (7, 0, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for some in (docs.withColumnRenamed("__row", "n_tokens"), docs.where("false").withColumnRenamed("__row", "fp")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, str(tmp_path))
            assert out.columns == some.columns
            if some.where("doc_id = 4").count():
                assert out.count() > 0
            else:
                assert out.count() == 0
        assert bpe.encode_documents(some, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == some.count()
    kept = corpus_pipeline.simhash_stage(spark, docs.drop("__row"), str(tmp_path))
    assert sorted((str(r.doc_id), str(r.text)[:10]) for r in kept.collect()) == [
        ("1", "None"), ("4", "quite anot"), ("4", "some text "), ("7", "long words"), ("None", "token=abcd")]
    assert kept.select(F.countDistinct("text")).first()[0] == 4
