import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from feedworks.llm import bpe

SF001 = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return bpe.codec(f.read(), PATTERN)


def expected(reference, text):
    ids = reference.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_documents_match_the_public_encoder(spark, reference):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:] for r in bpe.encode_documents(docs, PATH, PATTERN).collect()}
    assert got == {i: expected(reference, t) for i, t in texts.items()}


def test_odd_rows_and_round_trip(spark, reference):
    data = [(1, None, "a"), (2, "", "b"), (None, " \n\n x", "c"), (4, "<|endoftext|>", "d"), (4, "<|endoftext|>", "d"),
            (5, "a" * 5000 + "\U0001F469‍" * 300, "e"), (6, "wörd " * 30000, "f")]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_tokens string")
    got = bpe.encode_documents(docs, PATH, PATTERN, with_ids=True)
    rows = bpe.decode_documents(got, PATH, PATTERN).collect()
    key = lambda i, t: (-1 if i is None else i, *expected(reference, t), (t or "").encode())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.decoded))
                  for r in rows) == sorted(key(i, t) for i, t, _ in data)
    assert bpe.encode_documents(spark.createDataFrame([], docs.schema), PATH, PATTERN).collect() == []


def test_random_bytes_merge_exactly(reference, own):
    rng = random.Random(3)
    short = [t for t in own.ranks if len(t) < 6]
    for _ in range(3000):
        data = b"".join(rng.choice(short) for _ in range(rng.randint(1, 14)))
        want = [own.ranks[data]] if data in own.ranks else reference._encode_single_piece(data)
        assert own.encode_piece(data) == want
    for _ in range(1500):
        text = "".join(rng.choice("aab ceé中  \n'tsthinger0 12🙂_-=AB‍") for _ in range(rng.randint(0, 90)))
        assert own.encode(text) == reference.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()


def test_small_vocabulary_with_backtracking():
    ranks = {bytes([b]): i for i, b in enumerate(b"abc")} | {b"ab": 3, b"bc": 4, b"abc": 5, b"cab": 6, b"bcab": 7}
    own = bpe.Codec(ranks, ".+")

    def merge(data):
        parts = [data[i:i + 1] for i in range(len(data))]
        while True:
            best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1)
                        if parts[i] + parts[i + 1] in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    rng = random.Random(5)
    for _ in range(2000):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 16)))
        assert own.encode_piece(data) == (merge(data) if data not in own.ids else merge(data))
