import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from feedworks.llm import pieces

SF001 = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
# spaces in runs and at both ends, literal markers, names of special pieces, bytes without a piece
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", " \n ", "▁", "▁▁ ▁a▁", "<s> </s><unk>", "<0x41> <0x0A>", "\x00a \x00",
       "🙂🙂 é😀 日本", "ﬁ Ａ", "﻿ x", "a b　c", "x" * 5000, " " * 70, "▁" * 40 + "q", "�", "\t\t a\r\n"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def expected(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    decoded = library.decode(ids)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest()), ids, decoded


def test_chunks_alone_give_the_ids_of_the_whole_text(library, monkeypatch):
    rng = random.Random(1)
    parts = ["a", "b", "the ", "  ", " ", "▁", "é", "\n", "🙂", "日", "ing", "0x", "<", ">", "\x00", "1234"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    own = pieces.Pieces(open(MODEL, "rb").read())
    for limit in (1 << 20, 5):  # 5: every text is a long one, cut into parts
        monkeypatch.setattr(pieces, "PART", limit)
        for t in texts:
            chunks = [c for part in pieces.chunks_of(t) for c in part]
            ids = own.segment(chunks) if chunks else []
            assert [i for x in ids for i in x] == library.encode(t)
            assert " ".join(own.spell(ids)) == library.decode([1, *library.encode(t), 2])


def test_documents_match_the_library(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = sorted((r.doc_id, *expected(library, r.text)[0]) for r in docs.collect())
    for args in ({}, {"block_bytes": 20_000, "shard_bytes": 3_000}):
        assert sorted(map(tuple, pieces.encode_pieces(docs, MODEL, **args).collect())) == want


def test_odd_rows_ids_and_texts(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, None), (7, "same"), (7, "same"), (99, "word " * 300_000)]
    df = spark.createDataFrame([(*r, "z", "z") for r in rows], "doc_id long, text string, block string, ids string")
    out = pieces.encode_pieces(df, MODEL, with_ids=True, block_bytes=100).collect()
    key = lambda r: (str(r[0]), r[2], r[1])
    want = []
    for i, t in rows:
        digests, ids, decoded = expected(library, t)
        want.append((i, *digests, ids, decoded))
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    assert pieces.encode_pieces(spark.createDataFrame([], df.schema), MODEL).collect() == []


def test_a_model_that_changes_or_crosses_words_is_an_error(monkeypatch):
    class Model:
        def __init__(self, model_proto):
            self.pieces, self.folds = {b"crossing": ["▁a▁b"], b"folding": ["▁a"]}[model_proto], model_proto == b"folding"

        def get_piece_size(self):
            return len(self.pieces)

        def id_to_piece(self, i):
            return self.pieces[i]

        def normalize(self, text):
            return text.lower() if self.folds else "▁" + text.replace(" ", "▁")

    monkeypatch.setattr(pieces.sentencepiece, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError, match="crosses"):
        pieces.check_model(b"crossing")
    with pytest.raises(ValueError, match="changes"):
        pieces.check_model(b"folding")
